"""Bronze -> silver: typed, cleaned observations (one projection + one filter).

Silver layout (see :data:`stratus.config.SILVER_SCHEMA`): date, station,
year, month, day, the six numeric fields in raw units (``tmax`` and ``tmin``
in tenths of a degree) and the Celsius columns ``tmax_celsius``,
``tmin_celsius`` and ``tavg_celsius``.

Cleaning never raises on bad text: blanks and malformed numbers become NULL
(``try_cast``), malformed dates become NULL (shape check + ``try_cast``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.cleaning import is_missing, mean_of_tenths, numeric_or_null, parse_date, tenths_to_celsius

KEEP_NULL_TEMPS = "keep_null_temps"
DROP_MISSING_TEMPS = "drop_missing_temps"
AS_CODED_ROWS = "as_coded"


def _field(df: DataFrame, name: str):
    lowered = {c.lower(): c for c in df.columns}
    if name.lower() in lowered:
        return F.col(lowered[name.lower()])
    return F.lit(None).cast("string")


SILVER_ORDER = ("date", "station", "year", "month", "day", "tmax", "tmin", "prcp", "snow", "snwd",
                "awnd", "tmax_celsius", "tmin_celsius", "tavg_celsius")


def typed_fields(bronze: DataFrame) -> dict[str, Column]:
    """Typed key and measure expressions of silver, before any row is dropped."""
    fields = {
        "date": parse_date(_field(bronze, "DATE")),
        "station": F.nullif(_field(bronze, "STATION"), F.lit("")),
    }
    for c in config.NUMERIC_COLUMNS:
        fields[c.lower()] = numeric_or_null(_field(bronze, c))
    return fields


def derived_fields(col: Callable[[str], Column],
                   divisor: float = config.TEMPERATURE_DIVISOR) -> dict[str, Column]:
    """Calendar parts and Celsius columns from the typed fields (``col(name)``)."""
    return {
        "year": F.year(col("date")),
        "month": F.month(col("date")),
        "day": F.dayofmonth(col("date")),
        "tmax_celsius": tenths_to_celsius(col("tmax"), divisor),
        "tmin_celsius": tenths_to_celsius(col("tmin"), divisor),
        "tavg_celsius": mean_of_tenths(col("tmax"), col("tmin"), divisor),
    }


def keep_condition(col: Callable[[str], Column], on_missing: str = KEEP_NULL_TEMPS) -> Column:
    """Which typed rows become silver rows."""
    if on_missing not in (KEEP_NULL_TEMPS, DROP_MISSING_TEMPS, AS_CODED_ROWS):
        raise ValueError(f"unknown on_missing mode: {on_missing!r}")
    if on_missing == AS_CODED_ROWS:
        return col("tmax").isNotNull() & col("tmin").isNotNull()
    keep = col("date").isNotNull() & col("station").isNotNull()
    if on_missing == DROP_MISSING_TEMPS:
        keep = keep & col("tmax").isNotNull() & col("tmin").isNotNull()
    return keep


def clean_observations(bronze: DataFrame, *, on_missing: str = KEEP_NULL_TEMPS,
                       divisor: float = config.TEMPERATURE_DIVISOR, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed silver rows from bronze rows, with the bronze columns ``carry`` after them.

    ``on_missing``:
      * ``keep_null_temps`` (default): drop only rows without a usable key
        (date that does not parse, or no station); NULL measures stay.
      * ``drop_missing_temps``: additionally drop rows whose TMAX or TMIN is
        missing.
      * ``as_coded``: drop rows whose TMAX or TMIN is missing, and only those;
        unusable keys stay as NULL.
    """
    keep = keep_condition(F.col, on_missing)
    typed = bronze.select(*[e.alias(k) for k, e in typed_fields(bronze).items()], *carry)
    derived = derived_fields(F.col, divisor)
    return typed.where(keep).select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in SILVER_ORDER], *carry
    )


def rejected_rows(bronze: DataFrame) -> DataFrame:
    """The raw rows that silver drops for want of a key, with the reason."""
    date, station = _field(bronze, "DATE"), _field(bronze, "STATION")
    reason = F.concat_ws(
        "; ",
        F.when(is_missing(date), F.lit("DATE missing")).when(parse_date(date).isNull(), F.lit("DATE not a calendar day")),
        F.when(is_missing(station), F.lit("STATION missing")))
    return bronze.withColumn("reason", reason).where("reason <> ''")
