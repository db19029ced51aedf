"""All run metrics of a bronze input in one exact aggregate.

One global aggregate over the typed bronze rows yields, in a single row:

* the validation measures of bronze (:func:`quality.measure_columns`),
* bronze stage statistics (rows, missing values of the required columns),
* silver stage statistics and the silver column profile, evaluated on the
  rows the silver filter keeps (``count_if(keep AND ...)``), so silver does
  not need a second pass.

Unlike ``Observation`` metrics, which are accumulators and can count twice
when a shuffle-map stage is re-run after an executor loss, an aggregate's
result is exact under retries: the reducers read every map output once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from .. import config
from ..config import DEFAULT_RULES, ValidationRules
from ..functions.cleaning import is_missing
from . import quality
from .silver import KEEP_NULL_TEMPS, SILVER_ORDER, derived_fields, keep_condition, typed_fields

STAGE_COLUMNS = ("date", "station", "tmax", "tmin")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def run_measures(bronze: DataFrame, *, on_missing: str = KEEP_NULL_TEMPS,
                 rules: ValidationRules = DEFAULT_RULES,
                 divisor: float = config.TEMPERATURE_DIVISOR) -> DataFrame:
    """One row with every bronze and silver measure (one scan, exact)."""
    typed = typed_fields(bronze)
    proj = bronze.select(*[F.col(c) for c in bronze.columns],
                         *[e.alias(f"__s_{k}") for k, e in typed.items()])

    def col(name: str) -> Column:
        return F.col(f"__s_{name}")

    keep = keep_condition(col, on_missing)
    derived = derived_fields(col, divisor)
    silver = {n: (derived[n] if n in derived else col(n)) for n in SILVER_ORDER}
    aggs = quality.measure_columns(bronze, rules)
    aggs.append(_count_if(keep).alias("silver__rows"))
    for n, c in silver.items():
        aggs.append(_count_if(keep & c.isNotNull()).alias(f"silver__count__{n}"))
    for n in STAGE_COLUMNS:
        dtype = StringType() if n == "station" else DateType()
        aggs.append(_count_if(keep & is_missing(silver[n], dtype)).alias(f"silver__missing__{n}"))
    return proj.agg(*aggs)


def stage_rows(bronze: DataFrame, m: Row, rules: ValidationRules = DEFAULT_RULES) -> list[tuple]:
    """Stage statistics rows (see ``profile.STAGE_STATS_SCHEMA``) from the measure row."""
    out = []
    n = int(m["row_count"] or 0)
    for c in rules.required_columns:
        key = f"missing__{c}"
        if key in m.asDict():
            miss = int(m[key] or 0)
            out.append(("bronze", n, len(bronze.columns), c, miss, (miss * 100.0 / n) if n else None))
    s = int(m["silver__rows"] or 0)
    for c in STAGE_COLUMNS:
        miss = int(m[f"silver__missing__{c}"] or 0)
        out.append(("silver", s, len(SILVER_ORDER), c, miss, (miss * 100.0 / s) if s else None))
    return out


def profile_rows(m: Row) -> list[tuple]:
    """Silver column profile rows (column, count, nulls, null %) from the measure row."""
    s = int(m["silver__rows"] or 0)
    out = []
    for c in SILVER_ORDER:
        cnt = int(m[f"silver__count__{c}"] or 0)
        out.append((c, cnt, s - cnt, ((s - cnt) * 100.0 / s) if s else None))
    return out


def measure_values(m: Row, bronze: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> dict:
    """The validation measures (the fields of ``quality.quality_measures``)."""
    names = [f.name for f in quality.quality_measures(bronze, rules).schema.fields]
    return {k: m[k] for k in names}
