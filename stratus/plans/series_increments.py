"""Time series that grow by deliveries: each one reads its own rows and a few border rows per station.

Every delivery writes one folder ``key=<key>``. It holds the rows of the series
that are ``closed``, which means that their next day is known, and each station's
last rows, the border, which the next delivery's frames reach back to. The last
row of a station is ``open``: its next value is unknown until a later delivery
closes it. Border rows bring along what was worked out for them, so no frame is
ever filled from part of its rows. A delivery thus costs its own rows and
``BORDER`` rows per station, however long the series is.

Deliveries come in the order of their keys, and a station's rows after those it
has. A delivery that is run again replaces its folder; a folder whose writing did
not end is not read. A row not later than the station's last one, or a key before
one that is there, is an error: the folders after it would have to be made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import timeseries
from ..operators.timeseries import P, T
from ..session import remove_path

BORDER = max(config.ROLLING_SUM_ROWS, config.ROLLING_MEAN_ROWS) - 1
SERIES = ["date", "station", T, P, "prev_day_temp", "next_day_temp", "temp_change", "rolling_3day_avg", "rolling_7day_precip"]
_STORED = (f"date date, station string, {T} double, {P} double, prev_day_temp double, next_day_temp double, temp_change double, "
           "rolling_3day_avg double, rolling_7day_precip double, closed boolean, open boolean, border boolean, late boolean, key string")


def delivered(spark: SparkSession, path: str) -> list[str]:
    """Keys of the deliveries that were written to the end, in order."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = fs_path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n[len("key="):] for n in names if n.startswith("key=") and fs.exists(fs_path(f"{path}/{n}/_SUCCESS")))


def _stored(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    return spark.read.schema(_STORED).option("basePath", path).parquet(*(f"{path}/key={k}" for k in keys))


def _extended(days: DataFrame, border: DataFrame | None) -> DataFrame:
    """Rows to store for ``days``, which follow the ``border`` rows of their stations."""
    rows = days.select("date", "station", T, P, F.lit(True).alias("new"))
    if border is not None:
        held = [c for c in SERIES if c not in rows.columns] + ["open"]
        rows = rows.unionByName(border.select("date", "station", T, P, F.lit(False).alias("new"),
                                              *(F.col(c).alias(f"{c}__held") for c in held)), allowMissingColumns=True)
    else:
        rows = rows.withColumn("open__held", F.lit(None).cast("boolean"))
    w = timeseries.station_window()
    worked = {
        "prev_day_temp": timeseries.previous_value(T, w), "temp_change": timeseries.change(T, w),
        "rolling_3day_avg": timeseries.rolling_avg(T, config.ROLLING_MEAN_ROWS, w),
        "rolling_7day_precip": timeseries.rolling_sum(P, config.ROLLING_SUM_ROWS, w)}
    out = rows.select("*", *(c.alias(name) for name, c in worked.items()), timeseries.next_value(T, w).alias("next_day_temp"),
                      F.lead("new", 1).over(w).alias("next_new"), F.lead("date", 1).over(w).alias("next_date"),
                      F.lead("new", BORDER).over(w).isNull().alias("border"))
    if border is not None:
        for name in worked:
            out = out.withColumn(name, F.when(F.col("new"), F.col(name)).otherwise(F.col(f"{name}__held")))
    last = F.col("next_new").isNull()
    to_publish = F.col("new") | F.coalesce("open__held", F.lit(False))
    late = (F.col("new") & ~F.col("next_new")) | ((F.col("new") != F.col("next_new")) & F.col("date").eqNullSafe(F.col("next_date")))
    return out.select(*SERIES, (to_publish & ~last).alias("closed"), last.alias("open"), "border",
                      F.coalesce(late, F.lit(False)).alias("late")).where("closed OR border OR late")


def add_days(spark: SparkSession, days: DataFrame, key: str, path: str) -> None:
    """Add the gold rows of one delivery; ``key`` sorts after those that are there (or is the last one, run again)."""
    path = path.rstrip("/")
    done = delivered(spark, path)
    if done and key < done[-1]:
        raise ValueError(f"delivery {key!r} comes before {done[-1]!r}, which is there")
    before = [k for k in done if k < key]
    border = _stored(spark, path, before[-1:]).where("border") if before else None
    folder = f"{path}/key={key}"
    _extended(days, border).write.mode("overwrite").parquet(folder)
    late = _stored(spark, path, [key]).where("late").select("station", "date").first()
    if late is not None:
        remove_path(spark, folder)
        raise ValueError(f"station {late.station!r} already has rows from {late.date} on")


def series(spark: SparkSession, path: str) -> DataFrame:
    """The time series over all deliveries, as :func:`timeseries.with_time_series` gives it over all rows."""
    path = path.rstrip("/")
    keys = delivered(spark, path)
    if not keys:
        raise ValueError(f"no delivery below {path}")
    return _stored(spark, path, keys).where(F.col("closed") | (F.col("open") & (F.col("key") == keys[-1]))).select(*SERIES)
