"""Per-station time-series windows over gold.

All window expressions share one specification (partition by station, order
by date), so Spark plans a single exchange, a single sort and a single Window
node for lag, lead, the day-over-day change and both rolling frames.

Windows always carry a partition key. Gold holds one row per station and
day, so the largest window partition is bounded by the number of calendar
days in the data (about 36,500 rows for a century), however skewed the raw
rows per station are. Frames are ROWS frames (rows, not calendar days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config

T = "avg_temperature"
P = "total_precipitation"


def station_window(partition: str = "station", order: str = "date"):
    return Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_first())


def previous_value(c: str, w=None) -> Column:
    return F.lag(c, 1).over(w or station_window())


def next_value(c: str, w=None) -> Column:
    return F.lead(c, 1).over(w or station_window())


def change(c: str, w=None) -> Column:
    """Value minus the previous row's value; NULL on the first row."""
    return F.col(c) - previous_value(c, w)


def rolling_avg(c: str, rows: int = config.ROLLING_MEAN_ROWS, w=None) -> Column:
    """Mean of this row and the ``rows - 1`` rows before it (short at the start)."""
    return F.avg(c).over((w or station_window()).rowsBetween(-(rows - 1), Window.currentRow))


def rolling_sum(c: str, rows: int = config.ROLLING_SUM_ROWS, w=None) -> Column:
    return F.sum(c).over((w or station_window()).rowsBetween(-(rows - 1), Window.currentRow))


def with_time_series(gold: DataFrame) -> DataFrame:
    """Previous / next day, change, 3-row mean temperature, 7-row precipitation."""
    w = station_window()
    return gold.select(
        "date", "station", T, P,
        previous_value(T, w).alias("prev_day_temp"),
        next_value(T, w).alias("next_day_temp"),
        change(T, w).alias("temp_change"),
        rolling_avg(T, config.ROLLING_MEAN_ROWS, w).alias("rolling_3day_avg"),
        rolling_sum(P, config.ROLLING_SUM_ROWS, w).alias("rolling_7day_precip"),
    )


def station_timeseries(gold: DataFrame, station: str, n: int = 10) -> DataFrame:
    """Time-series view of one station: its first ``n`` days.

    The station predicate is on the window's partition key, so the optimizer
    pushes it below the window (and into the Parquet scan when gold is read
    from storage).
    """
    return (
        with_time_series(gold.where(F.col("station") == station))
        .orderBy("date")
        .limit(n)
    )


def daily_change(gold: DataFrame) -> DataFrame:
    w = station_window()
    return gold.select(
        "date", "station", T,
        previous_value(T, w).alias("prev_day_temp"),
        change(T, w).alias("temp_change"),
    )


def rolling_metrics(gold: DataFrame) -> DataFrame:
    w = station_window()
    return gold.select(
        "date", "station", T, P,
        rolling_avg(T, config.ROLLING_MEAN_ROWS, w).alias("rolling_3day_avg"),
        rolling_sum(P, config.ROLLING_SUM_ROWS, w).alias("rolling_7day_precip"),
    )
