"""Silver -> gold: one row per station and day.

The aggregate is a hash aggregate with map-side partial aggregation, so a
station that holds a large share of all rows costs one partial row per task
and day, not a hot reducer. The shuffle is on (date, station).

Temperature means are computed on the integer-valued tenths and converted
afterwards (``avg(tmax) / 10`` equals ``avg(tmax / 10)``). Sums of integers
are exact in any order, so the result does not depend on how rows are split
across tasks; the mean of pre-divided values would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

GOLD = "gold"
AS_CODED = "as_coded"


def _mean_celsius(df: DataFrame, tenths: str, celsius: str, divisor: float) -> Column:
    if tenths in df.columns:
        return F.avg(tenths) / F.lit(float(divisor))
    return F.avg(celsius)


def _mean_midpoint(df: DataFrame, divisor: float) -> Column:
    if "tmax" in df.columns and "tmin" in df.columns:
        return F.avg(F.col("tmax") + F.col("tmin")) / F.lit(2.0 * divisor)
    return F.avg("tavg_celsius")


def daily_gold(silver: DataFrame, *, dialect: str = GOLD,
               divisor: float = config.TEMPERATURE_DIVISOR) -> DataFrame:
    """Aggregate silver to one row per (date, station).

    ``dialect="gold"``: date, station, year, month, day, avg_tmax, avg_tmin,
    avg_temperature (°C, 1 dp), total_precipitation, total_snow (raw sums),
    avg_wind_speed (1 dp).

    ``dialect="as_coded"``: averages of the raw tenths as avg_max_temp and
    avg_min_temp, with the same sums and wind, plus year and month.
    """
    t_prec = config.TEMPERATURE_PRECISION
    w_prec = config.WIND_PRECISION
    keyed = silver.withColumn("date", F.col("date").cast("date"))
    if dialect == AS_CODED:
        agg = keyed.groupBy("date", "station").agg(
            F.round(F.avg("tmax"), t_prec).alias("avg_max_temp"),
            F.round(F.avg("tmin"), t_prec).alias("avg_min_temp"),
            F.sum("prcp").alias("total_precipitation"),
            F.sum("snow").alias("total_snow"),
            F.round(F.avg("awnd"), w_prec).alias("avg_wind_speed"),
        )
        return agg.withColumns({"year": F.year("date"), "month": F.month("date")})
    if dialect != GOLD:
        raise ValueError(f"unknown gold dialect: {dialect!r}")
    agg = keyed.groupBy("date", "station").agg(
        F.round(_mean_celsius(silver, "tmax", "tmax_celsius", divisor), t_prec).alias("avg_tmax"),
        F.round(_mean_celsius(silver, "tmin", "tmin_celsius", divisor), t_prec).alias("avg_tmin"),
        F.round(_mean_midpoint(silver, divisor), t_prec).alias("avg_temperature"),
        F.sum("prcp").cast("double").alias("total_precipitation"),
        F.sum("snow").cast("double").alias("total_snow"),
        F.round(F.avg("awnd"), w_prec).alias("avg_wind_speed"),
    )
    return agg.select(
        "date", "station",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        "avg_tmax", "avg_tmin", "avg_temperature",
        "total_precipitation", "total_snow", "avg_wind_speed",
    )
