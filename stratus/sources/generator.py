"""Distributed synthetic observation generator.

Rows are produced on the executors: a (station, start, end) skeleton is
exploded into one row per day with ``sequence``. Nothing is built in a
driver loop, so a long range or many stations scale with the cluster.

Random values are counter-based: each station-day has one SHA-256 of
``station|yyyy-MM-dd|seed``, and every draw is five of its hex digits mapped to
[0, 1). A station-day therefore gets the same values whatever the partitioning
(and in any engine that has SHA-256), and a task recomputed after an executor
loss reproduces exactly the rows it produced before (a positional ``rand``
after a shuffle would not).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .bronze_csv import validate_iso_date


def station_code(station_id: str) -> str:
    """``GHCND:USW00014735`` -> ``USW00014735`` (the namespace is dropped)."""
    return station_id.rsplit(":", 1)[-1]


_DRAW_DIGITS = 5  # hex digits of a draw; the 64 digits of a hash give 12 draws


def _draw(n: int) -> Column:
    """Uniform double in [0, 1): the n-th draw (from 1) of the station-day's hash ``h``."""
    digits = F.substring("h", _DRAW_DIGITS * (n - 1) + 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** _DRAW_DIGITS))


def _uniform_int(low: int | Column, high: int | Column, u: Column) -> Column:
    """Uniform integer in the inclusive range [low, high] from a [0, 1) draw."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (low + F.floor(u * (high - low + 1))).cast("int")


def generate_from_skeleton(skeleton: DataFrame, seed: int = 42) -> DataFrame:
    """Bronze rows for every day of each ``(station, start_date, end_date)`` row."""
    days = skeleton.select(
        F.col("station"),
        F.explode(F.sequence(F.col("start_date"), F.col("end_date"),
                             F.expr("INTERVAL 1 DAY"))).alias("d"),
    )
    key = F.concat_ws("|", "station", F.date_format("d", "yyyy-MM-dd"), F.lit(str(seed)))
    days = days.withColumn("h", F.sha2(key, 256))
    tmax_lo, tmax_hi = config.GEN_TMAX_RANGE
    values = days.select(
        "station", "d",
        _uniform_int(tmax_lo, tmax_hi, _draw(1)).alias("tmax"),
        _draw(2).alias("u_tmin"),
        F.when(_draw(3) < config.GEN_PRCP_PROBABILITY,
               _uniform_int(*config.GEN_PRCP_RANGE, _draw(4))).otherwise(0).alias("prcp"),
        F.when(_draw(5) < config.GEN_SNOW_PROBABILITY,
               _uniform_int(*config.GEN_SNOW_RANGE, _draw(6))).otherwise(0).alias("snow"),
        _draw(7).alias("u_snwd"),
        _uniform_int(*config.GEN_AWND_RANGE, _draw(8)).alias("awnd"),
        _draw(9).alias("b_tmax"),
        _draw(10).alias("b_tmin"),
        _draw(11).alias("b_prcp"),
    )
    tmin_hi = F.col("tmax") - F.lit(config.GEN_TMIN_GAP)
    tmin = (F.lit(config.GEN_TMIN_LOW)
            + F.floor(F.col("u_tmin") * (tmin_hi - config.GEN_TMIN_LOW + 1))).cast("int")
    snwd_lo, snwd_hi = config.GEN_SNWD_RANGE
    snwd = F.when(F.col("snow") > 0,
                  (snwd_lo + F.floor(F.col("u_snwd") * (snwd_hi - snwd_lo + 1))).cast("int")
                  ).otherwise(0)

    def blank_if(u: str, p: float, v: Column) -> Column:
        return F.when(F.col(u) < p, F.lit("")).otherwise(v.cast("string"))

    return values.select(
        F.date_format("d", "yyyy-MM-dd").alias("DATE"),
        F.col("station").alias("STATION"),
        blank_if("b_tmax", config.GEN_BLANK_TMAX, F.col("tmax")).alias("TMAX"),
        blank_if("b_tmin", config.GEN_BLANK_TMIN, tmin).alias("TMIN"),
        blank_if("b_prcp", config.GEN_BLANK_PRCP, F.col("prcp")).alias("PRCP"),
        F.col("snow").cast("string").alias("SNOW"),
        snwd.cast("string").alias("SNWD"),
        F.col("awnd").cast("string").alias("AWND"),
    )


def generate_observations(spark: SparkSession, start_date: str, end_date: str,
                          stations: tuple[str, ...] | list[str] = (config.DEFAULT_STATION_ID,),
                          seed: int = 42) -> DataFrame:
    """One bronze row per station and day in ``[start_date, end_date]``."""
    validate_iso_date(start_date)
    validate_iso_date(end_date)
    start = _dt.date.fromisoformat(start_date)
    end = _dt.date.fromisoformat(end_date)
    if start > end:
        raise ValueError("Start date must be before end date")
    skeleton = spark.createDataFrame(
        [(station_code(s), start, end) for s in stations],
        "station string, start_date date, end_date date",
    )
    return generate_from_skeleton(skeleton, seed)


def skeleton_from_silver(silver: DataFrame) -> DataFrame:
    """Per-station observed date span, computed with one partial aggregate."""
    return silver.groupBy("station").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )
