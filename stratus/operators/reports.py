"""Reporting aggregates over gold (and a few over silver).

Every report is one hash aggregate with map-side partial aggregation over its
grouping keys; label columns are ``CASE`` chains evaluated in the same
projection. Conditional counts are ``sum(CASE ...)`` (BIGINT) and shares are
DOUBLE arithmetic.

All functions take and return DataFrames and trigger no job; ordering is
applied last so that the optimizer can drop it where a consumer does not need
it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import labels
from ..functions.cleaning import exact_mean

T = "avg_temperature"
P = "total_precipitation"
W = "avg_wind_speed"


def _r1(c: Column) -> Column:
    return F.round(c, 1)


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * F.lit(100.0) / whole.cast("double")


def monthly_summary(gold: DataFrame) -> DataFrame:
    """Per (year, month): day count, mean temperature, total precipitation, mean wind."""
    return (
        gold.groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("days_count"),
            _r1(exact_mean(T)).alias("avg_temp_celsius"),
            _r1(F.sum(P)).alias("total_precipitation_mm"),
            _r1(exact_mean(W)).alias("avg_wind_speed"),
        )
        .select("year", "month", labels.month_name("month").alias("month_name"),
                "days_count", "avg_temp_celsius", "total_precipitation_mm", "avg_wind_speed")
        .orderBy("year", "month")
    )


def temperature_extremes(gold: DataFrame, hot: float = config.HOT_DAY_MIN,
                         freezing: float = config.FREEZING_DAY_BELOW) -> DataFrame:
    """Days at or above ``hot`` or below ``freezing``, hottest first."""
    return (
        gold.where((F.col(T) >= hot) | (F.col(T) < freezing))
        .select("date", "station", T, labels.temperature_category(T).alias("temperature_category"))
        .orderBy(F.col(T).desc(), "station", "date")
    )


def precipitation_analysis(gold: DataFrame) -> DataFrame:
    rainy = F.col(P) > config.RAINY_DAY_ABOVE
    return (
        gold.groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("total_days"),
            _count_if(rainy).alias("rainy_days"),
            _r1(_percent(_count_if(rainy), F.count(F.lit(1)))).alias("rainy_day_percentage"),
            _r1(exact_mean(P)).alias("avg_daily_precipitation"),
            _r1(F.max(P)).alias("max_daily_precipitation"),
        )
        .orderBy("month")
    )


def monthly_dashboard(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("total_days"),
            _r1(exact_mean(T)).alias("avg_temperature"),
            _r1(F.min(T)).alias("min_temperature"),
            _r1(F.max(T)).alias("max_temperature"),
            _r1(F.sum(P)).alias("total_precipitation"),
            _count_if(F.col(P) > config.RAINY_DAY_ABOVE).alias("rainy_days"),
            _count_if(F.col(T) < config.FREEZING_DAY_BELOW).alias("freezing_days"),
            _count_if(F.col(T) >= config.HOT_DAY_MIN).alias("hot_days"),
            _r1(exact_mean(W)).alias("avg_wind_speed"),
        )
        .select("month", labels.month_name("month").alias("month_name"), "total_days",
                "avg_temperature", "min_temperature", "max_temperature",
                "total_precipitation", "rainy_days", "freezing_days", "hot_days",
                "avg_wind_speed")
        .orderBy("month")
    )


def station_performance(gold: DataFrame) -> DataFrame:
    """Per station: data points, mean and sample stddev of temperature, climate label.

    The climate label is computed on the rounded mean.
    """
    return (
        gold.groupBy("station")
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            _r1(exact_mean(T)).alias("avg_temp"),
            _r1(F.stddev_samp(T)).alias("temp_variability"),
            _r1(F.sum(P)).alias("total_precip"),
            _r1(exact_mean(W)).alias("avg_wind"),
        )
        .withColumn("climate_category", labels.climate_category("avg_temp"))
        .orderBy(F.col("avg_temp").desc(), "station")
    )


def seasonal_trends(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("days"),
            _r1(exact_mean(T)).alias("avg_temp"),
            _r1(F.sum(P)).alias("total_precip"),
            _r1(exact_mean(W)).alias("avg_wind"),
            _r1(F.max(T) - F.min(T)).alias("temp_range"),
        )
        .select("month", labels.season("month").alias("season"), "days", "avg_temp",
                "total_precip", "avg_wind", "temp_range")
        .orderBy("month")
    )


def pattern_distribution(gold: DataFrame) -> DataFrame:
    """Occurrences of each weather pattern and its share of all days.

    The share uses a window over the aggregated result, which holds one row
    per pattern (at most six rows), so the single-partition window is bounded.
    """
    patterned = gold.select(T, P, labels.weather_pattern(T, P, "total_snow").alias("weather_pattern"))
    counted = patterned.groupBy("weather_pattern").agg(
        F.count(F.lit(1)).alias("occurrences"),
        _r1(exact_mean(T)).alias("avg_temp_for_pattern"),
        _r1(exact_mean(P)).alias("avg_precip_for_pattern"),
    )
    everything = Window.partitionBy()
    return counted.select(
        "weather_pattern",
        "occurrences",
        _r1(_percent(F.col("occurrences"), F.sum("occurrences").over(everything))).alias("percentage"),
        "avg_temp_for_pattern",
        "avg_precip_for_pattern",
    ).orderBy(F.col("occurrences").desc(), "weather_pattern")


def station_month_stats(gold: DataFrame) -> DataFrame:
    """Per (station, month): unrounded mean temperature and total precipitation."""
    return gold.groupBy("station", "month").agg(
        exact_mean(T).alias("monthly_avg_temp"),
        F.sum(P).alias("monthly_total_precip"),
    )


def station_month_rank(gold: DataFrame) -> DataFrame:
    """Rank stations within each month by mean temperature and by precipitation.

    The window input is the (station, month) aggregate: at most
    ``stations x 12`` rows, partitioned by month.
    """
    stats = station_month_stats(gold)
    by_month = Window.partitionBy("month")
    return stats.select(
        "station",
        "month",
        _r1(F.col("monthly_avg_temp")).alias("avg_temp"),
        _r1(F.col("monthly_total_precip")).alias("total_precip"),
        F.rank().over(by_month.orderBy(F.col("monthly_avg_temp").desc_nulls_last()))
        .alias("temp_rank"),
        F.rank().over(by_month.orderBy(F.col("monthly_total_precip").desc_nulls_last()))
        .alias("precip_rank"),
    ).orderBy("month", "temp_rank", "station")


def latest_days(gold: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most recent station-days (top-k; ties broken by station)."""
    return (
        gold.select("date", "station", T, P)
        .orderBy(F.col("date").desc(), F.col("station").asc())
        .limit(n)
    )


def year_month_summary(silver: DataFrame,
                       divisor: float = config.TEMPERATURE_DIVISOR) -> DataFrame:
    """Per ``yyyy-MM``: mean max and min temperature (°C) and total precipitation.

    Means are taken on the integer tenths and converted (exact in any order).
    """
    tmax = (F.avg("tmax") / F.lit(float(divisor))) if "tmax" in silver.columns else F.avg("tmax_celsius")
    tmin = (F.avg("tmin") / F.lit(float(divisor))) if "tmin" in silver.columns else F.avg("tmin_celsius")
    return (
        silver.groupBy(labels.year_month("date").alias("year_month"))
        .agg(tmax.alias("avg_max_temp"), tmin.alias("avg_min_temp"),
             F.sum("prcp").alias("total_precipitation"))
        .orderBy("year_month")
    )


def daily_precipitation(silver: DataFrame) -> DataFrame:
    """Per (date, station): summed precipitation and number of raw records."""
    return (
        silver.groupBy("date", "station")
        .agg(F.sum("prcp").alias("total_precipitation"),
             F.count(F.lit(1)).alias("record_count"))
        .orderBy("date", "station")
    )


def temperature_bands(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per row: Hot / Moderate / Cold on the daily maximum (strict bounds), hottest first.

    The other output columns break ties, so that the rows of one hot day or
    station spread over several range partitions. ``ordered=False``: as they come.
    """
    out = silver.select(
        "date", "station", "tmax_celsius", "tmin_celsius",
        labels.temperature_band3("tmax_celsius").alias("temp_category"),
    )
    return out.orderBy(F.col("tmax_celsius").desc_nulls_last(), "station", "date", "tmin_celsius") if ordered else out


def dataset_span(gold: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct stations, first and last date, in one aggregate."""
    stations = (F.approx_count_distinct("station") if approximate
                else F.count_distinct("station"))
    return gold.agg(
        F.count(F.lit(1)).alias("record_count"),
        stations.cast("bigint").alias("station_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def distinct_months(gold: DataFrame) -> DataFrame:
    return gold.select("year", "month").distinct().orderBy("year", "month")
