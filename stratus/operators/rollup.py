"""The report suite from one pass over gold.

``suite_partials`` aggregates gold once, by (year, month, station, weather
pattern), into counts, extremes and exact sums that can be added up again. Every
aggregated report is then a roll-up of these few rows, and equal row by row to
the same report worked out from gold. Partials of disjoint days may be put
together (``union``) before a roll-up, so the ones of old months can be kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import labels
from ..functions.cleaning import PARTS, exact_parts, exact_total
from .quality import REPORT_METRICS
from .reports import P, T, W

KEYS = ("year", "month", "station", "weather_pattern")
MEASURES = (T, P, W)
_SQUARE = "temperature_square"
_SUMMED = {T: T, P: P, W: W, _SQUARE: T}


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _r1(c: Column) -> Column:
    return F.round(c, 1)


def suite_partials(gold: DataFrame, rules=config.REPORT_RANGE_RULES) -> DataFrame:
    """One row per (year, month, station, weather pattern) with everything that the aggregated reports add up."""
    by_column = {r.column: r for r in rules}
    rows = gold.select("date", "year", "month", "station", *MEASURES,
                       labels.weather_pattern(T, P, "total_snow").alias("weather_pattern"))
    aggs = [F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
            _count_if(F.col(P) > config.RAINY_DAY_ABOVE).alias("rainy"),
            _count_if(F.col(T) < config.FREEZING_DAY_BELOW).alias("freezing"),
            _count_if(F.col(T) >= config.HOT_DAY_MIN).alias("hot")]
    for m in MEASURES:
        r = by_column[m]
        aggs += [F.count(m).alias(f"count_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}"),
                 _count_if((F.col(m) < r.low) | (F.col(m) > r.high)).alias(f"outliers_{m}")]
    for name, m in _SUMMED.items():
        value = F.col(m) * F.col(m) if name == _SQUARE else F.col(m)
        aggs += [F.sum(part).alias(f"sum{k}_{name}") for k, part in enumerate(exact_parts(value))]
    return rows.groupBy(*KEYS).agg(*aggs)


def _total(name: str) -> Column:
    return exact_total([F.sum(f"sum{k}_{name}") for k in range(PARTS)])


def _count(m: str) -> Column:
    return F.sum(f"count_{m}")


def _sum(m: str) -> Column:
    return F.when(_count(m) > 0, _total(m))


def _mean(m: str) -> Column:
    return F.when(_count(m) > 0, _total(m) / _count(m))


def _deviation(m: str, square: str) -> Column:
    """Sample standard deviation from the exact sums of the values and their squares."""
    n = _count(m)
    spread = (_total(square) - _total(m) * _total(m) / n) / (n - 1)
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0))))


def _days() -> Column:
    return F.sum("n")


def _share(part: Column, whole: Column) -> Column:
    return _r1(part.cast("double") * F.lit(100.0) / whole.cast("double"))


def monthly_summary(p: DataFrame) -> DataFrame:
    return p.groupBy("year", "month").agg(
        _days().alias("days_count"), _r1(_mean(T)).alias("avg_temp_celsius"), _r1(_sum(P)).alias("total_precipitation_mm"),
        _r1(_mean(W)).alias("avg_wind_speed")).select(
        "year", "month", labels.month_name("month").alias("month_name"), "days_count", "avg_temp_celsius",
        "total_precipitation_mm", "avg_wind_speed").orderBy("year", "month")


def precipitation_analysis(p: DataFrame) -> DataFrame:
    return p.groupBy("month").agg(
        _days().alias("total_days"), F.sum("rainy").alias("rainy_days"),
        _share(F.sum("rainy"), _days()).alias("rainy_day_percentage"), _r1(_mean(P)).alias("avg_daily_precipitation"),
        _r1(F.max(f"max_{P}")).alias("max_daily_precipitation")).orderBy("month")


def monthly_dashboard(p: DataFrame) -> DataFrame:
    return p.groupBy("month").agg(
        _days().alias("total_days"), _r1(_mean(T)).alias("avg_temperature"), _r1(F.min(f"min_{T}")).alias("min_temperature"),
        _r1(F.max(f"max_{T}")).alias("max_temperature"), _r1(_sum(P)).alias("total_precipitation"),
        F.sum("rainy").alias("rainy_days"), F.sum("freezing").alias("freezing_days"), F.sum("hot").alias("hot_days"),
        _r1(_mean(W)).alias("avg_wind_speed")).select(
        "month", labels.month_name("month").alias("month_name"), "total_days", "avg_temperature", "min_temperature",
        "max_temperature", "total_precipitation", "rainy_days", "freezing_days", "hot_days", "avg_wind_speed").orderBy("month")


def station_performance(p: DataFrame) -> DataFrame:
    return p.groupBy("station").agg(
        _days().alias("data_points"), _r1(_mean(T)).alias("avg_temp"), _r1(_deviation(T, _SQUARE)).alias("temp_variability"),
        _r1(_sum(P)).alias("total_precip"), _r1(_mean(W)).alias("avg_wind")).withColumn(
        "climate_category", labels.climate_category("avg_temp")).orderBy(F.col("avg_temp").desc(), "station")


def seasonal_trends(p: DataFrame) -> DataFrame:
    return p.groupBy("month").agg(
        _days().alias("days"), _r1(_mean(T)).alias("avg_temp"), _r1(_sum(P)).alias("total_precip"),
        _r1(_mean(W)).alias("avg_wind"), _r1(F.max(f"max_{T}") - F.min(f"min_{T}")).alias("temp_range")).select(
        "month", labels.season("month").alias("season"), "days", "avg_temp", "total_precip", "avg_wind",
        "temp_range").orderBy("month")


def pattern_distribution(p: DataFrame) -> DataFrame:
    """The share's window runs over one row per pattern."""
    counted = p.groupBy("weather_pattern").agg(
        _days().alias("occurrences"), _r1(_mean(T)).alias("avg_temp_for_pattern"), _r1(_mean(P)).alias("avg_precip_for_pattern"))
    return counted.select(
        "weather_pattern", "occurrences",
        _share(F.col("occurrences"), F.sum("occurrences").over(Window.partitionBy())).alias("percentage"),
        "avg_temp_for_pattern", "avg_precip_for_pattern").orderBy(F.col("occurrences").desc(), "weather_pattern")


def station_month_rank(p: DataFrame) -> DataFrame:
    stats = p.groupBy("station", "month").agg(_mean(T).alias("monthly_avg_temp"), _sum(P).alias("monthly_total_precip"))
    by_month = Window.partitionBy("month")
    return stats.select(
        "station", "month", _r1(F.col("monthly_avg_temp")).alias("avg_temp"),
        _r1(F.col("monthly_total_precip")).alias("total_precip"),
        F.rank().over(by_month.orderBy(F.col("monthly_avg_temp").desc_nulls_last())).alias("temp_rank"),
        F.rank().over(by_month.orderBy(F.col("monthly_total_precip").desc_nulls_last())).alias("precip_rank"),
    ).orderBy("month", "temp_rank", "station")


def _per_metric(p: DataFrame, aggs: list[Column], fields) -> DataFrame:
    """One row per metric from one aggregate."""
    return p.agg(*aggs).select(F.inline(F.array(*(F.struct(F.lit(label).alias("metric"), *fields(m)) for label, m in REPORT_METRICS))))


def completeness_report(p: DataFrame) -> DataFrame:
    aggs = [F.coalesce(_days(), F.lit(0)).alias("n"), *(F.coalesce(_count(m), F.lit(0)).alias(f"c_{m}") for m in MEASURES)]
    return _per_metric(p, aggs, lambda m: (
        F.col("n").alias("total_records"), F.col(f"c_{m}").alias("complete_records"),
        F.when(F.col("n") > 0, _share(F.col(f"c_{m}"), F.col("n"))).alias("completeness_percentage")))


def range_report(p: DataFrame) -> DataFrame:
    aggs = []
    for m in MEASURES:
        aggs += [F.min(f"min_{m}").alias(f"mn_{m}"), F.max(f"max_{m}").alias(f"mx_{m}"), _mean(m).alias(f"av_{m}"),
                 F.sum(f"outliers_{m}").alias(f"o_{m}")]
    return _per_metric(p, aggs, lambda m: (
        _r1(F.col(f"mn_{m}")).alias("min_value"), _r1(F.col(f"mx_{m}")).alias("max_value"),
        _r1(F.col(f"av_{m}")).alias("avg_value"), F.col(f"o_{m}").alias("outliers")))


def dataset_span(p: DataFrame) -> DataFrame:
    return p.agg(F.coalesce(_days(), F.lit(0)).cast("bigint").alias("record_count"),
                 F.count_distinct("station").cast("bigint").alias("station_count"),
                 F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


ROLLED_UP = {f.__name__: f for f in (
    monthly_summary, precipitation_analysis, station_month_rank, pattern_distribution, completeness_report, range_report,
    monthly_dashboard, station_performance, seasonal_trends, dataset_span)}


def melted(reports: dict[str, DataFrame], keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """All cells of all reports as rows: report, row_key, field, number, text."""
    out = None
    for name, df in reports.items():
        cells = []
        for f in df.schema.fields:
            if f.name in keys[name]:
                continue
            textual = f.dataType.typeName() in ("string", "date")
            value = F.col(f.name)
            cells.append(F.struct(F.lit(f.name).alias("field"),
                                  (F.lit(None) if textual else value).cast("double").alias("number"),
                                  (value if textual else F.lit(None)).cast("string").alias("text")))
        row = df.select(F.lit(name).alias("report"),
                        F.concat_ws("|", *(F.col(k).cast("string") for k in keys[name])).alias("row_key"), F.array(*cells).alias("cells"))
        rows = row.select("report", "row_key", F.inline("cells"))
        out = rows if out is None else out.unionByName(rows)
    return out
