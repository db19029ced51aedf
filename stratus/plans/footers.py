"""Answers from Parquet footers: counts and date spans of a stored table without reading a row.

Spark's DataSource V2 scan takes COUNT, MIN and MAX out of the footers when all
aggregates of a query can be had there and it groups by all partition columns
or none. That scan is a setting of a session, so these queries are planned in a
session of their own beside the caller's; tables and cluster are the same.

MIN and MAX are asked for the date only: text has no exact bounds in a footer,
and a file whose column is all null has none at all. Gold has no null date.
Counts of any column are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports
from ..sources.parquet import read_parquet

_KEPT = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.adaptive.enabled")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose Parquet scans answer aggregates from footers."""
    session = spark.newSession()
    for key in _KEPT:
        value = spark.conf.get(key, None)
        if value is not None:
            session.conf.set(key, value)
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def month_spans(spark: SparkSession, gold_path: str) -> DataFrame:
    """year, month, record_count, first_date, last_date: one row per month folder."""
    return read_parquet(footer_session(spark), gold_path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("record_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def table_span(spark: SparkSession, gold_path: str) -> DataFrame:
    """record_count, first_date, last_date of the whole table."""
    return read_parquet(footer_session(spark), gold_path).agg(
        F.count(F.lit(1)).alias("record_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def null_profile(spark: SparkSession, path: str, partition_columns: tuple[str, ...] = ("year", "month")) -> DataFrame:
    """column_name, row_count, null_count of every column that the files hold (a NaN counts as a value)."""
    table = read_parquet(footer_session(spark), path)
    names = [c for c in table.columns if c not in partition_columns]
    counted = table.agg(F.count(F.lit(1)).alias("rows__"), *(F.count(c).alias(f"n__{i}") for i, c in enumerate(names)))
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("rows__").alias("row_count"),
                     (F.col("rows__") - F.col(f"n__{i}")).alias("null_count")) for i, c in enumerate(names)]
    return counted.select(F.inline(F.array(*rows)))


def newest_months(spark: SparkSession, gold_path: str, rows: int) -> DataFrame:
    """The newest months of gold that hold at least ``rows`` rows between them (all months, if there are fewer).

    The months are walked by their footers' counts, one row per calendar month;
    the scan that follows lists only the folders from the last one needed on.
    """
    gold = read_parquet(spark, gold_path)
    seen = 0
    for m in month_spans(spark, gold_path).orderBy(F.desc("year"), F.desc("month")).collect():
        seen += m.record_count
        if seen >= rows:
            return gold.where((F.col("year") > m.year) | ((F.col("year") == m.year) & (F.col("month") >= m.month)))
    return gold


def newest_days(spark: SparkSession, gold_path: str, n: int = 5) -> DataFrame:
    """:func:`reports.latest_days` over the newest months only."""
    return reports.latest_days(newest_months(spark, gold_path, n), n)
