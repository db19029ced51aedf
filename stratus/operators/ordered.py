"""Windows and ranks over one global order, without gathering the rows in one task.

A window without PARTITION BY puts all rows into a single task. Here the rows
are range-partitioned by the order instead and written once; each range is a
window partition of its own, to which the few rows that a frame reaches back
to (or ahead) in its neighbours are added. Only the ranges' sizes, one number
per range, are read by the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import config
from ..session import scratch_path

RANGE = "range__"
T = "avg_temperature"
P = "total_precipitation"


def _stored_ranges(df: DataFrame, order: list[str | Column], ranges: int | None) -> DataFrame:
    """``df`` with the number of each row's range, written once (so that later jobs see the same ranges)."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    by = order if ranges is None else [ranges, *order]
    out = df.repartitionByRange(*by).withColumn(RANGE, F.spark_partition_id())
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _reach(sizes: list[tuple[int, int]], rows: int) -> list[tuple[int, int, int]]:
    """(range, later range, how many of the first one's last rows the later one's frames reach)."""
    out = []
    for k, (source, _) in enumerate(sizes):
        room = rows
        for target, size in sizes[k + 1:]:
            if room <= 0:
                break
            out.append((source, target, room))
            room -= size
    return out


def global_window(df: DataFrame, order: list[str], columns: dict[str, Callable[[WindowSpec], Column]], *,
                  before: int, after: int = 0, ranges: int | None = None) -> DataFrame:
    """``df`` with window columns over all rows in the order of ``order`` (ascending, NULL first).

    ``columns`` maps names to functions of the window; their frames may reach ``before`` rows back and ``after``
    rows ahead. The order should be total: rows that tie in it stand in any order, as in SQL.
    """
    spark = df.sparkSession
    stored = _stored_ranges(df, order, ranges)
    sizes = sorted((r[RANGE], r["count"]) for r in stored.groupBy(RANGE).count().collect())
    own = Window.partitionBy(RANGE)
    ascending = [F.col(c).asc_nulls_first() for c in order]
    pieces = [stored.withColumn("own__", F.lit(True))]
    reaches = ((_reach(sizes, before), [F.col(c).desc_nulls_last() for c in order]),
               (_reach(sizes[::-1], after), ascending))
    for reach, by in reaches:
        if reach:
            borders = spark.createDataFrame(reach, f"{RANGE} int, target__ int, room__ int")
            edge = stored.withColumn("place__", F.row_number().over(own.orderBy(*by))).where(F.col("place__") <= max(before, after))
            pieces.append(edge.join(borders, RANGE).where("place__ <= room__").drop(RANGE, "place__", "room__")
                          .withColumnRenamed("target__", RANGE).withColumn("own__", F.lit(False)))
    rows = pieces[0]
    for piece in pieces[1:]:
        rows = rows.unionByName(piece)
    window = own.orderBy(*ascending)
    return rows.select(*df.columns, "own__", *(fn(window).alias(name) for name, fn in columns.items())).where("own__").drop("own__")


def global_time_series(gold: DataFrame, ranges: int | None = None) -> DataFrame:
    """All station-days as one series by (date, station): previous and next row, change, 3-row mean, 7-row sum."""
    mean_rows, sum_rows = config.ROLLING_MEAN_ROWS, config.ROLLING_SUM_ROWS
    return global_window(
        gold.select("date", "station", T, P), ["date", "station"], {
            "prev_temp": lambda w: F.lag(T, 1).over(w),
            "next_temp": lambda w: F.lead(T, 1).over(w),
            "temp_change": lambda w: F.col(T) - F.lag(T, 1).over(w),
            "moving_avg_3row": lambda w: F.avg(T).over(w.rowsBetween(-(mean_rows - 1), Window.currentRow)),
            "moving_sum_7row": lambda w: F.sum(P).over(w.rowsBetween(-(sum_rows - 1), Window.currentRow)),
        }, before=max(mean_rows, sum_rows) - 1, after=1, ranges=ranges)


def rank_in_groups(df: DataFrame, group: str, value: str, name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with RANK() of ``value`` (descending, NULL last) in its ``group``, for groups of any size.

    Ranks are worked out over distinct values with their counts (pre-aggregated, so that a value which many rows
    share costs one row), range-partitioned by group and value: the rows before a range are a sum over the small
    table of the ranges' counts. Rows take the rank of their value by a join.
    """
    order = [F.col(group).asc_nulls_first(), F.col(value).desc_nulls_last()]
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n__"))
    stored = _stored_ranges(counted, order, ranges)
    sizes = stored.groupBy(group, RANGE).agg(F.sum("n__").alias("size__"))
    earlier = Window.partitionBy(group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("group__"), F.col(RANGE).alias("at__"),
                           F.coalesce(F.sum("size__").over(earlier), F.lit(0)).alias("before__"))
    local = Window.partitionBy(RANGE, group).orderBy(order[1]).rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored.withColumn("inside__", F.coalesce(F.sum("n__").over(local), F.lit(0)))
    ranked = ranked.join(offsets, F.col(group).eqNullSafe(F.col("group__")) & (F.col(RANGE) == F.col("at__")))
    ranked = ranked.select(F.col(group).alias("group__"), F.col(value).alias("value__"),
                           (F.col("before__") + F.col("inside__") + 1).alias(name))
    return df.join(ranked, df[group].eqNullSafe(F.col("group__")) & df[value].eqNullSafe(F.col("value__"))).drop("group__", "value__")


def daily_temperature_rank(gold: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each station-day's rank by mean temperature among all days of its calendar month."""
    return rank_in_groups(gold.select("date", "station", "month", T), "month", T, "temp_rank", ranges)
