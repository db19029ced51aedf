"""Gold storage: partitioned Parquet sink and scan.

Write layout: ``<path>/year=YYYY/month=M/part-*.parquet``. Before writing,
rows are rebalanced on the partition columns with the ``REBALANCE`` hint, so
each task writes few directories (no small-file explosion) while adaptive
execution still splits an oversized month into several tasks (no single task
for a hot partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config


def write_partitioned_parquet(df: DataFrame, path: str,
                              partition_cols: tuple[str, ...] | list[str] | None = None,
                              *, dynamic_overwrite: bool = False,
                              rebalance: bool = True,
                              count_rows: Observation | None = None) -> str:
    """Overwrite ``path`` with ``df`` partitioned by ``partition_cols``.

    If any partition column is absent the data is written unpartitioned.
    ``dynamic_overwrite`` replaces only the partitions present in ``df``
    (incremental re-runs); otherwise the whole directory is replaced, so two
    runs over the same input leave one copy. ``count_rows`` observes the
    number of written rows in the write stage itself, which is a result stage,
    so the count stays exact when tasks are retried.
    """
    cols = list(config.PARTITION_COLUMNS if partition_cols is None else partition_cols)
    partitioned = bool(cols) and all(c in df.columns for c in cols)
    out = df
    if partitioned and rebalance:
        out = df.hint("rebalance", *cols)
    if count_rows is not None:
        out = out.observe(count_rows, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").format("parquet")
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partitioned:
        writer = writer.partitionBy(*cols)
    writer.save(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet back; ``year=``/``month=`` directories become INT columns."""
    return spark.read.parquet(path)


def write_bucketed_table(df: DataFrame, path: str, table: str, buckets: int,
                         by: str, sort_by: tuple[str, ...]) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed by ``by`` (one sorted file per bucket).

    Rows are hash-partitioned on ``by`` into exactly ``buckets`` partitions
    first, so each write task holds one bucket and writes one file sorted by
    ``sort_by``. A scan of the table then reports hash partitioning on ``by``
    with ``buckets`` partitions, and any window or aggregate keyed on ``by``
    runs without an exchange. The table is registered in the session catalog
    over ``path`` (external), and its data lives under ``path``.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, by)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, by)
        .sortBy(*sort_by)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)
