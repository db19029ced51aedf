"""Parquet tables whose rows lie clustered, so that a scan skips the row groups a predicate cannot meet.

Rows are range-partitioned and sorted by the clustering columns, so footers hold
narrow bounds of them. A value between a row group's bounds that is not in it is
ruled out by the dictionary of a column of few values, and by a Bloom filter where
a column has too many for one (Parquet writes the filter only there). The ranges
end in a hash of the row, so that one key that holds most rows is still dealt
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 32 * 2**20


def write_clustered(df: DataFrame, path: str, by: tuple[str, ...] = ("station", "date"), *, bloom: tuple[str, ...] = ("station",),
                    row_group_bytes: int = ROW_GROUP_BYTES, ranges: int | None = None) -> str:
    """Overwrite ``path`` with ``df`` clustered ``by`` columns, with Bloom filters on ``bloom``.

    ``ranges``: number of files; by default as many as adaptive execution finds fit.
    """
    keys = [*(F.col(c) for c in by), F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    writer = dealt.sortWithinPartitions(*by).write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return path


def station_span(spark: SparkSession, path: str, station: str, first: str, last: str) -> DataFrame:
    """Rows of one station from day ``first`` to day ``last``, both included; the predicate reaches the scan."""
    day = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.read.parquet(path).where((F.col("station") == station) & day)
