"""Sources and sinks: landing CSV, partitioned Parquet, generator, fixtures."""

from pyspark.sql import DataFrame, SparkSession

from .. import config
from .bronze_csv import (
    default_date_range,
    landing_glob,
    landing_name,
    load_bronze_csv,
    validate_iso_date,
    write_landing_csv,
)
from .fixture import bronze_from_lineitem, bronze_from_tables, read_lineitem
from .generator import (
    generate_from_skeleton,
    generate_observations,
    skeleton_from_silver,
    station_code,
)
from .parquet import read_parquet, write_partitioned_parquet


def rows_with_schema(spark: SparkSession, rows, schema=config.GOLD_SCHEMA) -> DataFrame:
    """In-memory rows with an explicit schema (no inference)."""
    return spark.createDataFrame(rows, schema)


__all__ = [
    "default_date_range", "landing_glob", "landing_name", "load_bronze_csv", "validate_iso_date",
    "write_landing_csv", "bronze_from_lineitem", "bronze_from_tables", "read_lineitem",
    "generate_from_skeleton", "generate_observations", "skeleton_from_silver",
    "station_code", "read_parquet", "write_partitioned_parquet", "rows_with_schema",
]
