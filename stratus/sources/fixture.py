"""Bronze observations derived from the driver's ``lineitem`` table.

The test tables hold no weather data, so weather-shaped raw rows are derived
deterministically from ``lineitem``, with the faults that a landing CSV can
have: blanks, nulls, malformed numbers, impossible days, fractions. The same
rules are written in DuckDB SQL by :mod:`stratus.oracle`.

Fixed values (adapter rules):
  DATE     'bad-date', '2024-13-03', '' and null when l_orderkey % 40 is 0, 1, 2 and 3,
           else l_shipdate as yyyy-MM-dd
  STATION  null and '' when l_orderkey % 50 is 7 and 8, else 'STN' + (l_suppkey % stations)
  TMAX     '' when l_partkey % 20 = 0, '26x' when l_partkey % 200 = 7,
           else INT(l_quantity*10) - 150 + l_linenumber*10
  TMIN     '' when l_partkey % 20 = 1, 'n/a' when l_partkey % 200 = 8, else INT(l_quantity*10) - 150
  PRCP     '' when l_partkey % 50 = 2, else ROUND(l_discount*100) * 2 + (l_linenumber % 4) / 4
  SNOW     '' when l_partkey % 30 = 4, else INT(ROUND(l_tax*100)) when l_returnflag = 'R', else 0
  SNWD     l_linenumber when l_returnflag = 'R', else 0
  AWND     '' when l_partkey % 30 = 5, else INT(FLOOR(l_extendedprice / 400))
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
)

SMOKE_STATIONS = 10
BENCH_STATIONS = 100


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's input columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*LINEITEM_COLUMNS)


def bronze_from_lineitem(lineitem: DataFrame, stations: int = SMOKE_STATIONS) -> DataFrame:
    """Project ``lineitem`` onto the all-string bronze layout (no shuffle)."""
    blank = F.lit("")
    qty10 = (F.col("l_quantity") * 10).cast("int")
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    return lineitem.select(
        F.when(order % 40 == 0, F.lit("bad-date")).when(order % 40 == 1, F.lit("2024-13-03"))
        .when(order % 40 == 2, blank).when(order % 40 == 3, F.lit(None).cast("string"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("DATE"),
        F.when(order % 50 == 7, F.lit(None).cast("string")).when(order % 50 == 8, blank)
        .otherwise(F.concat(F.lit("STN"), (F.col("l_suppkey") % stations).cast("string"))).alias("STATION"),
        F.when(part % 20 == 0, blank).when(part % 200 == 7, F.lit("26x"))
        .otherwise((qty10 - 150 + line * 10).cast("string")).alias("TMAX"),
        F.when(part % 20 == 1, blank).when(part % 200 == 8, F.lit("n/a"))
        .otherwise((qty10 - 150).cast("string")).alias("TMIN"),
        F.when(part % 50 == 2, blank)
        .otherwise((F.round(F.col("l_discount") * 100).cast("double") * 2 + (line % 4) * F.lit(0.25)).cast("string"))
        .alias("PRCP"),
        F.when(part % 30 == 4, blank)
        .otherwise(F.when(returned, F.round(F.col("l_tax") * 100).cast("int")).otherwise(F.lit(0)).cast("string"))
        .alias("SNOW"),
        F.when(returned, line.cast("string")).otherwise(F.lit("0")).alias("SNWD"),
        F.when(part % 30 == 5, blank).otherwise(F.floor(F.col("l_extendedprice") / 400).cast("string")).alias("AWND"),
    )


def bronze_from_tables(spark: SparkSession, sf_dir: str, stations: int = SMOKE_STATIONS) -> DataFrame:
    return bronze_from_lineitem(read_lineitem(spark, sf_dir), stations)
