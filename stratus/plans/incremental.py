"""Increments: gold from stored sums, and validation from stored measures.

Gold. Each increment of silver is reduced to sums and counts per station-day,
which are written to a folder of the increment's own below the state. Late rows
are further sums of a station-day. Gold of the months that an increment touches
is worked out again from the sums of all increments of these months; the raw
rows are not read again. An increment that is run again replaces its own
folder, so nothing counts twice.

Validation. The measures of each landing file are kept in a ledger with the
file's path, length and time; only files that are not in it are read. The verdict
merges the measures of the files that are there now, so files that went or
changed do not count any more. A file that two runs measured counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_RULES, ValidationRules
from ..operators import quality
from ..sources.bronze_csv import load_bronze_csv
from ..sources.parquet import write_partitioned_parquet

STATE_SCHEMA = ("date date, station string, tmax_sum double, tmax_count bigint, tmin_sum double, tmin_count bigint, "
                "mid_sum double, mid_count bigint, prcp_sum double, prcp_count bigint, snow_sum double, snow_count bigint, "
                "awnd_sum double, awnd_count bigint, increment string, year int, month int")
_MEASURES = {"tmax": "tmax", "tmin": "tmin", "mid": "tmax + tmin", "prcp": "prcp", "snow": "snow", "awnd": "awnd"}


def station_day_sums(silver: DataFrame) -> DataFrame:
    """Sums and counts per station-day; they add up over increments."""
    aggs = []
    for name, value in _MEASURES.items():
        aggs += [F.sum(F.expr(value)).alias(f"{name}_sum"), F.count(F.expr(value)).alias(f"{name}_count")]
    return silver.groupBy(F.col("date").cast("date").alias("date"), "station").agg(*aggs).withColumns(
        {"year": F.year("date"), "month": F.month("date")})


def gold_from_sums(sums: DataFrame, divisor: float = config.TEMPERATURE_DIVISOR) -> DataFrame:
    """Gold rows from sums of any number of increments."""
    total = sums.groupBy("date", "station").agg(
        *(F.sum(f"{m}_{kind}").alias(f"{m}_{kind}") for m in _MEASURES for kind in ("sum", "count")))

    def mean(m: str, by: float, digits: int) -> Column:
        return F.when(F.col(f"{m}_count") > 0, F.round(F.col(f"{m}_sum") / F.col(f"{m}_count") / F.lit(by), digits))

    t, w = config.TEMPERATURE_PRECISION, config.WIND_PRECISION
    return total.select(
        "date", "station", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
        mean("tmax", divisor, t).alias("avg_tmax"), mean("tmin", divisor, t).alias("avg_tmin"),
        mean("mid", 2 * divisor, t).alias("avg_temperature"), F.col("prcp_sum").alias("total_precipitation"),
        F.col("snow_sum").alias("total_snow"), mean("awnd", 1.0, w).alias("avg_wind_speed"))


def add_increment(spark: SparkSession, silver: DataFrame, increment: str, state_path: str, gold_path: str) -> DataFrame:
    """Add the silver rows of one increment; returns the sums that gold's new months were worked out from.

    ``state_path`` holds ``increment=/year=/month=`` folders, ``gold_path`` ``year=/month=`` folders, of which only
    the increment's months are replaced.
    """
    folder = f"{state_path.rstrip('/')}/increment={increment}"
    old = []
    if _exists(spark, folder):  # a run before this one may have held other months
        old = [tuple(r) for r in spark.read.parquet(folder).select("year", "month").distinct().collect()]
    write_partitioned_parquet(station_day_sums(silver), folder, ("year", "month"))
    sums = spark.read.schema(STATE_SCHEMA).parquet(state_path)
    new = sums.where(F.col("increment") == increment).select("year", "month").distinct().collect()
    months: dict[int, set[int]] = {}  # the calendar months touched
    for year, month in {*old, *(tuple(r) for r in new)}:
        months.setdefault(year, set()).add(month)
    in_months = F.lit(False)
    for year, some in months.items():
        in_months = in_months | ((F.col("year") == year) & F.col("month").isin(sorted(some)))
    touched = sums.where(in_months)
    if months:
        write_partitioned_parquet(gold_from_sums(touched), gold_path, dynamic_overwrite=True)
    return touched


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


# -- validation ledger ---------------------------------------------------------------------------------

FILE_KEY = ["file", "length", "modified"]


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    """path, file, length, modified of the files below ``landing``, as Spark lists them (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    return files.select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def _merged(measures: DataFrame) -> DataFrame:
    """Measures of several files as those of all their rows."""
    aggs = []
    for f in measures.schema.fields:
        if f.name in FILE_KEY:
            continue
        fn = F.min if f.name.startswith("min__") else F.max if f.name.startswith("max__") else F.sum
        merged = fn(f.name)
        aggs.append((F.coalesce(merged, F.lit(0)) if fn is F.sum else merged).alias(f.name))
    return measures.agg(*aggs)


def update_ledger(spark: SparkSession, landing: str, ledger_path: str, rules: ValidationRules = DEFAULT_RULES) -> tuple[DataFrame, list[str]]:
    """Measure the landing files that the ledger does not hold yet.

    Returns the ledger's rows of the files that are there now, and the files that were read.
    """
    files = landing_files(spark, landing)
    known = _exists(spark, ledger_path)
    new = files.join(spark.read.parquet(ledger_path).select(*FILE_KEY), FILE_KEY, "left_anti") if known else files
    listed = new.select("path", *FILE_KEY).collect()  # one entry per new file, as in the listing of the scan that follows
    if not listed and not known:
        raise ValueError(f"no files below {landing}")
    if listed:
        rows = load_bronze_csv(spark, [r["path"] for r in listed])
        measures = quality.measure_columns(rows, rules)
        measured = rows.select("*", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(*measures)
        entries = spark.createDataFrame([tuple(r)[1:] for r in listed], new.select(*FILE_KEY).schema)
        entries.join(measured, "file", "left").write.mode("append").parquet(ledger_path)
    held = spark.read.parquet(ledger_path).join(files, FILE_KEY, "left_semi").dropDuplicates(FILE_KEY)
    return held, sorted(r["path"] for r in listed)


def incremental_verdict(spark: SparkSession, landing: str, ledger_path: str, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """The composite verdict over all landing files, reading only those that are new."""
    ledger, _ = update_ledger(spark, landing, ledger_path, rules)
    bronze = spark.createDataFrame([], config.BRONZE_SCHEMA)
    return quality.verdict_from_measures(_merged(ledger), bronze, rules)
