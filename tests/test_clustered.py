"""Clustered tables: the same rows, fewer of them read."""

import os
from datetime import date, timedelta

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stratus.operators import quality
from stratus.plans.inspect import explain_string, rows_scanned
from stratus.sources.clustered import station_span, write_clustered

SMALL = 16 * 2**10


def gold(spark, days=600, stations=12):
    start = date(2034, 1, 1)
    rows = [(start + timedelta(days=k), f"V{(s * 5) % 37:03d}", 20.0 + s, 10.0 + k % 7 + (40.0 if (k * s) % 97 == 96 else 0.0), None)
            for k in range(days) for s in range(stations)]
    df = spark.createDataFrame(rows, "date date, station string, avg_tmax double, avg_tmin double, avg_temperature double")
    mid = (F.col("avg_tmax") + F.col("avg_tmin")) / 2
    return df.withColumn("avg_temperature", F.when(F.col("station") != "V005", mid)).orderBy(F.xxhash64("date", "station"))


def groups(path):
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    return sum(pq.ParquetFile(f).num_row_groups for f in files)


def test_a_station_span_reads_few_rows(spark, tmp_path):
    df, plain, path = gold(spark), str(tmp_path / "plain"), str(tmp_path / "clustered")
    df.write.option("parquet.block.size", SMALL).parquet(plain)
    write_clustered(df, path, row_group_bytes=SMALL, ranges=4)
    assert groups(plain) > 4 and groups(path) > 4
    args = ("V010", "2034-03-01", "2034-03-20")
    before, after = station_span(spark, plain, *args), station_span(spark, path, *args)
    assert sorted(map(tuple, before.select("date", "station").collect())) == sorted(map(tuple, after.select("date", "station").collect()))
    assert after.count() == 20
    assert rows_scanned(before) == 7200 and rows_scanned(after) <= 7200 // 4
    assert "EqualTo(station,V010)" in explain_string(after)


def test_a_station_between_the_bounds_is_ruled_out(spark, tmp_path):
    path = write_clustered(gold(spark), str(tmp_path / "by day"), ("date",), row_group_bytes=SMALL, ranges=2)
    assert rows_scanned(station_span(spark, path, "V011", "2034-01-01", "2036-01-01")) == 0  # V000 to V035, without V011
    # few values are ruled out by their dictionary, many by the Bloom filter
    codes = spark.range(6000).select(F.md5(F.col("id").cast("string")).alias("code"), "id")
    for name, bloom in (("bloom", ("code",)), ("bare", ())):
        write_clustered(codes, str(tmp_path / name), ("id",), bloom=bloom, row_group_bytes=SMALL, ranges=2)
    scanned = {name: rows_scanned(spark.read.parquet(str(tmp_path / name)).where(F.col("code") == "8" * 32)) for name in ("bloom", "bare")}
    assert scanned["bare"] == 6000 and scanned["bloom"] <= 600


def test_inconsistent_days_are_found_by_the_stored_flag(spark, tmp_path):
    df, path = gold(spark), str(tmp_path / "flagged")
    write_clustered(quality.flag_inconsistent(df), path, ("inconsistent", "station", "date"), row_group_bytes=SMALL, ranges=4)
    table = spark.read.parquet(path)
    got, want = quality.flagged_consistency_report(table), quality.consistency_report(df)
    assert got.collect() == want.collect() and want.count() > 10
    assert table.where("inconsistent IS NULL").count() == 0  # rows without values are not inconsistent
    assert rows_scanned(table.where("inconsistent")) <= 7200 // 2


def test_one_hot_key_is_dealt_over_ranges(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(4000).select(F.lit("HOT").alias("station"), F.lit("2034-05-05").cast("date").alias("date"), "id")
    write_clustered(df, path, ranges=4)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_no_rows(spark, tmp_path):
    path = write_clustered(gold(spark).where("false"), str(tmp_path / "none"))
    assert station_span(spark, path, "V000", "2034-01-01", "2034-01-09").count() == 0
