"""Counts and spans from Parquet footers, and the newest days from the newest folders."""

import os
from datetime import date, timedelta

import pytest

from stratus.operators import dataset_span, latest_days
from stratus.plans import footers
from stratus.plans.inspect import explain_string
from stratus.sources import read_parquet, write_partitioned_parquet

GOLD = "date date, station string, year int, month int, avg_temperature double, total_precipitation double"


@pytest.fixture
def gold(spark, tmp_dir):
    """Five months over a turn of the year, three stations; precipitation is all null in two months."""
    start = date(2032, 10, 20)
    rows = []
    for k in range(130):
        d = start + timedelta(days=k)
        for s in range(1 + k % 3):
            rows.append((d, f"Q{s}", d.year, d.month, float(k - s) if k % 5 else None, None if d.month in (11, 12) else 0.25 * k))
    path = os.path.join(tmp_dir, "gold")
    write_partitioned_parquet(spark.createDataFrame(rows, GOLD), path)
    return path


def test_months_come_from_footers(spark, gold):
    found = footers.month_spans(spark, gold)
    plan = explain_string(found)
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan and "PushedGroupBy: [year, month]" in plan
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "station" not in read and "count(*)" in read  # one row per file, no row of the table
    want = read_parquet(spark, gold).groupBy("year", "month").agg({"date": "min"}).count()
    assert found.count() == want == 5
    assert sum(r.record_count for r in found.collect()) == read_parquet(spark, gold).count()


def test_span_equals_the_scan(spark, gold):
    got, want = footers.table_span(spark, gold).first(), dataset_span(read_parquet(spark, gold)).first()
    assert (got.record_count, got.first_date, got.last_date) == (want.record_count, want.first_date, want.last_date)


def test_null_counts_with_an_all_null_column(spark, gold):
    got = {r.column_name: (r.row_count, r.null_count) for r in footers.null_profile(spark, gold).collect()}
    table = read_parquet(spark, gold)
    assert set(got) == {"date", "station", "avg_temperature", "total_precipitation"}
    assert got == {c: (table.count(), table.where(f"{c} IS NULL").count()) for c in got}
    assert "PushedAggregation" in explain_string(footers.null_profile(spark, gold))


def test_the_callers_session_keeps_its_settings(spark, gold):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footers.month_spans(spark, gold).collect()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


@pytest.mark.parametrize("n", [1, 5, 52, 53, 54, 120, 1000])
def test_newest_days_equal_top_k_over_all(spark, gold, n):
    want = [tuple(r) for r in latest_days(read_parquet(spark, gold), n).collect()]
    assert [tuple(r) for r in footers.newest_days(spark, gold, n).collect()] == want


def test_five_newest_days_read_one_month(spark, gold):
    few = footers.newest_months(spark, gold, 5)
    assert [tuple(r) for r in few.select("year", "month").distinct().collect()] == [(2033, 2)]
    filters = explain_string(few).split("PartitionFilters:")[1].split("\n")[0]
    assert "2033" in filters and "year" in filters and "month" in filters
    assert footers.newest_months(spark, gold, 10_000).count() == read_parquet(spark, gold).count()
