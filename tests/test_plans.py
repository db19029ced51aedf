"""Plan-shape tests: single scans for fused checks, shared window sort,
predicate pushdown, and no Python evaluation anywhere."""

import os
import re

import pytest

from stratus.operators import profile, quality, timeseries
from stratus.plans.inspect import explain_string, uses_python
from stratus.plans.registry import Layers, build_queries
from stratus.sources import read_parquet, write_partitioned_parquet

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")

WRITE_QUERIES = {"bronze_csv_roundtrip", "gold_parquet_roundtrip", "gold_idempotent", "full_pipeline"}


def plan_of(df):
    return explain_string(df)


def scans(plan):
    return len(re.findall(r"(?m)^\(\d+\) Scan ", plan))


def nodes(plan, name):
    return len(re.findall(rf"(?m)^\(\d+\) {name}\b", plan))


def test_no_python_in_any_plan(spark):
    for name, fn in build_queries().items():
        if name in WRITE_QUERIES:
            continue
        assert not uses_python(fn(spark, SF)), name


@pytest.mark.parametrize("fn", [quality.validation_summary, quality.range_check, quality.quality_score,
                                quality.date_check, profile.column_profile, profile.column_profile_minmax])
def test_bronze_checks_are_one_scan(spark, fn):
    assert scans(plan_of(fn(Layers(10).bronze(spark, SF)))) == 1


@pytest.mark.parametrize("fn", [quality.completeness_report, quality.range_report])
def test_unioned_reports_are_one_scan(spark, fn):
    assert scans(plan_of(fn(Layers(10).gold(spark, SF)))) == 1


def test_windows_share_one_sort(spark):
    plan = plan_of(timeseries.with_time_series(Layers(10).gold(spark, SF)))
    assert nodes(plan, "Window") == 1
    assert nodes(plan, "Sort") == 1


def test_station_filter_reaches_parquet_scan(spark, tmp_dir):
    out = os.path.join(tmp_dir, "gold")
    write_partitioned_parquet(Layers(10).gold(spark, SF), out)
    df = timeseries.station_timeseries(read_parquet(spark, out), "STN1")
    plan = explain_string(df)
    assert "PushedFilters: [IsNotNull(station), EqualTo(station,STN1)]" in plan
    assert df.count() == 10


def test_column_pruning_on_lineitem(spark):
    plan = plan_of(Layers(10).gold(spark, SF))
    read_schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert "l_linestatus" not in read_schema and "l_orderkey" in read_schema


#: Queries that join by what they do: small tables of borders, offsets, files or names, and rows with the rank of their value.
JOINING = {"validation_incremental", "station_register", "global_timeseries", "daily_temperature_rank"}


def test_no_joins_or_broadcasts(spark):
    for name, fn in build_queries(stored=False).items():
        if name in WRITE_QUERIES | JOINING:
            continue
        plan = plan_of(fn(spark, SF))
        for bad in ("BroadcastExchange", "CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
            assert bad not in plan, (name, bad)


def test_gold_aggregates_partially_before_shuffle(spark):
    plan = plan_of(Layers(10).gold(spark, SF))
    partial = plan.find("partial_avg")
    exchange = plan.find("Exchange")
    assert 0 <= partial and 0 <= exchange
    # formatted plans list nodes bottom-up in the details section; the partial
    # aggregate node must sit below the (date, station) exchange in the tree
    tree = plan.split("\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("HashAggregate")
    assert "hashpartitioning(date" in plan


def test_single_partition_exchange_only_on_small_aggregates(spark):
    from stratus.operators import reports

    plan = plan_of(reports.pattern_distribution(Layers(10).gold(spark, SF)))
    tree = plan.split("\n\n")[0]
    # the unpartitioned window sits above the pattern aggregate (at most 6 rows)
    assert tree.index("Window") < tree.index("HashAggregate")


def test_time_series_on_gold_needs_one_station_exchange(spark):
    queries = build_queries()
    for name in ("daily_change", "rolling_metrics"):
        plan = plan_of(queries[name](spark, SF))
        assert nodes(plan, "Exchange") == 1 and "hashpartitioning(station" in plan, name