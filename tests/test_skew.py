"""One station holds a third of all raw rows: results stay exact and the
plan pre-aggregates before any shuffle."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from stratus.operators import clean_observations, daily_gold, reports
from stratus.plans.inspect import explain_string
from stratus.sources.fixture import bronze_from_lineitem, read_lineitem

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture
def skewed_bronze(spark):
    base = bronze_from_lineitem(read_lineitem(spark, SF), 10)
    # every third row is re-labelled to one hot station
    hot = F.when(F.xxhash64("DATE", "TMAX", "TMIN", "AWND", "PRCP") % 3 == 0, F.lit("HOT"))
    return base.withColumn("STATION", F.coalesce(hot, F.col("STATION")))


def test_hot_station_results_are_exact(spark, skewed_bronze):
    rows = skewed_bronze.collect()
    share = sum(r.STATION == "HOT" for r in rows) / len(rows)
    assert 0.25 < share < 0.42
    # brute force: per (date, station) count and precipitation total, in Python
    groups = collections.defaultdict(lambda: [0, None])  # SQL SUM of only NULLs is NULL
    for r in rows:
        if r.DATE in (None, "", "bad-date", "2024-13-03") or not r.STATION:
            continue
        g = groups[(r.DATE, r.STATION)]
        g[0] += 1
        if r.PRCP not in (None, ""):
            g[1] = (g[1] or 0.0) + float(r.PRCP)
    gold = daily_gold(clean_observations(skewed_bronze))
    got = {(str(r.date), r.station): r.total_precipitation for r in gold.collect()}
    assert len(got) == len(groups)
    assert all(got[k] == v[1] for k, v in groups.items())
    perf = {r.station: r.data_points for r in reports.station_performance(gold).collect()}
    assert perf["HOT"] == sum(1 for (d, s) in groups if s == "HOT")


def test_hot_station_is_pre_aggregated_before_the_shuffle(spark, skewed_bronze):
    plan = explain_string(daily_gold(clean_observations(skewed_bronze)))
    tree = plan.split("\n\n")[0]
    # the partial aggregate sits below the (date, station) exchange
    assert tree.index("Exchange") < tree.rindex("HashAggregate")
    assert "partial_sum" in plan and "hashpartitioning(date" in plan
