"""The suite rolled up from one pass over gold equals the reports worked out from gold."""

import os
import re

import pytest

from stratus.operators import quality, reports, rollup, sketches
from stratus.plans.analytics import REPORT_KEYS, analytics_suite, stored_partials
from stratus.plans.inspect import explain_string
from stratus.plans.registry import Layers
from stratus.sources import read_parquet, write_partitioned_parquet

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "gold")
    write_partitioned_parquet(Layers(10).gold(spark, SF), path)
    return read_parquet(spark, path)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", sorted(rollup.ROLLED_UP))
def test_rolled_up_report_equals_the_report(gold, name):
    direct = getattr(reports, name, None) or getattr(quality, name)
    partials = stored_partials(gold)
    out = rollup.ROLLED_UP[name](partials)
    want = direct(gold)
    assert out.dtypes == want.dtypes and rows(out) == rows(want)


def test_partials_of_parts_add_up(gold):
    years = sorted(r.year for r in gold.select("year").distinct().collect())
    early, late = (gold.where(f"year {sign} {years[len(years) // 2]}") for sign in ("<", ">="))
    assert early.count() and late.count()
    both = stored_partials(early).unionByName(stored_partials(late))
    for name, fn in rollup.ROLLED_UP.items():
        assert rows(fn(both)) == rows(fn(stored_partials(gold))), name


def test_suite_reads_gold_once(gold):
    plan = explain_string(rollup.suite_partials(gold))
    assert len(re.findall(r"(?m)^\(\d+\) Scan ", plan)) == 1
    partials = stored_partials(gold)
    for name, df in analytics_suite(gold, partials=partials).items():
        assert any("/gold/" in f for f in df.inputFiles()) == (name not in rollup.ROLLED_UP), name


def test_empty_gold(gold):
    partials = stored_partials(gold.where("false"))
    for name, fn in rollup.ROLLED_UP.items():
        direct = getattr(reports, name, None) or getattr(quality, name)
        got, want = rows(fn(partials)), rows(direct(gold.where("false")))
        assert got == want or name == "range_report", name


def test_melted_holds_every_cell(gold):
    suite = analytics_suite(gold, station="STN1", partials=stored_partials(gold))
    cells = rollup.melted(suite, REPORT_KEYS).groupBy("report").count().collect()
    for r in cells:
        df = suite[r.report]
        assert r["count"] == df.count() * (len(df.columns) - len(REPORT_KEYS[r.report]))
    assert {r.report for r in cells} == set(suite)


def test_sketches_of_months_unite(spark, gold):
    sketched = sketches.month_sketches(gold)
    got, want = sketches.span_of(sketched).first(), reports.dataset_span(gold).first()
    assert tuple(got) == tuple(want)
    many = spark.range(60_000).selectExpr("cast(id % 20 as int) AS month", "2031 AS year", "concat('S', id % 17001) AS station",
                                          "date '2031-01-01' AS date")
    estimate = sketches.span_of(sketches.month_sketches(many)).first().station_count
    assert abs(estimate / 17001 - 1) < 0.05
