"""Time series that grow by deliveries equal the windows over all rows after each of them."""

import os
import random
import shutil
from datetime import date, timedelta

import pytest

from stratus.operators.timeseries import with_time_series
from stratus.plans import series_increments as si
from stratus.plans.inspect import explain_string

DAYS = "date date, station string, avg_temperature double, total_precipitation double"


def rows_of(seed=3):
    """Five months of stations that come and go: one daily, one every ninth day, one of one day, one late, one with gaps."""
    draw, start, rows = random.Random(seed), date(2033, 11, 3), []
    keep = {"daily": lambda k: True, "ninth": lambda k: k % 9 == 4, "once": lambda k: k == 40,
            "new": lambda k: k > 100, "gaps": lambda k: k // 25 % 2 == 0}
    for k in range(150):
        for station, there in keep.items():
            if there(k):
                rows.append((start + timedelta(days=k), station, draw.choice([None, draw.randint(-80, 300) / 8]),
                             draw.choice([None, 0.0, draw.randint(0, 90) / 4])))
    return rows


def same(got, want):
    return sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("step", [1, 4, 31])
def test_equals_the_full_window_after_each_delivery(spark, tmp_path, step):
    path, rows = str(tmp_path / "series"), rows_of()
    start = rows[0][0]
    ends = [60 + step * i for i in range(4)] + [150]
    low = 0
    for n, high in enumerate(ends):
        part = [r for r in rows if low <= (r[0] - start).days < high]
        si.add_days(spark, spark.createDataFrame(part, DAYS), f"{n:03d}", path)
        so_far = spark.createDataFrame([r for r in rows if (r[0] - start).days < high], DAYS)
        assert same(si.series(spark, path), with_time_series(so_far))
        low = high


def halves():
    rows = rows_of()
    cut = date(2034, 1, 1)
    return [r for r in rows if r[0] < cut], [r for r in rows if r[0] >= cut]


def test_a_delivery_that_is_run_again_counts_once(spark, tmp_path):
    path, (first, second) = str(tmp_path / "series"), halves()
    for key, part in (("a", first), ("a", first), ("b", second[:20]), ("b", second)):
        si.add_days(spark, spark.createDataFrame(part, DAYS), key, path)
    assert same(si.series(spark, path), with_time_series(spark.createDataFrame(first + second, DAYS)))


def test_a_delivery_that_did_not_end_is_not_read(spark, tmp_path):
    path, (first, second) = str(tmp_path / "series"), halves()
    si.add_days(spark, spark.createDataFrame(first, DAYS), "a", path)
    shutil.copytree(f"{path}/key=a", f"{path}/key=b")
    os.remove(f"{path}/key=b/_SUCCESS")
    si.add_days(spark, spark.createDataFrame(second, DAYS), "c", path)
    assert si.delivered(spark, path) == ["a", "c"]
    assert same(si.series(spark, path), with_time_series(spark.createDataFrame(first + second, DAYS)))


def test_an_empty_delivery_keeps_the_borders(spark, tmp_path):
    path, (first, second) = str(tmp_path / "series"), halves()
    si.add_days(spark, spark.createDataFrame([], DAYS), "0", path)
    assert si.series(spark, path).count() == 0
    for key, part in (("a", first), ("b", []), ("c", second)):
        si.add_days(spark, spark.createDataFrame(part, DAYS), key, path)
    assert same(si.series(spark, path), with_time_series(spark.createDataFrame(first + second, DAYS)))


def test_late_rows_and_earlier_keys_are_errors(spark, tmp_path):
    path, (first, second) = str(tmp_path / "series"), halves()
    with pytest.raises(ValueError, match="no delivery"):
        si.series(spark, path)
    si.add_days(spark, spark.createDataFrame(first, DAYS), "m", path)
    with pytest.raises(ValueError, match="before"):
        si.add_days(spark, spark.createDataFrame(second, DAYS), "b", path)
    last = max(r[0] for r in first if r[1] == "daily")
    for day in (last, last - timedelta(days=2), date(2020, 1, 1)):
        with pytest.raises(ValueError, match="daily"):
            si.add_days(spark, spark.createDataFrame([(day, "daily", 1.0, 1.0), *second], DAYS), "n", path)
        assert si.delivered(spark, path) == ["m"]
    si.add_days(spark, spark.createDataFrame(second, DAYS), "n", path)
    assert same(si.series(spark, path), with_time_series(spark.createDataFrame(first + second, DAYS)))


def test_a_delivery_reads_the_last_borders_only(spark, tmp_path):
    path, (first, second) = str(tmp_path / "series"), halves()
    si.add_days(spark, spark.createDataFrame(first, DAYS), "a", path)
    border = si._stored(spark, path, ["a"]).where("border")
    assert border.groupBy("station").count().agg({"count": "max"}).first()[0] == si.BORDER
    plan = explain_string(si._extended(spark.createDataFrame(second, DAYS), border))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1 and "Join" not in tree
    assert "EqualTo(border,true)" in plan
