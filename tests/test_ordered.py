"""Global windows and ranks over range partitions, against plain Python."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stratus.operators import ordered
from stratus.plans.inspect import explain_string

SCHEMA = "date date, station string, month int, avg_temperature double, total_precipitation double"


def days(spark, n, seed=1, stations=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        d = date(2031, 5, 1) + timedelta(days=k // stations)
        rows.append((d, f"Q{k % stations}", d.month, rng.choice([None, round(rng.uniform(-9, 31), 1)]) if k % 5 == 0
                     else float(rng.randint(-4, 9)), rng.randint(0, 40) / 4))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, SCHEMA)


def expected(rows):
    out = []
    for k, (d, s, _, t, p) in enumerate(rows):
        before = rows[k - 1][3] if k else None
        frame = [r[3] for r in rows[max(0, k - 2):k + 1] if r[3] is not None]
        out.append((d, s, t, p, before, rows[k + 1][3] if k + 1 < len(rows) else None,
                    t - before if t is not None and before is not None else None,
                    sum(frame) / len(frame) if frame else None, sum(r[4] for r in rows[max(0, k - 6):k + 1])))
    return out


@pytest.mark.parametrize(("n", "ranges"), [(200, 9), (200, 60), (23, 23), (5, 4), (1, 3), (60, None)])
def test_global_series_equals_one_ordered_pass(spark, n, ranges):
    rows, df = days(spark, n)
    got = ordered.global_time_series(df, ranges).orderBy("date", "station").collect()
    for r, want in zip(got, expected(rows), strict=True):
        assert tuple(r)[:7] == want[:7] and r.moving_sum_7row == want[8]
        assert r.moving_avg_3row == want[7] or abs(r.moving_avg_3row - want[7]) < 1e-12


def test_global_series_of_no_rows(spark):
    assert ordered.global_time_series(days(spark, 3)[1].where("false")).count() == 0


def test_no_task_gets_all_rows(spark):
    _, df = days(spark, 300)
    for out in (ordered.global_time_series(df, 8), ordered.daily_temperature_rank(df, 8)):
        plan = explain_string(out)
        assert "SinglePartition" not in plan and "hashpartitioning(range__" in plan


def test_reach_goes_over_short_ranges():
    assert ordered._reach([(0, 9), (1, 2), (2, 1), (3, 50), (4, 4)], 6) == [
        (0, 1, 6), (0, 2, 4), (0, 3, 3), (1, 2, 6), (1, 3, 5), (2, 3, 6), (3, 4, 6)]


@pytest.mark.parametrize("ranges", [None, 1, 7, 40])
def test_rank_in_groups_of_any_size(spark, ranges):
    rows, df = days(spark, 400, seed=4)
    df = df.withColumn("month", F.when(F.col("month") < 8, F.col("month")))  # and a null group
    got = {(r.date, r.station): r.temp_rank for r in ordered.daily_temperature_rank(df, ranges).collect()}
    assert len(got) == len(rows)
    month = lambda r: r[2] if r[2] < 8 else None
    for r in rows:
        same = [x[3] for x in rows if month(x) == month(r)]
        above = [t for t in same if t is not None and (r[3] is None or t > r[3])]
        assert got[r[0], r[1]] == len(above) + 1


def test_a_value_that_most_rows_share_costs_one_row(spark):
    df = spark.range(5000).selectExpr("cast(id % 2 as int) AS month", "cast(if(id < 4500, 7, id) as double) AS v")
    out = ordered.rank_in_groups(df, "month", "v", "place", ranges=6)
    assert out.where("v = 7").select("place").distinct().collect()[0][0] == 251
    assert out.count() == 5000
