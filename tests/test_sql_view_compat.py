"""SQL over the gold view agrees with the DataFrame reports; properties of the mean and of the label bands."""

import datetime as dt
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratus.config import GOLD_SCHEMA
from stratus.functions import exact_mean, labels
from stratus.operators import reports, timeseries
from stratus.plans import create_view

pytestmark = pytest.mark.unit


@pytest.fixture
def view(spark):
    rows = []
    for i in range(40):
        day = dt.date(2016, 11, 20) + dt.timedelta(days=3 * i)
        t = round(-6 + 0.83 * i, 2)
        rows.append((day, f"P{i % 3}", day.year, day.month, day.day, t + 2, t - 2, t, i % 7 * 0.37, float(i % 5 == 0), 9.5 + i))
    gold = spark.createDataFrame(rows, GOLD_SCHEMA)
    create_view(gold)
    return gold


def _rows(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_monthly_means_of_the_view(spark, view):
    sql = spark.sql("SELECT month, count(*) n, round(avg(avg_temperature), 1) t, round(avg(avg_wind_speed), 1) w "
                    "FROM weather_data GROUP BY month")
    assert _rows(sql, sql.columns) == _rows(reports.monthly_dashboard(view),
                                           ["month", "total_days", "avg_temperature", "avg_wind_speed"])


def test_changes_of_the_view(spark, view):
    sql = spark.sql("SELECT cur.date, cur.station, cur.avg_temperature - old.avg_temperature AS diff FROM weather_data cur "
                    "JOIN weather_data old ON old.station = cur.station AND old.date = date_sub(cur.date, 9)")
    got = timeseries.daily_change(view).where("temp_change IS NOT NULL")
    assert _rows(sql, sql.columns) == _rows(got, ["date", "station", "temp_change"])


def test_patterns_of_the_view(spark, view):
    for r in reports.pattern_distribution(view).collect():
        same = view.withColumn("p", labels.weather_pattern()).where(F.col("p") == r.weather_pattern)
        same.createOrReplaceTempView("one_pattern")
        n, t, p = spark.sql("SELECT count(*), round(avg(avg_temperature), 1), round(avg(total_precipitation), 1) FROM one_pattern").first()
        assert (r.occurrences, r.avg_temp_for_pattern, r.avg_precip_for_pattern) == (n, t, p)


values = st.lists(st.integers(-600_000, 600_000).map(lambda k: k / 1000), min_size=1, max_size=40)


@settings(max_examples=25, deadline=None)
@given(values)
def test_mean_is_the_mean_of_the_values_in_any_order(spark, xs):
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    got = df.agg(exact_mean("x").alias("m")).first().m
    exact = sum(Fraction(round(v * 1000), 1000) for v in xs) / len(xs)
    assert abs(got - float(exact)) <= 1e-12 * max(1, abs(float(exact)))
    assert df.repartition(3).agg(exact_mean("x").alias("m")).first().m == got


def test_mean_of_odd_values(spark):
    def mean(*xs):
        return spark.createDataFrame([(v,) for v in xs], "x double").agg(exact_mean("x").alias("m")).first().m

    assert mean(None, None) is None and mean(1.0, None, 2.0) == 1.5
    assert mean(1.0, float("inf")) == float("inf") and mean(1e25, 3e25) == 2e25
    assert mean(1.0, float("nan")) != mean(1.0, float("nan"))


@settings(max_examples=20, deadline=None)
@given(values)
def test_temperature_category_matches_python_rule(spark, xs):
    def rule(t):
        return next((name for bound, name in ((25, "Hot"), (15, "Warm"), (5, "Cool"), (0, "Cold")) if t >= bound), "Freezing")

    df = spark.createDataFrame([(v,) for v in xs], "t double")
    assert [r[0] for r in df.select(labels.temperature_category(F.col("t"))).collect()] == [rule(v) for v in xs]


def test_small_and_wide_values_count_fully(spark):
    rows = [(1, 1e-11), (1, 3e-11), (2, 123456789012.34), (2, -123456789012.3), (3, 1e300), (3, 1.0), (4, None), (5, 1e17), (5, 1.0),
            (5, -1e17), (6, float("nan")), (6, 1.0), (7, 1e-30), (7, 3e-30), (8, 999999999.9), (8, 1000000000.1)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.m for r in df.repartition(7).groupBy("g").agg(exact_mean("x").alias("m")).collect()}
    assert got.pop(6) != got.get(6) and abs(got.pop(2) - 0.02) < 1e-12
    assert got == {1: 2e-11, 3: 5e299, 4: None, 5: 1 / 3, 7: 2e-30, 8: 1e9}
