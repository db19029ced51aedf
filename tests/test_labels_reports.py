import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratus.config import GOLD_SCHEMA
from stratus.functions import labels
from stratus.operators import reports, timeseries

pytestmark = pytest.mark.unit


def _labels(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_band_labels(spark):
    assert _labels(spark, [40.0, 25.0, 24.99, 14.9, 4.9, -0.01, None], labels.temperature_category) == [
        "Hot", "Hot", "Warm", "Cool", "Cold", "Freezing", "Freezing"]
    assert _labels(spark, [30.01, 30.0, 20.0, None], labels.temperature_band3) == ["Hot", "Moderate", "Cold", "Cold"]
    assert _labels(spark, [50.5, 50.0, 20.0, None], labels.precipitation_quality) == [
        "Heavy Precipitation", "Moderate Precipitation", "Light Precipitation", "Light Precipitation"]
    assert _labels(spark, [15.5, 15.0, 5.0, None], labels.climate_category) == [
        "Warm Climate", "Moderate Climate", "Cold Climate", "Cold Climate"]


def test_two_column_labels(spark):
    df = spark.createDataFrame([(40.0, -10.0), (40.1, 0.0), (30.5, 0.0), (12.0, -10.5), (12.0, -20.5), (None, None)],
                               "tmax_celsius double, tmin_celsius double")
    assert [r[0] for r in df.select(labels.temperature_quality()).collect()] == [
        "High Temperature", "Extreme Temperature", "High Temperature", "High Temperature", "Extreme Temperature",
        "Temperature OK"]
    df = spark.createDataFrame([(1.0, 2.0, 1.5), (9.0, 1.0, 6.5), (9.0, 1.0, 6.0), (None, 1.0, 2.0)],
                               "avg_tmax double, avg_tmin double, avg_temperature double")
    assert [r[0] for r in df.select(labels.consistency_label()).collect()] == [
        "ERROR: Max < Min", "WARNING: Avg not between min/max", "OK", "OK"]


def test_month_and_season_names(spark):
    assert _labels(spark, [3, 1, 2, 9], labels.month_name, "int") == ["March", "January", "February", "Other"]
    assert _labels(spark, [2, 4, 7, 10], labels.season, "int") == ["Winter", "Spring", "Summer", "Fall"]
    assert _labels(spark, [11], lambda c: labels.month_name(c, full=True), "int") == ["November"]


def test_weather_pattern_first_match_wins(spark):
    df = spark.createDataFrame(
        [(31.0, 0.0, 0.0), (31.0, 10.5, 0.0), (31.0, 10.0, 0.0), (2.0, 30.0, 0.5), (-4.0, 30.0, 0.0), (7.0, 15.5, 0.0), (None, None, None)],
        "avg_temperature double, total_precipitation double, total_snow double")
    assert [r[0] for r in df.select(labels.weather_pattern()).collect()] == [
        "Hot & Dry", "Warm & Rainy", "Normal", "Cold & Snowy", "Freezing", "Heavy Rain", "Normal"]


def _gold(spark, rows):
    return spark.createDataFrame(
        [(d, s, d.year, d.month, d.day, t + 3, t - 3, t, p, n, w) for d, s, t, p, n, w in rows], GOLD_SCHEMA)


@pytest.fixture
def gold(spark):
    """Two invented stations over a late winter and one summer day."""
    d = dt.date
    return _gold(spark, [
        (d(2017, 2, 3), "FELL", -2.25, 0.25, 4.0, 41.0), (d(2017, 2, 4), "FELL", -1.25, 0.25, 0.0, 38.5),
        (d(2017, 2, 5), "FELL", 0.34, 0.25, 0.0, 36.0), (d(2017, 2, 3), "QUAY", 6.4, 0.14, 0.0, 52.0),
        (d(2017, 3, 9), "QUAY", 9.1, 18.0, 0.0, 47.25), (d(2017, 8, 1), "QUAY", 26.6, 0.0, 0.0, 12.0),
    ])


def test_monthly_reports(gold):
    rows = {r.month: r for r in reports.monthly_summary(gold).collect()}
    assert (rows[2].month_name, rows[2].days_count, rows[2].avg_temp_celsius) == ("February", 4, 0.8)  # 3.24 / 4
    assert rows[2].total_precipitation_mm == 0.9 and rows[8].month_name == "Other"
    rain = {r.month: r for r in reports.precipitation_analysis(gold).collect()}
    assert (rain[2].total_days, rain[2].rainy_days, rain[2].rainy_day_percentage) == (4, 4, 100.0)
    assert rain[2].avg_daily_precipitation == 0.2 and rain[8].rainy_days == 0
    dash = {r.month: r for r in reports.monthly_dashboard(gold).collect()}
    assert (dash[2].freezing_days, dash[8].hot_days, dash[3].rainy_days) == (2, 1, 1)
    assert {r.month: r.season for r in reports.seasonal_trends(gold).collect()} == {2: "Winter", 3: "Spring", 8: "Summer"}


def test_extremes_latest_span(gold):
    assert [(r.avg_temperature, r.temperature_category) for r in reports.temperature_extremes(gold).collect()] == [
        (26.6, "Hot"), (-1.25, "Freezing"), (-2.25, "Freezing")]
    assert [(r.date, r.station) for r in reports.latest_days(gold, 2).collect()] == [
        (dt.date(2017, 8, 1), "QUAY"), (dt.date(2017, 3, 9), "QUAY")]
    r = reports.dataset_span(gold).first()
    assert (r.record_count, r.station_count, r.first_date, r.last_date) == (6, 2, dt.date(2017, 2, 3), dt.date(2017, 8, 1))
    assert [(r.year, r.month) for r in reports.distinct_months(gold).collect()] == [(2017, 2), (2017, 3), (2017, 8)]


def test_station_performance(spark, gold):
    rows = {r.station: r for r in reports.station_performance(gold).collect()}
    assert rows["FELL"].data_points == 3 and rows["FELL"].climate_category == "Cold Climate"
    assert rows["QUAY"].avg_temp == 14.0 and rows["QUAY"].climate_category == "Moderate Climate"  # 42.1 / 3
    single = _gold(spark, [(dt.date(2017, 1, 1), "ONE", 1.0, 0.0, 0.0, 1.0)])
    assert reports.station_performance(single).first().temp_variability is None


def test_pattern_distribution_uses_plain_means(spark):
    days = [(dt.date(2017, 4, i + 1), "S", 10.0, p, 0.0, 1.0) for i, p in enumerate((0.25, 0.25, 0.25, 0.14))]
    (r,) = reports.pattern_distribution(_gold(spark, days)).collect()
    assert (r.weather_pattern, r.occurrences, r.percentage, r.avg_precip_for_pattern) == ("Normal", 4, 100.0, 0.2)


def test_station_month_rank_sees_small_differences(spark):
    days = [(dt.date(2017, 4, 1), "LOW", 20.01, 2.0, 0.0, 1.0), (dt.date(2017, 4, 1), "HIGH", 20.04, 1.0, 0.0, 1.0)]
    rows = {r.station: r for r in reports.station_month_rank(_gold(spark, days)).collect()}
    assert (rows["HIGH"].temp_rank, rows["LOW"].temp_rank) == (1, 2)
    assert (rows["HIGH"].precip_rank, rows["LOW"].precip_rank) == (2, 1)


def test_silver_reports(spark):
    silver = spark.createDataFrame(
        [("2017-04-30", "S", 31.0, 11.0, 2.5), ("2017-04-30", "S", 20.0, 9.0, 0.5), ("2017-05-01", "S", 24.0, 13.0, None)],
        "date string, station string, tmax_celsius double, tmin_celsius double, prcp double")
    rows = {r.year_month: r for r in reports.year_month_summary(silver).collect()}
    assert (rows["2017-04"].avg_max_temp, rows["2017-04"].total_precipitation) == (25.5, 3.0)
    assert [(r.total_precipitation, r.record_count) for r in reports.daily_precipitation(silver).collect()] == [(3.0, 2), (None, 1)]
    assert [(r.tmax_celsius, r.temp_category) for r in reports.temperature_bands(silver).collect()] == [
        (31.0, "Hot"), (24.0, "Moderate"), (20.0, "Cold")]


def test_rolling_and_change(spark):
    temps = [20.25, 20.25, 20.14, -7.0]
    g = _gold(spark, [(dt.date(2017, 6, i + 1), "S", t, 0.5, 0.0, 1.0) for i, t in enumerate(temps)])
    rows = timeseries.with_time_series(g).orderBy("date").collect()
    assert [r.rolling_3day_avg for r in rows[:2]] == [20.25, 20.25]
    assert rows[2].rolling_3day_avg == pytest.approx(20.2133333333) and rows[3].rolling_3day_avg == pytest.approx(11.13)
    assert [r.rolling_7day_precip for r in rows] == [0.5, 1.0, 1.5, 2.0]
    assert rows[0].temp_change is None and rows[1].temp_change == 0.0 and rows[3].next_day_temp is None
    assert rows[3].temp_change == pytest.approx(-27.14)
    assert [r.date.day for r in timeseries.station_timeseries(g, "S", 2).collect()] == [1, 2]


def test_windows_do_not_mix_stations(gold):
    rows = {(r.station, r.date.month, r.date.day): r.temp_change for r in timeseries.daily_change(gold).collect()}
    assert rows["QUAY", 2, 3] is None and rows["QUAY", 3, 9] == pytest.approx(2.7) and rows["FELL", 2, 4] == 1.0
