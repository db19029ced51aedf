import datetime as dt

import pytest
from pyspark.sql.types import DateType

from stratus.operators.gold import AS_CODED, daily_gold
from stratus.operators.silver import AS_CODED_ROWS, DROP_MISSING_TEMPS, clean_observations, rejected_rows

pytestmark = pytest.mark.unit

# July days of two invented stations; temperatures in tenths of a degree.
RAW = [
    ("2019-07-04", "PEAK", "112", "-34", "0.25", "", "0", "31"),
    ("2019-07-05", "PEAK", None, "-20", "7.5", "12", "140", "44"),
    ("2019-07-06", "PEAK", "98", "", "", "0", "139", ""),
    ("2019-07-04", "SHORE", "231", "187", "3", "0", "0", "75"),
]


def test_clean_converts_tenths_and_keeps_null_temperatures(bronze_rows):
    rows = {(r.station, r.day): r for r in clean_observations(bronze_rows(RAW)).collect()}
    assert len(rows) == 4
    r = rows["PEAK", 4]
    assert (r.tmax_celsius, r.tmin_celsius, r.tavg_celsius) == (11.2, -3.4, 3.9)
    assert (r.year, r.month, r.prcp, r.snow, r.awnd) == (2019, 7, 0.25, None, 31.0)
    assert rows["PEAK", 5].tmax_celsius is None and rows["PEAK", 5].tavg_celsius is None
    assert rows["PEAK", 6].tmin is None and rows["PEAK", 6].prcp is None and rows["PEAK", 6].snwd == 139.0


@pytest.mark.parametrize("tmax,tmin,expected", [
    ("5", "-5", (0.5, -0.5, 0.0)), ("-120", "-250", (-12.0, -25.0, -18.5)), ("7", "12", (0.7, 1.2, 0.95)),
])
def test_temperature_conversion(bronze_rows, tmax, tmin, expected):
    r = clean_observations(bronze_rows([("1999-12-31", "X", tmax, tmin, "1", "1", "1", "1")])).first()
    assert (r.tmax_celsius, r.tmin_celsius, r.tavg_celsius) == expected


FAULTY = [
    ("2021-03-09", "X", "26x", "41", "1e1", "", None, "5"),
    ("2021-02-30", "X", "1", "1", "1", "1", "1", "1"),
    ("9 March", "X", "1", "1", "1", "1", "1", "1"),
    (None, "", "1", "1", "1", "1", "1", "1"),
    ("2021-03-10", None, "1", "1", "1", "1", "1", "1"),
    ("2021-03-10", "", "1", None, "1", "1", "1", "1"),
]


def test_malformed_text_becomes_null_and_unusable_keys_go(bronze_rows):
    (r,) = clean_observations(bronze_rows(FAULTY)).collect()
    assert (r.tmax, r.tmin, r.prcp, r.snow, r.snwd, r.awnd) == (None, 41.0, 10.0, None, None, 5.0)


def test_rejected_rows_carry_the_reason(bronze_rows):
    rejected = rejected_rows(bronze_rows(FAULTY))
    got = sorted((r.DATE or "", r.reason) for r in rejected.collect())
    assert got == [("", "DATE missing; STATION missing"), ("2021-02-30", "DATE not a calendar day"),
                   ("2021-03-10", "STATION missing"), ("2021-03-10", "STATION missing"),
                   ("9 March", "DATE not a calendar day")]


def test_row_modes(bronze_rows):
    assert clean_observations(bronze_rows(RAW), on_missing=DROP_MISSING_TEMPS).count() == 2
    as_coded = clean_observations(bronze_rows(RAW + FAULTY), on_missing=AS_CODED_ROWS)
    assert as_coded.count() == 2 + 4 and as_coded.where("date is null").count() == 3
    assert daily_gold(as_coded, dialect=AS_CODED).where("date is null").count() == 2
    with pytest.raises(ValueError):
        clean_observations(bronze_rows(RAW), on_missing="nope")


def test_daily_aggregate(bronze_rows):
    more = [("2019-07-04", "PEAK", "117", "-30", "0.5", "2", "0", "36"), ("2019-07-04", "PEAK", "", "-29", "0.14", "", "", "")]
    gold = daily_gold(clean_observations(bronze_rows(RAW + more)))
    assert isinstance(gold.schema["date"].dataType, DateType)
    rows = {(r.station, r.date): r for r in gold.collect()}
    assert len(rows) == 4
    r = rows["PEAK", dt.date(2019, 7, 4)]
    assert (r.avg_tmax, r.avg_tmin, r.avg_temperature) == (11.5, -3.1, 4.1)  # 11.45, -3.1, (7.8 + 8.7) / 4
    assert r.total_precipitation == pytest.approx(0.89) and r.total_snow == 2.0 and r.avg_wind_speed == 33.5
    assert (r.year, r.month, r.day) == (2019, 7, 4)
    none = rows["PEAK", dt.date(2019, 7, 5)]
    assert none.avg_tmax is None and none.avg_temperature is None and none.avg_tmin == -2.0


def test_daily_aggregate_on_celsius_silver(spark):
    silver = spark.createDataFrame(
        [("2020-02-29", "Q", -4.0, -9.0, -6.5, 1.5, 3.0, 12.0), ("2020-02-29", "Q", -2.0, None, None, 2.0, None, 13.0)],
        "date string, station string, tmax_celsius double, tmin_celsius double, tavg_celsius double, prcp double, "
        "snow double, awnd double")
    r = daily_gold(silver).first()
    assert (r.avg_tmax, r.avg_tmin, r.avg_temperature, r.total_precipitation, r.total_snow) == (-3.0, -9.0, -6.5, 3.5, 3.0)


def test_as_coded_dialect_averages_raw_tenths(bronze_rows):
    raw = bronze_rows([("2018-10-02", "Z", "77", "12", "4", "0", "0", "9"), ("2018-10-02", "Z", "80", "15", "1", "0", "0", "10")])
    gold = daily_gold(clean_observations(raw), dialect=AS_CODED)
    r = gold.first()
    assert (r.avg_max_temp, r.avg_min_temp, r.avg_wind_speed, r.total_precipitation) == (78.5, 13.5, 9.5, 5.0)
    assert set(gold.columns) == {"date", "station", "avg_max_temp", "avg_min_temp", "total_precipitation",
                                 "total_snow", "avg_wind_speed", "year", "month"}
    with pytest.raises(ValueError):
        daily_gold(clean_observations(raw), dialect="other")
