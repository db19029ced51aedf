import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from stratus.config import BRONZE_SCHEMA, ValidationRules
from stratus.operators import profile, quality

pytestmark = pytest.mark.unit


@pytest.fixture
def clean(bronze_rows):
    return bronze_rows([(f"2022-05-{day:02d}", "HARBOUR", str(12 + day), str(day - 3), str(day * 2), "0", "0", "33")
                        for day in range(1, 8)])


@pytest.fixture
def faulty(bronze_rows):
    return bronze_rows([
        ("2022-05-01", "HARBOUR", "61", "-51", "1000.5", "501", "7", "20000000"),
        ("1 May", None, "", "4", "-1", "", "", ""),
        ("2022-05-02", "HARBOUR", "18", "", "3", "-2", "0", "-0.5"),
        ("2022-13-40", "", "warm", "5", "0", "0", "0", "12"),
    ])


def test_schema_valid(clean):
    assert quality.validate_schema(clean) == (True, [])
    rows = quality.schema_check(clean).collect()
    assert len(rows) == 8 and all(r.type_ok and r.present and r.issue is None for r in rows)


def test_schema_check_reads_no_rows(clean):
    from stratus.plans.inspect import explain_string
    assert "Aggregate" not in explain_string(quality.schema_check(clean))


def test_schema_missing_column_and_wrong_type(spark):
    schema = StructType([StructField("DATE", StringType()), StructField("TMIN", DoubleType()), StructField("TMAX", StringType())])
    df = spark.createDataFrame([("2022-05-01", 3.5, "9")], schema)
    ok, issues = quality.validate_schema(df)
    assert not ok and any("STATION" in i for i in issues) and any("TMIN" in i for i in issues)
    rows = {r.column_name: r for r in quality.schema_check(df).collect()}
    assert rows["STATION"].present is False and "STATION" in rows["STATION"].issue
    assert rows["TMIN"].type_ok is False and rows["TMAX"].type_ok is True


def test_ranges(clean, faulty):
    assert quality.validate_ranges(clean) == (True, [])
    ok, issues = quality.validate_ranges(faulty)
    assert not ok
    assert issues == [
        "TMAX maximum value 61.0 above threshold 60", "TMIN minimum value -51.0 below threshold -50",
        "PRCP minimum value -1.0 below threshold 0", "PRCP maximum value 1000.5 above threshold 1000",
        "SNOW minimum value -2.0 below threshold 0", "SNOW maximum value 501.0 above threshold 500",
        "AWND minimum value -0.5 below threshold 0", "AWND maximum value 20000000.0 above threshold 100"]


@pytest.mark.parametrize("value,text", [("9999999.5", "9999999.5"), ("10000000", "10000000.0"), ("12345678.25", "12345678.25"),
                                        ("123456789012", "123456789012.0")])
def test_large_values_are_written_plainly(bronze_rows, value, text):
    df = bronze_rows([("2022-05-01", "H", "1", "1", value, "0", "0", "0")])
    assert quality.validate_ranges(df)[1] == [f"PRCP maximum value {text} above threshold 1000"]


def test_range_bounds_are_inclusive(bronze_rows):
    low = ("2022-05-01", "H", "-50", "-50", "0", "0", "0", "0")
    high = ("2022-05-02", "H", "60", "60", "1000", "500", "0", "100")
    assert quality.validate_ranges(bronze_rows([low, high])) == (True, [])


def test_range_unit_divisor(bronze_rows):
    df = bronze_rows([("2022-05-01", "H", "183", "97", "0", "0", "0", "1")])
    assert not quality.validate_ranges(df)[0]
    assert quality.validate_ranges(df, ValidationRules(unit_divisor=10.0))[0]


def test_dates(clean, faulty, spark):
    assert quality.validate_dates(clean) == (True, [])
    row = quality.date_check(faulty).first()
    assert (row.invalid_dates, row.total_dates, row.dates_valid) == (1, 4, False)  # the shape counts, not the calendar
    assert row.issue.startswith("High percentage of invalid dates: 25.00")
    assert quality.validate_dates(spark.createDataFrame([(1,)], "n int")) == (False, ["DATE column not found"])


def test_quality_scores(spark, clean, faulty):
    assert quality.score_of(clean) == 1.0
    assert quality.score_of(faulty) == pytest.approx(1 - 4 / 16)
    assert quality.score_of(spark.createDataFrame([], BRONZE_SCHEMA)) == 0.0


def test_validation_summary(clean, faulty):
    good = quality.validate_observations(clean)
    assert good.pop("issues") == [] and good.pop("quality_score") == 1.0 and all(good.values())
    bad = quality.validate_observations(faulty)
    assert not bad["overall_valid"] and bad["schema_valid"] and not bad["dates_valid"] and len(bad["issues"]) == 9


def test_gold_reports(spark):
    gold = spark.createDataFrame(
        [("2022-05-01", "A", 7.0, 9.0, 8.0, 0.25, 201.0), ("2022-05-02", "A", 16.0, 4.0, 12.5, 0.25, 3.0),
         ("2022-05-03", "A", 16.0, 4.0, 11.0, 0.25, None), ("2022-05-04", "A", None, None, 61.0, 0.14, 2.0)],
        "date string, station string, avg_tmax double, avg_tmin double, avg_temperature double, "
        "total_precipitation double, avg_wind_speed double")
    comp = {r.metric: r for r in quality.completeness_report(gold).collect()}
    assert comp["Wind Speed"].complete_records == 3 and comp["Wind Speed"].completeness_percentage == 75.0
    rng = {r.metric: r for r in quality.range_report(gold).collect()}
    assert [rng[m].outliers for m in ("Temperature", "Precipitation", "Wind Speed")] == [1, 0, 1]
    assert rng["Precipitation"].avg_value == 0.2  # the mean 0.2225, not the mean of values cut to one decimal
    labels = [r.consistency_check for r in quality.consistency_report(gold).collect()]
    assert labels == ["ERROR: Max < Min", "WARNING: Avg not between min/max"]


def test_row_labels_are_ordered(spark):
    silver = spark.createDataFrame([("2022-05-02", "A", 31.0, 1.0, 0.0), ("2022-05-01", "B", 41.0, 1.0, 60.0),
                                    ("2022-05-01", "A", 9.0, -21.0, 21.0)],
                                   "date string, station string, tmax_celsius double, tmin_celsius double, prcp double")
    rows = quality.row_quality_labels(silver).collect()
    assert [(r.date, r.station) for r in rows] == [("2022-05-01", "A"), ("2022-05-01", "B"), ("2022-05-02", "A")]
    assert [r.temp_quality for r in rows] == ["Extreme Temperature", "Extreme Temperature", "High Temperature"]


def test_threshold_evaluation(spark):
    metrics = spark.createDataFrame([("processing_time_seconds", 300.5), ("quality_score", 0.85), ("record_count", 99.0),
                                     ("memory_used_mb", 4096.0), ("unknown", 1.0)], "metric string, value double")
    got = {r.metric: r.breached for r in quality.evaluate_thresholds(metrics).collect()}
    assert got == {"processing_time_seconds": True, "quality_score": False, "record_count": True, "memory_used_mb": False}


def test_column_profiles(spark, faulty):
    rows = {r.column_name: r for r in profile.column_profile(faulty).collect()}
    assert rows["STATION"]["count"] == 3 and rows["STATION"].nulls == 1 and rows["STATION"].null_percentage == 25.0
    df = spark.createDataFrame([(4.5, "p"), (float("nan"), None), (None, "q")], "x double, s string")
    mm = {r.column_name: r for r in profile.column_profile_minmax(df).collect()}
    assert mm["x"].null_count == 2 and mm["s"].null_count == 1
    assert (mm["s"].min_value, mm["s"].max_value) == ("p", "q")
    with pytest.raises(ValueError):
        profile.profile_rows(spark.createDataFrame([], BRONZE_SCHEMA))


def test_stage_statistics(faulty):
    rows = {r.column_name: r for r in profile.stage_statistics(faulty, "bronze").collect()}
    assert rows["STATION"].missing_count == 2 and rows["TMAX"].missing_count == 1 and rows["DATE"].missing_count == 0
    assert rows["TMIN"].missing_percentage == 25.0 and rows["TMIN"].column_count == 8
