import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import DateType

from stratus import config
from stratus.operators import daily_gold
from stratus.operators.silver import clean_observations
from stratus.plans import pipeline
from stratus.plans.inspect import explain_string
from stratus.sources import (
    generate_observations,
    landing_name,
    load_bronze_csv,
    read_parquet,
    write_landing_csv,
    write_partitioned_parquet,
)

pytestmark = pytest.mark.integration


def _write_text(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_scan_reads_blanks_as_null(spark, tmp_dir):
    p = _write_text(os.path.join(tmp_dir, "w.csv"),
                    "DATE,STATION,TMAX,TMIN,PRCP,SNOW,SNWD,AWND\n"
                    "2031-08-14,QX7,193,88,7,1,2,31\n"
                    "2031-08-15,QX7,,79,3,0,4,44\n")
    df = load_bronze_csv(spark, p)
    assert df.columns == list(config.BRONZE_COLUMNS)
    rows = df.collect()
    assert len(rows) == 2 and rows[1].TMAX is None


def test_missing_input_raises(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        load_bronze_csv(spark, os.path.join(tmp_dir, "nope.csv")).count()


def test_landing_roundtrip(spark, tmp_dir, bronze_rows):
    src = bronze_rows([("2024-01-01", "S", "", "1", "2", "0", "0", "3"),
                       ("bad-date", "S", "5", "", "", "0", "0", "3")])
    path = write_landing_csv(src, os.path.join(tmp_dir, "landing"))
    back = load_bronze_csv(spark, path).orderBy("DATE").collect()
    assert back[0].DATE == "2024-01-01" and back[0].TMAX is None
    assert back[1].TMIN is None and back[1].PRCP is None


def test_partitioned_parquet_roundtrip_and_idempotency(spark, tmp_dir, bronze_rows):
    gold = daily_gold(clean_observations(bronze_rows([
        ("2024-01-01", "S", "250", "150", "1", "0", "0", "3"),
        ("2024-02-01", "S", "260", "160", "2", "0", "0", "4"),
        ("2024-02-02", "T", "270", "170", "3", "0", "0", "5"),
    ])))
    out = os.path.join(tmp_dir, "gold")
    write_partitioned_parquet(gold, out)
    write_partitioned_parquet(gold, out)
    visible = lambda p: sorted(n for n in os.listdir(p) if not n.startswith("."))
    assert visible(out) == ["_SUCCESS", "year=2024"]
    assert visible(os.path.join(out, "year=2024")) == ["month=1", "month=2"]
    back = read_parquet(spark, out)
    assert back.count() == 3
    assert dict(back.dtypes)["year"] == "int" and dict(back.dtypes)["month"] == "int"
    assert isinstance(back.schema["date"].dataType, DateType)
    assert back.filter(back.date == "2024-01-01").first() is not None
    # partition pruning: the month predicate reaches the scan as a partition filter
    plan = explain_string(back.where("month = 2"))
    assert "PartitionFilters: [isnotnull(month" in plan


def test_unpartitioned_when_columns_absent(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    out = write_partitioned_parquet(df, os.path.join(tmp_dir, "flat"))
    assert not any(n.startswith("year=") for n in os.listdir(out))


def test_generator_shape_bounds_and_seed(spark):
    df = generate_observations(spark, "2024-01-01", "2024-01-31", seed=3)
    rows = df.orderBy("DATE").collect()
    assert len(rows) == 31 and rows[0].DATE == "2024-01-01" and rows[-1].DATE == "2024-01-31"
    assert {r.STATION for r in rows} == {"USW00014735"}
    for r in rows:
        if r.TMAX:
            assert 200 <= int(r.TMAX) <= 350
        if r.TMIN:
            assert 100 <= int(r.TMIN) <= 300
        if r.TMAX and r.TMIN:
            assert int(r.TMIN) <= int(r.TMAX) - 50
        assert 10 <= int(r.AWND) <= 200
        assert int(r.SNWD) == 0 or int(r.SNOW) > 0
    again = generate_observations(spark, "2024-01-01", "2024-01-31", seed=3).orderBy("DATE").collect()
    assert again == rows
    assert generate_observations(spark, "2024-01-01", "2024-01-01").count() == 1
    with pytest.raises(ValueError):
        generate_observations(spark, "2024-02-01", "2024-01-01")
    with pytest.raises(ValueError):
        generate_observations(spark, "2024/01/01", "2024-01-02")


def test_landing_name():
    assert landing_name("GHCND:USW00014735", "2024-06-01", "2024-06-03") == \
        "weather_data_GHCND_USW00014735_2024-06-01_2024-06-03.csv"


def test_full_pipeline(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    path = pipeline.ingest(spark, landing, start_date="2024-01-01", end_date="2024-02-28", seed=1)
    assert os.path.basename(path).startswith("weather_data_GHCND_USW00014735_2024-01-01_2024-02-28")
    out = os.path.join(tmp_dir, "processed")
    from stratus.sources import landing_glob
    res = pipeline.transform(spark, landing_glob(landing), out, reports_path=os.path.join(tmp_dir, "reports"))
    gold = read_parquet(spark, out)
    assert gold.count() == 59 == res.view_count
    assert "avg_temperature" in gold.columns and isinstance(gold.schema["date"].dataType, DateType)
    assert len(gold.select("month").distinct().collect()) == 2
    # generated temperatures are tenths, so the default (raw) range rules flag them
    assert res.validation["schema_valid"] and not res.validation["ranges_valid"]
    stats = {(r.stage, r.column_name): r for r in res.stage_stats.collect()}
    assert stats[("bronze", "DATE")].row_count == 59 and stats[("silver", "date")].missing_count == 0
    prof = {r.column_name: r for r in res.profile.collect()}
    assert prof["date"]["count"] == 59
    alerts = {r.metric: r.breached for r in res.alerts.collect()}
    assert alerts["record_count"] is True  # 59 rows < 100 expected
    assert spark.sql(f"SELECT COUNT(*) AS c FROM {config.DEFAULT_VIEW_NAME}").first().c == 59
    text = pipeline.render_run_report(res)
    assert "Quality Score" in text and "TMAX" in text
    # idempotent re-run over the same output
    pipeline.transform(spark, path, out)
    assert read_parquet(spark, out).count() == 59


def test_pipeline_missing_input(spark, tmp_dir):
    with pytest.raises(Exception):
        pipeline.transform(spark, os.path.join(tmp_dir, "none.csv"), os.path.join(tmp_dir, "o"))


def test_pipeline_strict_mode(spark, tmp_dir, bronze_rows):
    bad = bronze_rows([("2024-01-01", "S", "999", "1", "0", "0", "0", "1")])
    with pytest.raises(ValueError):
        pipeline.transform(spark, bad, os.path.join(tmp_dir, "o"), fail_on_invalid=True)


def test_validate_only(spark, bronze_rows):
    checks = pipeline.validate_only(spark, bronze_rows([("2024-01-01", "S", "25", "15", "0", "0", "0", "5")]))
    assert checks["validation_summary"].first().overall_valid
    assert set(checks) == {"schema_check", "range_check", "date_check", "quality_score", "validation_summary"}


def test_report_files(spark, tmp_dir, bronze_rows):
    from stratus.plans.report_files import profile_parquet, profile_report, save_run_report

    silver = clean_observations(bronze_rows([
        ("2024-01-01", "S", "250", "150", "1", "0", "0", "3"),
        ("2024-01-02", "S", "", "160", "2", "0", "0", "4"),
    ]))
    text = profile_report(silver, os.path.join(tmp_dir, "profile_report.md"))
    assert "| tmax | 1 | 1 | 50.0% |" in text and "Total Records: 2" in text
    with pytest.raises(ValueError):
        profile_report(silver.limit(0))
    out = write_partitioned_parquet(daily_gold(silver), os.path.join(tmp_dir, "g"))
    prof = {r.column_name: r for r in profile_parquet(spark, out, os.path.join(tmp_dir, "p.md")).collect()}
    assert prof["avg_tmax"].null_count == 1 and prof["date"].min_value == "2024-01-01"
    with open(os.path.join(tmp_dir, "p.md")) as f:
        assert "**Total Rows:** 2" in f.read()
    res = pipeline.transform(spark, silver.sparkSession.createDataFrame(
        [("2024-01-01", "S", "25", "15", "0", "0", "0", "5")], config.BRONZE_SCHEMA), os.path.join(tmp_dir, "o"))
    path = save_run_report(res, logs_dir=os.path.join(tmp_dir, "logs"))
    with open(path) as f:
        body = f.read()
    assert "Overall Valid**: True" in body and "No issues found" in body


def test_generator_values_do_not_depend_on_partitioning(spark):
    from stratus.sources import generate_from_skeleton

    sk = spark.createDataFrame([("A", dt.date(2024, 1, 1), dt.date(2024, 3, 31)),
                                ("B", dt.date(2024, 2, 1), dt.date(2024, 2, 10))],
                               "station string, start_date date, end_date date")
    one = generate_from_skeleton(sk.coalesce(1), seed=5).orderBy("STATION", "DATE").collect()
    many = generate_from_skeleton(sk.repartition(7), seed=5).orderBy("STATION", "DATE").collect()
    assert one == many and len(one) == 91 + 10
    other_seed = generate_from_skeleton(sk, seed=6).orderBy("STATION", "DATE").collect()
    assert other_seed != one
    blanks = sum(1 for r in one if r.TMAX == "")
    assert 0 < blanks < 20  # about 5 % of 101 rows


def test_exact_and_observed_metrics_agree(spark, tmp_dir):
    from stratus.plans.registry import Layers

    bronze = Layers(10).bronze(spark, "/root/testdata/sf0.001")
    exact = pipeline.transform(spark, bronze, os.path.join(tmp_dir, "e"))
    observed = pipeline.transform(spark, bronze, os.path.join(tmp_dir, "o"), metrics="observed")
    assert exact.validation == observed.validation
    assert exact.view_count == observed.view_count > 4000
    assert _sorted(exact.stage_stats) == _sorted(observed.stage_stats)
    assert _sorted(exact.profile) == _sorted(observed.profile)
    # and they equal the lazily computed reports
    from stratus.operators import profile, quality

    assert quality.validate_observations(bronze) == exact.validation
    lazy = profile.stage_statistics(bronze, "bronze").unionByName(
        profile.stage_statistics(clean_observations(bronze), "silver"))
    assert _sorted(lazy) == _sorted(exact.stage_stats)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_landing_file_format(spark, tmp_dir):
    path = pipeline.ingest(spark, os.path.join(tmp_dir, "landing"), station_id="GHCND:USW00014735",
                           start_date="2024-01-01", end_date="2024-01-31", seed=9)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-") and p.endswith(".csv"))
    lines = []
    for p in parts:
        with open(os.path.join(path, p)) as f:
            body = f.read().splitlines()
        if body:
            assert body[0] == config.CSV_HEADER
            lines += body[1:]
    assert len(lines) == 31
    dates = sorted(line.split(",")[0] for line in lines)
    assert dates[0] == "2024-01-01" and dates[-1] == "2024-01-31"
    assert [dt.date.fromisoformat(d).toordinal() for d in dates] == list(
        range(dt.date(2024, 1, 1).toordinal(), dt.date(2024, 1, 31).toordinal() + 1))
    for line in lines:
        fields = line.split(",")
        assert len(fields) == 8 and fields[1] == "USW00014735"
        assert all(v == "" or v.lstrip("-").isdigit() for v in fields[2:])


def test_default_date_range_is_last_30_days():
    from stratus.sources import default_date_range

    start, end = default_date_range(dt.date(2024, 3, 31))
    assert (start, end) == ("2024-03-01", "2024-03-31")


def test_pipeline_bucketed_copy(spark, tmp_dir):
    from stratus.plans import analytics_suite
    from stratus.plans.inspect import explain_string
    from stratus.plans.registry import Layers

    res = pipeline.transform(spark, Layers(10).bronze(spark, "/root/testdata/sf0.001"),
                             os.path.join(tmp_dir, "g"), station_buckets=4)
    assert res.gold_by_station.count() == res.view_count
    series = analytics_suite(res.gold, station="STN1", gold_by_station=res.gold_by_station)["station_timeseries"]
    plan = explain_string(series)
    assert "Bucketed: true" in plan and "Exchange" not in plan.split("\n\n")[0]
    assert series.count() == 10


def test_run_full_ingests_then_transforms(spark, tmp_dir):
    res = pipeline.run_full(spark, os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out"),
                            station_id="GHCND:USW00014735", start_date="2024-02-01",
                            end_date="2024-02-29", seed=4)
    assert res.view_count == 29
    assert {r.station for r in res.gold.select("station").distinct().collect()} == {"USW00014735"}


def test_dynamic_overwrite_replaces_only_present_months(spark, tmp_dir, bronze_rows):
    out = os.path.join(tmp_dir, "gold")
    first = daily_gold(clean_observations(bronze_rows([
        ("2024-01-01", "S", "250", "150", "1", "0", "0", "3"),
        ("2024-02-01", "S", "260", "160", "2", "0", "0", "4"),
    ])))
    write_partitioned_parquet(first, out)
    update = daily_gold(clean_observations(bronze_rows([
        ("2024-02-01", "S", "200", "100", "9", "0", "0", "4"),
        ("2024-02-02", "S", "210", "110", "1", "0", "0", "4"),
    ])))
    write_partitioned_parquet(update, out, dynamic_overwrite=True)
    got = {(str(r.date), r.total_precipitation) for r in read_parquet(spark, out).collect()}
    assert got == {("2024-01-01", 1.0), ("2024-02-01", 9.0), ("2024-02-02", 1.0)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_results_do_not_depend_on_ansi_mode(spark, bronze_rows, ansi):
    from stratus.operators import validation_summary

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        raw = bronze_rows([
            ("2024-01-01", "S", "26x", "150", "", "0", "0", "50"),
            ("2024-13-03", "S", "250", "150", "1", "0", "0", "50"),
            ("2024-01-02", "S", "250", "", "1e1", "0", "0", " 7"),
        ])
        silver = clean_observations(raw).orderBy("date").collect()
        assert [(str(r.date), r.tmax, r.tmin, r.prcp, r.awnd) for r in silver] == [
            ("2024-01-01", None, 150.0, None, 50.0), ("2024-01-02", 250.0, None, 10.0, 7.0)]
        v = validation_summary(raw).first()
        assert v.schema_valid and v.dates_valid and not v.ranges_valid
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_run_reports_in_parallel(spark, tmp_dir):
    from stratus.plans import analytics_suite, run_reports, write_report_parquet
    from stratus.plans.registry import Layers

    gold = Layers(10).gold(spark, "/root/testdata/sf0.001")
    suite = analytics_suite(gold, station="STN1")
    paths = run_reports(suite, write_report_parquet(os.path.join(tmp_dir, "reports")), max_parallel=4)
    assert set(paths) == set(suite)
    for name, path in paths.items():
        assert read_parquet(spark, path).count() == suite[name].count(), name
