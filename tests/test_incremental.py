"""Increments of gold and of validation equal one full run."""

import os
from datetime import date

import pytest

from stratus import config
from stratus.operators import clean_observations, daily_gold, quality
from stratus.plans import incremental
from stratus.plans.inspect import explain_string
from stratus.sources import load_bronze_csv, read_parquet, write_landing_csv

SILVER = "date date, station string, tmax double, tmin double, prcp double, snow double, awnd double"


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def gold_rows(df):
    return sorted(map(str, df.select(*config.GOLD_SCHEMA.names).collect()))


MAY, JUNE = date(2031, 5, 30), date(2031, 6, 2)
FIRST = [(MAY, "K1", 211.0, 87.0, 1.5, None, 30.0), (MAY, "K2", None, 92.0, None, None, None), (JUNE, "K1", 240.0, 131.0, 0.0, 2.0, 11.0)]
LATE = [(MAY, "K1", 202.0, None, 0.25, 4.0, None), (MAY, "K2", 190.0, 71.0, 3.0, None, 8.0), (MAY, "K3", 155.0, 60.0, None, 1.0, 9.0)]


def test_late_rows_equal_one_full_run(spark, tmp_dir):
    state, out = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "gold")
    incremental.add_increment(spark, silver(spark, FIRST), "a", state, out)
    assert gold_rows(read_parquet(spark, out)) == gold_rows(daily_gold(silver(spark, FIRST)))
    june = sorted(os.listdir(os.path.join(out, "year=2031", "month=6")))
    touched = incremental.add_increment(spark, silver(spark, LATE), "b", state, out)
    want = gold_rows(daily_gold(silver(spark, FIRST + LATE)))
    assert gold_rows(read_parquet(spark, out)) == want
    assert sorted(os.listdir(os.path.join(out, "year=2031", "month=6"))) == june  # not rewritten
    plan = explain_string(touched)
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("\n")[0]
    incremental.add_increment(spark, silver(spark, LATE), "b", state, out)  # run again after a restart
    assert gold_rows(read_parquet(spark, out)) == want


def test_an_increment_that_changes_takes_its_old_rows_back(spark, tmp_dir):
    state, out = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "gold")
    incremental.add_increment(spark, silver(spark, FIRST), "a", state, out)
    incremental.add_increment(spark, silver(spark, LATE), "b", state, out)
    incremental.add_increment(spark, silver(spark, LATE[:1]), "b", state, out)
    assert gold_rows(read_parquet(spark, out)) == gold_rows(daily_gold(silver(spark, FIRST + LATE[:1])))


def test_an_empty_increment_changes_nothing(spark, tmp_dir):
    state, out = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "gold")
    incremental.add_increment(spark, silver(spark, FIRST), "a", state, out)
    incremental.add_increment(spark, silver(spark, []), "b", state, out)
    assert gold_rows(read_parquet(spark, out)) == gold_rows(daily_gold(silver(spark, FIRST)))


def landing_rows(bronze_rows, day, n):
    return bronze_rows([(f"2031-07-{day:02d}" if k % 7 else "soon", f"K{k % 3}", str(180 + k) if k % 4 else "", str(90 - k), "1", "0", "0", "20")
                        for k in range(n)])


def verdict(df):
    return tuple(df.first())


def test_only_new_files_are_read(spark, bronze_rows, tmp_dir):
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    with pytest.raises(Exception):
        incremental.update_ledger(spark, landing, ledger)
    for day, n in ((1, 30), (2, 12)):
        write_landing_csv(landing_rows(bronze_rows, day, n).coalesce(1), f"{landing}/day{day} é%", mode="append")
        full = verdict(quality.validation_summary(load_bronze_csv(spark, f"{landing}/*")))
        held, read = incremental.update_ledger(spark, landing, ledger)
        assert len(read) == 1 and held.count() == day and f"day{day}" in read[0]
        assert verdict(incremental.incremental_verdict(spark, landing, ledger)) == full
    assert incremental.update_ledger(spark, landing, ledger)[1] == []


def test_a_file_that_went_does_not_count(spark, bronze_rows, tmp_dir):
    landing, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    for day in (1, 2):
        write_landing_csv(landing_rows(bronze_rows, day, 9 * day).coalesce(1), f"{landing}/day{day}")
    incremental.update_ledger(spark, landing, ledger)
    write_landing_csv(landing_rows(bronze_rows, 2, 41).coalesce(1), f"{landing}/day2")  # replaced
    full = verdict(quality.validation_summary(load_bronze_csv(spark, f"{landing}/*")))
    assert verdict(incremental.incremental_verdict(spark, landing, ledger)) == full


def test_silver_from_landing_feeds_increments(spark, bronze_rows, tmp_dir):
    rows = landing_rows(bronze_rows, 3, 40)
    state, out = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "gold")
    cleaned = clean_observations(rows)
    incremental.add_increment(spark, cleaned.where("tmin > 70"), "x", state, out)
    incremental.add_increment(spark, cleaned.where("NOT tmin > 70"), "y", state, out)
    assert gold_rows(read_parquet(spark, out)) == gold_rows(daily_gold(cleaned))
