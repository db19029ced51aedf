import os

import pytest

from stratus.operators import clean_observations, daily_gold
from stratus.plans import pipeline
from stratus.sources import load_bronze_csv, read_parquet
from stratus.streaming import start_incremental_pipeline

pytestmark = pytest.mark.integration


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_incremental_gold_matches_batch(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    silver_p, gold_p, ckpt = (os.path.join(tmp_dir, n) for n in ("silver", "gold", "ckpt"))
    pipeline.ingest(spark, landing, station_id="GHCND:A", start_date="2024-01-01", end_date="2024-02-10", seed=1)
    pipeline.ingest(spark, landing, station_id="GHCND:B", start_date="2024-01-20", end_date="2024-01-31", seed=2)

    q = start_incremental_pipeline(spark, os.path.join(landing, "*"), silver_p, gold_p, ckpt,
                                   max_files_per_trigger=1)
    q.awaitTermination(180)
    expected = daily_gold(clean_observations(load_bronze_csv(spark, os.path.join(landing, "*"))))
    assert _rows(read_parquet(spark, gold_p).select(*expected.columns)) == _rows(expected)

    # A late file for January of station A (new rows for days already in gold).
    pipeline.ingest(spark, landing, station_id="GHCND:A", start_date="2024-01-05", end_date="2024-01-06", seed=3)
    q = start_incremental_pipeline(spark, os.path.join(landing, "*"), silver_p, gold_p, ckpt)
    q.awaitTermination(180)
    expected = daily_gold(clean_observations(load_bronze_csv(spark, os.path.join(landing, "*"))))
    got = read_parquet(spark, gold_p).select(*expected.columns)
    assert got.count() == expected.count()
    assert _rows(got) == _rows(expected)
