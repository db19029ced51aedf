"""Scratch folder rules, stored tables that follow their input, streams that restart, one parse of the landing files."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from stratus import session
from stratus.plans import pipeline
from stratus.plans.inspect import explain_string
from stratus.plans.registry import build_queries
from stratus.sources import bronze_from_tables, load_bronze_csv, read_parquet, rows_with_schema, write_landing_csv
from stratus.streaming import start_incremental_pipeline

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


class _Session:
    """What ensure_checkpoint_dir reads of a session."""

    def __init__(self, master, conf):
        self.conf, self.sparkContext, self.master, self.set_to = conf, self, master, None

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.set_to = path


def test_checkpoint_dir_is_required_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session("spark://host:7077", {}))
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.ensure_checkpoint_dir(shared) == "hdfs:///shared"
    local = _Session("local[2]", {"spark.sql.warehouse.dir": "file:/w"})
    assert session.ensure_checkpoint_dir(local) == "file:/w/_scratch" == local.set_to


@needs_tables
def test_stored_tables_follow_nested_new_files(spark, tmp_path):
    folder = tmp_path / "lineitem.parquet"
    (folder / "part=0").mkdir(parents=True)
    shutil.copy(f"{SF}/lineitem.parquet", folder / "part=0" / "a.parquet")
    queries = build_queries()
    before = queries["gold_view_count"](spark, str(tmp_path)).first()[0]
    silver = queries["column_profile"](spark, str(tmp_path)).where("column_name = 'date'").first()["count"]
    (folder / "part=1").mkdir()
    shutil.copy(f"{SF}/lineitem.parquet", folder / "part=1" / "b.parquet")
    again = queries["column_profile"](spark, str(tmp_path)).where("column_name = 'date'").first()["count"]
    assert again == 2 * silver
    assert queries["gold_view_count"](spark, str(tmp_path)).first()[0] == before
    assert queries["quality_score"](spark, str(tmp_path)).first().total_records == 2 * 6_000


@needs_tables
def test_one_file_and_many_files_have_one_plan_shape(spark, tmp_path):
    bronze = bronze_from_tables(spark, SF).limit(400)
    write_landing_csv(bronze.coalesce(1), str(tmp_path / "one"))
    write_landing_csv(bronze.repartition(9), str(tmp_path / "many"))
    plans = [explain_string(load_bronze_csv(spark, str(tmp_path / n))) for n in ("one", "many")]
    assert all("Exchange" not in p for p in plans)


@needs_tables
def test_transform_parses_csv_once_and_writes_rejects(spark, tmp_path):
    landing = write_landing_csv(bronze_from_tables(spark, SF), str(tmp_path / "landing"))
    result = pipeline.transform(spark, landing, str(tmp_path / "gold"), rejects_path=str(tmp_path / "rejects"))
    whole = load_bronze_csv(spark, landing).count()
    assert result.rejected.count() + result.profile.where("column_name = 'date'").first()["count"] == whole
    assert result.run.first().peak_memory_mb > 0
    assert result.view_count == read_parquet(spark, str(tmp_path / "gold")).count()


def test_a_restarted_stream_counts_once(spark, tmp_path):
    landing, silver, gold = (str(tmp_path / n) for n in ("landing", "silver", "gold"))
    pipeline.ingest(spark, landing, station_id="GHCND:N", start_date="2023-03-01", end_date="2023-03-10", seed=4)

    def run(checkpoint=None):
        start_incremental_pipeline(spark, os.path.join(landing, "*"), silver, gold, checkpoint).awaitTermination(180)
        return (spark.read.parquet(silver).count(), read_parquet(spark, gold).agg(F.sum("total_precipitation")).first()[0])

    first = run()
    pipeline.ingest(spark, landing, station_id="GHCND:N", start_date="2023-03-11", end_date="2023-03-20", seed=5)
    second = run()
    assert first[0] == 10 and second[0] == 20
    assert run() == second                                       # nothing new
    assert run(str(tmp_path / "another checkpoint")) == second   # every file once more


def test_rows_with_an_explicit_schema(spark):
    df = rows_with_schema(spark, [(None, "A", 2020, 1, 2, 1.0, 0.0, 0.5, 0.0, None, 3.0)])
    assert df.first().avg_temperature == 0.5 and dict(df.dtypes)["year"] == "int"
