"""End-to-end pipelines.

``transform`` runs bronze -> silver -> gold -> partitioned Parquet. By
default a CSV input is parsed once, into a columnar copy in the scratch
folder; one exact aggregate over it yields every run metric (validation
measures, bronze and silver stage statistics, the silver profile), then one
job writes gold from it. Both results are exact when tasks are retried.
``metrics="observed"`` folds the metrics into the write job through
``Observation`` instead (no copy, one scan, but at-least-once counts under
stage retries). The written row count is observed in the write stage, which
is a result stage. Rows without a usable key can be written, with the reason.

After the write, gold is read back from storage (which also cuts the
lineage) and registered as a temp view.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_RULES, ValidationRules
from ..operators import quality, run_metrics
from ..operators.gold import daily_gold
from ..operators.profile import observe_stage, observed_stage_rows, STAGE_STATS_SCHEMA
from ..operators.silver import clean_observations, rejected_rows
from ..session import remove_path, scratch_path
from ..sources.bronze_csv import load_bronze_csv, write_landing_csv, landing_name, default_date_range, validate_iso_date
from ..sources.generator import generate_from_skeleton, generate_observations, station_code
from ..sources.parquet import read_parquet, write_bucketed_table, write_partitioned_parquet


@dataclass
class PipelineResult:
    gold_path: str
    gold: DataFrame
    validation: dict
    stage_stats: DataFrame
    profile: DataFrame
    metrics: DataFrame
    alerts: DataFrame
    view_count: int | None = None
    timings: dict = field(default_factory=dict)
    gold_by_station: DataFrame | None = None
    rejected: DataFrame | None = None
    run: DataFrame | None = None  # one row: seconds, MB now and at most, start and end


def _verdict_from_measures(spark: SparkSession, bronze: DataFrame, values: dict,
                           rules: ValidationRules) -> dict:
    """Apply the verdict projection to the observed one-row measures."""
    template = quality.quality_measures(bronze, rules)
    row = tuple(values.get(f.name) for f in template.schema.fields)
    measures = spark.createDataFrame([row], template.schema)
    verdict_df = quality.verdict_from_measures(measures, bronze, rules)
    r = verdict_df.collect()[0]  # one row; collect runs one job, first() may probe several
    return {
        "overall_valid": bool(r["overall_valid"]),
        "schema_valid": bool(r["schema_valid"]),
        "ranges_valid": bool(r["ranges_valid"]),
        "dates_valid": bool(r["dates_valid"]),
        "quality_score": float(r["quality_score"]),
        "issues": list(r["issues"]),
    }


def driver_memory_mb(spark: SparkSession) -> float:
    """Memory that the driver holds now: this Python process (where /proc tells) and the JVM's used heap."""
    python = 0
    if os.path.exists("/proc/self/statm"):
        with open("/proc/self/statm", encoding="ascii") as f:
            python = int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return (python + runtime.totalMemory() - runtime.freeMemory()) / 2**20


def transform(spark: SparkSession, source: str | DataFrame, output_path: str, *,
              view_name: str = config.DEFAULT_VIEW_NAME,
              on_missing: str = "keep_null_temps",
              rules: ValidationRules = DEFAULT_RULES,
              fail_on_invalid: bool = False,
              dynamic_overwrite: bool = False,
              partition_cols: tuple[str, ...] | None = None,
              metrics: str = "exact",
              station_buckets: int | None = None,
              reports_path: str | None = None,
              rejects_path: str | None = None) -> PipelineResult:
    """Landing CSV (path/glob) or bronze DataFrame -> validated gold Parquet.

    ``metrics="exact"`` (default): one aggregate over the typed bronze rows
    computes the verdict, bronze and silver stage statistics and the silver
    profile (exact under task retries), then one job writes gold. The source is
    read once for both, into a Parquet copy that is deleted at the end.
    ``fail_on_invalid`` stops before the write at no extra cost.

    ``metrics="observed"``: the same measures ride on the write job through
    ``Observation`` (one scan). Observed counts come from accumulators in a
    shuffle-map stage and can count twice if that stage is re-run after an
    executor loss; the gold data itself is exact either way.

    ``station_buckets``: also write a copy of gold bucketed by station and
    sorted by (station, date) to ``<output_path>_by_station``, registered as
    a catalog table. Per-station windows over it need no shuffle.
    """
    if metrics not in ("exact", "observed"):
        raise ValueError(f"unknown metrics mode: {metrics!r}")
    started = time.time()
    memory = [driver_memory_mb(spark)]
    bronze = load_bronze_csv(spark, source) if isinstance(source, str) else source
    copy = None
    if metrics == "exact":
        copy = scratch_path(spark, "bronze")
        bronze.write.parquet(copy)
        bronze = spark.read.schema(bronze.schema).parquet(copy)
    gold_rows = Observation("gold_rows")

    if metrics == "exact":
        m = run_metrics.run_measures(bronze, on_missing=on_missing, rules=rules).collect()[0]
        measured = run_metrics.measure_values(m, bronze, rules)
        validation = _verdict_from_measures(spark, bronze, measured, rules)
        if fail_on_invalid and not validation["overall_valid"]:
            raise ValueError(f"Input failed validation: {validation['issues']}")
        stage_rows = run_metrics.stage_rows(bronze, m, rules)
        profile_rows = run_metrics.profile_rows(m)
        gold = daily_gold(clean_observations(bronze, on_missing=on_missing))
        t_write = time.time()
        write_partitioned_parquet(gold, output_path, partition_cols, dynamic_overwrite=dynamic_overwrite,
                                  count_rows=gold_rows)
        write_seconds = time.time() - t_write
    else:
        if fail_on_invalid:
            verdict = quality.validate_observations(bronze, rules)
            if not verdict["overall_valid"]:
                raise ValueError(f"Input failed validation: {verdict['issues']}")
        measure_obs = Observation("bronze_quality")
        bronze_obs_df = bronze.observe(measure_obs, *quality.measure_columns(bronze, rules))
        bronze_stage_df, bronze_stage_obs, bronze_cols = observe_stage(bronze_obs_df, "bronze")
        silver = clean_observations(bronze_stage_df, on_missing=on_missing)
        silver_stage_df, silver_stage_obs, silver_cols = observe_stage(silver, "silver")
        profile_obs = Observation("silver_profile")
        silver_profiled = silver_stage_df.observe(
            profile_obs, F.count(F.lit(1)).alias("__rows"),
            *[F.count(F.col(c)).alias(c) for c in silver.columns])
        t_write = time.time()
        write_partitioned_parquet(daily_gold(silver_profiled), output_path, partition_cols,
                                  dynamic_overwrite=dynamic_overwrite, count_rows=gold_rows)
        write_seconds = time.time() - t_write
        measured = measure_obs.get
        validation = _verdict_from_measures(spark, bronze, measured, rules)
        stage_rows = (observed_stage_rows("bronze", len(bronze.columns), bronze_cols, bronze_stage_obs.get)
                      + observed_stage_rows("silver", len(silver.columns), silver_cols, silver_stage_obs.get))
        prof = profile_obs.get
        n = int(prof.get("__rows", 0) or 0)
        profile_rows = [(c, int(prof.get(c, 0) or 0), n - int(prof.get(c, 0) or 0),
                         ((n - int(prof.get(c, 0) or 0)) * 100.0 / n) if n else None) for c in silver.columns]

    stage_stats = spark.createDataFrame(stage_rows, STAGE_STATS_SCHEMA)
    profile = spark.createDataFrame(
        profile_rows, "column_name string, count bigint, nulls bigint, null_percentage double")

    # Read back: lineage is cut at the written table; the view serves SQL.
    # The row count was observed in the write stage, so no extra scan is needed.
    gold_back = read_parquet(spark, output_path)
    gold_back.createOrReplaceTempView(view_name)
    view_count = int(gold_rows.get.get("rows", 0) or 0)
    by_station = None
    if station_buckets:
        path = output_path.rstrip("/") + "_by_station"
        table = f"{view_name}_by_station_{zlib.crc32(path.encode()):08x}"
        by_station = write_bucketed_table(gold_back, path, table, station_buckets,
                                          "station", ("station", "date"))

    rejected = None
    if rejects_path:
        rejected_rows(bronze).write.mode("overwrite").parquet(rejects_path)
        rejected = read_parquet(spark, rejects_path)
    if copy:
        remove_path(spark, copy)

    ended = time.time()
    memory.append(driver_memory_mb(spark))
    metrics_df = spark.createDataFrame(
        [
            ("processing_time_seconds", ended - started),
            ("memory_used_mb", memory[-1] - memory[0]),
            ("quality_score", validation["quality_score"]),
            ("record_count", float(measured.get("row_count", 0) or 0)),
            ("gold_rows", float(view_count)),
            ("write_seconds", write_seconds),
        ],
        "metric string, value double",
    )
    alerts = quality.evaluate_thresholds(metrics_df)
    result = PipelineResult(
        gold_path=output_path, gold=gold_back, validation=validation, stage_stats=stage_stats,
        profile=profile, metrics=metrics_df, alerts=alerts, view_count=view_count,
        gold_by_station=by_station, rejected=rejected,
        run=spark.createDataFrame(
            [(ended - started, memory[-1] - memory[0], max(memory), _dt.datetime.fromtimestamp(started).isoformat(),
              _dt.datetime.fromtimestamp(ended).isoformat())],
            "processing_time_seconds double, memory_used_mb double, peak_memory_mb double, start_time string, "
            "end_time string"),
        timings={"total": ended - started, "write": write_seconds,
                 "start_time": _dt.datetime.fromtimestamp(started).isoformat(),
                 "end_time": _dt.datetime.fromtimestamp(ended).isoformat()},
    )
    if reports_path:
        save_reports(result, reports_path)
    return result


def save_reports(result: PipelineResult, path: str) -> None:
    """Run reports as small Parquet tables (one file each)."""
    base = path.rstrip("/")
    for name, df in (("stage_stats", result.stage_stats), ("profile", result.profile),
                     ("metrics", result.metrics), ("alerts", result.alerts), ("run", result.run)):
        df.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")


def render_run_report(result: PipelineResult) -> str:
    """Markdown text of the run (a few collected rows)."""
    v = result.validation
    metrics = {r["metric"]: r["value"] for r in result.metrics.collect()}
    lines = [
        config.RUN_REPORT_TITLE,
        f"Generated: {_dt.datetime.now().strftime('%Y-%m-%d %H:%M:%S')}",
        "",
        "## Processing Metrics",
        f"- **Processing Time**: {metrics.get('processing_time_seconds', 0):.2f} seconds",
        f"- **Memory Used**: {metrics.get('memory_used_mb', 0):.2f} MB",
        "",
        "## Data Quality Metrics",
        f"- **Overall Valid**: {v['overall_valid']}",
        f"- **Schema Valid**: {v['schema_valid']}",
        f"- **Ranges Valid**: {v['ranges_valid']}",
        f"- **Dates Valid**: {v['dates_valid']}",
        f"- **Quality Score**: {v['quality_score']:.3f}",
        "",
        "## Performance Thresholds",
        f"- **Max Processing Time**: {config.MAX_PROCESSING_TIME_SECONDS}s",
        f"- **Min Quality Score**: {config.MIN_DATA_QUALITY_SCORE}",
        f"- **Max Memory Usage**: {config.MAX_MEMORY_USAGE_GB}GB",
        "",
        "## Issues Found",
    ]
    lines += [f"- {i}" for i in v["issues"]] or ["- No issues found"]
    return "\n".join(lines) + "\n"


def ingest(spark: SparkSession, landing_dir: str, *, station_id: str = config.DEFAULT_STATION_ID,
           start_date: str | None = None, end_date: str | None = None, seed: int = 42,
           spans: DataFrame | None = None) -> str:
    """Generate observations into the landing folder: for a station and date range, or for
    every row ``(station, start_date, end_date)`` of ``spans``."""
    if spans is not None:
        return write_landing_csv(generate_from_skeleton(spans, seed), f"{landing_dir.rstrip('/')}/observations")
    if not start_date or not end_date:
        d_start, d_end = default_date_range()
        start_date, end_date = start_date or d_start, end_date or d_end
    validate_iso_date(start_date)
    validate_iso_date(end_date)
    bronze = generate_observations(spark, start_date, end_date, [station_id], seed)
    path = f"{landing_dir.rstrip('/')}/{landing_name(station_id, start_date, end_date)}"
    return write_landing_csv(bronze, path)


def run_full(spark: SparkSession, landing_dir: str, output_path: str, **kwargs) -> PipelineResult:
    """Ingest, then transform the file just ingested."""
    ingest_kwargs = {k: kwargs.pop(k) for k in ("station_id", "start_date", "end_date", "seed", "spans") if k in kwargs}
    path = ingest(spark, landing_dir, **ingest_kwargs)
    return transform(spark, path, output_path, **kwargs)


def validate_only(spark: SparkSession, source: str | DataFrame,
                  rules: ValidationRules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """Validation without cleaning or writing: the check tables, lazily."""
    bronze = load_bronze_csv(spark, source) if isinstance(source, str) else source
    return {
        "schema_check": quality.schema_check(bronze, rules),
        "range_check": quality.range_check(bronze, rules),
        "date_check": quality.date_check(bronze, rules),
        "quality_score": quality.quality_score(bronze, rules),
        "validation_summary": quality.validation_summary(bronze, rules),
    }


__all__ = ["PipelineResult", "transform", "ingest", "run_full", "validate_only",
           "render_run_report", "save_reports", "station_code"]
