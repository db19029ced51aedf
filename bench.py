"""Benchmark: every registered query plus the one-job pipeline, at one scale.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_STATIONS (default 100, see FIXTURES.md). Prints ONE JSON line.

Each query is evaluated completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver). A short warm-up on sf0.001
runs first so JIT and code generation are not billed to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    stations = int(os.environ.get("BENCH_STATIONS", "100"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stratus-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(cpus * 2, 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from stratus.operators import pattern_distribution
    from stratus.plans import analytics_suite, pipeline, run_reports
    from stratus.plans.registry import Layers, StoredLayers, build_queries
    from stratus.session import ensure_checkpoint_dir, scratch_path

    ensure_checkpoint_dir(spark)
    queries = build_queries(stations=stations)

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for fn in queries.values():
            force(fn(spark, warm))

    times: dict[str, float] = {}
    # Silver and gold tables are written once; reports read them.
    t0 = time.perf_counter()
    stored = StoredLayers(stations)
    stored.silver(spark, sf_dir)
    stored.gold(spark, sf_dir)
    times["store_silver_gold_tables"] = round(time.perf_counter() - t0, 3)
    for name, fn in queries.items():
        t0 = time.perf_counter()
        force(fn(spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    # The ETL path: bronze -> silver -> gold Parquet in one job (validation,
    # stage statistics and profile ride on it), then the report suite over
    # the stored gold table.
    t0 = time.perf_counter()
    result = pipeline.transform(spark, Layers(stations).bronze(spark, sf_dir),
                                scratch_path(spark, "bench-gold"))
    times["pipeline_transform"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run_reports(analytics_suite(result.gold, station="STN1"), lambda name, df: force(df), max_parallel=4)
    times["analytics_suite_on_stored_gold"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    force(pattern_distribution(result.gold))
    times["flagship_on_stored_gold"] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_seconds_all_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "stations": stations,
        "cpus": cpus,
        "gold_rows": result.view_count,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
