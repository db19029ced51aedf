"""The analytics suite over a gold table and the SQL view helpers.

``analytics_suite(gold)`` returns the named report DataFrames (all lazy). With
``partials`` (the table of :func:`stored_partials`, worked out in one pass over
gold) the aggregated reports are roll-ups of it and read gold no more; the
row-level reports (extremes, inconsistent days, one station's series) filter
gold. Without, each report runs its own aggregate over gold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import quality, reports, rollup, timeseries
from ..session import scratch_path


def create_view(df: DataFrame, name: str = config.DEFAULT_VIEW_NAME) -> str:
    """Register (or replace) a session temp view."""
    df.createOrReplaceTempView(name)
    return name


def view_count(spark: SparkSession, name: str = config.DEFAULT_VIEW_NAME) -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS count FROM {name}")


#: The columns that tell the rows of each report apart.
REPORT_KEYS = {
    "monthly_summary": ("year", "month"), "temperature_extremes": ("date", "station"), "precipitation_analysis": ("month",),
    "station_month_rank": ("station", "month"), "pattern_distribution": ("weather_pattern",), "completeness_report": ("metric",),
    "range_report": ("metric",), "consistency_report": ("date", "station"), "monthly_dashboard": ("month",),
    "station_performance": ("station",), "seasonal_trends": ("month",), "dataset_span": (), "station_timeseries": ("date", "station"),
}


def stored_partials(gold: DataFrame, path: str | None = None) -> DataFrame:
    """The suite's mergeable aggregates, written once (to ``path`` or the scratch folder)."""
    path = path or scratch_path(gold.sparkSession, "suite-partials")
    partials = rollup.suite_partials(gold)
    partials.write.mode("overwrite").parquet(path)
    return gold.sparkSession.read.schema(partials.schema).parquet(path)


def analytics_suite(gold: DataFrame, station: str | None = None,
                    gold_by_station: DataFrame | None = None,
                    partials: DataFrame | None = None) -> dict[str, DataFrame]:
    """Named reports over gold: basic, advanced, quality and dashboard groups.

    ``gold_by_station`` (a station-bucketed copy, see ``pipeline.transform``)
    serves the per-station time series without a shuffle.
    """
    suite = {
        "monthly_summary": reports.monthly_summary(gold),
        "temperature_extremes": reports.temperature_extremes(gold),
        "precipitation_analysis": reports.precipitation_analysis(gold),
        "station_month_rank": reports.station_month_rank(gold),
        "pattern_distribution": reports.pattern_distribution(gold),
        "completeness_report": quality.completeness_report(gold),
        "range_report": quality.range_report(gold),
        "consistency_report": quality.consistency_report(gold),
        "monthly_dashboard": reports.monthly_dashboard(gold),
        "station_performance": reports.station_performance(gold),
        "seasonal_trends": reports.seasonal_trends(gold),
        "dataset_span": reports.dataset_span(gold),
    }
    if partials is not None:
        suite |= {name: fn(partials) for name, fn in rollup.ROLLED_UP.items()}
    if station is not None:
        series_source = gold if gold_by_station is None else gold_by_station
        suite["station_timeseries"] = timeseries.station_timeseries(series_source, station)
    return suite


def write_report_parquet(base_path: str):
    """A sink that writes each report as one Parquet directory under ``base_path``."""
    def sink(name: str, df: DataFrame) -> str:
        path = f"{base_path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return path
    return sink


def run_reports(suite: dict[str, DataFrame], sink, max_parallel: int = 4) -> dict:
    """Materialise every report with ``sink(name, df)``, up to ``max_parallel`` at once.

    Reports are independent jobs; submitting them from a small thread pool
    lets Spark run them concurrently, so short jobs overlap instead of each
    waiting for the previous job's last task. Results are returned by name;
    the first failure is raised.
    """
    from concurrent.futures import ThreadPoolExecutor

    if max_parallel <= 1:
        return {name: sink(name, df) for name, df in suite.items()}
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = {name: pool.submit(sink, name, df) for name, df in suite.items()}
        return {name: f.result() for name, f in futures.items()}
