"""Small text reports written from one collected result row per column.

The data behind every report is a DataFrame produced by one aggregate; only
its few rows (one per column, or one verdict) reach the driver to be
rendered as Markdown.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import profile
from ..sources.parquet import read_parquet
from .pipeline import PipelineResult, render_run_report


def _write(path: str, text: str) -> str:
    folder = os.path.dirname(path)
    if folder:
        os.makedirs(folder, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def profile_report(df: DataFrame, path: str | None = None) -> str:
    """Markdown column profile (count, nulls, null %) of ``df``; empty input raises."""
    rows = profile.profile_rows(df)
    total = rows[0]["count"] + rows[0]["nulls"]
    text = profile.render_profile_markdown(rows, total, _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    if path:
        _write(path, text)
    return text


def profile_parquet(spark: SparkSession, parquet_path: str, report_path: str | None = None) -> DataFrame:
    """Profile a Parquet table (rows, NULL-or-NaN count, min, max per column).

    Returns the profile DataFrame; with ``report_path`` also writes Markdown.
    """
    prof = profile.column_profile_minmax(read_parquet(spark, parquet_path))
    if report_path:
        rows = prof.collect()
        total = rows[0]["row_count"] if rows else 0
        lines = [config.PARQUET_PROFILE_TITLE, "", f"**Total Rows:** {total}", ""]
        lines += [f"- **{r['column_name']}**: nulls={r['null_count']}, min={r['min_value']}, "
                  f"max={r['max_value']}" for r in rows]
        _write(report_path, "\n".join(lines) + "\n")
    return prof


def save_run_report(result: PipelineResult, path: str | None = None, logs_dir: str = "logs") -> str:
    """Write the run report (processing metrics, verdict, thresholds, issues)."""
    if path is None:
        stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
        path = os.path.join(logs_dir, f"performance_report_{stamp}.md")
    return _write(path, render_run_report(result))
