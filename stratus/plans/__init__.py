"""Compositions: the ETL pipeline, the analytics suite and the query registry."""

from . import pipeline
from .analytics import analytics_suite, create_view, run_reports, view_count, write_report_parquet

__all__ = ["pipeline", "analytics_suite", "create_view", "run_reports", "view_count", "write_report_parquet"]
