"""DataFrame -> DataFrame operators: silver, gold, reports, windows, quality, profiles."""

from .gold import daily_gold
from .profile import column_profile, column_profile_minmax, stage_statistics
from .quality import (
    completeness_report,
    consistency_report,
    date_check,
    quality_score,
    range_check,
    range_report,
    row_quality_labels,
    schema_check,
    threshold_alerts,
    validate_observations,
    validation_summary,
)
from .reports import (
    daily_precipitation,
    dataset_span,
    latest_days,
    monthly_dashboard,
    monthly_summary,
    pattern_distribution,
    precipitation_analysis,
    seasonal_trends,
    station_month_rank,
    station_performance,
    temperature_bands,
    temperature_extremes,
    year_month_summary,
)
from .silver import clean_observations
from .timeseries import daily_change, rolling_metrics, station_timeseries, with_time_series

__all__ = [name for name in dir() if not name.startswith("_")]
