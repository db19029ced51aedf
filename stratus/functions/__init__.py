"""Column-returning building blocks: cleaning expressions, predicates, labels."""

from .cleaning import (
    bad_date_shape,
    is_missing,
    mean_of_tenths,
    null_or_nan,
    numeric_or_null,
    parse_date,
    exact_mean,
    exact_parts,
    exact_total,
    tenths_to_celsius,
)
from .labels import (
    band_label,
    climate_category,
    consistency_label,
    is_inconsistent,
    month_name,
    precipitation_quality,
    season,
    temperature_band3,
    temperature_category,
    temperature_quality,
    weather_pattern,
    year_month,
)

__all__ = [
    "bad_date_shape", "is_missing", "mean_of_tenths", "null_or_nan", "numeric_or_null",
    "parse_date", "exact_mean", "exact_parts", "exact_total", "tenths_to_celsius", "band_label", "climate_category",
    "consistency_label", "is_inconsistent", "month_name", "precipitation_quality",
    "season", "temperature_band3", "temperature_category", "temperature_quality",
    "weather_pattern", "year_month",
]
