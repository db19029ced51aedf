"""Label columns built from the fixed label tables in :mod:`stratus.config`.

Each function returns a ``Column`` (a ``CASE WHEN`` chain), so labels stay
inside whole-stage code generation. A NULL input compares as unknown and
falls through to the default label.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

_OPS = {
    ">=": operator.ge,
    ">": operator.gt,
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_label(value: Column | str, bands, default: str) -> Column:
    """First band ``(op, bound, label)`` whose comparison holds wins."""
    value = _col(value)
    expr = None
    for op, bound, label in bands:
        cond = _OPS[op](value, F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def temperature_category(mean_temp: Column | str = "avg_temperature") -> Column:
    """Hot / Warm / Cool / Cold / Freezing on inclusive lower bounds."""
    return band_label(mean_temp, config.TEMPERATURE_CATEGORY_BANDS,
                      config.TEMPERATURE_CATEGORY_DEFAULT)


def temperature_band3(tmax: Column | str = "tmax_celsius") -> Column:
    """Hot / Moderate / Cold on strict bounds."""
    return band_label(tmax, config.TEMPERATURE_BAND3_BANDS, config.TEMPERATURE_BAND3_DEFAULT)


def precipitation_quality(prcp: Column | str = "prcp") -> Column:
    return band_label(prcp, config.PRECIPITATION_QUALITY_BANDS,
                      config.PRECIPITATION_QUALITY_DEFAULT)


def climate_category(mean_temp: Column | str = "avg_temp") -> Column:
    return band_label(mean_temp, config.CLIMATE_BANDS, config.CLIMATE_DEFAULT)


def temperature_quality(tmax: Column | str = "tmax_celsius",
                        tmin: Column | str = "tmin_celsius") -> Column:
    tmax, tmin = _col(tmax), _col(tmin)
    expr = None
    for hot, cold, label in config.TEMPERATURE_QUALITY_RULES:
        cond = (tmax > F.lit(hot)) | (tmin < F.lit(cold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(config.TEMPERATURE_QUALITY_DEFAULT))


def weather_pattern(mean_temp: Column | str = "avg_temperature",
                    precipitation: Column | str = "total_precipitation",
                    snow: Column | str = "total_snow") -> Column:
    """Ordered compound pattern rules; the first rule that holds names the row."""
    others = {"precipitation": _col(precipitation), "snow": _col(snow)}
    mean_temp = _col(mean_temp)
    expr = None
    for rule in config.WEATHER_PATTERNS:
        parts = []
        if rule.temp_op is not None:
            parts.append(_OPS[rule.temp_op](mean_temp, F.lit(rule.temp_bound)))
        if rule.other is not None:
            parts.append(_OPS[rule.other_op](others[rule.other], F.lit(rule.other_bound)))
        cond = parts[0]
        for p in parts[1:]:
            cond = cond & p
        label = F.lit(rule.label)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(config.WEATHER_PATTERN_DEFAULT))


def month_name(month: Column | str = "month", full: bool = False) -> Column:
    """Month name from the short table (others read ``Other``), or all twelve."""
    month = _col(month)
    if full:
        return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")
    expr = None
    for number, name in sorted(config.MONTH_NAMES.items()):
        cond = month == F.lit(number)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(config.MONTH_NAME_DEFAULT))


def season(month: Column | str = "month") -> Column:
    month = _col(month)
    expr = None
    for months, name in config.SEASONS:
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(config.SEASON_DEFAULT))


def consistency_label(tmax: Column | str = "avg_tmax", tmin: Column | str = "avg_tmin",
                      mean: Column | str = "avg_temperature") -> Column:
    tmax, tmin, mean = _col(tmax), _col(tmin), _col(mean)
    return (
        F.when(tmax < tmin, F.lit(config.CONSISTENCY_MAX_BELOW_MIN))
        .when(mean_off(tmax, tmin, mean), F.lit(config.CONSISTENCY_MEAN_OFF))
        .otherwise(F.lit(config.CONSISTENCY_OK))
    )


def mean_off(tmax: Column, tmin: Column, mean: Column) -> Column:
    """The mean is more than the tolerance away from the midpoint of max and min."""
    return F.abs(mean - (tmax + tmin) / F.lit(2)) > F.lit(config.CONSISTENCY_MEAN_TOLERANCE)


def is_inconsistent(tmax: Column | str = "avg_tmax", tmin: Column | str = "avg_tmin",
                    mean: Column | str = "avg_temperature") -> Column:
    tmax, tmin, mean = _col(tmax), _col(tmin), _col(mean)
    return (tmax < tmin) | mean_off(tmax, tmin, mean)


def year_month(date: Column | str = "date") -> Column:
    """``yyyy-MM`` key: the first seven characters of the ISO date text."""
    return F.substring(_col(date).cast("string"), 1, 7)
