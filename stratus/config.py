"""Fixed values of the observation model.

Everything in this module is plain data: schemas, rule presets, label
tables and thresholds. Operators read these values; nothing here runs Spark.

The values marked "fixed values" must stay equal to the behaviour this engine
reproduces (column names, units, validation bounds, label texts and their
thresholds). They are stated once, here, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Bronze layout (raw landing CSV, every field a string).
# ---------------------------------------------------------------------------
BRONZE_COLUMNS = ("DATE", "STATION", "TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "AWND")
NUMERIC_COLUMNS = ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "AWND")
REQUIRED_COLUMNS = ("DATE", "STATION", "TMAX", "TMIN")
CSV_HEADER = ",".join(BRONZE_COLUMNS)

BRONZE_SCHEMA = StructType([StructField(c, StringType(), True) for c in BRONZE_COLUMNS])

# ---------------------------------------------------------------------------
# Units and precision.
# Temperatures arrive in tenths of a degree Celsius; precipitation, snow,
# snow depth and wind are kept in their raw units.
# ---------------------------------------------------------------------------
TEMPERATURE_DIVISOR = 10.0
TEMPERATURE_PRECISION = 1
WIND_PRECISION = 1
DATE_PATTERN = "yyyy-MM-dd"
DATE_SHAPE_REGEX = r"^\d{4}-\d{2}-\d{2}$"
MAX_INVALID_DATE_PERCENT = 5.0

# ---------------------------------------------------------------------------
# Silver / gold layouts.
# ---------------------------------------------------------------------------
SILVER_SCHEMA = StructType(
    [
        StructField("date", DateType(), True),
        StructField("station", StringType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
        StructField("day", IntegerType(), True),
        StructField("tmax", DoubleType(), True),
        StructField("tmin", DoubleType(), True),
        StructField("prcp", DoubleType(), True),
        StructField("snow", DoubleType(), True),
        StructField("snwd", DoubleType(), True),
        StructField("awnd", DoubleType(), True),
        StructField("tmax_celsius", DoubleType(), True),
        StructField("tmin_celsius", DoubleType(), True),
        StructField("tavg_celsius", DoubleType(), True),
    ]
)

GOLD_SCHEMA = StructType(
    [
        StructField("date", DateType(), True),
        StructField("station", StringType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
        StructField("day", IntegerType(), True),
        StructField("avg_tmax", DoubleType(), True),
        StructField("avg_tmin", DoubleType(), True),
        StructField("avg_temperature", DoubleType(), True),
        StructField("total_precipitation", DoubleType(), True),
        StructField("total_snow", DoubleType(), True),
        StructField("avg_wind_speed", DoubleType(), True),
    ]
)

PARTITION_COLUMNS = ("year", "month")
DEFAULT_VIEW_NAME = "weather_data"


# ---------------------------------------------------------------------------
# Range rules (inclusive bounds, in the unit of the column).
# SNWD has no rule. Two presets exist: the pipeline rules and the looser
# bounds of the analytics range report (precipitation and wind up to 200).
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class RangeRule:
    column: str
    low: float
    high: float


PIPELINE_RANGE_RULES = (
    RangeRule("TMAX", -50, 60),
    RangeRule("TMIN", -50, 60),
    RangeRule("PRCP", 0, 1000),
    RangeRule("SNOW", 0, 500),
    RangeRule("AWND", 0, 100),
)

REPORT_RANGE_RULES = (
    RangeRule("avg_temperature", -50, 60),
    RangeRule("total_precipitation", 0, 200),
    RangeRule("avg_wind_speed", 0, 200),
)

# ---------------------------------------------------------------------------
# Run thresholds.
# ---------------------------------------------------------------------------
MAX_PROCESSING_TIME_SECONDS = 300
MIN_DATA_QUALITY_SCORE = 0.85
MAX_MEMORY_USAGE_GB = 4
EXPECTED_RECORD_COUNT_MIN = 100

# ---------------------------------------------------------------------------
# Label tables. Each band is (comparison, bound, label); bands
# are tried top-down and the first match wins, NULL falls through to the
# default.
# ---------------------------------------------------------------------------
TEMPERATURE_CATEGORY_BANDS = (
    (">=", 25, "Hot"),
    (">=", 15, "Warm"),
    (">=", 5, "Cool"),
    (">=", 0, "Cold"),
)
TEMPERATURE_CATEGORY_DEFAULT = "Freezing"

TEMPERATURE_BAND3_BANDS = (
    (">", 30, "Hot"),
    (">", 20, "Moderate"),
)
TEMPERATURE_BAND3_DEFAULT = "Cold"

PRECIPITATION_QUALITY_BANDS = (
    (">", 50, "Heavy Precipitation"),
    (">", 20, "Moderate Precipitation"),
)
PRECIPITATION_QUALITY_DEFAULT = "Light Precipitation"

CLIMATE_BANDS = (
    (">", 15, "Warm Climate"),
    (">", 5, "Moderate Climate"),
)
CLIMATE_DEFAULT = "Cold Climate"

# Day classes used by the extremes and dashboard reports: a hot day has a
# mean of at least 25, a freezing day a mean below 0, a rainy day any
# precipitation above 0.
HOT_DAY_MIN = 25
FREEZING_DAY_BELOW = 0
RAINY_DAY_ABOVE = 0

# Rolling frames of the time-series view (ROWS frames, current row included).
ROLLING_MEAN_ROWS = 3
ROLLING_SUM_ROWS = 7

# Temperature quality: (tmax above, tmin below, label), first match wins.
TEMPERATURE_QUALITY_RULES = (
    (40, -20, "Extreme Temperature"),
    (30, -10, "High Temperature"),
)
TEMPERATURE_QUALITY_DEFAULT = "Temperature OK"

# Month names used by the reports (months outside the table read "Other").
MONTH_NAMES = {1: "January", 2: "February", 3: "March"}
MONTH_NAME_DEFAULT = "Other"

SEASONS = (
    ((12, 1, 2), "Winter"),
    ((3, 4, 5), "Spring"),
    ((6, 7, 8), "Summer"),
)
SEASON_DEFAULT = "Fall"

# Consistency labels of the temperature triple (max, min, mean).
CONSISTENCY_MAX_BELOW_MIN = "ERROR: Max < Min"
CONSISTENCY_MEAN_OFF = "WARNING: Avg not between min/max"
CONSISTENCY_OK = "OK"
CONSISTENCY_MEAN_TOLERANCE = 1.0


# Weather patterns, tried in order, first match wins:
#   Hot & Dry     mean >= 25 and precipitation = 0
#   Warm & Rainy  mean >= 15 and precipitation > 10
#   Cold & Snowy  mean <  5  and snow > 0
#   Freezing      mean <  0
#   Heavy Rain    precipitation > 15
#   Normal        otherwise
@dataclass(frozen=True)
class PatternRule:
    label: str
    temp_op: str | None = None
    temp_bound: float | None = None
    other: str | None = None  # "precipitation" or "snow"
    other_op: str | None = None
    other_bound: float | None = None


WEATHER_PATTERNS = (
    PatternRule("Hot & Dry", ">=", 25, "precipitation", "=", 0),
    PatternRule("Warm & Rainy", ">=", 15, "precipitation", ">", 10),
    PatternRule("Cold & Snowy", "<", 5, "snow", ">", 0),
    PatternRule("Freezing", "<", 0),
    PatternRule("Heavy Rain", None, None, "precipitation", ">", 15),
)
WEATHER_PATTERN_DEFAULT = "Normal"

# ---------------------------------------------------------------------------
# Issue texts and report titles (printf-style where formatted).
# ---------------------------------------------------------------------------
ISSUE_MISSING_COLUMNS = "Missing required columns: {columns}"
ISSUE_MISSING_COLUMN = "Missing required column: {column}"
ISSUE_NOT_STRING = "Column {column} should be StringType, got {dtype}"
ISSUE_BELOW_MIN = "%s minimum value %s below threshold %s"
ISSUE_ABOVE_MAX = "%s maximum value %s above threshold %s"
ISSUE_INVALID_DATES = "High percentage of invalid dates: %.2f%%"
ISSUE_NO_DATE_COLUMN = "DATE column not found"
PROFILE_REPORT_TITLE = "# Weather Data Profile Report"
PARQUET_PROFILE_TITLE = "# Data Profile Report"
RUN_REPORT_TITLE = "# Performance Report"

# ---------------------------------------------------------------------------
# Synthetic observation generator (tenths / raw units).
# ---------------------------------------------------------------------------
GEN_TMAX_RANGE = (200, 350)
GEN_TMIN_LOW = 100
GEN_TMIN_GAP = 50  # tmin <= tmax - 50
GEN_PRCP_RANGE = (0, 50)
GEN_PRCP_PROBABILITY = 0.3
GEN_SNOW_RANGE = (0, 20)
GEN_SNOW_PROBABILITY = 0.1
GEN_SNWD_RANGE = (0, 100)
GEN_AWND_RANGE = (10, 200)
GEN_BLANK_TMAX = 0.05
GEN_BLANK_TMIN = 0.05
GEN_BLANK_PRCP = 0.02
DEFAULT_STATION_ID = "GHCND:USW00014735"
LANDING_FILE_PREFIX = "weather_data"
DEFAULT_LOOKBACK_DAYS = 30

# ---------------------------------------------------------------------------
# Session settings (adaptive execution on, advisory partition size).
# ---------------------------------------------------------------------------
SPARK_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


@dataclass(frozen=True)
class Thresholds:
    max_processing_time_seconds: float = MAX_PROCESSING_TIME_SECONDS
    min_data_quality_score: float = MIN_DATA_QUALITY_SCORE
    max_memory_usage_gb: float = MAX_MEMORY_USAGE_GB
    expected_record_count_min: int = EXPECTED_RECORD_COUNT_MIN


@dataclass(frozen=True)
class ValidationRules:
    required_columns: tuple = REQUIRED_COLUMNS
    numeric_columns: tuple = NUMERIC_COLUMNS
    range_rules: tuple = PIPELINE_RANGE_RULES
    # 1.0 compares raw values with the bounds; 10.0 converts tenths first.
    unit_divisor: float = 1.0
    max_invalid_date_percent: float = MAX_INVALID_DATE_PERCENT
    min_quality_score: float = MIN_DATA_QUALITY_SCORE


DEFAULT_RULES = ValidationRules()
