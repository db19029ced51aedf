"""stratus: a Spark-native engine for daily station observations.

bronze (raw CSV strings) -> silver (typed rows) -> gold (one row per station
and day, Parquet partitioned by year/month), with data-quality checks and
time-series reporting, all as lazy DataFrame plans built from Spark built-ins.

The most used entry points are re-exported here.
"""

from .operators import (  # noqa: F401
    clean_observations,
    daily_gold,
    validate_observations,
    validation_summary,
)
from .plans import analytics_suite, create_view, pipeline, view_count  # noqa: F401
from .session import get_session  # noqa: F401
from .sources import (  # noqa: F401
    generate_observations,
    load_bronze_csv,
    read_parquet,
    write_landing_csv,
    write_partitioned_parquet,
)

__version__ = "0.1.0"
