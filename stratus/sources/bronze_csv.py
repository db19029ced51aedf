"""Landing CSV: the bronze scan and the landing sink.

The scan uses the fixed all-string schema (no inference pass over the data)
and accepts a file, a directory or a glob. Empty fields read back as NULL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .. import config


def load_bronze_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read landing CSV files with a header row and the bronze schema.

    A missing path raises ``AnalysisException`` from Spark itself.
    """
    return (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .schema(config.BRONZE_SCHEMA)
        .csv(path)
    )


def validate_iso_date(text: str) -> str:
    try:
        _dt.datetime.strptime(text, "%Y-%m-%d")
    except (TypeError, ValueError) as exc:
        raise ValueError("Dates must be in YYYY-MM-DD format") from exc
    return text


def default_date_range(today: _dt.date | None = None,
                       days: int = config.DEFAULT_LOOKBACK_DAYS) -> tuple[str, str]:
    today = today or _dt.date.today()
    return (today - _dt.timedelta(days=days)).isoformat(), today.isoformat()


def landing_name(station_id: str, start: str, end: str) -> str:
    """``weather_data_<station with ':' as '_'>_<start>_<end>.csv``.

    Spark writes a directory of part files under this name; the landing glob
    (:func:`landing_glob`) matches it, and a matched directory is read whole.
    """
    return f"{config.LANDING_FILE_PREFIX}_{station_id.replace(':', '_')}_{start}_{end}.csv"


def landing_glob(landing_dir: str) -> str:
    """Input pattern of the transform: every landing file or directory."""
    return f"{landing_dir.rstrip('/')}/{config.LANDING_FILE_PREFIX}_*.csv"


def write_landing_csv(bronze: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write bronze rows as header CSV part files under ``path``.

    Every task writes its own part file, so the write scales with the
    cluster; the directory is then a valid input of :func:`load_bronze_csv`.
    """
    (
        bronze.select(*config.BRONZE_COLUMNS)
        .write.mode(mode)
        .option("header", "true")
        .option("emptyValue", "")
        .csv(path)
    )
    return path
