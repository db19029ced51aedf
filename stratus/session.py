"""Session construction and the shared scratch location.

The scratch location is the shared folder named by ``spark.checkpoint.dir``.
Only a local master may leave it unset (a folder beside the warehouse is used
then); anywhere else that is an error, as executors share no local folder.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession

from . import config


def get_session(app_name: str = "stratus", master: str | None = None, **extra_conf) -> SparkSession:
    """Return the active session, creating one with the engine's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(config.SPARK_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.update({k.replace("__", "."): v for k, v in extra_conf.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch folder; set beside the warehouse for an unset local session."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


_made: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/stratus-{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_made() -> None:
    while _made:
        spark, path = _made.pop()
        with contextlib.suppress(Exception):  # the session may have been stopped before
            if spark.sparkContext._jsc is not None:
                remove_path(spark, path)
