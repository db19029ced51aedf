"""Sending this package to Python workers that cannot import it by themselves."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the application, once.

    The archive lies in the driver's own folder: the driver serves it, and no
    executor reads that folder.
    """
    context = spark.sparkContext
    if _shipped.get("to") == context.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="stratus-package-"), "stratus_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped["to"] = context.applicationId
