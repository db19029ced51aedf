"""Plan inspection helpers (used by tests and the bench to check plan shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "MapInArrow", "PythonUDF")


def explain_string(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` would print."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def uses_python(df: DataFrame) -> bool:
    text = explain_string(df, "extended")
    return any(n in text for n in PYTHON_NODES)


def rows_scanned(df: DataFrame) -> int:
    """Runs ``df`` (scans, filters and projections only) and returns how many rows its scans handed over.

    Rows of row groups and pages that the footers rule out are not among them.
    """
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
