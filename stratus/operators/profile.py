"""Column profiles and stage statistics.

Each profile is one global aggregate over all columns at once (map-side
partial aggregation, one scan), then unpivoted to one row per column with
``inline``. Inside the pipeline, stage statistics come from the fused run
aggregate (:mod:`stratus.operators.run_metrics`), or, in the optional
single-pass mode, from ``Observation`` metrics on the write job
(:func:`observe_stage`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config
from ..functions.cleaning import is_missing, null_or_nan


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: non-NULL count, NULL count and NULL percentage of all rows.

    An empty input yields NULL percentages; :func:`profile_rows` raises.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, name in enumerate(df.columns):
        aggs.append(F.count(F.col(name)).alias(f"__c{i}"))
    m = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"__c{i}").alias("count"),
            (F.col("__rows") - F.col(f"__c{i}")).alias("nulls"),
            F.when(F.col("__rows") > 0,
                   (F.col("__rows") - F.col(f"__c{i}")).cast("double") * F.lit(100.0)
                   / F.col("__rows").cast("double")).alias("null_percentage"),
        )
        for i, name in enumerate(df.columns)
    ]
    return m.select(F.inline(F.array(*rows)))


def column_profile_minmax(df: DataFrame) -> DataFrame:
    """Per column: row count, NULL-or-NaN count, min and max (as text)."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        aggs += [
            _count_if(null_or_nan(c, field.dataType)).alias(f"__n{i}"),
            F.min(c).cast("string").alias(f"__lo{i}"),
            F.max(c).cast("string").alias(f"__hi{i}"),
        ]
    m = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.col("__rows").alias("row_count"),
            F.col(f"__n{i}").alias("null_count"),
            F.col(f"__lo{i}").alias("min_value"),
            F.col(f"__hi{i}").alias("max_value"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return m.select(F.inline(F.array(*rows)))


def profile_rows(df: DataFrame) -> list[dict]:
    """Eager profile (one small collect: one row per column)."""
    rows = [r.asDict() for r in column_profile(df).collect()]
    if not rows or rows[0]["count"] + rows[0]["nulls"] == 0:
        raise ValueError("Cannot generate profile for empty DataFrame")
    return rows


def render_profile_markdown(rows: list[dict], total: int, generated: str) -> str:
    lines = [
        config.PROFILE_REPORT_TITLE, "",
        f"Generated: {generated}", "",
        f"Total Records: {total}", "",
        "## Column Statistics", "",
        "| Column | Count | Nulls | Null % |",
        "|--------|-------|-------|--------|",
    ]
    for r in rows:
        lines.append(f"| {r['column_name']} | {r['count']} | {r['nulls']} | {r['null_percentage']:.1f}% |")
    return "\n".join(lines) + "\n"


# ---------------------------------------------------------------------------
# Stage statistics -- Q6
# ---------------------------------------------------------------------------
def _stage_columns(df: DataFrame, required=config.REQUIRED_COLUMNS) -> list[str]:
    lowered = {c.lower(): c for c in df.columns}
    return [lowered[r.lower()] for r in required if r.lower() in lowered]


def stage_statistics(df: DataFrame, stage: str, required=config.REQUIRED_COLUMNS) -> DataFrame:
    """One row per required column present: stage, rows, columns, missing count and %."""
    cols = _stage_columns(df, required)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [_count_if(is_missing(c, df.schema[c].dataType)).alias(f"__m{i}") for i, c in enumerate(cols)]
    m = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.col("__rows").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(c).alias("column_name"),
            F.col(f"__m{i}").alias("missing_count"),
            F.when(F.col("__rows") > 0, F.col(f"__m{i}").cast("double") * F.lit(100.0)
                   / F.col("__rows").cast("double")).alias("missing_percentage"),
        )
        for i, c in enumerate(cols)
    ]
    return m.select(F.inline(F.array(*rows)))


def observe_stage(df: DataFrame, stage: str,
                  required=config.REQUIRED_COLUMNS) -> tuple[DataFrame, Observation, list[str]]:
    """Attach stage metrics to ``df``; they fill when a later action runs."""
    cols = _stage_columns(df, required)
    obs = Observation(stage)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [_count_if(is_missing(c, df.schema[c].dataType)).alias(f"missing__{c}") for c in cols]
    return df.observe(obs, *metrics), obs, cols


def observed_stage_rows(stage: str, column_count: int, cols: list[str], values: dict) -> list[tuple]:
    rows = []
    n = int(values.get("rows", 0) or 0)
    for c in cols:
        missing = int(values.get(f"missing__{c}", 0) or 0)
        rows.append((stage, n, column_count, c, missing, (missing * 100.0 / n) if n else None))
    return rows


STAGE_STATS_SCHEMA = ("stage string, row_count bigint, column_count int, column_name string, "
                      "missing_count bigint, missing_percentage double")
