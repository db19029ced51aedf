"""Data-quality checks.

Design: every check over a DataFrame is derived from ONE global aggregate
(``quality_measures``): row count, missing counts of the required columns,
min/max of each range-checked column and the date-shape counts. The checks
are projections of that single row, unpivoted with ``inline`` where a check
yields several rows. A full validation is therefore one scan with map-side
partial aggregation; the reference shape (one job per column per check) is
not reproduced.

The eager helpers (``validate_observations`` and friends) collect only the
one-row verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config
from ..config import DEFAULT_RULES, ValidationRules
from ..functions.cleaning import bad_date_shape, is_missing, numeric_or_null, exact_mean
from ..functions.labels import consistency_label, is_inconsistent, precipitation_quality, temperature_quality


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _present(df: DataFrame, name: str) -> bool:
    return name in df.columns  # case-sensitive, as the column contract is


def _fmt_num(c: Column) -> Column:
    """Number text without an exponent below 1e16 (``20000000.0``)."""
    plain = F.regexp_replace(c.cast("decimal(30,8)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when((F.abs(c) >= 1e7) & (F.abs(c) < 1e16), plain).otherwise(c.cast("string"))


# ---------------------------------------------------------------------------
# Schema check (metadata) -- Q1
# ---------------------------------------------------------------------------
def schema_issues(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> list[str]:
    issues = []
    missing = [c for c in rules.required_columns if c not in df.columns]
    if missing:
        listed = ", ".join(repr(c) for c in sorted(missing))  # stable order, set notation
        issues.append(config.ISSUE_MISSING_COLUMNS.format(columns="{" + listed + "}"))
    for name in rules.numeric_columns:
        if name in df.columns:
            dtype = df.schema[name].dataType
            if not isinstance(dtype, StringType):
                issues.append(config.ISSUE_NOT_STRING.format(column=name, dtype=dtype))
    return issues


def schema_check(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """One row per expected column: presence, type and the issue text if any (the schema alone is read)."""
    expected = list(dict.fromkeys(list(rules.required_columns) + list(rules.numeric_columns)))
    rows = []
    for name in expected:
        present = name in df.columns
        dtype = df.schema[name].dataType if present else None
        required = name in rules.required_columns
        must_be_string = name in rules.numeric_columns
        type_ok = (not present) or (not must_be_string) or isinstance(dtype, StringType)
        if required and not present:
            issue = config.ISSUE_MISSING_COLUMN.format(column=name)
        elif not type_ok:
            issue = config.ISSUE_NOT_STRING.format(column=name, dtype=dtype)
        else:
            issue = None
        rows.append((name, "string", dtype.simpleString() if dtype is not None else None, required, present,
                     type_ok, issue))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, required boolean, "
              "present boolean, type_ok boolean, issue string")


# ---------------------------------------------------------------------------
# The fused measure row -- serves Q2, Q3, Q4, Q5, Q9
# ---------------------------------------------------------------------------
def measure_columns(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> list[Column]:
    """Aggregate expressions for all counts and extremes the checks need."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for name in rules.required_columns:
        if _present(df, name):
            aggs.append(_count_if(is_missing(name, df.schema[name].dataType)).alias(f"missing__{name}"))
    for rule in rules.range_rules:
        if _present(df, rule.column):
            value = numeric_or_null(F.col(rule.column).cast("string")) / F.lit(float(rules.unit_divisor))
            aggs.append(F.min(value).alias(f"min__{rule.column}"))
            aggs.append(F.max(value).alias(f"max__{rule.column}"))
    if _present(df, "DATE"):
        date_text = F.col("DATE").cast("string")
        aggs.append(_count_if(bad_date_shape(date_text)).alias("invalid_dates"))
        aggs.append(F.count("DATE").alias("nonnull_dates"))
    return aggs


def quality_measures(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """One row: all counts and extremes the checks need, in a single aggregate."""
    return df.agg(*measure_columns(df, rules))


def _missing_total(measures: DataFrame, rules: ValidationRules) -> Column:
    parts = [F.col(f"missing__{c}") for c in rules.required_columns if f"missing__{c}" in measures.columns]
    total = F.lit(0).cast("bigint")
    for p in parts:
        total = total + p
    return total


def _score(measures: DataFrame, rules: ValidationRules) -> Column:
    denom = F.col("row_count") * F.lit(len(rules.required_columns))
    return F.when(F.col("row_count") == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - _missing_total(measures, rules).cast("double") / denom.cast("double")
    )


def _range_structs(measures: DataFrame, rules: ValidationRules) -> list[Column]:
    structs = []
    for rule in rules.range_rules:
        if f"min__{rule.column}" not in measures.columns:
            continue
        lo, hi = F.lit(float(rule.low)), F.lit(float(rule.high))
        mn, mx = F.col(f"min__{rule.column}"), F.col(f"max__{rule.column}")
        below = F.coalesce(mn < lo, F.lit(False))
        above = F.coalesce(mx > hi, F.lit(False))
        structs.append(F.struct(
            F.lit(rule.column).alias("column_name"),
            lo.alias("low"),
            hi.alias("high"),
            mn.alias("min_value"),
            mx.alias("max_value"),
            below.alias("below_low"),
            above.alias("above_high"),
            F.when(below, F.format_string(config.ISSUE_BELOW_MIN,
                                          F.lit(rule.column), _fmt_num(mn), F.lit(str(rule.low))))
            .alias("low_issue"),
            F.when(above, F.format_string(config.ISSUE_ABOVE_MAX,
                                          F.lit(rule.column), _fmt_num(mx), F.lit(str(rule.high))))
            .alias("high_issue"),
        ))
    return structs


def range_check(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """Per rule: observed min/max after the numeric cast and whether a bound is broken.

    Bounds are inclusive; a column with only NULLs breaks nothing.
    """
    m = quality_measures(df, rules)
    structs = _range_structs(m, rules)
    if not structs:
        return m.select(F.inline(F.array().cast(
            "array<struct<column_name:string,low:double,high:double,min_value:double,"
            "max_value:double,below_low:boolean,above_high:boolean,low_issue:string,high_issue:string>>")))
    return m.select(F.inline(F.array(*structs))).select(
        "column_name", "low", "high", "min_value", "max_value",
        (~(F.col("below_low") | F.col("above_high"))).alias("in_range"),
        F.concat_ws("; ", "low_issue", "high_issue").alias("issue"),
    ).withColumn("issue", F.when(F.col("issue") == "", None).otherwise(F.col("issue")))


def _date_cols(measures: DataFrame, rules: ValidationRules) -> dict[str, Column]:
    if "invalid_dates" not in measures.columns:
        return {
            "invalid_dates": F.lit(None).cast("bigint"),
            "total_dates": F.lit(None).cast("bigint"),
            "invalid_percentage": F.lit(None).cast("double"),
            "dates_valid": F.lit(False),
            "date_issue": F.lit(config.ISSUE_NO_DATE_COLUMN),
        }
    pct = F.when(F.col("nonnull_dates") > 0,
                 F.col("invalid_dates").cast("double") * F.lit(100.0)
                 / F.col("nonnull_dates").cast("double"))
    too_many = F.coalesce(pct > F.lit(rules.max_invalid_date_percent), F.lit(False))
    return {
        "invalid_dates": F.col("invalid_dates"),
        "total_dates": F.col("nonnull_dates"),
        "invalid_percentage": pct,
        "dates_valid": ~too_many,
        "date_issue": F.when(too_many, F.format_string(
            config.ISSUE_INVALID_DATES, pct)),
    }


def date_check(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """Share of DATE values not shaped ``dddd-dd-dd`` (NULL and empty count as invalid,
    the denominator counts non-NULL values); more than 5 % fails."""
    m = quality_measures(df, rules)
    d = _date_cols(m, rules)
    return m.select(*[c.alias(k) for k, c in d.items()]).withColumnRenamed("date_issue", "issue")


def quality_score(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """1 - missing required values / (rows x required columns); 0.0 for no rows."""
    m = quality_measures(df, rules)
    return m.select(
        F.col("row_count").alias("total_records"),
        _missing_total(m, rules).alias("missing_values"),
        _score(m, rules).alias("quality_score"),
    )


def validation_summary(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """The composite verdict as one row (schema, ranges, dates, score, issues)."""
    return verdict_from_measures(quality_measures(df, rules), df, rules)


def verdict_from_measures(m: DataFrame, df: DataFrame,
                          rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """Project the measure row ``m`` of ``df`` onto the composite verdict."""
    s_issues = schema_issues(df, rules)
    structs = _range_structs(m, rules)
    range_issues = []
    ranges_valid = F.lit(True)
    for s in structs:
        ranges_valid = ranges_valid & ~s["below_low"] & ~s["above_high"]
        range_issues += [s["low_issue"], s["high_issue"]]
    d = _date_cols(m, rules)
    issue_items = [F.lit(i) for i in s_issues] + range_issues + [d["date_issue"]]
    score = _score(m, rules)
    schema_valid = F.lit(not s_issues)
    return m.select(
        (schema_valid & ranges_valid & d["dates_valid"]
         & (score >= F.lit(rules.min_quality_score))).alias("overall_valid"),
        schema_valid.alias("schema_valid"),
        ranges_valid.alias("ranges_valid"),
        d["dates_valid"].alias("dates_valid"),
        score.alias("quality_score"),
        F.array_compact(F.array(*[i.cast("string") for i in issue_items])).alias("issues"),
    )


def validate_observations(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> dict:
    """Eager form of :func:`validation_summary`: collects its single row."""
    row = validation_summary(df, rules).first()
    return {
        "overall_valid": bool(row["overall_valid"]),
        "schema_valid": bool(row["schema_valid"]),
        "ranges_valid": bool(row["ranges_valid"]),
        "dates_valid": bool(row["dates_valid"]),
        "quality_score": float(row["quality_score"]),
        "issues": list(row["issues"]),
    }


def validate_schema(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> tuple[bool, list[str]]:
    issues = schema_issues(df, rules)
    return not issues, issues


def validate_ranges(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> tuple[bool, list[str]]:
    rows = range_check(df, rules).collect()
    issues = [part for r in rows if r["issue"] for part in r["issue"].split("; ")]
    return not issues, issues


def validate_dates(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> tuple[bool, list[str]]:
    row = date_check(df, rules).first()
    issues = [row["issue"]] if row["issue"] else []
    return bool(row["dates_valid"]), issues


def score_of(df: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> float:
    return float(quality_score(df, rules).first()["quality_score"])


# ---------------------------------------------------------------------------
# Gold reports -- Q8a, Q8b, Q8c
# ---------------------------------------------------------------------------
REPORT_METRICS = (
    ("Temperature", "avg_temperature"),
    ("Precipitation", "total_precipitation"),
    ("Wind Speed", "avg_wind_speed"),
)


def completeness_report(gold: DataFrame) -> DataFrame:
    """Per metric: total rows, non-NULL rows and their percentage (one scan)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count(c).alias(f"c_{i}") for i, (_, c) in enumerate(REPORT_METRICS)]
    m = gold.agg(*aggs)
    rows = [
        F.struct(
            F.lit(label).alias("metric"),
            F.col("n").alias("total_records"),
            F.col(f"c_{i}").alias("complete_records"),
            F.when(F.col("n") > 0, F.round(F.col(f"c_{i}").cast("double") * F.lit(100.0) / F.col("n").cast("double"), 1))
            .alias("completeness_percentage"),
        )
        for i, (label, _) in enumerate(REPORT_METRICS)
    ]
    return m.select(F.inline(F.array(*rows)))


def range_report(gold: DataFrame, rules=config.REPORT_RANGE_RULES) -> DataFrame:
    """Per metric: min, max, mean (1 dp) and outliers outside the report bounds."""
    by_col = {r.column: r for r in rules}
    aggs = []
    for i, (_, c) in enumerate(REPORT_METRICS):
        r = by_col[c]
        aggs += [
            F.min(c).alias(f"mn_{i}"), F.max(c).alias(f"mx_{i}"), exact_mean(c).alias(f"av_{i}"),
            _count_if((F.col(c) < r.low) | (F.col(c) > r.high)).alias(f"o_{i}"),
        ]
    m = gold.agg(*aggs)
    rows = [
        F.struct(
            F.lit(label).alias("metric"),
            F.round(F.col(f"mn_{i}"), 1).alias("min_value"),
            F.round(F.col(f"mx_{i}"), 1).alias("max_value"),
            F.round(F.col(f"av_{i}"), 1).alias("avg_value"),
            F.col(f"o_{i}").alias("outliers"),
        )
        for i, (label, _) in enumerate(REPORT_METRICS)
    ]
    return m.select(F.inline(F.array(*rows)))


def consistency_report(gold: DataFrame) -> DataFrame:
    """Station-days whose max is below the min or whose mean is off the midpoint."""
    return _labelled(gold.where(is_inconsistent()))


def flag_inconsistent(gold: DataFrame) -> DataFrame:
    """Gold with ``inconsistent``, to be stored: a table clustered by it holds such rows in few row groups."""
    return gold.withColumn("inconsistent", F.coalesce(is_inconsistent(), F.lit(False)))


def flagged_consistency_report(flagged: DataFrame) -> DataFrame:
    """:func:`consistency_report` from the stored flag, by which the scan skips row groups."""
    return _labelled(flagged.where("inconsistent"))


def _labelled(days: DataFrame) -> DataFrame:
    return days.select("date", "station", "avg_tmax", "avg_tmin", "avg_temperature",
                       consistency_label().alias("consistency_check")).orderBy("date", "station")


# ---------------------------------------------------------------------------
# Row-level quality labels -- Q10
# ---------------------------------------------------------------------------
def row_quality_labels(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per silver row: temperature and precipitation quality labels, by date.

    The other output columns break ties, so that one hot day or station
    spreads over several range partitions. ``ordered=False``: a projection only.
    """
    out = silver.select(
        "date", "station", "tmax_celsius", "tmin_celsius", "prcp",
        temperature_quality("tmax_celsius", "tmin_celsius").alias("temp_quality"),
        precipitation_quality("prcp").alias("precip_quality"),
    )
    return out.orderBy("date", "station", "tmax_celsius", "tmin_celsius", "prcp") if ordered else out


# ---------------------------------------------------------------------------
# Thresholds -- Q9
# ---------------------------------------------------------------------------
THRESHOLD_SPECS = (
    # metric, threshold, direction ("min": value must be >= threshold)
    ("processing_time_seconds", float(config.MAX_PROCESSING_TIME_SECONDS), "max"),
    ("memory_used_mb", float(config.MAX_MEMORY_USAGE_GB * 1024), "max"),
    ("quality_score", float(config.MIN_DATA_QUALITY_SCORE), "min"),
    ("record_count", float(config.EXPECTED_RECORD_COUNT_MIN), "min"),
)


def evaluate_thresholds(metrics: DataFrame, specs=THRESHOLD_SPECS) -> DataFrame:
    """``metrics(metric, value)`` -> metric, value, threshold, direction, breached.

    Thresholds attach by literal CASE expressions on the metric name, not by a
    join; metrics without a threshold are dropped.
    """
    threshold = None
    direction = None
    for name, bound, dirn in specs:
        cond = F.col("metric") == F.lit(name)
        threshold = F.when(cond, F.lit(bound)) if threshold is None else threshold.when(cond, F.lit(bound))
        direction = F.when(cond, F.lit(dirn)) if direction is None else direction.when(cond, F.lit(dirn))
    out = metrics.select(
        "metric",
        F.col("value").cast("double").alias("value"),
        threshold.alias("threshold"),
        direction.alias("direction"),
    ).where(F.col("threshold").isNotNull())
    breached = F.when(F.col("direction") == "max", F.col("value") > F.col("threshold")) \
        .otherwise(F.col("value") < F.col("threshold"))
    return out.withColumn("breached", F.coalesce(breached, F.lit(False)))


def data_metrics(bronze: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    """Deterministic run metrics of a bronze input: quality score and record count."""
    m = quality_measures(bronze, rules)
    rows = [
        F.struct(F.lit("quality_score").alias("metric"), _score(m, rules).alias("value")),
        F.struct(F.lit("record_count").alias("metric"), F.col("row_count").cast("double").alias("value")),
    ]
    return m.select(F.inline(F.array(*rows)))


def threshold_alerts(bronze: DataFrame, rules: ValidationRules = DEFAULT_RULES) -> DataFrame:
    return evaluate_thresholds(data_metrics(bronze, rules))
