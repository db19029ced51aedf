"""Reference SQL (DuckDB dialect) for every registered query.

The SQL re-derives bronze, silver and gold from ``lineitem`` with the same
rules as :mod:`stratus.sources.fixture`, :mod:`stratus.operators.silver` and
:mod:`stratus.operators.gold`, then states each report as plain SQL. Types
are cast so that both engines agree (BIGINT counts, INTEGER calendar parts,
DOUBLE measures). FAVG is the plain mean with compensated summation, so that a
mean does not depend on the order in which DuckDB meets the rows.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    column: str
    low: int
    high: int


# Fixed values, stated here apart from the engine's own configuration.
RANGE_RULES = (Rule("TMAX", -50, 60), Rule("TMIN", -50, 60), Rule("PRCP", 0, 1000), Rule("SNOW", 0, 500), Rule("AWND", 0, 100))
REQUIRED = ("DATE", "STATION", "TMAX", "TMIN")
NUMERIC = ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "AWND")
BRONZE = ("DATE", "STATION", "TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "AWND")


def bronze_cte(stations: int) -> str:
    return f"""bronze AS (
  SELECT
    CASE WHEN l_orderkey % 40 = 0 THEN 'bad-date' WHEN l_orderkey % 40 = 1 THEN '2024-13-03'
         WHEN l_orderkey % 40 = 2 THEN '' WHEN l_orderkey % 40 = 3 THEN NULL
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS "DATE",
    CASE WHEN l_orderkey % 50 = 7 THEN NULL WHEN l_orderkey % 50 = 8 THEN ''
         ELSE 'STN' || CAST(l_suppkey % {stations} AS VARCHAR) END AS "STATION",
    CASE WHEN l_partkey % 20 = 0 THEN '' WHEN l_partkey % 200 = 7 THEN '26x'
         ELSE CAST(CAST(TRUNC(l_quantity * 10) AS BIGINT) - 150 + l_linenumber * 10 AS VARCHAR) END AS "TMAX",
    CASE WHEN l_partkey % 20 = 1 THEN '' WHEN l_partkey % 200 = 8 THEN 'n/a'
         ELSE CAST(CAST(TRUNC(l_quantity * 10) AS BIGINT) - 150 AS VARCHAR) END AS "TMIN",
    CASE WHEN l_partkey % 50 = 2 THEN ''
         ELSE CAST(CAST(ROUND(l_discount * 100) AS DOUBLE) * 2 + (l_linenumber % 4) * 0.25::DOUBLE AS VARCHAR) END AS "PRCP",
    CASE WHEN l_partkey % 30 = 4 THEN ''
         ELSE CAST(CASE WHEN l_returnflag = 'R' THEN CAST(ROUND(l_tax * 100) AS BIGINT) ELSE 0 END AS VARCHAR) END AS "SNOW",
    CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS VARCHAR) ELSE '0' END AS "SNWD",
    CASE WHEN l_partkey % 30 = 5 THEN '' ELSE CAST(CAST(FLOOR(l_extendedprice / 400) AS BIGINT) AS VARCHAR) END AS "AWND"
  FROM lineitem
)"""


SILVER_CTE = """typed AS (
  SELECT CAST(TRY_STRPTIME("DATE", '%Y-%m-%d') AS DATE) AS d, NULLIF("STATION", '') AS station,
         TRY_CAST("TMAX" AS DOUBLE) AS tmax, TRY_CAST("TMIN" AS DOUBLE) AS tmin,
         TRY_CAST("PRCP" AS DOUBLE) AS prcp, TRY_CAST("SNOW" AS DOUBLE) AS snow,
         TRY_CAST("SNWD" AS DOUBLE) AS snwd, TRY_CAST("AWND" AS DOUBLE) AS awnd
  FROM bronze
),
silver AS (
  SELECT d AS date, station,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day,
         tmax, tmin, prcp, snow, snwd, awnd,
         tmax / 10.0 AS tmax_celsius, tmin / 10.0 AS tmin_celsius,
         (tmax + tmin) / 20.0 AS tavg_celsius
  FROM typed
  WHERE d IS NOT NULL AND station IS NOT NULL
)"""

GOLD_CTE = """gold AS (
  SELECT date, station,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day,
         ROUND(AVG(tmax) / 10.0, 1) AS avg_tmax,
         ROUND(AVG(tmin) / 10.0, 1) AS avg_tmin,
         ROUND(AVG(tmax + tmin) / 20.0, 1) AS avg_temperature,
         CAST(SUM(prcp) AS DOUBLE) AS total_precipitation,
         CAST(SUM(snow) AS DOUBLE) AS total_snow,
         ROUND(AVG(awnd), 1) AS avg_wind_speed
  FROM silver
  GROUP BY date, station
)"""


# The generator's ranges, probabilities and seed; draw u[n] is five hex digits of the station-day's hash.
GENERATED_CTE = """spans AS (SELECT station, MIN(date) AS a, MAX(date) AS b FROM silver GROUP BY station),
days AS (SELECT station, CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM spans),
hashed AS (SELECT station, d, sha256(station || '|' || strftime(d, '%Y-%m-%d') || '|7') AS h FROM days),
draws AS (SELECT station, d,
    list_transform(range(0, 11), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) / 1048576::DOUBLE) AS u
  FROM hashed),
drawn AS (SELECT station, d, u, CAST(200 + FLOOR(u[1] * 151) AS INTEGER) AS tmax,
    CASE WHEN u[3] < 0.3::DOUBLE THEN CAST(FLOOR(u[4] * 51) AS INTEGER) ELSE 0 END AS prcp,
    CASE WHEN u[5] < 0.1::DOUBLE THEN CAST(FLOOR(u[6] * 21) AS INTEGER) ELSE 0 END AS snow
  FROM draws),
generated AS (SELECT strftime(d, '%Y-%m-%d') AS "DATE", station AS "STATION",
    CASE WHEN u[9] < 0.05::DOUBLE THEN '' ELSE CAST(tmax AS VARCHAR) END AS "TMAX",
    CASE WHEN u[10] < 0.05::DOUBLE THEN ''
         ELSE CAST(CAST(100 + FLOOR(u[2] * (tmax - 50 - 100 + 1)) AS INTEGER) AS VARCHAR) END AS "TMIN",
    CASE WHEN u[11] < 0.02::DOUBLE THEN '' ELSE CAST(prcp AS VARCHAR) END AS "PRCP",
    CAST(snow AS VARCHAR) AS "SNOW",
    CASE WHEN snow > 0 THEN CAST(CAST(FLOOR(u[7] * 101) AS INTEGER) AS VARCHAR) ELSE '0' END AS "SNWD",
    CAST(CAST(10 + FLOOR(u[8] * 191) AS INTEGER) AS VARCHAR) AS "AWND"
  FROM drawn)"""


def with_layers(body: str, stations: int = 10, layers: str = "gold") -> str:
    ctes = [bronze_cte(stations)]
    if layers in ("silver", "gold"):
        ctes.append(SILVER_CTE)
    if layers == "gold":
        ctes.append(GOLD_CTE)
    return "WITH " + ",\n".join(ctes) + "\n" + body


MONTH_NAME = ("CASE WHEN month = 1 THEN 'January' WHEN month = 2 THEN 'February' "
              "WHEN month = 3 THEN 'March' ELSE 'Other' END")
TEMP_CATEGORY = ("CASE WHEN avg_temperature >= 25 THEN 'Hot' WHEN avg_temperature >= 15 THEN 'Warm' "
                 "WHEN avg_temperature >= 5 THEN 'Cool' WHEN avg_temperature >= 0 THEN 'Cold' "
                 "ELSE 'Freezing' END")
PATTERN = """CASE
      WHEN avg_temperature >= 25 AND total_precipitation = 0 THEN 'Hot & Dry'
      WHEN avg_temperature >= 15 AND total_precipitation > 10 THEN 'Warm & Rainy'
      WHEN avg_temperature < 5 AND total_snow > 0 THEN 'Cold & Snowy'
      WHEN avg_temperature < 0 THEN 'Freezing'
      WHEN total_precipitation > 15 THEN 'Heavy Rain'
      ELSE 'Normal' END"""
W_STATION = "PARTITION BY station ORDER BY date ASC NULLS FIRST"
INCONSISTENT = "(avg_tmax < avg_tmin OR ABS(avg_temperature - (avg_tmax + avg_tmin) / 2) > 1)"


def _count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE)"


SILVER_COLUMNS = ("date", "station", "year", "month", "day", "tmax", "tmin", "prcp", "snow",
                  "snwd", "awnd", "tmax_celsius", "tmin_celsius", "tavg_celsius")
GOLD_COLUMNS = ("date", "station", "year", "month", "day", "avg_tmax", "avg_tmin",
                "avg_temperature", "total_precipitation", "total_snow", "avg_wind_speed")
DOUBLE_COLUMNS = {"tmax", "tmin", "prcp", "snow", "snwd", "awnd", "tmax_celsius", "tmin_celsius",
                  "tavg_celsius", "avg_tmax", "avg_tmin", "avg_temperature",
                  "total_precipitation", "total_snow", "avg_wind_speed"}


def _mean_of_three(window: str) -> str:
    """AVG of this row and the two before it, added up in their order."""
    x = "avg_temperature"
    parts = [f"COALESCE(LAG({x}, {k}) OVER ({window}), 0::DOUBLE)" for k in (2, 1)] + [f"COALESCE({x}, 0::DOUBLE)"]
    n = f"COUNT({x}) OVER ({window} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN {n} > 0 THEN ({' + '.join(parts)}) / {n} END"


def _profile_sql(table: str, columns) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS nulls, "
            f"CASE WHEN COUNT(*) > 0 THEN {_pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} END AS null_percentage "
            f"FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _profile_minmax_sql(table: str, columns) -> str:
    parts = []
    for c in columns:
        nulls = f"{c} IS NULL OR isnan({c})" if c in DOUBLE_COLUMNS else f"{c} IS NULL"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, {_count_if(nulls)} AS null_count, "
            f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _range_check_sql() -> str:
    parts = []
    for r in RANGE_RULES:
        c = r.column
        mn, mx = f'MIN(TRY_CAST("{c}" AS DOUBLE))', f'MAX(TRY_CAST("{c}" AS DOUBLE))'
        low_issue = (f"CASE WHEN {mn} < {float(r.low)} THEN '{c} minimum value ' || CAST({mn} AS VARCHAR) "
                     f"|| ' below threshold {r.low}' END")
        high_issue = (f"CASE WHEN {mx} > {float(r.high)} THEN '{c} maximum value ' || CAST({mx} AS VARCHAR) "
                      f"|| ' above threshold {r.high}' END")
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({r.low} AS DOUBLE) AS low, CAST({r.high} AS DOUBLE) AS high, "
            f"{mn} AS min_value, {mx} AS max_value, "
            f"NOT (COALESCE({mn} < {float(r.low)}, false) OR COALESCE({mx} > {float(r.high)}, false)) AS in_range, "
            f"NULLIF(concat_ws('; ', {low_issue}, {high_issue}), '') AS issue FROM bronze")
    return "\nUNION ALL\n".join(parts)


MISSING_BRONZE = " + ".join(
    _count_if(f"\"{c}\" IS NULL OR \"{c}\" = ''") for c in REQUIRED)
SCORE_SQL = (f"CASE WHEN COUNT(*) = 0 THEN 0.0 ELSE 1.0 - CAST({MISSING_BRONZE} AS DOUBLE) "
             f"/ CAST(COUNT(*) * {len(REQUIRED)} AS DOUBLE) END")
BAD_DATE = "(\"DATE\" IS NULL OR \"DATE\" = '' OR NOT regexp_matches(\"DATE\", '^\\d{4}-\\d{2}-\\d{2}$'))"


def _validation_sql() -> str:
    mins = {r.column: (f'MIN(TRY_CAST("{r.column}" AS DOUBLE))', f'MAX(TRY_CAST("{r.column}" AS DOUBLE))', r)
            for r in RANGE_RULES}
    ranges_ok = " AND ".join(
        f"NOT COALESCE({mn} < {float(r.low)}, false) AND NOT COALESCE({mx} > {float(r.high)}, false)"
        for mn, mx, r in mins.values())
    issues = []
    for c, (mn, mx, r) in mins.items():
        issues.append(f"CASE WHEN {mn} < {float(r.low)} THEN '{c} minimum value ' || CAST({mn} AS VARCHAR) "
                      f"|| ' below threshold {r.low}' END")
        issues.append(f"CASE WHEN {mx} > {float(r.high)} THEN '{c} maximum value ' || CAST({mx} AS VARCHAR) "
                      f"|| ' above threshold {r.high}' END")
    pct = f"CASE WHEN COUNT(\"DATE\") > 0 THEN {_pct(_count_if(BAD_DATE), 'COUNT(\"DATE\")')} END"
    dates_ok = f"NOT COALESCE({pct} > 5.0, false)"
    issues.append(f"CASE WHEN {pct} > 5.0 THEN "
                  f"printf('High percentage of invalid dates: %.2f%%', {pct}) END")
    return f"""SELECT ({ranges_ok}) AND ({dates_ok}) AND ({SCORE_SQL}) >= 0.85 AS overall_valid,
  true AS schema_valid, ({ranges_ok}) AS ranges_valid, ({dates_ok}) AS dates_valid,
  {SCORE_SQL} AS quality_score,
  concat_ws('; ', {', '.join(issues)}) AS issues
FROM bronze"""


def _stage_sql() -> str:
    parts = []
    for c in REQUIRED:
        m = _count_if(f"\"{c}\" IS NULL OR \"{c}\" = ''")
        parts.append(f"SELECT 'bronze' AS stage, COUNT(*) AS row_count, {len(BRONZE)} AS column_count, "
                     f"'{c}' AS column_name, {m} AS missing_count, "
                     f"CASE WHEN COUNT(*) > 0 THEN {_pct(m, 'COUNT(*)')} END AS missing_percentage FROM bronze")
    for c in ("date", "station", "tmax", "tmin"):
        m = _count_if(f"{c} IS NULL")
        parts.append(f"SELECT 'silver' AS stage, COUNT(*) AS row_count, {len(SILVER_COLUMNS)} AS column_count, "
                     f"'{c}' AS column_name, {m} AS missing_count, "
                     f"CASE WHEN COUNT(*) > 0 THEN {_pct(m, 'COUNT(*)')} END AS missing_percentage FROM silver")
    return "SELECT stage, row_count, CAST(column_count AS INTEGER) AS column_count, column_name, missing_count, " \
           "missing_percentage FROM (" + "\nUNION ALL\n".join(parts) + ")"


class Report(NamedTuple):
    """A report's keys, numbers and texts (column names)."""
    keys: str
    numbers: str
    texts: str = ""


SUITE = {
    "monthly_summary": Report("year month", "days_count avg_temp_celsius total_precipitation_mm avg_wind_speed", "month_name"),
    "temperature_extremes": Report("date station", "avg_temperature", "temperature_category"),
    "precipitation_analysis": Report(
        "month", "total_days rainy_days rainy_day_percentage avg_daily_precipitation max_daily_precipitation"),
    "station_month_rank": Report("station month", "avg_temp total_precip temp_rank precip_rank"),
    "pattern_distribution": Report("weather_pattern", "occurrences percentage avg_temp_for_pattern avg_precip_for_pattern"),
    "completeness_report": Report("metric", "total_records complete_records completeness_percentage"),
    "range_report": Report("metric", "min_value max_value avg_value outliers"),
    "consistency_report": Report("date station", "avg_tmax avg_tmin avg_temperature", "consistency_check"),
    "monthly_dashboard": Report(
        "month", "total_days avg_temperature min_temperature max_temperature total_precipitation rainy_days freezing_days "
        "hot_days avg_wind_speed", "month_name"),
    "station_performance": Report("station", "data_points avg_temp temp_variability total_precip avg_wind", "climate_category"),
    "seasonal_trends": Report("month", "days avg_temp total_precip avg_wind temp_range", "season"),
    "dataset_span": Report("", "record_count station_count", "first_date last_date"),
    "station_timeseries": Report(
        "date station", "avg_temperature total_precipitation prev_day_temp next_day_temp temp_change rolling_3day_avg "
        "rolling_7day_precip"),
}
RUN_TABLES = {
    "profile": Report("column_name", "count nulls null_percentage"),
    "stage_stats": Report("stage column_name", "row_count column_count missing_count missing_percentage"),
    "metrics": Report("metric", "value"),
    "alerts": Report("metric", "value threshold breached", "direction"),
}


def _melted(name: str, report: Report, sql: str) -> str:
    """All cells of a report as rows: report, row_key, field, number, text."""
    cells = [f"{{'field': '{c}', 'number': CAST({c} AS DOUBLE), 'text': CAST(NULL AS VARCHAR)}}" for c in report.numbers.split()]
    cells += [f"{{'field': '{c}', 'number': CAST(NULL AS DOUBLE), 'text': CAST({c} AS VARCHAR)}}" for c in report.texts.split()]
    key = ", ".join(f"CAST({k} AS VARCHAR)" for k in report.keys.split()) or "''"
    return (f"SELECT '{name}' AS report, row_key, c.field AS field, c.number AS number, c.text AS text FROM "
            f"(SELECT concat_ws('|', {key}) AS row_key, unnest([{', '.join(cells)}]) AS c FROM ({sql}) r)")


def oracle_queries(stations: int = 10, timeseries_station: str = "STN1") -> dict[str, str]:
    g = lambda body: with_layers(body, stations, "gold")
    s = lambda body: with_layers(body, stations, "silver")
    b = lambda body: with_layers(body, stations, "bronze")
    gold_all = "SELECT * FROM gold"
    q = {}
    q["bronze_csv_roundtrip"] = b(
        "SELECT " + ", ".join(f"NULLIF(\"{c}\", '') AS \"{c}\"" for c in BRONZE) + " FROM bronze")
    q["silver_clean"] = s("SELECT * FROM silver")
    q["silver_drop_required"] = s("SELECT * FROM silver WHERE tmax IS NOT NULL AND tmin IS NOT NULL")
    q["gold_daily"] = g(gold_all)
    q["gold_as_coded"] = s("""SELECT d AS date, station, ROUND(AVG(tmax), 1) AS avg_max_temp, ROUND(AVG(tmin), 1) AS avg_min_temp,
  SUM(prcp) AS total_precipitation, SUM(snow) AS total_snow, ROUND(AVG(awnd), 1) AS avg_wind_speed,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM typed WHERE tmax IS NOT NULL AND tmin IS NOT NULL GROUP BY d, station""")
    q["gold_parquet_roundtrip"] = g(gold_all)
    q["gold_idempotent"] = g(gold_all)
    q["full_pipeline"] = g(gold_all)
    q["gold_view_count"] = g("SELECT COUNT(*) AS count FROM gold")
    q["distinct_months"] = g("SELECT DISTINCT year, month FROM gold")
    q["monthly_summary"] = g(f"""SELECT year, month, {MONTH_NAME} AS month_name, COUNT(*) AS days_count,
  ROUND(FAVG(avg_temperature), 1) AS avg_temp_celsius, ROUND(SUM(total_precipitation), 1) AS total_precipitation_mm,
  ROUND(FAVG(avg_wind_speed), 1) AS avg_wind_speed
FROM gold GROUP BY year, month""")
    q["temperature_extremes"] = g(f"""SELECT date, station, avg_temperature, {TEMP_CATEGORY} AS temperature_category
FROM gold WHERE avg_temperature >= 25 OR avg_temperature < 0""")
    q["temperature_bands"] = s("""SELECT date, station, tmax_celsius, tmin_celsius,
  CASE WHEN tmax_celsius > 30 THEN 'Hot' WHEN tmax_celsius > 20 THEN 'Moderate' ELSE 'Cold' END AS temp_category
FROM silver""")
    rainy = _count_if("total_precipitation > 0")
    q["precipitation_analysis"] = g(f"""SELECT month, COUNT(*) AS total_days, {rainy} AS rainy_days,
  ROUND({_pct(rainy, 'COUNT(*)')}, 1) AS rainy_day_percentage,
  ROUND(FAVG(total_precipitation), 1) AS avg_daily_precipitation,
  ROUND(MAX(total_precipitation), 1) AS max_daily_precipitation
FROM gold GROUP BY month""")
    q["year_month_summary"] = s("""SELECT substr(CAST(date AS VARCHAR), 1, 7) AS year_month,
  AVG(tmax) / 10.0 AS avg_max_temp, AVG(tmin) / 10.0 AS avg_min_temp, SUM(prcp) AS total_precipitation
FROM silver GROUP BY 1""")
    q["daily_precipitation"] = s("""SELECT date, station, SUM(prcp) AS total_precipitation, COUNT(*) AS record_count
FROM silver GROUP BY date, station""")
    ts_cols = f"""date, station, avg_temperature, total_precipitation,
  LAG(avg_temperature, 1) OVER ({W_STATION}) AS prev_day_temp,
  LEAD(avg_temperature, 1) OVER ({W_STATION}) AS next_day_temp,
  avg_temperature - LAG(avg_temperature, 1) OVER ({W_STATION}) AS temp_change,
  {_mean_of_three(W_STATION)} AS rolling_3day_avg,
  SUM(total_precipitation) OVER ({W_STATION} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7day_precip"""
    q["station_timeseries"] = g(
        f"SELECT {ts_cols} FROM gold WHERE station = '{timeseries_station}' ORDER BY date LIMIT 10")
    q["daily_change"] = g(f"""SELECT date, station, avg_temperature,
  LAG(avg_temperature, 1) OVER ({W_STATION}) AS prev_day_temp,
  avg_temperature - LAG(avg_temperature, 1) OVER ({W_STATION}) AS temp_change
FROM gold""")
    q["rolling_metrics"] = g(f"""SELECT date, station, avg_temperature, total_precipitation,
  {_mean_of_three(W_STATION)} AS rolling_3day_avg,
  SUM(total_precipitation) OVER ({W_STATION} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7day_precip
FROM gold""")
    q["station_month_rank"] = g("""SELECT station, month, ROUND(monthly_avg_temp, 1) AS avg_temp,
  ROUND(monthly_total_precip, 1) AS total_precip,
  CAST(RANK() OVER (PARTITION BY month ORDER BY monthly_avg_temp DESC NULLS LAST) AS INTEGER) AS temp_rank,
  CAST(RANK() OVER (PARTITION BY month ORDER BY monthly_total_precip DESC NULLS LAST) AS INTEGER) AS precip_rank
FROM (SELECT station, month, FAVG(avg_temperature) AS monthly_avg_temp,
             SUM(total_precipitation) AS monthly_total_precip
      FROM gold GROUP BY station, month) s""")
    q["pattern_distribution"] = g(f"""SELECT weather_pattern, occurrences,
  ROUND({_pct('occurrences', 'SUM(occurrences) OVER ()')}, 1) AS percentage,
  avg_temp_for_pattern, avg_precip_for_pattern
FROM (SELECT weather_pattern, COUNT(*) AS occurrences,
             ROUND(FAVG(avg_temperature), 1) AS avg_temp_for_pattern,
             ROUND(FAVG(total_precipitation), 1) AS avg_precip_for_pattern
      FROM (SELECT avg_temperature, total_precipitation, {PATTERN} AS weather_pattern FROM gold) p
      GROUP BY weather_pattern) c""")
    q["monthly_dashboard"] = g(f"""SELECT month, {MONTH_NAME} AS month_name, COUNT(*) AS total_days,
  ROUND(FAVG(avg_temperature), 1) AS avg_temperature, ROUND(MIN(avg_temperature), 1) AS min_temperature,
  ROUND(MAX(avg_temperature), 1) AS max_temperature, ROUND(SUM(total_precipitation), 1) AS total_precipitation,
  {rainy} AS rainy_days, {_count_if('avg_temperature < 0')} AS freezing_days,
  {_count_if('avg_temperature >= 25')} AS hot_days, ROUND(FAVG(avg_wind_speed), 1) AS avg_wind_speed
FROM gold GROUP BY month""")
    q["station_performance"] = g("""SELECT station, data_points, avg_temp, temp_variability, total_precip, avg_wind,
  CASE WHEN avg_temp > 15 THEN 'Warm Climate' WHEN avg_temp > 5 THEN 'Moderate Climate' ELSE 'Cold Climate' END
    AS climate_category
FROM (SELECT station, COUNT(*) AS data_points, ROUND(FAVG(avg_temperature), 1) AS avg_temp,
             ROUND(STDDEV_SAMP(avg_temperature), 1) AS temp_variability,
             ROUND(SUM(total_precipitation), 1) AS total_precip, ROUND(FAVG(avg_wind_speed), 1) AS avg_wind
      FROM gold GROUP BY station) m""")
    q["seasonal_trends"] = g("""SELECT month,
  CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
       WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  COUNT(*) AS days, ROUND(FAVG(avg_temperature), 1) AS avg_temp, ROUND(SUM(total_precipitation), 1) AS total_precip,
  ROUND(FAVG(avg_wind_speed), 1) AS avg_wind, ROUND(MAX(avg_temperature) - MIN(avg_temperature), 1) AS temp_range
FROM gold GROUP BY month""")
    q["latest_days"] = g("""SELECT date, station, avg_temperature, total_precipitation FROM gold
ORDER BY date DESC, station ASC LIMIT 5""")
    q["completeness_report"] = g("\nUNION ALL\n".join(
        f"SELECT '{label}' AS metric, COUNT(*) AS total_records, COUNT({c}) AS complete_records, "
        f"ROUND({_pct(f'COUNT({c})', 'COUNT(*)')}, 1) AS completeness_percentage FROM gold"
        for label, c in (("Temperature", "avg_temperature"), ("Precipitation", "total_precipitation"),
                         ("Wind Speed", "avg_wind_speed"))))
    q["range_report"] = g("\nUNION ALL\n".join(
        f"SELECT '{label}' AS metric, ROUND(MIN({c}), 1) AS min_value, ROUND(MAX({c}), 1) AS max_value, "
        f"ROUND(FAVG({c}), 1) AS avg_value, {_count_if(f'{c} < {lo} OR {c} > {hi}')} AS outliers FROM gold"
        for label, c, lo, hi in (("Temperature", "avg_temperature", -50, 60),
                                 ("Precipitation", "total_precipitation", 0, 200),
                                 ("Wind Speed", "avg_wind_speed", 0, 200))))
    q["consistency_report"] = g(f"""SELECT date, station, avg_tmax, avg_tmin, avg_temperature,
  CASE WHEN avg_tmax < avg_tmin THEN 'ERROR: Max < Min'
       WHEN ABS(avg_temperature - (avg_tmax + avg_tmin) / 2) > 1 THEN 'WARNING: Avg not between min/max'
       ELSE 'OK' END AS consistency_check
FROM gold WHERE {INCONSISTENT}""")
    q["row_quality_labels"] = s("""SELECT date, station, tmax_celsius, tmin_celsius, prcp,
  CASE WHEN tmax_celsius > 40 OR tmin_celsius < -20 THEN 'Extreme Temperature'
       WHEN tmax_celsius > 30 OR tmin_celsius < -10 THEN 'High Temperature'
       ELSE 'Temperature OK' END AS temp_quality,
  CASE WHEN prcp > 50 THEN 'Heavy Precipitation' WHEN prcp > 20 THEN 'Moderate Precipitation'
       ELSE 'Light Precipitation' END AS precip_quality
FROM silver""")
    q["range_check"] = b(_range_check_sql())
    bad = _count_if(BAD_DATE)
    pct = f"CASE WHEN COUNT(\"DATE\") > 0 THEN {_pct(bad, 'COUNT(\"DATE\")')} END"
    q["date_check"] = b(f"""SELECT {bad} AS invalid_dates, COUNT("DATE") AS total_dates,
  {pct} AS invalid_percentage,
  NOT COALESCE({pct} > 5.0, false) AS dates_valid,
  CASE WHEN {pct} > 5.0
       THEN printf('High percentage of invalid dates: %.2f%%', {pct}) END AS issue
FROM bronze""")
    q["quality_score"] = b(f"""SELECT COUNT(*) AS total_records, {MISSING_BRONZE} AS missing_values,
  {SCORE_SQL} AS quality_score FROM bronze""")
    q["validation_summary"] = b(_validation_sql())
    q["column_profile"] = s(_profile_sql("silver", SILVER_COLUMNS))
    q["column_profile_minmax"] = g(_profile_minmax_sql("gold", GOLD_COLUMNS))
    q["dataset_span"] = g("""SELECT COUNT(*) AS record_count, COUNT(DISTINCT station) AS station_count,
  MIN(date) AS first_date, MAX(date) AS last_date FROM gold""")
    q["stage_stats"] = s(_stage_sql())
    q["threshold_alerts"] = b(f"""SELECT metric, value, threshold, direction,
  CASE WHEN direction = 'max' THEN value > threshold ELSE value < threshold END AS breached
FROM (
  SELECT 'quality_score' AS metric, {SCORE_SQL} AS value, CAST(0.85 AS DOUBLE) AS threshold,
         'min' AS direction FROM bronze
  UNION ALL
  SELECT 'record_count', CAST(COUNT(*) AS DOUBLE), CAST(100.0 AS DOUBLE), 'min' FROM bronze
) t""")
    q["synthetic_observations"] = s("""SELECT station, date_diff('day', MIN(date), MAX(date)) + 1 AS days,
  MIN(date) AS first_date, MAX(date) AS last_date, CAST(0 AS BIGINT) AS out_of_range
FROM silver GROUP BY station""")
    q["synthetic_values"] = f"WITH {bronze_cte(stations)},\n{SILVER_CTE},\n{GENERATED_CTE}\nSELECT * FROM generated"
    q["ingest_and_transform"] = f"""WITH landed AS ({q["synthetic_values"]}),
bronze AS (SELECT * FROM landed),
{SILVER_CTE},
{GOLD_CTE}
SELECT * FROM gold"""
    q["rejected_rows"] = b("""SELECT * FROM (SELECT *, concat_ws('; ',
  CASE WHEN "DATE" IS NULL OR "DATE" = '' THEN 'DATE missing'
       WHEN TRY_STRPTIME("DATE", '%Y-%m-%d') IS NULL THEN 'DATE not a calendar day' END,
  CASE WHEN "STATION" IS NULL OR "STATION" = '' THEN 'STATION missing' END) AS reason FROM bronze) r WHERE reason <> ''""")
    q["silver_as_coded"] = with_layers("""SELECT d AS date, station,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  tmax, tmin, prcp, snow, snwd, awnd, tmax / 10.0 AS tmax_celsius, tmin / 10.0 AS tmin_celsius,
  (tmax + tmin) / 20.0 AS tavg_celsius FROM typed WHERE tmax IS NOT NULL AND tmin IS NOT NULL""", stations, "silver")
    q["date_equality"] = s("SELECT * FROM silver WHERE date = DATE '1995-06-17'")
    q["null_outputs"] = s("SELECT * FROM silver WHERE tavg_celsius IS NULL")
    q["first_match"] = g(f"SELECT * FROM gold WHERE station = '{timeseries_station}' ORDER BY date LIMIT 1")
    q["validate_only"] = q["validation_summary"]
    q["metrics"] = b(f"""SELECT 'quality_score' AS metric, {SCORE_SQL} AS value FROM bronze
UNION ALL SELECT 'record_count', CAST(COUNT(*) AS DOUBLE) FROM bronze
UNION ALL SELECT 'gold_rows', (SELECT CAST(COUNT(*) AS DOUBLE) FROM ({q["gold_daily"]}) g)""")
    tables = {"profile": q["column_profile"], "stage_stats": q["stage_stats"], "metrics": q.pop("metrics"),
              "alerts": q["threshold_alerts"]}
    q["report_files"] = "\nUNION ALL\n".join(_melted(name, report, tables[name]) for name, report in RUN_TABLES.items())
    q["analytics_suite"] = "\nUNION ALL\n".join(_melted(name, report, q[name]) for name, report in SUITE.items())
    q["gold_incremental"] = g(gold_all)
    landed = ", ".join(f"NULLIF(\"{c}\", '') AS \"{c}\"" for c in BRONZE)
    q["validation_incremental"] = (f"WITH {bronze_cte(stations)},\nlanded AS (SELECT {landed} FROM bronze)\n"
                                   + _validation_sql().replace("FROM bronze", "FROM landed"))
    q["station_register"] = g("""SELECT station, COUNT(*) AS days, MAX(avg_temperature) AS hottest,
  CASE WHEN CAST(substr(station, 4) AS INTEGER) % 2 = 0 THEN 'Station ' || substr(station, 4) END AS name
FROM gold GROUP BY station""")
    whole = "ORDER BY date ASC NULLS FIRST, station ASC NULLS FIRST"
    seven = f"{whole} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
    q["global_timeseries"] = g(f"""SELECT date, station, avg_temperature, total_precipitation,
  LAG(avg_temperature, 1) OVER ({whole}) AS prev_temp, LEAD(avg_temperature, 1) OVER ({whole}) AS next_temp,
  avg_temperature - LAG(avg_temperature, 1) OVER ({whole}) AS temp_change,
  {_mean_of_three(whole)} AS moving_avg_3row,
  SUM(total_precipitation) OVER ({seven}) AS moving_sum_7row FROM gold""")
    q["daily_temperature_rank"] = g("""SELECT date, station, month, avg_temperature,
  RANK() OVER (PARTITION BY month ORDER BY avg_temperature DESC NULLS LAST) AS temp_rank FROM gold""")
    q["series_by_deliveries"] = g(f"SELECT {ts_cols} FROM gold")
    q["month_spans"] = g("""SELECT year, month, COUNT(*) AS record_count, MIN(date) AS first_date, MAX(date) AS last_date
FROM gold GROUP BY year, month""")
    q["table_span"] = g("SELECT COUNT(*) AS record_count, MIN(date) AS first_date, MAX(date) AS last_date FROM gold")
    q["null_profile"] = g("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count FROM gold"
        for c in GOLD_COLUMNS if c not in ("year", "month")))
    q["newest_days"] = q["latest_days"]
    q["station_days"] = s(f"""SELECT * FROM silver WHERE station = '{timeseries_station}'
  AND date BETWEEN DATE '1995-01-01' AND DATE '1995-06-30'""")
    q["inconsistent_days"] = q["consistency_report"]
    q["sketched_span"] = g("""SELECT year, COUNT(*) AS record_count, COUNT(DISTINCT station) AS station_count,
  MIN(date) AS first_date, MAX(date) AS last_date FROM gold GROUP BY year""")
    return q
