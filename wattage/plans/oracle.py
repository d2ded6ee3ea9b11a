"""DuckDB text of every named query in ``catalog.py`` (the correctness oracle).

The oracle is written the plain way (global ``row_number``, full outer joins,
correlated NOT EXISTS); Spark's plans differ but must give the same rows.
Integer parts are cast to INTEGER and window numbers to BIGINT so the types
match Spark's; computed doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from .jobs import SEED_REGIONS
from ..sources.fixtures import LINEITEM_READINGS_SQL, RAW_READINGS_SQL

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
RUN_DATE_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


STG = """
stg AS (
    SELECT period_date, respondent, respondent_name, data_type, data_type_name,
           value AS demand_value, value_units, loaded_at,
           CAST(extract(hour FROM period_date) AS INTEGER) AS hour,
           CAST(extract(day FROM period_date) AS INTEGER) AS day,
           CAST(extract(month FROM period_date) AS INTEGER) AS month,
           CAST(extract(year FROM period_date) AS INTEGER) AS year,
           CAST(dayofweek(period_date) AS INTEGER) AS day_of_week,
           CAST(date_trunc('day', period_date) AS TIMESTAMP) AS date_value
    FROM raw_readings
    WHERE value IS NOT NULL AND value > 0 AND period_date IS NOT NULL
)"""

DR = f"""
dr AS (
    SELECT CAST(row_number() OVER (ORDER BY respondent, respondent_name) AS BIGINT) AS region_key,
           respondent, respondent_name,
           CASE WHEN respondent = 'click' THEN 'National' ELSE 'Regional' END AS region_type,
           {AS_OF_SQL} AS created_at
    FROM (SELECT DISTINCT respondent, respondent_name FROM stg)
)"""

DR_LATEST = f"""
dr_latest AS (
    SELECT CAST(row_number() OVER (ORDER BY respondent, respondent_name) AS BIGINT) AS region_key,
           respondent, respondent_name,
           CASE WHEN respondent = 'click' THEN 'National' ELSE 'Regional' END AS region_type,
           {AS_OF_SQL} AS created_at
    FROM (
        SELECT respondent, respondent_name FROM (
            SELECT respondent, respondent_name,
                   row_number() OVER (PARTITION BY respondent ORDER BY loaded_at DESC, respondent_name DESC) AS rn
            FROM stg
        ) WHERE rn = 1
    )
)"""


def _calendar(name: str, spine_from: str) -> str:
    return f"""
{name} AS (
    SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_key,
           date_value,
           CAST(year(date_value) AS INTEGER) AS year,
           CAST(quarter(date_value) AS INTEGER) AS quarter,
           CAST(month(date_value) AS INTEGER) AS month,
           strftime(date_value, '%B') AS month_name,
           CAST(weekofyear(date_value) AS INTEGER) AS week,
           CAST(day(date_value) AS INTEGER) AS day,
           CAST(dayofweek(date_value) AS INTEGER) AS day_of_week,
           strftime(date_value, '%a') AS day_name,
           dayofweek(date_value) IN (0, 6) AS is_weekend,
           FALSE AS is_holiday
    FROM {spine_from}
)"""


DD_SPINE = """
dd_spine AS (
    SELECT CAST(DATE '2023-01-01' + CAST(range AS INTEGER) AS DATE) AS date_value
    FROM range(1461)
    WHERE DATE '2023-01-01' + CAST(range AS INTEGER) <= DATE '2026-12-31'
)"""
DD = DD_SPINE + "," + _calendar("dd", "dd_spine")

DD_DATA_SPINE = """
cal_bounds AS (
    SELECT min(CAST(period_date AS DATE)) AS s, CAST(max(CAST(period_date AS DATE)) + INTERVAL 12 MONTH AS DATE) AS e
    FROM raw_readings
),
dd_data_spine AS (
    SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_value
    FROM cal_bounds
)"""
DD_DATA = DD_DATA_SPINE + "," + _calendar("dd_data", "dd_data_spine")

FCT = """
fct AS (
    SELECT CAST(row_number() OVER (ORDER BY s.period_date ASC NULLS FIRST, r.region_key ASC NULLS FIRST,
                                            s.data_type ASC NULLS FIRST, s.respondent ASC NULLS FIRST) AS BIGINT) AS demand_key,
           s.period_date, d.date_key, r.region_key, s.hour, s.demand_value,
           s.value_units AS demand_units, s.loaded_at
    FROM stg s
    LEFT JOIN dr r ON s.respondent = r.respondent
    LEFT JOIN dd d ON CAST(s.date_value AS DATE) = d.date_value
)"""

DAILY = """
daily AS (
    SELECT CAST(date_trunc('day', period_date) AS TIMESTAMP) AS period_day, respondent, respondent_name,
           round(avg(demand_value), 6) AS avg_demand_mw,
           round(min(demand_value), 6) AS min_demand_mw,
           round(max(demand_value), 6) AS max_demand_mw,
           round(sum(demand_value), 6) AS total_demand_mwh,
           count(*) AS hourly_record_count
    FROM stg
    GROUP BY 1, 2, 3
)"""

DAILY_MEAN = """
daily_mean AS (
    SELECT CAST(date_trunc('day', period_date) AS TIMESTAMP) AS period_day, respondent, avg(demand_value) AS avg_demand_mw
    FROM stg
    GROUP BY 1, 2
)"""

SUMMARY = f"""
summary AS (
    SELECT CAST(row_number() OVER (ORDER BY period_date ASC NULLS FIRST, region ASC NULLS FIRST) AS BIGINT) AS summary_key,
           period_date, region, hour, day_of_week, is_weekend,
           round(total_demand, 6) AS total_demand, round(avg_demand, 6) AS avg_demand,
           round(max_demand, 6) AS max_demand, round(min_demand, 6) AS min_demand,
           round(demand_variance, 6) AS demand_variance,
           {AS_OF_SQL} AS created_at
    FROM (
        SELECT f.period_date, r.respondent AS region, f.hour, d.day_of_week, d.is_weekend,
               sum(f.demand_value) AS total_demand, avg(f.demand_value) AS avg_demand,
               max(f.demand_value) AS max_demand, min(f.demand_value) AS min_demand,
               var_samp(f.demand_value) AS demand_variance, count(*) AS record_count
        FROM fct f
        LEFT JOIN dr r ON f.region_key = r.region_key
        LEFT JOIN dd d ON f.date_key = d.date_key
        GROUP BY f.period_date, r.respondent, f.hour, d.day_of_week, d.is_weekend
    )
)"""

ORACLE: dict[str, str] = {
    "stg_hourly": _with(RAW_READINGS_SQL, STG) + "SELECT * FROM stg",
    "demand_by_region": _with(RAW_READINGS_SQL, STG)
    + """SELECT period_date, respondent, respondent_name,
       round(sum(demand_value), 6) AS total_demand, round(avg(demand_value), 6) AS avg_demand,
       round(max(demand_value), 6) AS max_demand, round(min(demand_value), 6) AS min_demand,
       count(*) AS record_count
FROM stg GROUP BY period_date, respondent, respondent_name""",
    "daily_demand": _with(RAW_READINGS_SQL, STG, DAILY) + "SELECT * FROM daily",
    "forecast_vs_actual": _with(RAW_READINGS_SQL, STG, DAILY) + "SELECT * FROM daily",
    "daily_demand_lineitem": _with(LINEITEM_READINGS_SQL, STG)
    + """SELECT CAST(date_trunc('day', period_date) AS TIMESTAMP) AS period_day, respondent, respondent_name,
       CAST(sum(CAST(demand_value AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_demand_mw,
       min(demand_value) AS min_demand_mw, max(demand_value) AS max_demand_mw,
       CAST(sum(CAST(demand_value AS DECIMAL(18, 2))) AS DOUBLE) AS total_demand_mwh,
       count(*) AS hourly_record_count
FROM stg GROUP BY 1, 2, 3""",
    "dim_date": _with(RAW_READINGS_SQL, DD_DATA) + "SELECT * FROM dd_data",
    "calendar_head": _with(RAW_READINGS_SQL, DD_DATA) + "SELECT * FROM dd_data ORDER BY date_value LIMIT 10",
    "dim_region": _with(RAW_READINGS_SQL, STG, DR) + "SELECT * FROM dr",
    "dim_region_latest": _with(RAW_READINGS_SQL, STG, DR_LATEST) + "SELECT * FROM dr_latest",
    "fct_hourly": _with(RAW_READINGS_SQL, STG, DR, DD, FCT) + "SELECT * FROM fct",
    "fct_dense_key_orders": """SELECT CAST(row_number() OVER (ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS BIGINT) AS order_seq,
       o_orderkey, o_orderdate, o_custkey, o_totalprice
FROM orders""",
    "demand_summary": _with(RAW_READINGS_SQL, STG, DR, DD, FCT, SUMMARY) + "SELECT * FROM summary",
}


# ---------------------------------------------------------------------------
# Sources

SERVICE = """
service AS (
    SELECT CASE WHEN user_id % 10 = 0 THEN strftime(ts, '%Y-%m-%d')
                WHEN user_id % 10 = 1 THEN 'n/a'
                ELSE strftime(ts, '%Y-%m-%dT%H') END AS period,
           event_type AS respondent,
           'Region ' || event_type AS respondent_name_raw,
           CASE user_id % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'DF' WHEN 2 THEN 'NG' ELSE 'TI' END AS type,
           'Type ' || CASE user_id % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'DF' WHEN 2 THEN 'NG' ELSE 'TI' END AS type_name,
           CASE WHEN event_id % 50 = 0 THEN 'N/A' ELSE CAST(value AS VARCHAR) END AS value_text,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'MWh' END AS units
    FROM events
),
normalised AS (
    SELECT TRY_CAST(regexp_replace(period, '^(\\d{4}-\\d{2}-\\d{2})T(\\d{1,2})$', '\\1 \\2:00:00') AS TIMESTAMP) AS period_date,
           respondent,
           respondent_name_raw AS respondent_name,
           type AS data_type,
           type_name AS data_type_name,
           TRY_CAST(value_text AS DOUBLE) AS value,
           coalesce(units, 'MWh') AS value_units
    FROM service
)"""

NEWEST = """
SELECT period_date, respondent, respondent_name, data_type, data_type_name, value, value_units, loaded_at
FROM (
    SELECT *, row_number() OVER (PARTITION BY respondent ORDER BY period_date DESC, data_type DESC) AS rn
    FROM raw_readings
) WHERE rn <= 100"""

REJECTS = """
SELECT *, CASE WHEN period_date IS NULL THEN 'period'
               WHEN respondent IS NULL OR respondent = '' THEN 'respondent'
               WHEN data_type IS NULL OR data_type = '' THEN 'data_type' END AS reason
FROM normalised
WHERE period_date IS NULL OR respondent IS NULL OR respondent = '' OR data_type IS NULL OR data_type = ''"""

# Upserts

BATCH = """
batch_src AS (
    SELECT period_date, respondent, respondent_name, data_type, data_type_name, value + 1 AS value, value_units, loaded_at
    FROM raw_mapped WHERE period_date >= TIMESTAMP '2024-01-28 00:00:00'
    UNION ALL
    SELECT period_date + INTERVAL 40 DAY, respondent, respondent_name, data_type, data_type_name, value, value_units,
           loaded_at + INTERVAL 40 DAY
    FROM raw_mapped WHERE period_date >= TIMESTAMP '2024-01-29 00:00:00'
),
batch AS (
    SELECT period_date, respondent, respondent_name, data_type, data_type_name, value, value_units, loaded_at
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY period_date, respondent, data_type
            ORDER BY loaded_at DESC NULLS LAST, respondent_name DESC NULLS LAST, data_type_name DESC NULLS LAST,
                     value DESC NULLS LAST, value_units DESC NULLS LAST) AS rn
        FROM batch_src
    ) WHERE rn = 1
)"""

UPSERT_READINGS = f"""
SELECT coalesce(t.period_date, s.period_date) AS period_date,
       coalesce(t.respondent, s.respondent) AS respondent,
       CASE WHEN s.period_date IS NOT NULL THEN s.respondent_name ELSE t.respondent_name END AS respondent_name,
       coalesce(t.data_type, s.data_type) AS data_type,
       CASE WHEN s.period_date IS NOT NULL THEN s.data_type_name ELSE t.data_type_name END AS data_type_name,
       CASE WHEN s.period_date IS NOT NULL THEN s.value ELSE t.value END AS value,
       CASE WHEN s.period_date IS NOT NULL THEN s.value_units ELSE t.value_units END AS value_units,
       CASE WHEN s.period_date IS NOT NULL THEN {AS_OF_SQL} ELSE t.loaded_at END AS loaded_at
FROM raw_readings t
FULL OUTER JOIN batch s
  ON t.period_date = s.period_date AND t.respondent = s.respondent AND t.data_type = s.data_type"""

_SEED_ROWS = ",\n           ".join(f"({i + 1}, '{code}', '{name}', '{kind}')" for i, (code, name, kind) in enumerate(SEED_REGIONS))
SEED = f"""
seed(seed_order, respondent, respondent_name, region_type) AS (
    VALUES {_SEED_ROWS}
)"""

INSERT_REGIONS = f"""
SELECT * FROM dr
UNION ALL
SELECT CAST((SELECT max(region_key) FROM dr) + row_number() OVER (ORDER BY seed_order) AS BIGINT) AS region_key,
       respondent, respondent_name, region_type, {AS_OF_SQL} AS created_at
FROM seed s
WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.respondent = s.respondent)"""

INSERT_DATES = """
, target AS (
    SELECT * FROM dd WHERE date_value IN (SELECT DISTINCT CAST(date_value AS DATE) FROM stg)
)
SELECT * FROM target
UNION ALL
SELECT * FROM dd WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.date_value = dd.date_value)"""

# Type-2 history

def _hist_input(name: str, src: str, stamp: str) -> str:
    return f"""
{name} AS (
    SELECT respondent, respondent_name, 'Regional' AS region_type, {stamp} AS created_at
    FROM (
        SELECT respondent, respondent_name,
               row_number() OVER (PARTITION BY respondent ORDER BY CAST(period_date AS DATE) DESC, respondent_name DESC NULLS LAST) AS rn
        FROM {src} WHERE respondent IS NOT NULL
    ) WHERE rn = 1
)"""


T1_SQL = "TIMESTAMP '2024-01-16 00:00:00'"
T2_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

SNAPSHOTS = f"""
snap1_src AS (SELECT * FROM raw_readings WHERE loaded_at < {T1_SQL}),
snap2_base AS (SELECT * FROM raw_readings WHERE loaded_at >= {T1_SQL} AND respondent <> 'error'),
snap2_src AS (
    SELECT period_date, respondent,
           CASE WHEN respondent = 'view' THEN respondent_name || ' (renamed)' ELSE respondent_name END AS respondent_name
    FROM snap2_base
    UNION ALL
    SELECT period_date, 'signup2' AS respondent, respondent_name FROM snap2_base WHERE respondent = 'signup'
),
{_hist_input("in1", "snap1_src", T1_SQL).strip()},
{_hist_input("in2", "snap2_src", T2_SQL).strip()},
h1 AS (
    SELECT *, {T1_SQL} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM in1
),
cmp AS (
    SELECT h.respondent AS h_respondent, h.respondent_name AS h_name, h.region_type AS h_type, h.created_at AS h_created,
           h.valid_from AS h_from,
           s.respondent AS s_respondent, s.respondent_name AS s_name, s.region_type AS s_type, s.created_at AS s_created,
           CASE WHEN s.respondent IS NULL THEN 'missing'
                WHEN h.respondent IS NULL THEN 'new'
                WHEN h.respondent_name IS NOT DISTINCT FROM s.respondent_name
                 AND h.region_type IS NOT DISTINCT FROM s.region_type THEN 'same'
                ELSE 'changed' END AS state
    FROM (SELECT * FROM h1 WHERE valid_to IS NULL) h
    FULL OUTER JOIN in2 s ON h.respondent = s.respondent
),
hist AS (
    SELECT * FROM h1 WHERE valid_to IS NOT NULL
    UNION ALL
    SELECT h_respondent, h_name, h_type, h_created, h_from, CAST(NULL AS TIMESTAMP), TRUE FROM cmp WHERE state IN ('same', 'missing')
    UNION ALL
    SELECT h_respondent, h_name, h_type, h_created, h_from, {T2_SQL}, FALSE FROM cmp WHERE state = 'changed'
    UNION ALL
    SELECT s_respondent, s_name, s_type, s_created, {T2_SQL}, CAST(NULL AS TIMESTAMP), TRUE FROM cmp WHERE state IN ('changed', 'new')
)"""

# Quality

FCT_ROWS = """
fct_rows AS (
    SELECT s.period_date, d.date_key, r.region_key, s.hour, s.demand_value, s.value_units AS demand_units, s.loaded_at
    FROM stg s
    LEFT JOIN dr r ON s.respondent = r.respondent
    LEFT JOIN dd d ON CAST(s.date_value AS DATE) = d.date_value
)"""

BY_REGION = """
by_region AS (
    SELECT period_date, respondent, respondent_name, sum(demand_value) AS total_demand
    FROM stg GROUP BY period_date, respondent, respondent_name
)"""


def _report_row(check: str, table: str, column: str, failing: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, (SELECT count(*) FROM ({failing})) AS failures"


def _nn(table: str, col: str) -> str:
    return _report_row("not_null", table, col, f"SELECT 1 FROM {table_alias(table)} WHERE {col} IS NULL")


def table_alias(table: str) -> str:
    return {"raw_readings": "raw_readings", "stg_hourly": "stg", "stg_by_region": "by_region", "dim_region": "dr", "fct_hourly": "fct_rows"}[table]


DQ_REPORT_BODY = "\nUNION ALL\n".join(
    [
        _nn("raw_readings", "period_date"),
        _nn("raw_readings", "respondent"),
        _nn("raw_readings", "value"),
        _nn("stg_hourly", "period_date"),
        _nn("stg_hourly", "demand_value"),
        _nn("stg_hourly", "respondent"),
        _report_row("accepted_values", "stg_hourly", "respondent",
                    "SELECT 1 FROM stg WHERE respondent NOT IN ('click', 'purchase', 'signup', 'view')"),
        _nn("stg_by_region", "period_date"),
        _nn("stg_by_region", "respondent"),
        _nn("stg_by_region", "total_demand"),
        _nn("dim_region", "region_key"),
        _report_row("unique", "dim_region", "region_key",
                    "SELECT region_key FROM dr WHERE region_key IS NOT NULL GROUP BY region_key HAVING count(*) > 1"),
        _nn("dim_region", "respondent"),
        _report_row("unique", "dim_region", "respondent",
                    "SELECT respondent FROM dr WHERE respondent IS NOT NULL GROUP BY respondent HAVING count(*) > 1"),
        _nn("fct_hourly", "demand_value"),
        _nn("fct_hourly", "region_key"),
        _report_row("relationships", "fct_hourly", "region_key",
                    "SELECT 1 FROM fct_rows f WHERE region_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dr WHERE dr.region_key = f.region_key)"),
    ]
)

# Forecast

Z95 = "1.959963984540054"
Z80 = "1.2815515655446004"


def _train(p: str, run: str) -> str:
    return f"""
train_{p} AS (
    SELECT CAST(date_trunc('day', f.period_date) AS TIMESTAMP) AS date, r.respondent AS region,
           avg(f.demand_value) AS avg_demand_mw
    FROM fct_rows f JOIN dr r ON f.region_key = r.region_key
    WHERE f.period_date >= {run} - INTERVAL 90 DAY AND f.period_date < {run}
    GROUP BY 1, 2
)"""


def _fit(p: str, src: str, min_points: int = 14) -> str:
    return f"""
usable_{p} AS (
    SELECT * FROM {src} WHERE region IN (SELECT region FROM {src} GROUP BY region HAVING count(*) >= {min_points})
),
pts_{p} AS (
    SELECT region, date, CAST(date_diff('day', DATE '2000-01-01', CAST(date AS DATE)) AS DOUBLE) AS x,
           avg_demand_mw AS y, CAST(dayofweek(date) AS INTEGER) AS day_of_week
    FROM usable_{p}
),
line_{p} AS (
    SELECT region, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, max(date) AS last_date, count(*) AS n_points
    FROM pts_{p} GROUP BY region
),
resid_{p} AS (
    SELECT p.region, p.day_of_week, p.y - (l.slope * p.x + l.intercept) AS e
    FROM pts_{p} p JOIN line_{p} l ON p.region = l.region
),
wk_{p} AS (SELECT region, day_of_week, avg(e) AS effect FROM resid_{p} GROUP BY region, day_of_week),
sig_{p} AS (
    SELECT r.region, stddev_samp(r.e - w.effect) AS sigma
    FROM resid_{p} r JOIN wk_{p} w ON r.region = w.region AND r.day_of_week = w.day_of_week
    GROUP BY r.region
),
series_{p} AS (
    SELECT l.region, l.slope, l.intercept, s.sigma, l.last_date, l.n_points
    FROM line_{p} l LEFT JOIN sig_{p} s ON l.region = s.region
)"""


def _predict(p: str, horizon: int = 7, z: str = Z95) -> str:
    return f"""
steps_{p} AS (
    SELECT region, slope, intercept, sigma, last_date, unnest(generate_series(1, {horizon})) AS step FROM series_{p}
),
pred_{p} AS (
    SELECT st.region AS series, st.ts, CAST(st.step AS INTEGER) AS step,
           st.slope * st.x + st.intercept + coalesce(w.effect, 0.0) AS forecast,
           st.slope * st.x + st.intercept + coalesce(w.effect, 0.0) - {z} * st.sigma AS lower_bound,
           st.slope * st.x + st.intercept + coalesce(w.effect, 0.0) + {z} * st.sigma AS upper_bound
    FROM (
        SELECT *, CAST(CAST(last_date AS DATE) + CAST(step AS INTEGER) AS TIMESTAMP) AS ts,
               CAST(dayofweek(CAST(last_date AS DATE) + CAST(step AS INTEGER)) AS INTEGER) AS day_of_week,
               CAST(date_diff('day', DATE '2000-01-01', CAST(last_date AS DATE) + CAST(step AS INTEGER)) AS DOUBLE) AS x
        FROM steps_{p}
    ) st
    LEFT JOIN wk_{p} w ON st.region = w.region AND st.day_of_week = w.day_of_week
)"""


def _rows(p: str, run: str) -> str:
    return f"""
rows_{p} AS (
    SELECT replace(series, '"', '') AS region, ts AS forecast_date, forecast, lower_bound, upper_bound, {run} AS generated_at
    FROM pred_{p}
)"""


def _forecast(p: str, run: str, z: str = Z95) -> list[str]:
    return [_train(p, run), _fit(p, f"train_{p}"), _predict(p, 7, z), _rows(p, run)]


def _evaluate(p: str, src: str, run: str, holdout: int = 7) -> list[str]:
    return [
        f"""
ev_last_{p} AS (SELECT region, max(date) AS last_day FROM {src} GROUP BY region),
ev_tag_{p} AS (
    SELECT t.*, t.date > CAST(CAST(l.last_day AS DATE) - {holdout} AS TIMESTAMP) AS hold
    FROM {src} t JOIN ev_last_{p} l ON t.region = l.region
),
ev_fit_{p} AS (SELECT date, avg_demand_mw, region FROM ev_tag_{p} WHERE NOT hold),
ev_hold_{p} AS (SELECT region, date AS ts, avg_demand_mw AS actual FROM ev_tag_{p} WHERE hold)""",
        _fit(f"e{p}", f"ev_fit_{p}"),
        f"""
ev_scored_{p} AS (
    SELECT h.region, h.actual, se.slope * h.x + se.intercept + coalesce(w.effect, 0.0) AS forecast
    FROM (
        SELECT region, actual, CAST(date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS DOUBLE) AS x,
               CAST(dayofweek(ts) AS INTEGER) AS day_of_week
        FROM ev_hold_{p}
    ) h
    JOIN series_e{p} se ON se.region = h.region
    LEFT JOIN wk_e{p} w ON w.region = h.region AND w.day_of_week = h.day_of_week
),
ev_stats_{p} AS (
    SELECT s.region,
           avg(abs(actual - forecast)) AS mae,
           sqrt(avg((actual - forecast) * (actual - forecast))) AS rmse,
           CASE WHEN count(*) FILTER (actual = 0) = 0 THEN avg(abs(actual - forecast) / nullif(abs(actual), 0)) * 100.0 END AS mape,
           1.0 - sum((actual - forecast) * (actual - forecast)) / nullif(sum((actual - m.mean_actual) * (actual - m.mean_actual)), 0) AS r2
    FROM ev_scored_{p} s JOIN (SELECT region, avg(actual) AS mean_actual FROM ev_scored_{p} GROUP BY region) m
      ON s.region = m.region
    GROUP BY s.region
),
metrics_{p} AS (
    SELECT strftime({run}, '%Y%m%d_%H%M%S') AS model_version, {run} AS training_date, region, metric_name,
           metric_value, 'holdout' AS dataset_type, {run} AS created_at
    FROM (
        SELECT region, 'MAE' AS metric_name, mae AS metric_value FROM ev_stats_{p}
        UNION ALL SELECT region, 'RMSE', rmse FROM ev_stats_{p}
        UNION ALL SELECT region, 'MAPE', mape FROM ev_stats_{p}
        UNION ALL SELECT region, 'R2', r2 FROM ev_stats_{p}
    )
)""",
    ]


def _count_metrics(p: str, rows: str, run: str) -> str:
    return f"""
cm_{p} AS (
    SELECT strftime({run}, '%Y%m%d_%H%M%S') AS model_version, {run} AS training_date, region,
           'FORECAST_PERIODS' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value, 'forecast' AS dataset_type,
           {run} AS created_at
    FROM {rows} GROUP BY region
)"""


R17 = "TIMESTAMP '2024-01-17 00:00:00'"
R24 = "TIMESTAMP '2024-01-24 00:00:00'"
R31 = RUN_DATE_SQL

BASE = [RAW_READINGS_SQL, STG, DR, DD, FCT_ROWS]


def _results(p: str) -> str:
    return f"""
res_{p} AS (
    SELECT region, forecast_date, CAST(NULL AS DOUBLE) AS actual, forecast, lower_bound, upper_bound, generated_at,
           {AS_OF_SQL} AS loaded_at
    FROM rows_{p}
)"""


def _r(cols: str) -> str:
    return cols


FC_OUT = "region, forecast_date, round(forecast, 6) AS forecast, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound, generated_at"

ORACLE.update(
    {
        "only_regions": _with(RAW_READINGS_SQL)
        + "SELECT * FROM raw_readings WHERE respondent IN ('click', 'purchase', 'signup', 'view')",
        "newest_per_region": _with(RAW_READINGS_SQL) + NEWEST,
        "normalise": _with(SERVICE) + "SELECT * FROM normalised",
        "rejects": _with(SERVICE) + REJECTS,
        "dedupe_batch": _with(RAW_READINGS_SQL, BATCH) + "SELECT * FROM batch",
        "upsert_readings": _with(RAW_READINGS_SQL, BATCH) + UPSERT_READINGS,
        "insert_absent_regions": _with(RAW_READINGS_SQL, STG, DR, SEED) + INSERT_REGIONS,
        "insert_absent_dates": _with(RAW_READINGS_SQL, STG, DD) + INSERT_DATES.lstrip(),
        "region_history_input": _with(RAW_READINGS_SQL, _hist_input("hin", "raw_readings", AS_OF_SQL)) + "SELECT * FROM hin",
        "region_history": _with(RAW_READINGS_SQL, SNAPSHOTS) + "SELECT * FROM hist",
        "history_as_of": _with(RAW_READINGS_SQL, SNAPSHOTS)
        + "SELECT * FROM hist WHERE valid_from <= TIMESTAMP '2024-01-20 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-20 00:00:00')",
        "dq_not_null": _with(RAW_READINGS_SQL) + "SELECT * FROM raw_readings WHERE value IS NULL",
        "dq_unique": _with(RAW_READINGS_SQL, SNAPSHOTS)
        + "SELECT respondent, count(*) AS n_rows FROM hist WHERE respondent IS NOT NULL GROUP BY respondent HAVING count(*) > 1",
        "dq_accepted": _with(RAW_READINGS_SQL, STG)
        + "SELECT * FROM stg WHERE respondent NOT IN ('click', 'purchase', 'signup', 'view')",
        "dq_relationship": _with(*BASE)
        + "SELECT * FROM fct_rows f WHERE region_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dr WHERE dr.region_key = f.region_key AND dr.respondent NOT IN ('error', 'view'))",
        "dq_keys": _with(RAW_READINGS_SQL, BATCH)
        + "SELECT period_date, respondent, data_type, count(*) AS n_rows FROM batch_src WHERE period_date IS NOT NULL AND respondent IS NOT NULL AND data_type IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1",
        "dq_counts": _with(RAW_READINGS_SQL, STG, DR, DD)
        + """SELECT * FROM (
    SELECT 'dim_date' AS check_name, count(*) AS actual, CAST(1461 AS BIGINT) AS expected FROM dd
    UNION ALL
    SELECT 'dim_region', count(*), CAST(4 AS BIGINT) FROM dr
) WHERE actual <> expected""",
        "dq_report": _with(*BASE, BY_REGION) + DQ_REPORT_BODY,
        "region_counts": _with(*BASE)
        + "SELECT r.respondent, count(*) AS record_count FROM fct_rows f JOIN dr r ON f.region_key = r.region_key GROUP BY r.respondent ORDER BY record_count DESC, r.respondent",
        "coverage_raw": _with(RAW_READINGS_SQL)
        + "SELECT respondent, count(*) AS raw_count, min(period_date) AS earliest_date, max(period_date) AS latest_date FROM raw_readings GROUP BY respondent",
        "coverage_fact": _with(*BASE)
        + "SELECT r.respondent, count(*) AS fact_count, min(f.period_date) AS earliest_date, max(f.period_date) AS latest_date FROM fct_rows f JOIN dr r ON f.region_key = r.region_key GROUP BY r.respondent",
        "coverage_train": _with(*BASE, _train("a", R31))
        + "SELECT region, count(*) AS training_records, min(date) AS earliest_date, max(date) AS latest_date FROM train_a GROUP BY region",
        "coverage_forecast": _with(*BASE, *_forecast("a", R31))
        + "SELECT region, count(*) AS forecast_count, min(forecast_date) AS first_forecast, max(forecast_date) AS last_forecast FROM rows_a GROUP BY region",
        "key_counts": _with(RAW_READINGS_SQL, STG) + "SELECT respondent, count(*) AS staging_count FROM stg GROUP BY respondent",
        "layer_counts": _with(*BASE, *_forecast("a", R31))
        + """SELECT 'raw_readings' AS layer, count(*) AS n_rows FROM raw_readings
UNION ALL SELECT 'stg_hourly', count(*) FROM stg
UNION ALL SELECT 'dim_region', count(*) FROM dr
UNION ALL SELECT 'dim_date', count(*) FROM dd
UNION ALL SELECT 'fct_hourly', count(*) FROM fct_rows
UNION ALL SELECT 'forecast_results', count(*) FROM rows_a""",
        "layer_dropoff": _with(*BASE)
        + """, r AS (SELECT respondent, count(*) AS raw_count FROM raw_readings GROUP BY respondent),
s AS (SELECT respondent, count(*) AS staging_count FROM stg GROUP BY respondent),
f AS (SELECT d.respondent, count(*) AS fact_count FROM fct_rows x JOIN dr d ON x.region_key = d.region_key GROUP BY d.respondent)
SELECT coalesce(r.respondent, s.respondent, f.respondent) AS respondent,
       coalesce(r.raw_count, 0) AS raw_count, coalesce(s.staging_count, 0) AS staging_count, coalesce(f.fact_count, 0) AS fact_count
FROM r FULL OUTER JOIN s ON r.respondent = s.respondent
FULL OUTER JOIN f ON coalesce(r.respondent, s.respondent) = f.respondent""",
        "trailing_days": _with(RAW_READINGS_SQL)
        + f"SELECT * FROM raw_readings WHERE period_date >= {R31} - INTERVAL 14 DAY AND period_date < {R31}",
        "loaded_on": _with(RAW_READINGS_SQL) + "SELECT * FROM raw_readings WHERE CAST(loaded_at AS DATE) = DATE '2024-01-15'",
        "run_rows": _with(*BASE, *_forecast("b", R24), *_forecast("c", R31), _results("b"), _results("c"))
        + f"SELECT region, forecast_date, actual, round(forecast, 6) AS forecast, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound, generated_at, loaded_at FROM (SELECT * FROM res_b UNION ALL SELECT * FROM res_c) WHERE generated_at = {R31}",
        "train_daily": _with(*BASE, _train("a", R31))
        + "SELECT date, region, round(avg_demand_mw, 6) AS avg_demand_mw FROM train_a",
        "usable_series": _with(*BASE, _train("a", R31), _fit("a", "train_a"))
        + "SELECT date, region, round(avg_demand_mw, 6) AS avg_demand_mw FROM usable_a",
        "forecast_fit": _with(*BASE, _train("a", R31), _fit("a", "train_a"))
        + "SELECT region, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(sigma, 6) AS sigma, last_date, n_points FROM series_a",
        "forecast_weekday": _with(*BASE, _train("a", R31), _fit("a", "train_a"))
        + "SELECT region, day_of_week, round(effect, 6) AS effect FROM wk_a",
        "forecast_steps": _with(*BASE, _train("a", R31), _fit("a", "train_a"), _predict("a"))
        + "SELECT series, ts, step, round(forecast, 6) AS forecast, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM pred_a",
        "forecast_7d": _with(*BASE, *_forecast("a", R31)) + f"SELECT {FC_OUT} FROM rows_a",
        "forecast_metrics": _with(*BASE, _train("a", R31), *_evaluate("a", "train_a", R31))
        + "SELECT model_version, training_date, region, metric_name, round(metric_value, 6) AS metric_value, dataset_type, created_at FROM metrics_a",
        "forecast_count_metrics": _with(*BASE, *_forecast("a", R31), _count_metrics("a", "rows_a", R31)) + "SELECT * FROM cm_a",
        "forecast_with_actuals": _with(*BASE, *_forecast("b", R24), DAILY_MEAN)
        + f"""SELECT {FC_OUT}, round(d.avg_demand_mw, 6) AS actual,
       round(d.avg_demand_mw - f.forecast, 6) AS prediction_error,
       (d.avg_demand_mw >= f.lower_bound AND d.avg_demand_mw <= f.upper_bound) AS in_interval
FROM rows_b f LEFT JOIN daily_mean d ON d.respondent = f.region AND d.period_day = f.forecast_date""",
        "history_with_forecast": _with(*BASE, *_forecast("a", R31), DAILY)
        + """SELECT respondent AS region, period_day AS date, avg_demand_mw AS value, CAST(NULL AS DOUBLE) AS lower_bound,
       CAST(NULL AS DOUBLE) AS upper_bound, 'actual' AS kind FROM daily
UNION ALL
SELECT region, forecast_date, round(forecast, 6), round(lower_bound, 6), round(upper_bound, 6), 'forecast' FROM rows_a""",
        "forecast_preview": _with(*BASE, *_forecast("a", R31))
        + "SELECT region, forecast_date, round(forecast, 6) AS forecast, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM rows_a ORDER BY region, forecast_date LIMIT 10",
        "upsert_forecasts": _with(
            *BASE, *_forecast("b", R24), *_forecast("c", R31), *_forecast("d", R31, Z80), *_forecast("e", R17),
            _results("b"), _results("c"),
        )
        + f""", tgt AS (SELECT * FROM res_b UNION ALL SELECT * FROM res_c),
bat AS (SELECT * FROM rows_d UNION ALL SELECT * FROM rows_e)
SELECT coalesce(t.region, s.region) AS region, coalesce(t.forecast_date, s.forecast_date) AS forecast_date,
       t.actual AS actual,
       round(CASE WHEN s.region IS NOT NULL THEN s.forecast ELSE t.forecast END, 6) AS forecast,
       round(CASE WHEN s.region IS NOT NULL THEN s.lower_bound ELSE t.lower_bound END, 6) AS lower_bound,
       round(CASE WHEN s.region IS NOT NULL THEN s.upper_bound ELSE t.upper_bound END, 6) AS upper_bound,
       coalesce(t.generated_at, s.generated_at) AS generated_at,
       CASE WHEN t.region IS NULL THEN {AS_OF_SQL} ELSE t.loaded_at END AS loaded_at
FROM tgt t FULL OUTER JOIN bat s
  ON t.region = s.region AND t.forecast_date = s.forecast_date AND t.generated_at = s.generated_at""",
        "upsert_metrics": _with(
            *BASE, *_forecast("b", R24), *_forecast("c", R31), _count_metrics("b", "rows_b", R24),
            _count_metrics("c", "rows_c", R31), *_evaluate("b", "train_b", R24), *_evaluate("b5", "train_b", R24, 5),
        )
        + f""", tgt AS (SELECT * FROM cm_b UNION ALL SELECT * FROM metrics_b),
bat AS (SELECT * FROM metrics_b5 UNION ALL SELECT * FROM cm_c)
SELECT coalesce(t.model_version, s.model_version) AS model_version,
       CASE WHEN t.model_version IS NULL THEN s.training_date ELSE t.training_date END AS training_date,
       coalesce(t.region, s.region) AS region, coalesce(t.metric_name, s.metric_name) AS metric_name,
       round(CASE WHEN s.model_version IS NOT NULL THEN s.metric_value ELSE t.metric_value END, 6) AS metric_value,
       CASE WHEN t.model_version IS NULL THEN s.dataset_type ELSE t.dataset_type END AS dataset_type,
       CASE WHEN t.model_version IS NULL THEN {AS_OF_SQL} ELSE t.created_at END AS created_at
FROM tgt t FULL OUTER JOIN bat s
  ON t.model_version = s.model_version AND t.region = s.region AND t.metric_name = s.metric_name""",
    }
)


STREAMED = f"""
SELECT period_date, respondent, respondent_name, data_type, data_type_name,
       CASE WHEN period_date < {T1_SQL} AND extract(hour FROM period_date) % 4 = 1 THEN value - 1 ELSE value END AS value,
       value_units, {AS_OF_SQL} AS loaded_at
FROM raw_readings"""

CORRECTED = f"""
SELECT period_date, respondent, respondent_name, data_type, data_type_name,
       CASE extract(hour FROM period_date) % 4 WHEN 0 THEN value WHEN 1 THEN value - 1 WHEN 3 THEN value / 2 END AS value,
       value_units, {AS_OF_SQL} AS loaded_at
FROM raw_readings WHERE respondent IN ('click', 'purchase', 'signup', 'view')"""

LOAD_REJECTS = """
, landed AS (
    SELECT TRY_CAST(regexp_replace(period, '^(\\d{4}-\\d{2}-\\d{2})T(\\d{1,2})$', '\\1 \\2:00:00') AS TIMESTAMP) AS period_date,
           CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE respondent END AS respondent,
           CASE WHEN n % 7 = 0 THEN '' ELSE type END AS data_type
    FROM (SELECT *, CAST('0x' || substr(md5(concat_ws('|', period, respondent, type)), 1, 2) AS INTEGER) AS n FROM service)
), tagged AS (
    SELECT CASE WHEN period_date IS NULL THEN 'period'
                WHEN respondent IS NULL OR respondent = '' THEN 'respondent'
                WHEN data_type = '' THEN 'data_type' END AS reason, respondent
    FROM landed
    UNION ALL
    SELECT 'page', NULL FROM nation
)
SELECT reason, respondent, count(*) AS n_rows FROM tagged WHERE reason IS NOT NULL GROUP BY 1, 2"""

BACKTEST = """
, pts AS (
    SELECT region, date, CAST(date_diff('day', DATE '2000-01-01', CAST(date AS DATE)) AS DOUBLE) AS x, avg_demand_mw AS y, dayofweek(date) AS dow FROM train_a
), cuts AS (
    SELECT region, CAST(last_day - CAST(7 + 5 * i AS INTEGER) AS TIMESTAMP) AS origin
    FROM (SELECT region, CAST(max(date) AS DATE) AS last_day FROM train_a GROUP BY region), range(2) t(i)
), known AS (
    SELECT p.*, c.origin FROM pts p JOIN cuts c ON p.region = c.region AND p.date <= c.origin
), lines AS (
    SELECT region, origin, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM known GROUP BY region, origin HAVING count(*) >= 14
), effects AS (
    SELECT k.region, k.origin, dow, avg(y - (slope * x + intercept)) AS effect FROM known k JOIN lines l ON k.region = l.region AND k.origin = l.origin GROUP BY 1, 2, 3
), scored AS (
    SELECT p.region, date_diff('day', l.origin, p.date) AS step, p.y - (slope * x + intercept + coalesce(effect, 0)) AS e
    FROM pts p JOIN lines l ON p.region = l.region AND p.date > l.origin AND p.date <= l.origin + INTERVAL 7 DAY
    LEFT JOIN effects f ON f.region = p.region AND f.origin = l.origin AND f.dow = p.dow
)
SELECT region, CAST(step AS INTEGER) AS step, count(*) AS n_origins, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e), 6) AS bias
FROM scored GROUP BY 1, 2"""

GAPPY = """
train_g AS (
    SELECT date, region, CASE WHEN region = 'click' THEN 100.0 ELSE avg_demand_mw END AS avg_demand_mw
    FROM train_a
    WHERE (region <> 'error' OR extract(day FROM date) <= 10)
      AND (region <> 'view' OR extract(day FROM date) <= 20 OR extract(day FROM date) = 28)
)"""

RENAMED = f"""
, names AS (SELECT DISTINCT respondent, respondent_name, period_date < {T1_SQL} AS early FROM raw_readings)
SELECT respondent, respondent_name, 'Regional' AS region_type, {T1_SQL} AS created_at, {T1_SQL} AS valid_from,
       CASE WHEN respondent = 'view' THEN {T2_SQL} END AS valid_to, respondent <> 'view' AS is_current
FROM names WHERE early
UNION ALL
SELECT respondent, CASE WHEN respondent = 'view' THEN respondent_name || ' (renamed)' ELSE respondent_name END, 'Regional',
       {T2_SQL}, {T2_SQL}, CAST(NULL AS TIMESTAMP), TRUE
FROM names WHERE NOT early AND (respondent = 'view' OR respondent NOT IN (SELECT respondent FROM names WHERE early))"""

ORACLE.update(
    {
        "ingest_json": _with(SERVICE) + "SELECT * FROM normalised",
        "write_raw": _with(RAW_READINGS_SQL) + "SELECT * FROM raw_readings",
        "ingest_stream": _with(RAW_READINGS_SQL) + STREAMED,
        "load_corrections": _with(RAW_READINGS_SQL) + CORRECTED,
        "load_twice_refresh": _with(RAW_READINGS_SQL, STG, DAILY) + "SELECT * FROM daily",
        "stream_refresh": _with(RAW_READINGS_SQL, f"streamed AS ({STREAMED})", STG.replace("raw_readings", "streamed"), DAILY) + "SELECT * FROM daily",
        "stored_fact": _with(RAW_READINGS_SQL, STG, DR, DD_DATA, FCT.replace("LEFT JOIN dd d", "LEFT JOIN dd_data d"))
        + f"""SELECT * REPLACE ({AS_OF_SQL} AS loaded_at),
       (SELECT count(*) FROM stg WHERE period_date < {T1_SQL}) AS rows_while_stopped FROM fct""",
        "load_rejects": _with(SERVICE) + LOAD_REJECTS,
        "materialise": _with(RAW_READINGS_SQL, STG, DAILY) + "SELECT * FROM daily WHERE extract(day FROM period_day) <= 20",
        "replace_table": _with(RAW_READINGS_SQL) + "SELECT * REPLACE (value * 2 AS value) FROM raw_readings WHERE respondent <> 'error'",
        "region_history_rename": _with(RAW_READINGS_SQL) + RENAMED,
        "dim_date_holidays": _with(RAW_READINGS_SQL, DD_DATA)
        + """SELECT * REPLACE (date_value IN (SELECT CAST(period_date AS DATE) FROM raw_readings WHERE dayofweek(period_date) = 0) AS is_holiday)
FROM dd_data""",
        "dq_require_rows": _with(RAW_READINGS_SQL) + "SELECT respondent, count(*) AS n_rows FROM raw_readings GROUP BY respondent",
        "forecast_metrics_gaps": _with(*BASE, _train("a", R31), GAPPY, *_evaluate("g", "train_g", R31))
        + "SELECT model_version, training_date, region, metric_name, round(metric_value, 6) AS metric_value, dataset_type, created_at FROM metrics_g",
        "forecast_fit_states": _with(*BASE, _train("a", R31), _fit("a", "train_a"))
        + "SELECT region, n_points, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(sigma, 6) AS sigma FROM series_a",
        "forecast_backtest": _with(*BASE, _train("a", R31)) + BACKTEST,
        "skipped_series": _with(*BASE, _train("a", R31), GAPPY)
        + "SELECT region, count(*) AS n_points FROM train_g GROUP BY region HAVING count(*) < 14",
        "forecast_rows_quoted": _with(*BASE, *_forecast("a", R31)) + f"SELECT {FC_OUT} FROM rows_a",
        "gbt_features": _with(*BASE, _train("a", R31), GAPPY)
        + """SELECT t.region, t.date, round(t.avg_demand_mw, 6) AS label, round(a.avg_demand_mw, 6) AS lag_1, round(b.avg_demand_mw, 6) AS lag_7,
       CAST(dayofweek(t.date) AS DOUBLE) AS day_of_week,
       CAST(date_diff('day', DATE '2000-01-01', CAST(t.date AS DATE)) AS DOUBLE) AS day_number
FROM train_g t
JOIN train_g a ON a.region = t.region AND a.date = t.date - INTERVAL 1 DAY
JOIN train_g b ON b.region = t.region AND b.date = t.date - INTERVAL 7 DAY""",
    }
)

ORACLE["region_list"] = (
    _with(RAW_READINGS_SQL, STG, DR) + "SELECT region_key, respondent, respondent_name, region_type FROM dr ORDER BY region_key"
)

ORACLE["fct_hourly_lineitem"] = (
    _with(LINEITEM_READINGS_SQL, STG, DR, DD_DATA, FCT.replace("LEFT JOIN dd d", "LEFT JOIN dd_data d")) + "SELECT * FROM fct"
)
ORACLE["upsert_lineitem"] = (
    _with(
        LINEITEM_READINGS_SQL,
        """
batch AS (
    SELECT * REPLACE (value * 2 AS value) FROM raw_readings WHERE extract(day FROM period_date) > 20
    UNION ALL
    SELECT * REPLACE (period_date + INTERVAL 3650 DAY AS period_date) FROM raw_readings WHERE respondent = 'NO'
)""",
    )
    + UPSERT_READINGS
)
