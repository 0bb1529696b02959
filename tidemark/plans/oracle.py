"""DuckDB SQL that recomputes every registered query independently.

Each oracle is ``WITH <fixture CTEs> <query>``; the fixtures mirror
``sources/fixtures.py`` but are written from scratch in DuckDB's dialect,
and expected feature values are derived from the generation rules (the
source rows), not by re-parsing the strings.
"""

from __future__ import annotations

FIXTURE_CTES = {
    "lines": """
lines AS (
  SELECT l_orderkey,
         CAST(count(*) AS DOUBLE) AS n_lines,
         sum(l_quantity) AS sum_qty,
         abs(max(l_discount)) AS max_discount,
         abs(max(l_tax)) AS max_tax,
         max(l_extendedprice) AS max_price,
         list_sort(list_distinct(list(p_name))) AS parts,
         list_sort(list_distinct(list(p_brand))) AS brands
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey)""",
    "samples": """
samples AS (
  SELECT o_orderkey AS sample_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS sample_date,
         CAST(o_orderdate AS DATE) AS order_date,
         o_totalprice AS total_price,
         CAST(o_custkey AS DOUBLE) AS cust_key,
         n_lines, sum_qty, max_discount, max_tax, max_price,
         max_discount * 80.0 AS entropy,
         CASE o_orderkey % 10
           WHEN 0 THEN NULL
           WHEN 1 THEN ''
           WHEN 2 THEN coalesce(array_to_string(parts, '|'), '')
           WHEN 3 THEN '[''' || coalesce(array_to_string(parts, ''', '''), '')
           ELSE CASE WHEN coalesce(len(parts), 0) <= 0 THEN '[]'
                     ELSE '[''' || array_to_string(parts, ''', ''') || ''']' END
         END AS imported_dlls,
         CASE WHEN brands IS NULL THEN NULL
              WHEN len(brands) = 0 THEN '[]'
              WHEN (o_orderkey // 10) % 4 = 0 THEN '[''' || array_to_string(brands, ''', ''') || ''',]'
              WHEN (o_orderkey // 10) % 4 = 1 THEN array_to_string(brands, ', ')
              WHEN (o_orderkey // 10) % 4 = 2 THEN '["' || array_to_string(brands, '", "') || '"]'
              ELSE '[''' || array_to_string(brands, ''', ''') || ''']'
         END AS imported_symbols,
         CASE o_orderkey % 5
           WHEN 0 THEN NULL
           WHEN 1 THEN '[]'
           WHEN 2 THEN '[[''' || o_orderpriority || ''', ''' || o_orderstatus || ''']]'
           WHEN 3 THEN o_orderpriority || ', ' || o_orderstatus
           ELSE '[''' || o_orderpriority || ''']'
         END AS identify,
         CASE o_orderkey % 8
           WHEN 0 THEN '1970-01-01 00:00:00'
           WHEN 1 THEN 'unknown'
           WHEN 2 THEN NULL
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           WHEN 4 THEN '2100-06-01 12:00:00'
           ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         END AS formatted_ts,
         parts, brands, o_orderpriority AS priority, o_orderstatus AS status,
         o_orderkey % 10 AS v_dll, (o_orderkey // 10) % 4 AS v_sym,
         o_orderkey % 5 AS v_id, o_orderkey % 8 AS v_ts
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)""",
    # per (sample, model) pseudo-probability, same integer arithmetic as Spark
    "scores": """
scores AS (
  SELECT s.sample_id, s.label, s.sample_date, m.model_id,
         CAST(floor((('0x' || substr(md5('m42:' || CAST(m.model_id AS VARCHAR) || ':' || CAST(s.sample_id AS VARCHAR)), 1, 8))::UBIGINT
                     / 4294967295.0) * 60) + 40 * s.label AS DOUBLE) / 100.0 AS p
  FROM samples s, (SELECT range AS model_id FROM range(5)) m)""",
    "drift": """
drift AS (
  SELECT event_id,
         CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'train' ELSE 'deploy' END AS side,
         CAST(value AS DOUBLE) AS value,
         CAST(user_id AS DOUBLE) AS user_id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS prop_k,
         CAST(hour(ts) AS DOUBLE) AS hour
  FROM events)""",
}

_DEPS = {"samples": ["lines"], "scores": ["lines", "samples"], "drift": [], "lines": []}


def with_fixtures(*names: str) -> str:
    """``WITH`` prefix holding the named fixtures and their dependencies."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(FIXTURE_CTES[n] for n in order) + "\n"

# ---------------------------------------------------------------------------
# Reusable SQL pieces
# ---------------------------------------------------------------------------
H = "md5('42:' || CAST(sample_id AS VARCHAR))"

SPLIT_CTES = f""",
cut AS (
  SELECT sample_date AS cutoff FROM (
    SELECT sample_date, row_number() OVER (ORDER BY sample_date) - 1 AS i, count(*) OVER () AS n
    FROM samples WHERE label = 1)
  WHERE i = n - greatest(CAST(round_even(n * 0.2, 0) AS BIGINT), 1)),
negr AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1 AS r,
         count(*) OVER (PARTITION BY label) AS n
  FROM samples WHERE label <> 1),
tsplit AS (
  SELECT s.*, CASE WHEN s.sample_date < cut.cutoff THEN 'train' ELSE 'test' END AS split, cut.cutoff
  FROM samples s, cut WHERE s.label = 1
  UNION ALL
  SELECT negr.* EXCLUDE (r, n), CASE WHEN r < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split, cut.cutoff
  FROM negr, cut)
"""

WINDOW_CTES = f""",
train AS (SELECT * FROM tsplit WHERE split = 'train'),
q AS (
  SELECT quantile_cont(epoch_us(CAST(sample_date AS TIMESTAMP)), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS qs
  FROM train WHERE label = 1),
wpos AS (
  SELECT t.*, CAST(least(
           (CASE WHEN epoch_us(CAST(sample_date AS TIMESTAMP)) >= qs[2] THEN 1 ELSE 0 END)
         + (CASE WHEN epoch_us(CAST(sample_date AS TIMESTAMP)) >= qs[3] THEN 1 ELSE 0 END)
         + (CASE WHEN epoch_us(CAST(sample_date AS TIMESTAMP)) >= qs[4] THEN 1 ELSE 0 END)
         + (CASE WHEN epoch_us(CAST(sample_date AS TIMESTAMP)) >= qs[5] THEN 1 ELSE 0 END), 4) AS INTEGER) AS window_id
  FROM train t, q WHERE t.label = 1),
wnegr AS (
  SELECT *, row_number() OVER (ORDER BY {H}, sample_id) - 1 AS r, count(*) OVER () AS n
  FROM train WHERE label <> 1),
windowed AS (
  SELECT * FROM wpos
  UNION ALL
  SELECT wnegr.* EXCLUDE (r, n),
         CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                   ELSE (n % 5) + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS window_id
  FROM wnegr)
"""

ORACLES: dict[str, str] = {}


def _s(*fx):
    return with_fixtures(*fx)


ORACLES["temporal_split_summary"] = _s("samples") + SPLIT_CTES + """
SELECT split, count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos,
       count(*) FILTER (WHERE label = 0) AS n_neg, any_value(cutoff) AS cutoff
FROM tsplit GROUP BY split"""

ORACLES["temporal_split_rows"] = _s("samples") + SPLIT_CTES + "SELECT sample_id, label, split FROM tsplit"

ORACLES["random_split_summary"] = _s("samples") + f""",
rr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1 AS r,
              count(*) OVER (PARTITION BY label) AS n FROM samples)
SELECT CASE WHEN r < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split, count(*) AS n,
       count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg
FROM rr GROUP BY 1"""

ORACLES["no_lookahead"] = _s("samples") + SPLIT_CTES + """
SELECT max(sample_date) FILTER (WHERE split = 'train') AS max_train_date,
       min(sample_date) FILTER (WHERE split = 'test') AS min_test_date,
       any_value(cutoff) AS cutoff,
       max(sample_date) FILTER (WHERE split = 'train') < any_value(cutoff)
         AND any_value(cutoff) <= min(sample_date) FILTER (WHERE split = 'test') AS no_lookahead
FROM tsplit WHERE label = 1"""

ORACLES["window_cutoffs"] = _s("samples") + SPLIT_CTES + WINDOW_CTES + """
SELECT CAST(i - 1 AS INTEGER) AS cutoff_idx, CAST(round(qs[i]) AS BIGINT) AS cutoff_micros
FROM q, range(1, 7) t(i)"""

ORACLES["window_assignment"] = _s("samples") + SPLIT_CTES + WINDOW_CTES + \
    "SELECT sample_id, label, window_id FROM windowed"

ORACLES["calibration_tail"] = _s("samples") + SPLIT_CTES + WINDOW_CTES + f""",
cp AS (
  SELECT sample_id, window_id,
         row_number() OVER (PARTITION BY window_id ORDER BY sample_date DESC, {H}) - 1 AS r,
         greatest(round_even(count(*) OVER (PARTITION BY window_id) * 0.15, 0), 1) AS ncal
  FROM windowed WHERE label = 1),
cn AS (
  SELECT sample_id, window_id,
         row_number() OVER (PARTITION BY window_id ORDER BY {H}, sample_id) - 1 AS r,
         round_even(count(*) OVER (PARTITION BY window_id) * 0.15, 0) AS ncal
  FROM windowed WHERE label <> 1)
SELECT sample_id, window_id, CASE WHEN r < ncal THEN 'calibration' ELSE 'fit' END AS part FROM cp
UNION ALL
SELECT sample_id, window_id, CASE WHEN r < ncal THEN 'calibration' ELSE 'fit' END AS part FROM cn"""

ORACLES["stratified_folds"] = _s("samples") + f"""
SELECT sample_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1) % 10 AS INTEGER) AS fold
FROM samples"""

ORACLES["prevalence_sample"] = _s("samples") + f""",
rr AS (SELECT sample_id, label, row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1 AS r
       FROM samples),
picked AS (SELECT * FROM rr WHERE (label = 1 AND r < 50) OR (label <> 1 AND r < 450))
SELECT sample_id, label,
       CAST(row_number() OVER (ORDER BY md5('42:shuffle:' || CAST(sample_id AS VARCHAR))) - 1 AS INTEGER) AS sample_pos
FROM picked"""

ORACLES["demo_per_class"] = _s("samples") + SPLIT_CTES + f""",
rr AS (SELECT sample_id, label, row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1 AS pick
       FROM tsplit WHERE split = 'test')
SELECT * FROM rr WHERE (label = 1 AND pick < 3) OR (label = 0 AND pick < 2)"""

ORACLES["time_sample"] = _s("samples") + """,
ym AS (SELECT DISTINCT year(sample_date) AS y, month(sample_date) AS m FROM samples WHERE label = 1),
keep AS (SELECT y, min(m) AS m FROM ym GROUP BY y)
SELECT sample_id, sample_date FROM samples s JOIN keep k
  ON year(s.sample_date) = k.y AND month(s.sample_date) = k.m
WHERE s.label = 1"""

# --- string features (expected values from the generation rules) ----------
FEAT_CTE = """,
feat AS (
  SELECT sample_id, label,
    CAST(CASE WHEN v_dll IN (0, 1, 3) THEN 0 ELSE coalesce(len(parts), 0) END AS INTEGER) AS n_imported_dlls,
    CAST(coalesce(len(brands), 0) AS INTEGER) AS n_imported_symbols,
    CASE WHEN v_id IN (0, 1) THEN 0
         WHEN contains(priority, 'URGENT') OR contains(priority, 'HIGH') THEN 1 ELSE 0 END AS identify_is_packed,
    CAST(CASE v_id WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 1 END AS INTEGER)
      AS identify_signature_count,
    CAST(CASE v_ts WHEN 0 THEN 1970 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 4 THEN 2100
         ELSE year(order_date) END AS INTEGER) AS formatted_timedatestamp_year,
    CASE WHEN brands IS NOT NULL AND list_has_any(brands, ['Brand#1', 'Brand#13', 'Brand#22'])
         THEN 1 ELSE 0 END AS imports_dangerous_api
  FROM samples),
eng AS (
  SELECT *,
    CASE WHEN formatted_timedatestamp_year IS NULL
           OR formatted_timedatestamp_year NOT BETWEEN 1990 AND 2030 THEN 1 ELSE 0 END AS time_alignment_anomaly,
    CASE WHEN n_imported_dlls = 0 OR n_imported_dlls > 100 THEN 1 ELSE 0 END AS dll_count_anomaly
  FROM feat)
"""

ORACLES["list_parse"] = _s("samples") + """
SELECT sample_id,
  CAST(CASE WHEN v_dll IN (0, 1, 3) THEN 0 ELSE coalesce(len(parts), 0) END AS INTEGER) AS n_dlls,
  CASE WHEN v_dll IN (0, 1, 3) THEN '' ELSE coalesce(array_to_string(parts, '|'), '') END AS dlls_joined,
  CAST(coalesce(len(brands), 0) AS INTEGER) AS n_symbols,
  coalesce(array_to_string(brands, '|'), '') AS symbols_joined,
  CASE WHEN v_dll IN (0, 1) THEN 'empty'
       WHEN v_dll = 2 AND coalesce(len(parts), 0) = 0 THEN 'empty'
       WHEN v_dll = 3 THEN 'malformed' ELSE 'ok' END AS dll_status
FROM samples"""

ORACLES["list_features"] = _s("samples") + FEAT_CTE + """
SELECT sample_id, n_imported_dlls, n_imported_symbols, identify_is_packed, identify_signature_count,
       imports_dangerous_api, dll_count_anomaly FROM eng"""

ORACLES["timestamp_features"] = _s("samples") + FEAT_CTE + \
    "SELECT sample_id, formatted_timedatestamp_year, time_alignment_anomaly FROM eng"

ORACLES["engineered_features"] = _s("samples") + FEAT_CTE + """
SELECT sample_id, label, n_imported_dlls, n_imported_symbols, identify_is_packed, identify_signature_count,
       formatted_timedatestamp_year, imports_dangerous_api, time_alignment_anomaly, dll_count_anomaly FROM eng"""

RAW_STRINGS = """
WITH raw AS (
  SELECT o_orderkey AS sample_id, CAST(o_totalprice AS VARCHAR) AS price_text,
         o_orderpriority AS priority_text, substr(o_orderpriority, 1, 1) AS priority_digit,
         o_orderstatus AS status_text
  FROM orders)
"""

ORACLES["numeric_coercion"] = RAW_STRINGS + """
SELECT sample_id, TRY_CAST(price_text AS DOUBLE) AS price_text, TRY_CAST(priority_text AS DOUBLE) AS priority_text,
       TRY_CAST(priority_digit AS DOUBLE) AS priority_digit, TRY_CAST(status_text AS DOUBLE) AS status_text
FROM raw"""

ORACLES["coercion_loss"] = RAW_STRINGS + """,
lost AS (
  SELECT count(*) FILTER (WHERE price_text IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NULL) AS price_text,
         count(*) FILTER (WHERE priority_text IS NOT NULL AND TRY_CAST(priority_text AS DOUBLE) IS NULL) AS priority_text,
         count(*) FILTER (WHERE priority_digit IS NOT NULL AND TRY_CAST(priority_digit AS DOUBLE) IS NULL) AS priority_digit,
         count(*) FILTER (WHERE status_text IS NOT NULL AND TRY_CAST(status_text AS DOUBLE) IS NULL) AS status_text
  FROM raw)
SELECT "column", n_lost FROM (UNPIVOT lost ON price_text, priority_text, priority_digit, status_text
                              INTO NAME "column" VALUE n_lost) WHERE n_lost > 0"""

# --- profiling ------------------------------------------------------------------
DAILY = """
WITH counts AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)),
                                              INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem),
daily AS (SELECT s.day, coalesce(c.n, 0) AS n FROM spine s LEFT JOIN counts c USING (day))
"""

ORACLES["class_balance_by_day"] = _s("samples") + """
SELECT order_date AS day, count(*) FILTER (WHERE label = 0) AS n_neg, count(*) FILTER (WHERE label = 1) AS n_pos
FROM samples GROUP BY order_date"""

ORACLES["daily_counts"] = DAILY + "SELECT day, n FROM daily"

ORACLES["monthly_rollup"] = DAILY + """
SELECT strftime(day, '%Y-%m') AS month, CAST(sum(n) AS BIGINT) AS total, round(avg(n), 6) AS mean_per_day,
       max(n) AS max_per_day, count(*) AS days
FROM daily GROUP BY 1"""

ORACLES["empty_periods"] = DAILY + """
SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS days, count(*) FILTER (WHERE n = 0) AS empty_days,
       CAST(sum(n) AS BIGINT) AS total, round_even(100.0 * count(*) FILTER (WHERE n = 0) / count(*), 1) AS pct_empty
FROM daily GROUP BY 1
UNION ALL
SELECT NULL, count(*), count(*) FILTER (WHERE n = 0), CAST(sum(n) AS BIGINT),
       round_even(100.0 * count(*) FILTER (WHERE n = 0) / count(*), 1)
FROM daily"""

ORACLES["timestamp_profile"] = _s("samples") + """
SELECT count(*) AS n_rows, count(try_strptime(formatted_ts, '%Y-%m-%d %H:%M:%S')) AS n_valid,
       min(try_strptime(formatted_ts, '%Y-%m-%d %H:%M:%S')) AS min_ts,
       max(try_strptime(formatted_ts, '%Y-%m-%d %H:%M:%S')) AS max_ts
FROM samples"""

NUMERIC = ["total_price", "cust_key", "n_lines", "sum_qty", "max_discount", "max_tax", "max_price", "entropy"]

ORACLES["numeric_describe"] = _s("samples") + f""",
long AS (SELECT * FROM (SELECT {', '.join(NUMERIC)} FROM samples)
         UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUMERIC)})))
SELECT feature, count(value) AS count, count(*) FILTER (WHERE value IS NULL) AS null_count,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(100.0 * count(*) FILTER (WHERE value IS NULL) / count(*), 6) AS null_pct,
       round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95
FROM long GROUP BY feature"""

PROFILE_TYPES = {"sample_id": "bigint", "label": "int", "sample_date": "date", "total_price": "double",
                 "n_lines": "double", "max_discount": "double", "imported_dlls": "string",
                 "imported_symbols": "string", "identify": "string", "formatted_ts": "string"}

ORACLES["null_report"] = _s("samples") + f""",
long AS (SELECT * FROM (SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in PROFILE_TYPES)} FROM samples)
         UNPIVOT INCLUDE NULLS (v FOR "column" IN ({', '.join(PROFILE_TYPES)}))),
types AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{t}')" for c, t in PROFILE_TYPES.items())}) t("column", dtype))
SELECT "column", dtype, count(*) FILTER (WHERE v IS NULL) AS null_count,
       round(100.0 * count(*) FILTER (WHERE v IS NULL) / count(*), 6) AS null_pct,
       count(DISTINCT v) AS n_distinct
FROM long JOIN types USING ("column") GROUP BY "column", dtype"""

ORACLES["string_cardinality"] = _s("samples") + """,
long AS (UNPIVOT (SELECT imported_dlls, imported_symbols, identify, formatted_ts FROM samples)
         ON imported_dlls, imported_symbols, identify, formatted_ts INTO NAME "column" VALUE v)
SELECT "column", count(*) AS non_null, count(DISTINCT v) AS n_distinct, CAST(max(length(v)) AS INTEGER) AS max_len,
       CAST(trunc(quantile_cont(length(v), 0.5)) AS INTEGER) AS median_len
FROM long GROUP BY "column\""""

ORACLES["near_zero_variance"] = _s("samples") + FEAT_CTE + f""",
j AS (SELECT s.*, e.dll_count_anomaly, e.identify_is_packed FROM samples s JOIN eng e USING (sample_id)),
long AS (SELECT * FROM (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC + ['dll_count_anomaly', 'identify_is_packed'])} FROM j)
         UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUMERIC + ['dll_count_anomaly', 'identify_is_packed'])})))
SELECT feature, min(value) IS NOT DISTINCT FROM max(value) AS near_zero_variance, round(avg(value), 6) AS mean
FROM long GROUP BY feature"""

# --- preprocessing ----------------------------------------------------------
LOG_COLS = ["total_price", "sum_qty", "max_price", "n_imported_dlls", "n_imported_symbols", "identify_signature_count"]
SCALE_COLS = ["cust_key", "n_lines", "max_discount", "max_tax", "entropy", "identify_is_packed",
              "formatted_timedatestamp_year", "imports_dangerous_api", "time_alignment_anomaly", "dll_count_anomaly"]
_ALL = LOG_COLS + SCALE_COLS
_LOGSET = ", ".join(f"'{c}'" for c in LOG_COLS)

PREP_CTES = SPLIT_CTES + FEAT_CTE + f""",
prep AS (
  SELECT t.sample_id, t.split, {', '.join(f'CAST({("e." if c in ("n_imported_dlls", "n_imported_symbols", "identify_signature_count", "identify_is_packed", "formatted_timedatestamp_year", "imports_dangerous_api", "time_alignment_anomaly", "dll_count_anomaly") else "t.") + c} AS DOUBLE) AS {c}' for c in _ALL)}
  FROM tsplit t JOIN eng e USING (sample_id)),
plong AS (SELECT * FROM prep UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(_ALL)}))),
med AS (SELECT feature, quantile_cont(value, 0.5) AS median FROM plong WHERE split = 'train' GROUP BY feature),
imp AS (
  SELECT p.sample_id, p.split, p.feature, m.median,
         CASE WHEN p.feature IN ({_LOGSET})
              THEN ln(1 + CASE WHEN coalesce(p.value, m.median) >= 0 THEN coalesce(p.value, m.median) ELSE 0 END)
              ELSE coalesce(p.value, m.median) END AS t
  FROM plong p JOIN med m USING (feature)),
st AS (SELECT feature, any_value(median) AS median, avg(t) AS mean, stddev_pop(t) AS std
       FROM imp WHERE split = 'train' GROUP BY feature),
scaled AS (
  SELECT i.sample_id, i.split, i.feature,
         (i.t - st.mean) / CASE WHEN st.std = 0 THEN 1 ELSE st.std END AS value
  FROM imp i JOIN st USING (feature))
"""

ORACLES["median_impute"] = _s("samples") + PREP_CTES + "SELECT feature, round(median, 6) AS median FROM st"
ORACLES["scaler_stats"] = _s("samples") + PREP_CTES + \
    "SELECT feature, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM st"
ORACLES["log_scale_transform"] = _s("samples") + PREP_CTES + \
    "SELECT sample_id, feature, round(value, 6) AS value FROM scaled WHERE split = 'test'"
ORACLES["leakage_profile"] = _s("samples") + PREP_CTES + """
SELECT split, feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS n_bad
FROM scaled GROUP BY split, feature"""

# --- drift, metrics, decisions --------------------------------------------------------


def PF(model: str, sid: str = "sample_id", label: str = "label") -> str:
    """The fixture's pseudo-probability of ``model`` for a row."""
    return (f"(CAST(floor((('0x' || substr(md5('m42:' || CAST({model} AS VARCHAR) || ':' || CAST({sid} AS VARCHAR)), 1, 8))::UBIGINT"
            f" / 4294967295.0) * 60) + 40 * {label} AS DOUBLE) / 100.0)")


def ACC(pred: str, label: str = "label") -> str:
    return f"avg(CASE WHEN CAST({pred} AS INTEGER) = {label} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


META_CTES = SPLIT_CTES + WINDOW_CTES + f""",
cp AS (
  SELECT sample_id, window_id, label,
         row_number() OVER (PARTITION BY window_id ORDER BY sample_date DESC, {H}) - 1 AS r,
         greatest(round_even(count(*) OVER (PARTITION BY window_id) * 0.15, 0), 1) AS ncal
  FROM windowed WHERE label = 1),
cn AS (
  SELECT sample_id, window_id, label,
         row_number() OVER (PARTITION BY window_id ORDER BY {H}, sample_id) - 1 AS r,
         round_even(count(*) OVER (PARTITION BY window_id) * 0.15, 0) AS ncal
  FROM windowed WHERE label <> 1),
cal AS (SELECT sample_id, window_id, label FROM cp WHERE r < ncal
        UNION ALL SELECT sample_id, window_id, label FROM cn WHERE r < ncal),
inacc AS (SELECT window_id, {ACC(PF('window_id') + ' >= 0.5')} AS in_acc FROM cal GROUP BY window_id),
recent AS (SELECT CAST(m AS INTEGER) AS window_id, {ACC(PF('m') + ' >= 0.5')} AS recent_acc
           FROM tsplit, range(5) r(m) WHERE split = 'test' GROUP BY m),
sizes AS (SELECT window_id, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos,
                 count(*) FILTER (WHERE label <> 1) AS n_neg, max(sample_date) AS max_date
          FROM windowed GROUP BY window_id),
meta0 AS (
  SELECT w.window_id, coalesce(n_rows, 0) AS n_rows, coalesce(n_pos, 0) AS n_pos, coalesce(n_neg, 0) AS n_neg,
         (coalesce(n_pos, 0) > 0 AND coalesce(n_neg, 0) > 0) AS active, in_acc AS in_acc0,
         coalesce(recent_acc, 0.0) AS recent_acc, max_date
  FROM (SELECT CAST(range AS INTEGER) AS window_id FROM range(5)) w
  LEFT JOIN sizes USING (window_id) LEFT JOIN inacc USING (window_id) LEFT JOIN recent USING (window_id)),
meta AS (SELECT * EXCLUDE (in_acc0), CASE WHEN active THEN coalesce(in_acc0, 0.0) ELSE 0.0 END AS in_acc FROM meta0),
wt AS (
  SELECT *, exp(-1.0 * (5 - 1 - window_id) / 4.0) AS rec,
         exp(-2.0 * least(greatest(greatest(0.0, in_acc - recent_acc)
                                   / CASE WHEN in_acc > 1e-9 THEN in_acc ELSE 1.0 END, 0.0), 1.0)) AS pen
  FROM meta),
wr AS (SELECT *, rec * in_acc * pen AS raw, sum(rec * in_acc * pen) OVER () AS s FROM wt),
w1 AS (SELECT *, CASE WHEN s <= 0 THEN 1.0 / 5 ELSE raw / s END AS w0 FROM wr),
w2 AS (SELECT *, CASE WHEN active THEN w0 ELSE 0.0 END AS wa FROM w1),
weights AS (SELECT window_id, active, wa / greatest(sum(wa) OVER (), 1e-12) AS weight FROM w2)
"""

DEC_CTES = META_CTES + """,
dec AS (
  SELECT sc.sample_id, any_value(sc.label) AS label, sum(w.weight * sc.p) AS probability,
         least(greatest(2 * stddev_pop(sc.p) FILTER (WHERE w.active), 0), 1) AS disagreement
  FROM scores sc JOIN weights w ON sc.model_id = w.window_id GROUP BY sc.sample_id),
dec2 AS (SELECT *, least(greatest(2 * abs(probability - 0.5) - disagreement, 0), 1) AS confidence FROM dec),
decided AS (SELECT *, CASE WHEN confidence < 0.65 THEN 'BLOCKED_UNCERTAIN' WHEN probability >= 0.5 THEN 'BLOCKED_MALWARE'
                           ELSE 'ALLOWED' END AS verdict FROM dec2)
"""

DRIFT_CTES = """,
dl AS (SELECT * FROM (SELECT side, value, user_id, prop_k, hour FROM drift)
       UNPIVOT INCLUDE NULLS (value FOR feature IN (value, user_id, prop_k, hour))),
dlf AS (SELECT * FROM dl WHERE value IS NOT NULL AND isfinite(value)),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
          FROM dlf WHERE side = 'train' GROUP BY feature),
bk AS (SELECT d.feature, d.side,
              CASE WHEN d.value < e[1] OR d.value > e[len(e)] THEN NULL
                   WHEN len(list_filter(e, lambda x: x <= d.value)) - 1 >= len(e) - 1 THEN len(e) - 2
                   ELSE len(list_filter(e, lambda x: x <= d.value)) - 1 END AS bucket
       FROM dlf d JOIN edges USING (feature)),
cnt AS (SELECT feature, bucket, count(*) FILTER (WHERE side = 'train') AS tc, count(*) FILTER (WHERE side = 'deploy') AS dc
        FROM bk WHERE bucket IS NOT NULL GROUP BY feature, bucket),
spine AS (SELECT feature, unnest(generate_series(0, len(e) - 2)) AS bucket FROM edges WHERE len(e) >= 2),
sp AS (SELECT s.feature, s.bucket, coalesce(c.tc, 0) AS tc, coalesce(c.dc, 0) AS dc FROM spine s LEFT JOIN cnt c USING (feature, bucket)),
pct AS (SELECT feature, tc / greatest(sum(tc) OVER (PARTITION BY feature), 1) + 1e-6 AS tp,
               dc / greatest(sum(dc) OVER (PARTITION BY feature), 1) + 1e-6 AS dp FROM sp),
per AS (SELECT feature, sum((dp - tp) * ln(dp / tp)) AS psi FROM pct GROUP BY feature),
ns AS (SELECT feature, count(*) FILTER (WHERE side = 'train') AS n_train, count(*) FILTER (WHERE side = 'deploy') AS n_deploy
       FROM dlf GROUP BY feature),
feats AS (SELECT * FROM (VALUES ('value'), ('user_id'), ('prop_k'), ('hour')) t(feature)),
psi AS (SELECT f.feature, CASE WHEN coalesce(n_train, 0) = 0 OR coalesce(n_deploy, 0) = 0 THEN 0.0
                               ELSE coalesce(psi, 0.0) END AS psi,
               coalesce(n_train, 0) AS n_train, coalesce(n_deploy, 0) AS n_deploy
        FROM feats f LEFT JOIN ns USING (feature) LEFT JOIN per USING (feature))
"""

ORACLES["psi_per_feature"] = _s("drift") + DRIFT_CTES + \
    "SELECT feature, round(psi, 6) AS psi, n_train, n_deploy FROM psi"
ORACLES["psi_average"] = _s("drift") + DRIFT_CTES + \
    "SELECT round(coalesce(avg(psi), 0.0), 6) AS avg_psi, count(*) AS n_features FROM psi"
ORACLES["psi_band"] = _s("drift") + DRIFT_CTES + """
SELECT feature, CASE WHEN psi < 0.1 THEN 'none' WHEN psi <= 0.25 THEN 'moderate' ELSE 'large' END AS band FROM psi"""

ORACLES["window_metrics"] = _s("samples") + META_CTES + """
SELECT window_id, n_rows, n_pos, n_neg, active, round(in_acc, 6) AS in_acc, round(recent_acc, 6) AS recent_acc, max_date
FROM meta"""
ORACLES["accuracy_decay"] = _s("samples") + META_CTES + """
SELECT window_id, round(least(greatest(greatest(0.0, in_acc - recent_acc)
                          / CASE WHEN in_acc > 1e-9 THEN in_acc ELSE 1.0 END, 0.0), 1.0), 6) AS decay FROM meta"""
ORACLES["vote_weights"] = _s("samples") + META_CTES + "SELECT window_id, round(weight, 6) AS weight FROM weights"
ORACLES["drift_status"] = _s("samples") + META_CTES + """
SELECT round(max_by(in_acc, window_id), 6) AS newest_acc, round(min_by(in_acc, window_id), 6) AS oldest_acc,
       round(max_by(in_acc, window_id) - min_by(in_acc, window_id), 6) AS trend,
       CASE WHEN max_by(in_acc, window_id) - min_by(in_acc, window_id) < -0.02 THEN 'down'
            WHEN max_by(in_acc, window_id) - min_by(in_acc, window_id) > 0.02 THEN 'up' ELSE 'flat' END AS trend_class,
       string_agg(printf('%.3f', round_even(in_acc, 3)), ' ' ORDER BY window_id) AS per_window,
       count(*) AS n_active
FROM meta WHERE active"""
ORACLES["retrain_alert"] = _s("samples") + META_CTES + """,
ra AS (SELECT window_id, in_acc,
              avg(in_acc) OVER (ORDER BY window_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean_older,
              lag(in_acc) OVER (ORDER BY window_id) AS prev_acc
       FROM meta WHERE active)
SELECT round(in_acc, 6) AS newest_acc, round(mean_older, 6) AS mean_older, round(prev_acc, 6) AS prev_acc,
       in_acc < mean_older - 0.05 AS retrain, (prev_acc - in_acc) >= 0.05 AS sharp_drop
FROM ra ORDER BY window_id DESC LIMIT 1"""

ORACLES["disagreement"] = _s("scores") + """
SELECT sample_id, round(least(greatest(2 * stddev_pop(p), 0), 1), 6) AS disagreement FROM scores GROUP BY sample_id"""
ORACLES["weighted_vote"] = _s("scores") + DEC_CTES + "SELECT sample_id, round(probability, 6) AS probability FROM decided"
ORACLES["joint_confidence"] = _s("scores") + DEC_CTES + "SELECT sample_id, round(confidence, 6) AS confidence FROM decided"
ORACLES["verdicts"] = _s("scores") + DEC_CTES + """
SELECT sample_id, verdict, verdict <> 'ALLOWED' AS is_positive_decision,
       round_even(probability, 4) AS probability, round_even(confidence, 4) AS confidence FROM decided"""
ORACLES["verdict_counts"] = _s("scores") + DEC_CTES + """
SELECT count(*) FILTER (WHERE verdict = 'ALLOWED') AS n_allowed,
       count(*) FILTER (WHERE verdict = 'BLOCKED_MALWARE') AS n_blocked_malware,
       count(*) FILTER (WHERE verdict = 'BLOCKED_UNCERTAIN') AS n_blocked_uncertain FROM decided"""
ORACLES["threshold_sweep"] = _s("scores") + DEC_CTES + """
SELECT t AS threshold, count(*) FILTER (WHERE confidence < t OR probability >= 0.5) AS n_blocked,
       count(*) FILTER (WHERE confidence < t) AS n_uncertain,
       round(avg(CASE WHEN CAST((confidence < t OR probability >= 0.5) AS INTEGER) = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
         AS blocking_accuracy
FROM decided, (VALUES (0.55::DOUBLE), (0.65::DOUBLE), (0.75::DOUBLE)) th(t) GROUP BY t"""
ORACLES["confusion_matrix"] = _s("scores") + DEC_CTES + """,
cm AS (SELECT label, CAST(verdict <> 'ALLOWED' AS INTEGER) AS decision, count(*) AS n FROM decided GROUP BY ALL)
SELECT l.label, l.decision, coalesce(cm.n, 0) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) l(label, decision) LEFT JOIN cm USING (label, decision)"""

ORACLES["accuracy_by_model"] = _s("scores") + f"""
SELECT CAST(model_id AS INTEGER) AS model_id, round({ACC('p >= 0.5')}, 6) AS accuracy FROM scores GROUP BY model_id"""


def AUC_SQL(src: str, keys: str) -> str:
    return f"""
g_{src} AS (SELECT {keys}, p, count(*) FILTER (WHERE label = 1) AS np, count(*) FILTER (WHERE label <> 1) AS nn
            FROM {src} GROUP BY {keys}, p),
c_{src} AS (SELECT *, coalesce(sum(nn) OVER (PARTITION BY {keys} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
            FROM g_{src}),
auc_{src} AS (SELECT {keys}, CASE WHEN sum(np) > 0 AND sum(nn) > 0 THEN sum(np * (below + 0.5 * nn)) / (sum(np) * sum(nn)) END AS auc,
                     CAST(sum(np) AS BIGINT) AS n_pos, CAST(sum(nn) AS BIGINT) AS n_neg
              FROM c_{src} GROUP BY {keys})"""


ORACLES["roc_auc_by_model"] = _s("scores") + "," + AUC_SQL("scores", "model_id") + """
SELECT CAST(model_id AS INTEGER) AS model_id, round(auc, 6) AS auc, n_pos, n_neg FROM auc_scores"""

RECORD_CTES = SPLIT_CTES + f""",
rsplit AS (SELECT sample_id, label,
                  CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {H}, sample_id) - 1
                            < ceil(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split
           FROM samples),
sides AS (SELECT sample_id, label, split, 'random' AS protocol FROM rsplit
          UNION ALL SELECT sample_id, label, split, 'temporal' FROM tsplit),
trf AS (SELECT *, CAST((row_number() OVER (PARTITION BY protocol, label ORDER BY {H}, sample_id) - 1) % 10 AS INTEGER) AS fold
        FROM sides WHERE split = 'train'),
mids AS (SELECT CAST(range AS INTEGER) AS model_id FROM range(5)),
trm AS (SELECT trf.*, mids.model_id, {PF('mids.model_id', 'trf.sample_id', 'trf.label')} AS p FROM trf, mids),
tem AS (SELECT sides.*, mids.model_id, {PF('mids.model_id', 'sides.sample_id', 'sides.label')} AS p
        FROM sides, mids WHERE split = 'test'),
{AUC_SQL("trm", "model_id, protocol, fold")},
{AUC_SQL("tem", "model_id, protocol")},
names AS (SELECT CAST(range AS INTEGER) AS model_id, 'score_' || range AS model_name FROM range(5)),
ntr AS (SELECT protocol, count(*) AS nt FROM sides WHERE split = 'train' GROUP BY protocol),
cvacc AS (SELECT model_id, protocol, fold, {ACC('p >= 0.5')} AS accuracy, count(*) AS n_val FROM trm GROUP BY ALL),
cv AS (SELECT model_name, protocol, fold, auc, accuracy, nt - n_val AS n_train, n_val, 0.0::DOUBLE AS fit_seconds
       FROM auc_trm JOIN cvacc USING (model_id, protocol, fold) JOIN names USING (model_id) JOIN ntr USING (protocol)),
hoacc AS (SELECT model_id, protocol, {ACC('p >= 0.5')} AS accuracy, count(*) AS n_test FROM tem GROUP BY ALL),
ho AS (SELECT model_name, protocol, auc, accuracy, nt AS n_train, n_test, 0.0::DOUBLE AS fit_seconds
       FROM auc_tem JOIN hoacc USING (model_id, protocol) JOIN names USING (model_id) JOIN ntr USING (protocol))
"""

ORACLES["cv_summary"] = _s("samples") + RECORD_CTES + """
SELECT model_name, protocol, round_even(avg(auc), 4) AS auc_mean, round_even(stddev_samp(auc), 4) AS auc_std,
       round_even(avg(accuracy), 4) AS acc_mean, round_even(stddev_samp(accuracy), 4) AS acc_std,
       round_even(avg(fit_seconds), 4) AS fit_seconds_mean
FROM cv GROUP BY model_name, protocol"""
ORACLES["holdout_summary"] = _s("samples") + RECORD_CTES + """
SELECT model_name, protocol, round_even(auc, 4) AS auc, round_even(accuracy, 4) AS accuracy, n_train, n_test,
       round_even(fit_seconds, 4) AS fit_seconds FROM ho"""
ORACLES["drift_gap_table"] = _s("samples") + RECORD_CTES + """,
cs AS (SELECT model_name, avg(auc) FILTER (WHERE protocol = 'random') AS rm, stddev_samp(auc) FILTER (WHERE protocol = 'random') AS rs,
              avg(auc) FILTER (WHERE protocol = 'temporal') AS tm, stddev_samp(auc) FILTER (WHERE protocol = 'temporal') AS ts
       FROM cv GROUP BY model_name),
hs AS (SELECT model_name, any_value(auc) FILTER (WHERE protocol = 'random') AS ra, any_value(auc) FILTER (WHERE protocol = 'temporal') AS ta,
              any_value(accuracy) FILTER (WHERE protocol = 'random') AS rc, any_value(accuracy) FILTER (WHERE protocol = 'temporal') AS tc
       FROM ho GROUP BY model_name),
ordt AS (SELECT model_name, model_id AS ord FROM names)
SELECT model_name, round_even(rm, 4) AS random_cv_auc, round_even(rs, 4) AS random_cv_std,
       round_even(tm, 4) AS temporal_cv_auc, round_even(ts, 4) AS temporal_cv_std, round_even(rm - tm, 4) AS drift_gap_cv_auc,
       round_even(ra, 4) AS random_holdout_auc, round_even(ta, 4) AS temporal_holdout_auc,
       round_even(ra - ta, 4) AS drift_gap_holdout_auc, round_even(rc, 4) AS random_holdout_acc,
       round_even(tc, 4) AS temporal_holdout_acc, round_even(rc - tc, 4) AS drift_gap_holdout_acc, ord
FROM cs LEFT JOIN hs USING (model_name) JOIN ordt USING (model_name)"""

# --- explanations ---------------------------------------------------------------
from tidemark.operators import explain as XT  # noqa: E402  (fixed wording only)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fill(template: str, **exprs: str) -> str:
    out, rest = [], template
    while "{" in rest:
        i = rest.index("{")
        j = rest.index("}", i)
        out += [q(rest[:i]), exprs[rest[i + 1:j]]]
        rest = rest[j + 1:]
    out.append(q(rest))
    return "(" + " || ".join(out) + ")"


def _al(a: str, b: str) -> str:
    return f"CASE WHEN verdict = 'ALLOWED' THEN {a} ELSE {b} END"


_E2 = "printf('%.2f', coalesce(entropy, 0.0))"
_NS = "CAST(coalesce(sections, 0.0) AS VARCHAR)"
_ND = "CAST(ndll AS VARCHAR)"
_P2, _C2 = "printf('%.2f', probability)", "printf('%.2f', confidence)"

EXPLAIN_CTES = DEC_CTES + FEAT_CTE + f""",
ex AS (
  SELECT d.sample_id, d.verdict, d.probability, d.confidence, s.identify, s.entropy, s.n_lines AS sections,
         e.identify_is_packed AS packed, e.imports_dangerous_api AS danger, e.dll_count_anomaly AS dllan,
         e.n_imported_dlls AS ndll, e.time_alignment_anomaly AS tan
  FROM decided d JOIN samples s USING (sample_id) JOIN eng e USING (sample_id)),
ev AS (
  SELECT *, list_filter([
    CASE WHEN packed = 1 THEN {_al(sql_fill(XT.TXT_PACKED_ALLOWED, identify="coalesce(identify, 'None')"), q(XT.TXT_PACKED_BLOCKED))}
         WHEN coalesce(entropy, 0.0) >= 7.5 THEN {_al(sql_fill(XT.TXT_ENTROPY_ALLOWED, entropy=_E2), sql_fill(XT.TXT_ENTROPY_BLOCKED, entropy=_E2))} END,
    CASE WHEN danger = 1 THEN {_al(q(XT.TXT_API_ALLOWED), q(XT.TXT_API_BLOCKED))} END,
    CASE WHEN dllan = 1 THEN CASE WHEN ndll = 0 THEN {_al(q(XT.TXT_ZERO_DLL_ALLOWED), q(XT.TXT_ZERO_DLL_BLOCKED))}
                                  ELSE {_al(sql_fill(XT.TXT_MANY_DLL_ALLOWED, n_dlls=_ND), sql_fill(XT.TXT_MANY_DLL_BLOCKED, n_dlls=_ND))} END END,
    CASE WHEN tan = 1 THEN {_al(q(XT.TXT_TIME_ALLOWED), q(XT.TXT_TIME_BLOCKED))} END,
    CASE WHEN coalesce(sections, 0.0) >= 10 THEN {_al(sql_fill(XT.TXT_SECTIONS_ALLOWED, sections=_NS), sql_fill(XT.TXT_SECTIONS_BLOCKED, sections=_NS))} END
  ], lambda x: x IS NOT NULL) AS fired FROM ex),
ev2 AS (
  SELECT *, CASE WHEN len(fired) > 0 THEN fired
    WHEN verdict = 'ALLOWED' THEN [
      'Positive evidence: ' || array_to_string(list_filter([
         CASE WHEN coalesce(entropy, 0.0) > 0 AND coalesce(entropy, 0.0) < 7.0 THEN {sql_fill(XT.TXT_POS_ENTROPY, entropy=_E2)} END,
         CASE WHEN ndll BETWEEN 1 AND 50 THEN {sql_fill(XT.TXT_POS_DLLS, n_dlls=_ND, plural="CASE WHEN ndll <> 1 THEN 's' ELSE '' END")} END,
         {q(XT.TXT_POS_CLEAN)}], lambda x: x IS NOT NULL), '; ') || '.',
      {sql_fill(XT.TXT_DRIVEN, p=_P2, c=_C2)}]
    ELSE [{sql_fill(XT.TXT_NO_DOMINANT, p=_P2, c=_C2)}] END AS why
  FROM ev),
tech AS (
  SELECT sample_id, CASE WHEN verdict = 'ALLOWED' THEN [] ELSE list_distinct_ordered END AS techs FROM (
    SELECT sample_id, verdict, list_concat(
      CASE WHEN danger = 1 THEN ['T1055:Process Injection', 'T1106:Native API'] ELSE [] END,
      CASE WHEN packed = 1 THEN ['T1027.002:Software Packing', 'T1027:Obfuscated Files or Information'] ELSE [] END,
      CASE WHEN coalesce(entropy, 0.0) >= 7.5 THEN ['T1027:Obfuscated Files or Information', 'T1140:Deobfuscate/Decode Files or Information'] ELSE [] END,
      CASE WHEN tan = 1 THEN ['T1070.006:Timestomp'] ELSE [] END,
      CASE WHEN dllan = 1 THEN ['T1129:Shared Modules (anomalous import surface)'] ELSE [] END) AS raw_t
    FROM ex) x,
  LATERAL (SELECT list(t ORDER BY i) AS list_distinct_ordered FROM (
      SELECT t, min(i) AS i FROM (SELECT unnest(raw_t) AS t, unnest(range(1, len(raw_t) + 1)) AS i) GROUP BY t)))
"""

ORACLES["evidence_bullets"] = _s("scores") + EXPLAIN_CTES + """
SELECT sample_id, verdict, CAST(len(why) AS INTEGER) AS n_why, array_to_string(why, ' || ') AS why FROM ev2"""

ORACLES["matched_techniques"] = _s("scores") + EXPLAIN_CTES + """
SELECT e.sample_id, e.verdict, CAST(len(coalesce(t.techs, [])) AS INTEGER) AS n_techniques,
       array_to_string(coalesce(t.techs, []), '|') AS techniques
FROM ex e LEFT JOIN tech t USING (sample_id)"""

ORACLES["recommended_actions"] = _s("scores") + EXPLAIN_CTES + f"""
SELECT sample_id, verdict,
       CASE verdict WHEN 'BLOCKED_MALWARE' THEN 5 WHEN 'BLOCKED_UNCERTAIN' THEN 4 ELSE 2 END AS n_actions,
       CASE verdict WHEN 'BLOCKED_MALWARE' THEN {q(' || '.join(XT.ACTIONS['BLOCKED_MALWARE']))}
                    WHEN 'BLOCKED_UNCERTAIN' THEN {q(' || '.join(XT.ACTIONS['BLOCKED_UNCERTAIN']))}
                    ELSE {q(' || '.join(XT.ACTIONS['ALLOWED']))} END AS actions
FROM ex"""

_PC = lambda x: f"printf('%.0f%%', ({x}) * 100)"
ORACLES["explanation_report"] = _s("scores") + EXPLAIN_CTES + f"""
SELECT sample_id, verdict,
  CASE verdict
    WHEN 'BLOCKED_MALWARE' THEN {sql_fill(XT.SUMMARY_BLOCKED, system="'The ensemble'", p0=_PC('probability'), c0=_PC('confidence'))}
    WHEN 'BLOCKED_UNCERTAIN' THEN {sql_fill(XT.SUMMARY_UNCERTAIN, system="'The ensemble'", p0=_PC('probability'), c0=_PC('confidence'), t0=_PC('0.65'))}
    ELSE {sql_fill(XT.SUMMARY_ALLOWED, system="'The ensemble'", g0=_PC('1 - probability'), p2="printf('%.2f%%', probability * 100)", c0=_PC('confidence'))}
  END AS summary,
  'template' AS backend
FROM ex"""

# --- scans ---------------------------------------------------------------------------
ORACLES["dated_csv_scan"] = """
SELECT o_orderkey AS sample_id, o_totalprice AS size, CAST(o_orderdate AS DATE) AS sample_date, 1 AS label
FROM orders WHERE o_orderstatus = 'F'"""
ORACLES["combined_load"] = """
SELECT o_orderkey AS sample_id, o_totalprice AS "Size", TRY_CAST(o_orderpriority AS DOUBLE) AS "Identify",
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS sample_date
FROM orders"""
ORACLES["per_file_counts"] = """
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"""


# --- streaming: all 30-day event-time windows of the input
ORACLES["stream_accuracy"] = f"""
WITH o AS (SELECT o_orderkey AS sample_id, o_orderdate AS ts, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
           FROM orders),
m AS (SELECT o.*, CAST(r.model_id AS INTEGER) AS model_id, {PF('r.model_id', 'o.sample_id', 'o.label')} AS p
      FROM o, (SELECT range AS model_id FROM range(5)) r),
b AS (SELECT time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS window_start, * FROM m)
SELECT window_start, model_id, round({ACC('p >= 0.5')}, 6) AS accuracy, count(*) AS n
FROM b
GROUP BY window_start, model_id"""

ORACLES["stream_psi"] = _s("drift") + DRIFT_CTES + """,
ev AS (SELECT ts, CAST(value AS DOUBLE) AS value, CAST(user_id AS DOUBLE) AS user_id,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS prop_k, CAST(hour(ts) AS DOUBLE) AS hour FROM events),
evl AS (SELECT * FROM ev UNPIVOT INCLUDE NULLS (value FOR feature IN (value, user_id, prop_k, hour))),
evb AS (SELECT time_bucket(INTERVAL '1 day', e.ts, TIMESTAMP '1970-01-01') AS window_start, e.feature,
               CASE WHEN e.value < g.e[1] OR e.value > g.e[len(g.e)] THEN NULL
                    WHEN len(list_filter(g.e, lambda x: x <= e.value)) - 1 >= len(g.e) - 1 THEN len(g.e) - 2
                    ELSE len(list_filter(g.e, lambda x: x <= e.value)) - 1 END AS bucket
        FROM evl e JOIN edges g USING (feature) WHERE e.value IS NOT NULL AND len(g.e) >= 2),
dcn AS (SELECT window_start, feature, bucket, count(*) AS dc FROM evb
        WHERE bucket IS NOT NULL GROUP BY ALL),
wins AS (SELECT DISTINCT window_start, feature FROM dcn),
trc AS (SELECT sp.feature, sp.bucket, coalesce(c.tc, 0) AS tc FROM spine sp
        LEFT JOIN (SELECT feature, bucket, count(*) FILTER (WHERE side = 'train') AS tc FROM bk
                   WHERE bucket IS NOT NULL GROUP BY ALL) c USING (feature, bucket)),
j AS (SELECT w.window_start, w.feature, t.bucket, t.tc, coalesce(d.dc, 0) AS dc
      FROM wins w JOIN trc t USING (feature) LEFT JOIN dcn d USING (window_start, feature, bucket)),
pc AS (SELECT *, tc / greatest(sum(tc) OVER (PARTITION BY window_start, feature), 1) + 1e-6 AS tp,
              dc / greatest(sum(dc) OVER (PARTITION BY window_start, feature), 1) + 1e-6 AS dp FROM j)
SELECT window_start, feature, round(sum((dp - tp) * ln(dp / tp)), 6) AS psi, CAST(sum(dc) AS BIGINT) AS n_deploy
FROM pc GROUP BY window_start, feature"""

ORACLES["stream_scoring"] = _s("scores") + EXPLAIN_CTES + f"""
SELECT sample_id, verdict, round_even(probability, 4) AS probability, round_even(confidence, 4) AS confidence,
  CASE verdict
    WHEN 'BLOCKED_MALWARE' THEN {sql_fill(XT.SUMMARY_BLOCKED, system="'The ensemble'", p0=_PC('probability'), c0=_PC('confidence'))}
    WHEN 'BLOCKED_UNCERTAIN' THEN {sql_fill(XT.SUMMARY_UNCERTAIN, system="'The ensemble'", p0=_PC('probability'), c0=_PC('confidence'), t0=_PC('0.65'))}
    ELSE {sql_fill(XT.SUMMARY_ALLOWED, system="'The ensemble'", g0=_PC('1 - probability'), p2="printf('%.2f%%', probability * 100)", c0=_PC('confidence'))}
  END AS summary,
  CAST(len(why) AS INTEGER) AS n_why
FROM ev2"""


ORACLES["date_filtered_scan"] = """
SELECT o_orderkey AS sample_id, o_totalprice AS size, CAST(o_orderdate AS DATE) AS sample_date FROM orders
WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"""

ORACLES["json_backfill"] = """
SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS size,
       CAST(0 AS DOUBLE) AS entropy, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '' END AS name FROM orders"""

ORACLES["results_sink"] = """
SELECT o_orderstatus AS stage, o_orderpriority AS protocol, 'm' AS model_name,
       count(*) + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1000 END AS n FROM orders GROUP BY o_orderstatus, o_orderpriority"""

ORACLES["head_rows"] = "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10"

ORACLES["key_lookup"] = """
SELECT o_orderkey AS sample_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)"""

ORACLES["schema_inventory"] = """
WITH a AS (SELECT column_name AS c FROM (DESCRIBE SELECT * FROM documents)),
b AS (SELECT column_name AS c FROM (DESCRIBE SELECT * FROM benchmark))
SELECT coalesce(a.c, b.c) AS "column", CASE WHEN a.c IS NULL THEN 'right_only' WHEN b.c IS NULL THEN 'left_only' ELSE 'shared' END AS "where"
FROM a FULL JOIN b ON a.c = b.c"""

ORACLES["required_columns"] = """
SELECT o_orderkey AS sample_id, o_totalprice AS total_price, m AS max_discount FROM orders
JOIN (SELECT l_orderkey, abs(max(l_discount)) AS m FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
WHERE m IS NOT NULL AND isfinite(m)"""

ORACLES["precondition_counts"] = """
SELECT count(*) FILTER (o_orderstatus = 'F') AS n_pos, count(*) FILTER (o_orderstatus = 'F' AND o_orderdate IS NULL) AS n_undated FROM orders"""

ORACLES["csv_round_trip"] = """
SELECT o_orderkey AS sample_id, o_totalprice AS size, o_orderpriority AS "Identify", 0 AS label
FROM orders WHERE o_orderstatus <> 'F'"""

ORACLES["isotonic_calibration"] = _s("samples") + f""",
g AS (SELECT {PF('0', 'sample_id', 'label')} AS p, sum(label) AS s, count(*) AS n FROM samples GROUP BY 1),
c AS (SELECT p, sum(s) OVER (ORDER BY p) AS su, sum(n) OVER (ORDER BY p) AS nu, s, n FROM g),
m AS (SELECT i.p, j.p AS pj, min((k.su - j.su + j.s) / (k.nu - j.nu + j.n)) AS least
      FROM c i JOIN c j ON j.p <= i.p JOIN c k ON k.p >= i.p GROUP BY i.p, j.p)
SELECT p, round(max(least), 6) AS calibrated FROM m GROUP BY p"""


def _report() -> str:
    from tidemark.operators.metrics import REPORT_ROWS, report_frame
    title = "### Random vs temporal hold-out, 5 md5 score columns"
    fixed = ", ".join(f"({1000 * s + i}, {q(line)})" for s in range(3) for i, line in enumerate(report_frame(s, None if s else title)))
    row = lambda s, *c: f"printf({q(REPORT_ROWS[s])}, {', '.join(c)}) AS line"
    return f"""
WITH h AS ({ORACLES["drift_gap_table"]}), s AS ({ORACLES["cv_summary"]})
SELECT CAST(n AS INTEGER) AS line_no, line FROM (VALUES {fixed}) f(n, line)
UNION ALL SELECT CAST(100 + ord AS INTEGER), {row(0, "model_name", "random_holdout_auc", "temporal_holdout_auc", "drift_gap_holdout_auc", "random_holdout_acc", "temporal_holdout_acc", "drift_gap_holdout_acc")} FROM h
UNION ALL SELECT CAST(1100 + ord AS INTEGER), {row(1, "model_name", "random_cv_auc", "random_cv_std", "temporal_cv_auc", "temporal_cv_std")} FROM h
UNION ALL SELECT CAST(2100 + row_number() OVER (ORDER BY model_name, protocol) AS INTEGER), {row(2, "model_name", "protocol", "auc_mean", "auc_std", "acc_mean", "acc_std", "fit_seconds_mean")} FROM s"""


ORACLES["evaluation_report"] = _report()

ORACLES["upload_check"] = """
WITH u AS (SELECT o_orderpriority AS upload, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i, count(*) AS n FROM orders GROUP BY 1)
SELECT upload, n, CASE i % 3 WHEN 0 THEN '' WHEN 1 THEN 'the table lacks the columns o_orderkey'
                  ELSE 'the table lacks the columns o_orderkey, o_totalprice' END AS lacks FROM u"""

ORACLES["result_parts"] = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'cv' ELSE 'holdout' END AS stage, CASE WHEN o_orderkey % 2 = 0 THEN 'random' ELSE 'temporal' END AS protocol,
       translate(lower(o_orderpriority), ' -', '') AS model_name, count(*) AS n, round(max(o_totalprice), 2) AS top
FROM orders GROUP BY ALL"""

ORACLES["stream_late_labels"] = f"""
WITH o AS (SELECT o_orderkey AS sample_id, o_orderdate AS ts FROM orders),
label AS (SELECT l_orderkey AS sample_id, l_shipdate AS lts, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem WHERE l_linenumber = 1),
j AS (SELECT o.*, label FROM o LEFT JOIN label l ON l.sample_id = o.sample_id AND lts >= ts AND lts <= ts + INTERVAL 60 DAY),
m AS (SELECT time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS window_start, CAST(r.model_id AS INTEGER) AS model_id, label,
             {PF('r.model_id', 'j.sample_id', '0')} AS p FROM j, (SELECT range AS model_id FROM range(5)) r),
a AS (SELECT window_start, model_id, count(*) AS n, count(label) AS n_labelled, count(*) - count(label) AS n_unlabelled,
             avg(CASE WHEN label IS NOT NULL THEN CAST((p >= 0.3)::INT = label AS INT) END) AS accuracy FROM m GROUP BY ALL),
b AS (SELECT *, lag(accuracy) OVER (PARTITION BY model_id ORDER BY window_start) AS last FROM a)
SELECT window_start, model_id, n, n_labelled, n_unlabelled, round(accuracy, 6) AS accuracy,
       round(CASE WHEN last IS NOT NULL AND accuracy IS NOT NULL THEN CASE WHEN last <= 0 THEN 0.0
             ELSE least(greatest((last - accuracy) / last, 0.0), 1.0) END END, 6) AS decay FROM b"""
