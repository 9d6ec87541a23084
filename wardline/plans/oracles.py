"""DuckDB oracle SQL, one statement per query key.

The driver tables are pre-registered as views (orders, lineitem, part,
customer, events, ...). Each statement re-derives its inputs with the same
fixture expressions as ``wardline.sources.adapters`` and then states the
operator in plain SQL: rules, thresholds and formulas are written out here,
not taken from the operators, so that a wrong one cannot pass on both sides.
Column names and types match the Spark results.
"""

from __future__ import annotations

from ..sources import adapters as A
from . import catalog as C


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(number: str, words: list[str]) -> str:
    """The fixture word that ``number`` selects, counting round."""
    return f"list_extract([{', '.join(map(quoted, words))}], CAST(1 + ({number}) % {len(words)} AS BIGINT))"


def mean2(column: str) -> str:
    """Average of a column with two decimals at most, rounded half up to two: whole hundredths throughout."""
    total = f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) * 100 AS HUGEINT)"
    return f"CAST((2 * {total} + count({column})) // (2 * nullif(count({column}), 0)) AS DOUBLE) / 100"


# fixed values: the surveyed rules, in the order they are evaluated
AGE_BUCKET = """CASE WHEN days_since_published <= 30 THEN 'new' WHEN days_since_published <= 90 THEN 'recent'
              WHEN days_since_published <= 365 THEN 'aging' ELSE 'chronic' END"""
AGE_MULTIPLIER = """CAST(CASE age_bucket WHEN 'new' THEN 1.0 WHEN 'recent' THEN 1.2 WHEN 'aging' THEN 1.5
                    WHEN 'chronic' THEN 2.0 END AS DOUBLE)"""
CATEGORY = """CASE WHEN summary ILIKE '%injection%' OR summary ILIKE '%rce%' OR summary ILIKE '%remote code%' THEN 'code_execution'
                    WHEN summary ILIKE '%privilege%' OR summary ILIKE '%escalation%' THEN 'privilege_escalation'
                    WHEN summary ILIKE '%disclosure%' OR summary ILIKE '%exposure%' OR summary ILIKE '%leak%' THEN 'data_exposure'
                    WHEN summary ILIKE '%bypass%' OR summary ILIKE '%authentication%' THEN 'auth_bypass'
                    WHEN summary ILIKE '%traversal%' OR summary ILIKE '%path%' THEN 'path_traversal'
                    ELSE 'other' END"""
COLUMN_CLASS = """CASE WHEN column_name ILIKE '%email%' THEN 'PII_EMAIL' WHEN column_name ILIKE '%phone%' THEN 'PII_PHONE'
                    WHEN column_name ILIKE '%ssn%' THEN 'PII_SSN' WHEN column_name ILIKE '%password%' THEN 'CREDENTIAL'
                    WHEN column_name ILIKE '%secret%' THEN 'CREDENTIAL' WHEN column_name ILIKE '%address%' THEN 'PII_ADDRESS'
                    WHEN column_name ILIKE '%dob%' THEN 'PII_DOB' WHEN column_name ILIKE '%birth%' THEN 'PII_DOB'
                    WHEN column_name ILIKE '%credit_card%' THEN 'PII_PAYMENT' WHEN column_name ILIKE '%salary%' THEN 'PII_FINANCIAL'
                    WHEN column_name ILIKE '%income%' THEN 'PII_FINANCIAL' ELSE 'NOT_SENSITIVE' END"""
PLAN_RESOURCE = r"'^\s*[#~+\-]\s+([\w.]+)\s+will be'"
PLAN_COUNTS = r"'Plan:\s*(\d+) to add,\s*(\d+) to change,\s*(\d+) to destroy'"

ORDERS_AS_OF = f"DATE '{A.ORDERS_AS_OF.isoformat()}'"
ORDERS_AS_OF_TS = f"TIMESTAMP '{A.ORDERS_AS_OF.isoformat()} 00:00:00'"
EVENTS_AS_OF = f"TIMESTAMP '{A.EVENTS_AS_OF.strftime('%Y-%m-%d %H:%M:%S')}'"

# ------------------------------------------------------------------ shared CTEs

RAW_FULL = f"""
    'ADV-' || o_orderkey AS ghsa_id,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         ELSE 'CVE-' || year(o_orderdate) || '-' || o_orderkey END AS cve_id,
    {pick('o_custkey', A.SUMMARY_WORDS)} || ' in module ' || o_custkey AS summary,
    'status ' || o_orderstatus AS description,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'
         WHEN '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS DOUBLE) / 10.0 END AS cvss_score,
    CAST(NULL AS VARCHAR) AS cvss_vector_string,
    o_orderdate AS published_at,
    o_orderdate AS updated_at,
    CASE WHEN o_orderkey % 29 = 0 THEN o_orderdate END AS withdrawn_at,
    'https://advisories.example/ADV-' || o_orderkey AS html_url,
    CAST(0 AS BIGINT) AS credits_count,
    'github_rest' AS source_api,
    o_orderdate AS ingested_at"""

RAW = f"raw AS (SELECT {RAW_FULL} FROM orders)"

STG = f"""stg AS (
  SELECT ghsa_id AS advisory_id, cve_id, summary, description, lower(severity) AS severity,
         CAST(cvss_score AS DOUBLE) AS cvss_score, published_at, updated_at, ingested_at,
         coalesce(cvss_score >= 9.0, false) AS is_critical,
         CAST(date_diff('day', CAST(published_at AS DATE), {ORDERS_AS_OF}) AS BIGINT) AS days_since_published
  FROM raw WHERE withdrawn_at IS NULL)"""

ENR = f"""bkt AS (
  SELECT *, {AGE_BUCKET} AS age_bucket FROM stg),
enr AS (
  SELECT *, round(coalesce(cvss_score, 0.0) * age_risk_multiplier, 2) AS composite_risk_score
  FROM (SELECT *, {AGE_MULTIPLIER} AS age_risk_multiplier,
               {CATEGORY} AS vulnerability_category
        FROM bkt))"""

ADVISORY_BASE = f"WITH {RAW},\n{STG},\n{ENR}"

PACKAGES = f"""pkg AS (
  SELECT 'ADV-' || l_orderkey AS ghsa_id, {pick('p_size', A.PACKAGE_ECOSYSTEMS)} AS ecosystem,
         p_name AS package_name
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CRITICAL = f"""crit AS (
  SELECT advisory_id, cve_id, summary, severity, cvss_score, composite_risk_score, age_bucket,
         days_since_published, vulnerability_category, published_at
  FROM enr WHERE composite_risk_score >= 9.0)"""

SUMMARY = f"""summ AS (
  SELECT severity, age_bucket, vulnerability_category,
         count(*) AS total_count,
         {mean2('cvss_score')} AS avg_cvss_score,
         {mean2('composite_risk_score')} AS avg_composite_risk_score,
         max(composite_risk_score) AS max_composite_risk_score,
         CAST(sum(CAST(is_critical AS INTEGER)) AS BIGINT) AS critical_count
  FROM enr GROUP BY severity, age_bucket, vulnerability_category)"""

ECO = f"""flat AS (
  SELECT e.advisory_id, e.severity, e.composite_risk_score, p.ecosystem AS ecosystem_name
  FROM enr e JOIN pkg p ON p.ghsa_id = e.advisory_id
  WHERE p.ecosystem IS NOT NULL AND p.ecosystem <> ''),
eco AS (
  SELECT ecosystem_name,
         count(DISTINCT advisory_id) AS total_vulnerabilities,
         CAST(sum(CASE WHEN severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count,
         CAST(sum(CASE WHEN severity = 'high' THEN 1 ELSE 0 END) AS BIGINT) AS high_count,
         {mean2('composite_risk_score')} AS avg_risk_score,
         max(composite_risk_score) AS max_risk_score
  FROM flat GROUP BY ecosystem_name)"""


def health_sql(source_name: str, table_sql: str, ts_col: str, as_of: str) -> str:
    """Pipeline health (M4) of ``table_sql`` as a CTE named ``health``."""
    return f"""health_m AS (
  SELECT max({ts_col}) AS last_ingested_at,
         CAST(date_diff('hour', max({ts_col}), {as_of}) AS BIGINT) AS hours_since_last_load,
         count(*) AS total_rows,
         count(CASE WHEN {ts_col} >= {as_of} - INTERVAL 24 HOUR THEN 1 END) AS rows_last_24h,
         count(CASE WHEN {ts_col} >= {as_of} - INTERVAL 7 DAY THEN 1 END) AS rows_last_7d
  FROM {table_sql}),
health_f AS (
  SELECT *, coalesce(hours_since_last_load <= 25, false) AS is_fresh,
         coalesce(rows_last_24h >= avg_daily_rows_7d * 0.5, false) AS is_row_count_normal
  FROM (SELECT *, CAST(round(rows_last_7d / 7.0) AS BIGINT) AS avg_daily_rows_7d FROM health_m)),
health AS (
  SELECT {quoted(source_name)} AS source_table, last_ingested_at, hours_since_last_load, total_rows,
         rows_last_24h, rows_last_7d, avg_daily_rows_7d, is_fresh, is_row_count_normal,
         CASE WHEN is_fresh AND is_row_count_normal THEN 'healthy'
              WHEN is_fresh AND NOT is_row_count_normal THEN 'low_volume_warning'
              WHEN NOT is_fresh THEN 'stale' ELSE 'unknown' END AS pipeline_status,
         {as_of} AS checked_at
  FROM health_f)"""


ORACLES: dict[str, str] = {}

ORACLES["stage_advisories"] = f"{ADVISORY_BASE}\nSELECT * FROM stg"
ORACLES["enrich_vulnerabilities"] = f"{ADVISORY_BASE}\nSELECT * FROM enr"
ORACLES["mart_critical"] = f"{ADVISORY_BASE},\n{CRITICAL}\nSELECT * FROM crit"
ORACLES["mart_summary"] = f"{ADVISORY_BASE},\n{SUMMARY}\nSELECT * FROM summ"
ORACLES["mart_ecosystem_risk"] = f"{ADVISORY_BASE},\n{PACKAGES},\n{ECO}\nSELECT * FROM eco"
ORACLES["pipeline_health"] = (
    f"WITH {health_sql('events', 'events', 'ts', EVENTS_AS_OF)}\nSELECT * FROM health")


# ------------------------------------------------------------------ more CTEs

def ts(value) -> str:
    if hasattr(value, "hour"):
        return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"
    return f"TIMESTAMP '{value.isoformat()} 00:00:00'"


ISO = "'%Y-%m-%dT%H:%M:%SZ'"

LISTING = f"""lst AS (
  SELECT event_type AS ecosystem, event_id AS position, 'ADV-' || user_id AS ghsa_id,
         CASE WHEN contains(props, '"k": 0}}') THEN NULL
              WHEN value >= 300 THEN 'CRITICAL' WHEN value >= 100 THEN 'High'
              WHEN value >= 20 THEN 'moderate' ELSE 'low' END AS severity,
         ts AS updated_at,
         CAST(list_position([{', '.join(map(quoted, A.EVENT_ECOSYSTEMS))}], event_type) AS INTEGER) AS ecosystem_rank
  FROM events WHERE event_type IN ({', '.join(map(quoted, A.EVENT_ECOSYSTEMS))}))"""

SEVERITY_IN = "lower(coalesce(severity, '')) IN ('critical', 'high')"

CAPPED = """capped AS (
  SELECT ecosystem, position, ghsa_id, severity, updated_at, ecosystem_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY ecosystem ORDER BY position) AS rn FROM lst)
  WHERE rn <= 200)"""

QLOG = f"""qlog AS (
  SELECT event_id AS query_id, CAST(user_id AS VARCHAR) AS user_name, upper(event_type) AS role_name,
         {pick('user_id', A.QUERY_TEXTS)} AS query_text,
         CAST(floor(value * 20000000) AS BIGINT) AS bytes_scanned,
         CAST(floor(value * 5000) AS BIGINT) AS rows_produced,
         ts AS start_time, 'SUCCESS' AS execution_status
  FROM events WHERE ts >= {EVENTS_AS_OF} - INTERVAL 7 DAY),
anom AS (
  SELECT * FROM (
    SELECT *, CASE WHEN bytes_scanned > 5368709120 THEN 'large_scan_over_5gb'
                   WHEN hour(start_time) NOT BETWEEN 6 AND 22 THEN 'off_hours_access'
                   WHEN query_text ILIKE '%password%' OR query_text ILIKE '%secret%' OR query_text ILIKE '%ssn%' THEN 'sensitive_column_access'
                   WHEN rows_produced > 1000000 THEN 'large_export' END AS flag_reason
    FROM qlog) WHERE flag_reason IS NOT NULL)"""

ROLES = f"""grants AS (
  SELECT c_name AS grantee_name, {pick('c_nationkey', A.GRANT_ROLES)} AS role FROM customer),
logins AS (
  SELECT c_name AS user_name, o_orderdate AS event_timestamp,
         CASE WHEN o_orderstatus = 'P' THEN 'NO' ELSE 'YES' END AS is_success
  FROM orders JOIN customer ON o_custkey = c_custkey),
last_login AS (
  SELECT user_name, max(event_timestamp) AS last_login FROM logins WHERE is_success = 'YES' GROUP BY user_name),
audit AS (
  SELECT * FROM (
    SELECT *, CASE WHEN granted_role IN ('SYSADMIN', 'ACCOUNTADMIN')
                        AND days_since_login > 30 THEN 'admin_role_unused_30_days'
                   WHEN days_since_login > 90 THEN 'user_inactive_90_days'
                   WHEN granted_role = 'ACCOUNTADMIN' THEN 'accountadmin_flag_review' END AS risk_flag
    FROM (SELECT g.grantee_name AS user_name, g.role AS granted_role, l.last_login,
                 CAST(date_diff('day', CAST(l.last_login AS DATE), {ORDERS_AS_OF}) AS BIGINT) AS days_since_login
          FROM grants g LEFT JOIN last_login l ON g.grantee_name = l.user_name))
  WHERE risk_flag IS NOT NULL)"""

EXPOSURE = f"""cols AS (
  SELECT 'ANALYTICS' AS table_catalog, {pick('p_size', A.COLUMN_SCHEMAS)} AS table_schema,
         p_type AS table_name, {pick('p_partkey', A.COLUMN_NAMES)} || '_' || p_partkey AS column_name,
         {pick('p_partkey', A.DATA_TYPES)} AS data_type
  FROM part),
expo AS (
  SELECT *, CASE WHEN pii_classification = 'NOT_SENSITIVE' THEN NULL
                 WHEN column_name ILIKE '%email%' OR column_name ILIKE '%phone%' OR column_name ILIKE '%ssn%' OR column_name ILIKE '%address%' THEN 'PROTECTED'
                 ELSE 'EXPOSED - ACTION REQUIRED' END AS exposure_status,
         {EVENTS_AS_OF} AS checked_at
  FROM (SELECT table_catalog AS database_name, table_schema AS schema_name, table_name, column_name, data_type,
               {COLUMN_CLASS} AS pii_classification
        FROM cols WHERE table_schema <> 'INFORMATION_SCHEMA')
  WHERE pii_classification <> 'NOT_SENSITIVE')"""


def zscore_sql(src: str, part: str, value: str, mean: str, sd: str) -> str:
    """Window form of the z-score (the oracle states the surveyed formulation)."""
    return f"""(SELECT *, CASE WHEN {sd} IS NULL OR {sd} = 0 THEN 0.0 ELSE ({value} - {mean}) / {sd} END AS z_score
  FROM (SELECT *, avg({value}) OVER (PARTITION BY {part}) AS {mean},
               stddev_samp({value}) OVER (PARTITION BY {part}) AS {sd} FROM {src}))"""


ORDERS_TS = ts(A.ORDERS_AS_OF)

SUMMARY_ANOM = f"""sanom AS (
  SELECT severity || '_' || age_bucket || '_' || vulnerability_category AS advisory_id,
         vulnerability_category AS ecosystem, avg_composite_risk_score AS composite_risk_score,
         round(ecosystem_mean, 6) AS ecosystem_mean, round(ecosystem_stddev, 6) AS ecosystem_stddev,
         round(z_score, 6) AS z_score, 'statistical_outlier' AS anomaly_type, {ORDERS_TS} AS detected_at
  FROM {zscore_sql('summ', 'vulnerability_category', 'avg_composite_risk_score', 'ecosystem_mean', 'ecosystem_stddev')}
  WHERE abs(z_score) > 2.0)"""

ADV_HEALTH = health_sql("RAW_GITHUB_ADVISORIES", "raw", "ingested_at", ORDERS_TS)

FACTS = f"""topeco AS (
  SELECT ecosystem_name, critical_count FROM eco
  ORDER BY avg_risk_score DESC NULLS LAST, ecosystem_name LIMIT 1),
facts AS (
  SELECT s.*, e.eco_count,
         coalesce((SELECT ecosystem_name FROM topeco), 'N/A') AS top_ecosystem,
         CAST(coalesce((SELECT critical_count FROM topeco), 0) AS BIGINT) AS top_ecosystem_critical,
         c.max_score, h.pipeline_status, h.total_rows, h.last_ingested_at
  FROM (SELECT CAST(coalesce(sum(total_count), 0) AS BIGINT) AS total_cves,
               CAST(coalesce(sum(critical_count), 0) AS BIGINT) AS critical_count,
               {', '.join(f"CAST(coalesce(sum(total_count) FILTER (WHERE age_bucket = '{a}'), 0) AS BIGINT) AS {a}_count" for a in ('new', 'recent', 'aging', 'chronic'))}
        FROM summ) s,
       (SELECT count(DISTINCT ecosystem_name) AS eco_count FROM eco) e,
       (SELECT coalesce(max(composite_risk_score), 0.0) AS max_score FROM crit) c,
       health h)"""

BRIEF_BASE = f"{ADVISORY_BASE},\n{CRITICAL},\n{SUMMARY},\n{PACKAGES},\n{ECO},\n{ADV_HEALTH},\n{FACTS}"

PLAN_TEXT = """CASE WHEN o_orderstatus = 'F' THEN 'No changes. Your infrastructure matches the configuration.'
       ELSE 'Terraform will perform the following actions:' || chr(10) || chr(10)
            || '  # m.t' || o_custkey || ' will be created' || chr(10)
            || '  ~ m.u' || (o_orderkey % 4) || ' will be updated in-place' || chr(10)
            || '  # m.q["k' || (o_orderkey % 3) || '"] will be destroyed' || chr(10)
            || '  # m.t' || o_custkey || ' will be created' || chr(10) || chr(10)
            || 'Plan: ' || (o_custkey % 5) || ' to add, ' || (o_orderkey % 4) || ' to change, '
            || (o_orderkey % 2) || ' to destroy.' END"""

DRIFT = f"""plans AS (
  SELECT o_orderkey AS run_id, CAST(o_orderkey % 3 AS INTEGER) AS exit_code, {PLAN_TEXT} AS stdout,
         o_orderdate AS checked_at, CAST(o_custkey % 10 AS VARCHAR) AS environment
  FROM orders),
parsed AS (
  SELECT *, list_filter(list_transform(string_split_regex(stdout, '\\r\\n|\\r|\\n'),
                                       lambda l: regexp_extract(l, {PLAN_RESOURCE}, 1)),
                        lambda x: x <> '') AS names
  FROM plans WHERE exit_code <> 1),
drift AS (
  SELECT run_id, environment, checked_at, exit_code = 2 AS drift_detected,
         {', '.join(f"CAST(coalesce(TRY_CAST(regexp_extract(stdout, {PLAN_COUNTS}, {i}) AS BIGINT), 0) AS BIGINT) AS resources_to_{n}" for i, n in ((1, 'add'), (2, 'change'), (3, 'destroy')))},
         CAST(to_json({{'changed_resources': list_filter(names, lambda x, i: NOT list_contains(names[1:i-1], x))}})
              AS VARCHAR) AS drift_details,
         stdout AS raw_plan_output
  FROM parsed)"""

SNAP = f"""first_snap AS (
  SELECT o_custkey AS custkey, count(*) AS order_count, max(o_totalprice) AS max_price,
         max(o_orderdate) AS last_order_date
  FROM orders WHERE o_orderdate <= {ts(A.HISTORY_FIRST_AS_OF)} GROUP BY o_custkey),
now_snap AS (
  SELECT o_custkey AS custkey, count(*) AS order_count, max(o_totalprice) AS max_price,
         max(o_orderdate) AS last_order_date
  FROM orders GROUP BY o_custkey),
j AS (
  SELECT h.custkey, h.order_count, h.max_price, h.last_order_date,
         n.custkey AS n_key, n.order_count AS n_count, n.max_price AS n_max, n.last_order_date AS n_last,
         CASE WHEN h.custkey IS NOT NULL AND n.custkey IS NOT NULL
                   AND (h.order_count IS DISTINCT FROM n.order_count OR h.max_price IS DISTINCT FROM n.max_price)
                   THEN 'changed'
              WHEN h.custkey IS NOT NULL AND n.custkey IS NOT NULL THEN 'unchanged'
              WHEN n.custkey IS NOT NULL THEN 'new' ELSE 'vanished' END AS state
  FROM first_snap h FULL OUTER JOIN now_snap n ON h.custkey = n.custkey),
snap_rows AS (
  SELECT custkey, order_count, max_price, last_order_date, {ts(A.HISTORY_FIRST_AS_OF)} AS valid_from,
         CASE WHEN state = 'changed' THEN {ORDERS_TS} END AS valid_to
  FROM j WHERE state IN ('changed', 'unchanged', 'vanished')
  UNION ALL
  SELECT n_key, n_count, n_max, n_last, {ORDERS_TS}, CAST(NULL AS TIMESTAMP)
  FROM j WHERE state IN ('changed', 'new')),
snap AS (
  SELECT *, md5(CAST(custkey AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS scd_id FROM snap_rows)"""

MODEL_CTES = {
    "stg_github_advisories": "stg",
    "int_vulnerabilities_enriched": "enr",
    "mart_vulnerability_summary": "summ",
    "mart_ecosystem_risk": "eco",
    "mart_critical_vulnerabilities": "crit",
    "mart_pipeline_health": "health",
}
MODELS_BASE = f"{ADVISORY_BASE},\n{CRITICAL},\n{SUMMARY},\n{PACKAGES},\n{ECO},\n{ADV_HEALTH}"

# fixed values: the declared data tests
NOT_NULL = {
    "stg_github_advisories": ["advisory_id", "severity", "published_at"],
    "int_vulnerabilities_enriched": ["advisory_id", "age_bucket", "age_risk_multiplier", "vulnerability_category",
                                     "composite_risk_score"],
    "mart_vulnerability_summary": ["severity", "age_bucket", "vulnerability_category", "total_count"],
    "mart_ecosystem_risk": ["ecosystem_name", "total_vulnerabilities"],
    "mart_critical_vulnerabilities": ["advisory_id", "severity", "cvss_score", "composite_risk_score"],
    "mart_pipeline_health": ["source_table", "last_ingested_at", "pipeline_status"],
}
UNIQUE = {"stg_github_advisories": "advisory_id", "int_vulnerabilities_enriched": "advisory_id",
          "mart_ecosystem_risk": "ecosystem_name", "mart_critical_vulnerabilities": "advisory_id"}
ACCEPTED = {"stg_github_advisories": ("severity", ["critical", "high", "medium", "low"]),
            "int_vulnerabilities_enriched": ("age_bucket", ["new", "recent", "aging", "chronic"]),
            "mart_pipeline_health": ("pipeline_status", ["healthy", "low_volume_warning", "stale", "unknown"])}


def _dq_not_null() -> str:
    parts = [f"SELECT {quoted(m)} AS model, {quoted(c)} AS column_name, 'not_null' AS test, "
             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {MODEL_CTES[m]}"
             for m, cols in NOT_NULL.items() for c in cols]
    return f"{MODELS_BASE}\n" + "\nUNION ALL\n".join(parts)


def _dq_unique() -> str:
    parts = [f"SELECT {quoted(m)} AS model, {quoted(k)} AS column_name, 'unique' AS test, "
             f"(SELECT count(*) FROM (SELECT {k} FROM {MODEL_CTES[m]} WHERE {k} IS NOT NULL "
             f"GROUP BY {k} HAVING count(*) > 1)) AS failures"
             for m, k in UNIQUE.items()]
    return f"{MODELS_BASE}\n" + "\nUNION ALL\n".join(parts)


def _dq_accepted() -> str:
    parts = [f"SELECT {quoted(m)} AS model, {quoted(c)} AS column_name, 'accepted_values' AS test, "
             f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(map(quoted, vals))})) "
             f"AS BIGINT) AS failures FROM {MODEL_CTES[m]}"
             for m, (c, vals) in ACCEPTED.items()]
    return f"{MODELS_BASE}\n" + "\nUNION ALL\n".join(parts)


def _freshness(source: str, table_sql: str, col: str, as_of: str) -> str:
    return f"""SELECT {quoted(source)} AS source_table, max_loaded_at, age_seconds,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN age_seconds > 172800 THEN 'error'
            WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max({col}) AS max_loaded_at,
             CAST(date_sub('second', max({col}), {as_of}) AS BIGINT) AS age_seconds FROM {table_sql})"""


def _brief_actions() -> str:
    return f"""{BRIEF_BASE},
acts AS (
  SELECT 1 AS n, CAST(chronic_count AS VARCHAR) || ' advisories are open for over a year; schedule their fixes first.' AS action
  FROM facts WHERE chronic_count > 10
  UNION ALL SELECT 2, 'Check what depends on ' || top_ecosystem || ': it has '
         || CAST(top_ecosystem_critical AS VARCHAR) || ' critical advisories.' FROM facts WHERE top_ecosystem_critical > 5
  UNION ALL SELECT 3, 'Loads are late or uneven; look at the ingest job before relying on these figures.' FROM facts WHERE pipeline_status <> 'healthy'
  UNION ALL SELECT 4, 'Run the data tests before the next brief.' FROM facts)
SELECT CAST(row_number() OVER (ORDER BY n) AS BIGINT) AS action_no, action FROM acts"""


ORACLES.update({
    # ---------------------------------------------------------------- sources
    "flatten_advisory_json": f"""SELECT ghsa_id, cve_id, coalesce(summary, '') AS summary,
       description, severity, cvss_score,
       CASE WHEN cvss_score IS NOT NULL THEN 'CVSS:3.1/AV:N/S:' || severity END AS cvss_vector_string,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS cwe_count,
       CAST(CASE WHEN o_orderkey % 5 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS package_count,
       strftime(published_at, {ISO}) AS published_at,
       CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE strftime(updated_at, {ISO}) END AS updated_at,
       strftime(withdrawn_at, {ISO}) AS withdrawn_at, html_url,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS BIGINT) AS credits_count,
       'github_rest' AS source_api, {ORDERS_TS} AS ingested_at
FROM (SELECT {RAW_FULL}, o_orderkey, o_custkey FROM orders)""",
    "explode_packages": f"""WITH d AS (SELECT 'ADV-' || o_orderkey AS ghsa_id, o_orderkey, o_custkey,
                  o_orderkey % 5 <> 0 AS has_packages FROM orders),
p AS (SELECT ghsa_id, CASE WHEN has_packages THEN {pick('o_custkey', A.PACKAGE_ECOSYSTEMS)} END AS ecosystem,
             'pkg' || o_custkey AS package_name FROM d
      UNION ALL
      SELECT ghsa_id, CASE WHEN has_packages THEN {pick('o_orderkey', A.PACKAGE_ECOSYSTEMS)} END,
             'lib' || o_orderkey FROM d)
SELECT * FROM p WHERE ecosystem IS NOT NULL AND ecosystem <> ''""",
    "unwrap_cve_pages": """SELECT 'CVE-' || year(o_orderdate) || '-' || o_orderkey || sfx AS cve_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS published, o_orderstatus AS vuln_status,
       o_orderdate AS fetched_at
FROM (SELECT *, '' AS sfx FROM orders UNION ALL SELECT *, '-R' AS sfx FROM orders)""",
    "unwrap_advisory_nodes": """SELECT 'ADV-' || o_orderkey AS ghsa_id, o_orderpriority AS severity, o_orderdate AS fetched_at
FROM orders
UNION ALL
SELECT 'ADV-' || o_orderkey || '-R', 'LOW', o_orderdate FROM orders""",
    "typed_load": f"""SELECT ghsa_id, published_at, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE updated_at END AS updated_at,
       withdrawn_at, {ORDERS_TS} AS ingested_at,
       CASE WHEN o_orderkey % 5 <> 0 THEN {pick('o_custkey', A.PACKAGE_ECOSYSTEMS)} END AS first_ecosystem,
       CASE WHEN o_orderkey % 3 = 0 THEN 'CWE-79' END AS first_cwe,
       cvss_score AS raw_cvss_score
FROM (SELECT {RAW_FULL}, o_orderkey, o_custkey FROM orders)""",
    # ---------------------------------------------------------------- ingest
    "severity_filter": f"WITH {LISTING}\nSELECT * FROM lst WHERE {SEVERITY_IN}",
    "cap_per_ecosystem": f"WITH {LISTING},\n{CAPPED}\nSELECT * FROM capped",
    "first_seen_dedupe": f"""WITH {LISTING}
SELECT ecosystem, position, ghsa_id, severity, updated_at, ecosystem_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ghsa_id ORDER BY ecosystem_rank, position) AS rn
  FROM lst WHERE {SEVERITY_IN}) WHERE rn = 1""",
    "incremental_since": f"SELECT * FROM (SELECT {RAW_FULL} FROM orders) WHERE updated_at >= {ts(A.BATCH_UPDATED_SINCE)}",
    "incremental_window": f"""SELECT * FROM (SELECT {RAW_FULL} FROM orders)
WHERE published_at >= {ts(C.WINDOW_LO)} AND published_at <= {ts(C.WINDOW_HI)}""",
    "upsert_merge": f"""WITH raw AS (SELECT {RAW_FULL} FROM orders),
tgt AS (SELECT * FROM raw WHERE updated_at < {ts(A.TARGET_LOADED_BEFORE)}),
src AS (SELECT * REPLACE (CASE WHEN cvss_score IS NULL THEN NULL ELSE least(cvss_score + 1.0, 10.0) END AS cvss_score,
                          {ORDERS_TS} AS ingested_at)
        FROM raw WHERE updated_at >= {ts(A.BATCH_UPDATED_SINCE)})
SELECT * FROM src
UNION ALL
SELECT * FROM tgt WHERE ghsa_id NOT IN (SELECT ghsa_id FROM src)""",
    "upsert_records": f"""WITH items AS (
  SELECT 'CVE-' || year(o_orderdate) || '-' || o_orderkey || sfx AS cve_id, o_orderstatus AS vuln_status,
         o_orderdate AS fetched_at
  FROM (SELECT *, '' AS sfx FROM orders UNION ALL SELECT *, '-R' AS sfx FROM orders)),
tgt AS (SELECT *, fetched_at AS loaded_at FROM items WHERE fetched_at < {ts(A.TARGET_LOADED_BEFORE)}),
src AS (SELECT *, {ORDERS_TS} AS loaded_at FROM items WHERE fetched_at >= {ts(A.BATCH_UPDATED_SINCE)})
SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE cve_id NOT IN (SELECT cve_id FROM src)""",
    # ---------------------------------------------------------------- security
    "anomalous_queries": f"WITH {QLOG}\nSELECT * FROM anom",
    "role_audit": f"WITH {ROLES}\nSELECT * FROM audit",
    "pii_exposure": f"WITH {EXPOSURE}\nSELECT * FROM expo",
    "masked_customers": """SELECT c_custkey AS customer_id, c_name AS full_name, '***MASKED***' AS email,
       repeat('X', greatest(length(phone) - 4, 0)) || right(phone, 4) AS phone,
       '[REDACTED]' AS ssn, '[REDACTED]' AS address
FROM (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone FROM customer)""",
    "security_summary": f"""WITH {QLOG},
{ROLES},
{EXPOSURE}
SELECT {EVENTS_AS_OF} AS report_generated_at, a.total_anomalies, r.total_role_risks,
       p.total_exposed_columns, p.total_protected_columns,
       CASE WHEN a.total_anomalies = 0 AND r.total_role_risks = 0 AND p.total_exposed_columns = 0
                 THEN 'GREEN - No issues detected'
            WHEN p.total_exposed_columns > 0 OR r.total_role_risks > 0 THEN 'AMBER - Issues require attention'
            ELSE 'RED - Immediate action required' END AS security_health_status
FROM (SELECT count(*) AS total_anomalies FROM anom) a,
     (SELECT count(*) AS total_role_risks FROM audit) r,
     (SELECT count(*) FILTER (WHERE exposure_status = 'EXPOSED - ACTION REQUIRED') AS total_exposed_columns,
             count(*) FILTER (WHERE exposure_status = 'PROTECTED') AS total_protected_columns FROM expo) p""",
    # ---------------------------------------------------------------- outliers
    "zscore_outliers": f"""WITH g AS (
  SELECT event_type, user_id,
         CAST(sum(CAST(value AS DECIMAL(24, 6))) AS DOUBLE) / count(value) AS avg_value
  FROM events GROUP BY event_type, user_id HAVING count(value) > 0)
SELECT event_type, user_id, avg_value, round(mean_value, 6) AS mean_value,
       round(stddev_value, 6) AS stddev_value, round(z_score, 6) AS z_score
FROM {zscore_sql('g', 'event_type', 'avg_value', 'mean_value', 'stddev_value')}
WHERE abs(z_score) > 2.0""",
    "summary_anomalies": f"{ADVISORY_BASE},\n{SUMMARY},\n{SUMMARY_ANOM}\nSELECT * FROM sanom",
    "anomaly_counts": f"""{ADVISORY_BASE},\n{SUMMARY},\n{SUMMARY_ANOM}
SELECT ecosystem, count(*) AS anomaly_count FROM sanom GROUP BY ecosystem""",
    "advisory_outliers": f"""{ADVISORY_BASE},\n{PACKAGES},
pairs AS (SELECT DISTINCT ghsa_id, ecosystem AS ecosystem_name FROM pkg WHERE ecosystem IS NOT NULL AND ecosystem <> ''),
aj AS (SELECT e.advisory_id, e.composite_risk_score, p.ecosystem_name FROM enr e JOIN pairs p ON p.ghsa_id = e.advisory_id)
SELECT advisory_id, ecosystem_name AS ecosystem, composite_risk_score, round(ecosystem_mean, 6) AS ecosystem_mean,
       round(ecosystem_stddev, 6) AS ecosystem_stddev, round(z_score, 6) AS z_score,
       'statistical_outlier' AS anomaly_type, {ORDERS_TS} AS detected_at
FROM {zscore_sql('aj', 'ecosystem_name', 'composite_risk_score', 'ecosystem_mean', 'ecosystem_stddev')}
WHERE abs(z_score) > 2.0""",
    # ---------------------------------------------------------------- brief
    "brief_top_threats": f"""{ADVISORY_BASE},\n{CRITICAL}
SELECT advisory_id, cve_id, summary, severity, cvss_score, composite_risk_score, age_bucket,
       days_since_published, vulnerability_category
FROM crit ORDER BY composite_risk_score DESC NULLS LAST, advisory_id LIMIT 5""",
    "brief_top_ecosystems": f"""{ADVISORY_BASE},\n{PACKAGES},\n{ECO}
SELECT ecosystem_name, avg_risk_score, critical_count, total_vulnerabilities
FROM eco ORDER BY avg_risk_score DESC NULLS LAST, ecosystem_name LIMIT 3""",
    "brief_severity": f"""{ADVISORY_BASE},\n{SUMMARY}
SELECT severity, CAST(sum(total_count) AS BIGINT) AS total, CAST(sum(critical_count) AS BIGINT) AS critical_sum
FROM summ GROUP BY severity""",
    "brief_age": f"""{ADVISORY_BASE},\n{SUMMARY}
SELECT age_bucket, CAST(sum(total_count) AS BIGINT) AS total FROM summ GROUP BY age_bucket""",
    "brief_facts": f"""{BRIEF_BASE}
SELECT total_cves, critical_count, eco_count, top_ecosystem, top_ecosystem_critical, max_score,
       new_count, recent_count, aging_count, chronic_count, pipeline_status, total_rows, last_ingested_at
FROM facts""",
    "brief_actions": _brief_actions(),
    # ---------------------------------------------------------------- drift
    "drift_records": f"WITH {DRIFT}\nSELECT * FROM drift",
    "drift_episodes": f"""WITH {DRIFT},
w AS (
  SELECT environment, checked_at, run_id, drift_detected,
         lag(drift_detected) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS prev,
         lead(drift_detected) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS nxt,
         lead(checked_at) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS next_at
  FROM drift),
s AS (
  SELECT *, sum(CASE WHEN drift_detected AND coalesce(NOT prev, true) THEN 1 ELSE 0 END)
              OVER (PARTITION BY environment ORDER BY checked_at, run_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM w)
SELECT environment, CAST(island AS BIGINT) AS episode_no, min(checked_at) AS drift_started_at,
       max(checked_at) AS last_drift_at, count(*) AS drifted_checks,
       max(CASE WHEN coalesce(NOT nxt, true) THEN next_at END) AS resolved_at
FROM s WHERE drift_detected GROUP BY environment, island""",
    # ---------------------------------------------------------------- history
    "scd2_snapshot": f"WITH {SNAP}\nSELECT * FROM snap",
    "scd2_as_of": f"""WITH {SNAP}
SELECT * FROM snap WHERE valid_from <= {ts(C.AS_OF_READ)}
  AND (valid_to IS NULL OR {ts(C.AS_OF_READ)} < valid_to)""",
    # ---------------------------------------------------------------- quality
    "dq_not_null": _dq_not_null(),
    "dq_unique": _dq_unique(),
    "dq_accepted_values": _dq_accepted(),
    "dq_freshness": _freshness("events", "events", "ts", EVENTS_AS_OF) + "\nUNION ALL\n"
    + _freshness("RAW_GITHUB_ADVISORIES", f"(SELECT {RAW_FULL} FROM orders)", "ingested_at", ORDERS_TS),
})


def _threat_brief() -> str:
    ts_fmt = "'%Y-%m-%d %H:%M:%S'"
    cap = "upper(substring(coalesce(severity, 'unknown'), 1, 1)) || lower(substring(coalesce(severity, 'unknown'), 2))"
    return f"""{BRIEF_BASE},
tl AS (
  SELECT coalesce(string_agg(line, chr(10) ORDER BY k1, k2), '') AS threat_lines FROM (
    SELECT -composite_risk_score AS k1, advisory_id AS k2,
           concat_ws(' | ', coalesce(cve_id, 'N/A'), CAST(composite_risk_score AS VARCHAR), severity,
                     CAST(days_since_published AS VARCHAR) || ' days', vulnerability_category,
                     coalesce(summary, '')) AS line
    FROM (SELECT * FROM crit ORDER BY composite_risk_score DESC NULLS LAST, advisory_id LIMIT 5))),
el AS (
  SELECT coalesce(string_agg(line, chr(10) ORDER BY k1, k2), '') AS eco_lines FROM (
    SELECT -avg_risk_score AS k1, ecosystem_name AS k2,
           ecosystem_name || ' avg risk ' || CAST(avg_risk_score AS VARCHAR) || ', '
             || CAST(critical_count AS VARCHAR) || ' critical CVEs' AS line
    FROM (SELECT * FROM eco ORDER BY avg_risk_score DESC NULLS LAST, ecosystem_name LIMIT 3))),
sl AS (
  SELECT coalesce(string_agg(line, chr(10) ORDER BY k1, k2), '') AS sev_lines FROM (
    SELECT coalesce(list_position(['critical', 'high', 'medium', 'low'], severity), 5) AS k1, severity AS k2,
           {cap} || ' ' || CAST(CAST(sum(total_count) AS BIGINT) AS VARCHAR) AS line
    FROM summ GROUP BY severity)),
al AS (
  SELECT concat_ws(chr(10),
           CASE WHEN chronic_count > 10
                THEN CAST(chronic_count AS VARCHAR) || ' advisories are open for over a year; schedule their fixes first.' END,
           CASE WHEN top_ecosystem_critical > 5 THEN 'Check what depends on ' || top_ecosystem || ': it has '
                  || CAST(top_ecosystem_critical AS VARCHAR) || ' critical advisories.' END,
           CASE WHEN pipeline_status <> 'healthy' THEN 'Loads are late or uneven; look at the ingest job before relying on these figures.' END,
           'Run the data tests before the next brief.') AS action_lines
  FROM facts)
SELECT md5('brief|' || strftime({ORDERS_TS}, {ts_fmt})) AS brief_id, {ORDERS_TS} AS generated_at,
       total_cves AS cve_count, critical_count, top_ecosystem, pipeline_status,
       concat_ws(chr(10),
         'Threat brief',
         'Written ' || strftime({ORDERS_TS}, '%Y-%m-%d %H:%M') || ' UTC',
         'Newest data ' || strftime(last_ingested_at, {ts_fmt}) || ' UTC',
         '', 'Overview',
         'Advisories loaded: ' || CAST(total_rows AS VARCHAR),
         CAST(critical_count AS VARCHAR) || ' critical, in ' || CAST(eco_count AS VARCHAR)
           || ' ecosystems',
         'Load state: ' || pipeline_status,
         '', 'Highest scores', threat_lines,
         '', 'Ecosystems by average score', eco_lines,
         '', 'Counts by severity', sev_lines,
         '', 'Age and peaks',
         'By age: ' || CAST(new_count AS VARCHAR) || ' new / ' || CAST(recent_count AS VARCHAR)
           || ' recent / ' || CAST(aging_count AS VARCHAR) || ' aging / ' || CAST(chronic_count AS VARCHAR)
           || ' chronic',
         'Peak score: ' || CAST(max_score AS VARCHAR),
         'First ecosystem: ' || top_ecosystem,
         '', 'Next steps', action_lines) AS brief_text
FROM facts, tl, el, sl, al"""


ORACLES["threat_brief"] = _threat_brief()


def snapshots_sql(first: str, now: str, key: str, columns: list[str], checks: list[str], delete: bool = False) -> str:
    """Type-2 history after a first and a second snapshot, both given as SELECTs."""
    t0, t1 = ts(A.HISTORY_FIRST_AS_OF), ORDERS_TS
    differs = " OR ".join(f"f.{c} IS DISTINCT FROM n.{c}" for c in checks)
    gone = t1 if delete else "CAST(NULL AS TIMESTAMP)"
    of = lambda t: ", ".join(f"{t}.{c}" for c in columns)
    return f"""WITH f AS ({first}), n AS ({now}),
versions AS (
  SELECT {of('f')}, {t0} AS valid_from, CASE WHEN n.{key} IS NULL THEN {gone} WHEN {differs} THEN {t1} END AS valid_to
  FROM f LEFT JOIN n ON f.{key} = n.{key}
  UNION ALL
  SELECT {of('n')}, {t1}, CAST(NULL AS TIMESTAMP) FROM n LEFT JOIN f ON f.{key} = n.{key}
  WHERE f.{key} IS NULL OR {differs})
SELECT *, md5(CAST({key} AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS scd_id FROM versions"""


def _customers_sql(where: str) -> str:
    return f"""SELECT o_custkey AS custkey, count(*) AS order_count, max(o_totalprice) AS max_price,
       max(o_orderdate) AS last_order_date FROM orders WHERE {where} GROUP BY o_custkey"""


def _ecosystem_sql(before: str | None, when: str) -> str:
    cut = f"WHERE published_at < {before}" if before else ""
    return f"""{ADVISORY_BASE}, enr_all AS (SELECT * FROM enr {cut}),
{PACKAGES},
{ECO.replace("FROM enr e", "FROM enr_all e")}
SELECT ecosystem_name, total_vulnerabilities, critical_count, high_count, avg_risk_score, max_risk_score,
       {when} AS snapshotted_at FROM eco"""


HEALTH_SNAP = ["source_table", "pipeline_status", "total_rows", "rows_last_24h", "rows_last_7d", "hours_since_last_load",
               "is_fresh", "is_row_count_normal", "last_ingested_at", "snapshotted_at"]


def _health_snap_sql(when: str) -> str:
    return f"""WITH {RAW}, {health_sql("RAW_GITHUB_ADVISORIES", "raw", "ingested_at", when)}
SELECT {", ".join(HEALTH_SNAP[:-1])}, {when} AS snapshotted_at FROM health"""


def _exposure_snap_sql(where: str, when: str) -> str:
    return f"""WITH {EXPOSURE}
SELECT concat_ws('|', column_name, table_name, schema_name) AS pii_key, schema_name, table_name, column_name,
       pii_classification, exposure_status, checked_at, {when} AS snapshotted_at FROM expo WHERE {where}"""


FIRST_TS = ts(A.HISTORY_FIRST_AS_OF)
LANDED_DOCS = f"""docs AS (SELECT {RAW_FULL}, o_orderkey FROM orders),
versions AS (
  SELECT ghsa_id, cve_id, severity, cvss_score, published_at,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE updated_at END AS updated_at, withdrawn_at, o_orderkey FROM docs
  UNION ALL
  SELECT ghsa_id, cve_id, 'CRITICAL', cvss_score, published_at, TIMESTAMP '1989-12-31 19:00:00', withdrawn_at, o_orderkey FROM docs)"""

ORACLES.update({
    "scd2_hard_deletes": snapshots_sql(
        _customers_sql(f"o_orderdate <= {FIRST_TS}"), _customers_sql(f"o_orderdate >= {ts(A.BATCH_UPDATED_SINCE)}"),
        "custkey", ["custkey", "order_count", "max_price", "last_order_date"], ["order_count", "max_price"], delete=True),
    "snap_ecosystem_risk": snapshots_sql(
        _ecosystem_sql(ts(A.TARGET_LOADED_BEFORE), FIRST_TS), _ecosystem_sql(None, ORDERS_TS), "ecosystem_name",
        ["ecosystem_name", "total_vulnerabilities", "critical_count", "high_count", "avg_risk_score", "max_risk_score",
         "snapshotted_at"],
        ["total_vulnerabilities", "critical_count", "avg_risk_score", "max_risk_score"]),
    "snap_pipeline_health": snapshots_sql(
        _health_snap_sql(FIRST_TS), _health_snap_sql(ORDERS_TS), "source_table", HEALTH_SNAP,
        ["pipeline_status", "total_rows", "hours_since_last_load"]),
    "snap_pii_exposure": snapshots_sql(
        _exposure_snap_sql("schema_name = 'RAW'", FIRST_TS), _exposure_snap_sql("true", ORDERS_TS), "pii_key",
        ["pii_key", "schema_name", "table_name", "column_name", "pii_classification", "exposure_status", "checked_at",
         "snapshotted_at"], ["exposure_status", "pii_classification"]),
    "advisory_outliers_low": ORACLES["advisory_outliers"].replace("abs(z_score) > 2.0", "abs(z_score) > 1.5"),
    "dq_listing": f"""WITH l AS (
  SELECT 'ADV-' || user_id AS ghsa_id, ts AS updated_at,
         CASE WHEN contains(props, '"k": 0}}') THEN NULL WHEN value >= 300 THEN 'critical' WHEN value >= 100 THEN 'high'
              WHEN value >= 20 THEN 'moderate' ELSE 'low' END AS severity
  FROM events)
SELECT 'listing' AS model, 'ghsa_id' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE ghsa_id IS NULL) AS failures FROM l
UNION ALL SELECT 'listing', 'severity', 'not_null', count(*) FILTER (WHERE severity IS NULL) FROM l
UNION ALL SELECT 'listing', 'updated_at', 'not_null', count(*) FILTER (WHERE updated_at IS NULL) FROM l
UNION ALL SELECT 'listing', 'ghsa_id', 'unique',
  (SELECT count(*) FROM (SELECT ghsa_id FROM l WHERE ghsa_id IS NOT NULL GROUP BY ghsa_id HAVING count(*) > 1))
UNION ALL SELECT 'listing', 'severity', 'accepted_values',
  count(*) FILTER (WHERE severity NOT IN ('critical', 'high', 'medium', 'low')) FROM l""",
    "first_positions": f"""WITH {LISTING}
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ecosystem ORDER BY position) AS rn FROM lst)
WHERE rn <= 100000""",
    "dq_contract": f"""{ADVISORY_BASE},\n{CRITICAL},
l AS (SELECT 'ADV-' || user_id AS ghsa_id, ts AS updated_at,
             CASE WHEN contains(props, '"k": 0}}') THEN NULL ELSE 'some' END AS severity FROM events)
SELECT 'listing' AS model, 'ghsa_id' AS column_name, count(*) FILTER (WHERE ghsa_id IS NULL) AS failures FROM l
UNION ALL SELECT 'listing', 'severity', count(*) FILTER (WHERE severity IS NULL) FROM l
UNION ALL SELECT 'listing', 'updated_at', count(*) FILTER (WHERE updated_at IS NULL) FROM l
UNION ALL SELECT 'mart_critical_vulnerabilities', c, 0 FROM (SELECT unnest(['advisory_id', 'severity', 'cvss_score',
  'composite_risk_score', 'age_bucket']) AS c)
  WHERE NOT EXISTS (SELECT 1 FROM crit WHERE advisory_id IS NULL OR severity IS NULL OR cvss_score IS NULL
                    OR composite_risk_score IS NULL OR age_bucket IS NULL)""",
    "land_advisories": f"""WITH {LANDED_DOCS},
newest AS (SELECT * EXCLUDE (o_orderkey) FROM (
  SELECT *, row_number() OVER (PARTITION BY ghsa_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM versions) WHERE rn = 1),
nameless AS (SELECT NULL AS ghsa_id, cve_id, severity, cvss_score, published_at,
                    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE updated_at END AS updated_at, withdrawn_at
             FROM docs WHERE o_orderkey % 3 = 0)
SELECT * EXCLUDE (rn) FROM newest WHERE severity IN ('CRITICAL', 'HIGH')
UNION ALL SELECT * FROM nameless WHERE severity IN ('CRITICAL', 'HIGH')""",
    "landing_rejects": """SELECT 'ADV-' || o_orderkey AS named, 'invalid JSON in raw_json' AS reject_reason
FROM orders WHERE o_orderkey % 4 = 0""",
})
