"""Fixed values.

These lists and thresholds must equal the ones of the surveyed system for the
results to match; they are stated here plainly, in the order the rules are
evaluated (first match wins wherever a list of rules is given). LIKE patterns
keep their wildcard meaning: ``_`` matches any one character.
"""

# --- Fixed values: advisory enrichment -------------------------------------

# Age bucket by days since publication: upper bound (inclusive) → label.
AGE_BUCKETS = [(30, "new"), (90, "recent"), (365, "aging")]
AGE_BUCKET_ELSE = "chronic"

# Risk multiplier per age bucket.
AGE_MULTIPLIERS = [("new", 1.0), ("recent", 1.2), ("aging", 1.5), ("chronic", 2.0)]

# Vulnerability category from the summary, case-insensitive LIKE.
CATEGORY_RULES = [
    ("code_execution", ["%injection%", "%rce%", "%remote code%"]),
    ("privilege_escalation", ["%privilege%", "%escalation%"]),
    ("data_exposure", ["%disclosure%", "%exposure%", "%leak%"]),
    ("auth_bypass", ["%bypass%", "%authentication%"]),
    ("path_traversal", ["%traversal%", "%path%"]),
]
CATEGORY_ELSE = "other"

CRITICAL_CVSS = 9.0            # is_critical: cvss >= this
CRITICAL_MART_SCORE = 9.0      # mart_critical: composite score >= this
SEVERITIES = ["critical", "high", "medium", "low"]
AGE_LABELS = ["new", "recent", "aging", "chronic"]

# --- Fixed values: pipeline health -----------------------------------------

FRESH_HOURS = 25               # fresh when hours since last load <= this
NORMAL_VOLUME_RATIO = 0.5      # normal when rows in 24 h >= ratio * daily average
HEALTH_STATUSES = ["healthy", "low_volume_warning", "stale", "unknown"]
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# --- Fixed values: security audit ------------------------------------------

LARGE_SCAN_BYTES = 5368709120
WORK_HOURS = (6, 22)           # inclusive hour range that is not off-hours
SENSITIVE_QUERY_PATTERNS = ["%password%", "%secret%", "%ssn%"]
LARGE_EXPORT_ROWS = 1000000
QUERY_LOOKBACK_DAYS = 7

ADMIN_ROLES = ["SYSADMIN", "ACCOUNTADMIN"]
REVIEW_ROLE = "ACCOUNTADMIN"
ADMIN_UNUSED_DAYS = 30
USER_INACTIVE_DAYS = 90

# Sensitive column name → class, case-insensitive LIKE, first match wins.
SENSITIVE_COLUMN_RULES = [
    ("PII_EMAIL", ["%email%"]),
    ("PII_PHONE", ["%phone%"]),
    ("PII_SSN", ["%ssn%"]),
    ("CREDENTIAL", ["%password%"]),
    ("CREDENTIAL", ["%secret%"]),
    ("PII_ADDRESS", ["%address%"]),
    ("PII_DOB", ["%dob%"]),
    ("PII_DOB", ["%birth%"]),
    ("PII_PAYMENT", ["%credit_card%"]),
    ("PII_FINANCIAL", ["%salary%"]),
    ("PII_FINANCIAL", ["%income%"]),
]
NOT_SENSITIVE = "NOT_SENSITIVE"
PROTECTED_COLUMN_PATTERNS = ["%email%", "%phone%", "%ssn%", "%address%"]
PROTECTED = "PROTECTED"
EXPOSED = "EXPOSED - ACTION REQUIRED"
EXCLUDED_SCHEMA = "INFORMATION_SCHEMA"

HEALTH_GREEN = "GREEN - No issues detected"
HEALTH_AMBER = "AMBER - Issues require attention"
HEALTH_RED = "RED - Immediate action required"

# --- Fixed values: outliers --------------------------------------------------

Z_THRESHOLD = 2.0
OUTLIER_LABEL = "statistical_outlier"

# --- Fixed values: brief -----------------------------------------------------

TOP_THREATS = 5
TOP_ECOSYSTEMS = 3
CHRONIC_ACTION_MIN = 10        # action when chronic count > this
ECOSYSTEM_ACTION_MIN = 5       # action when top ecosystem critical count > this

# --- Fixed values: drift -----------------------------------------------------

PLAN_SUMMARY_PATTERN = r"Plan:\s*(\d+) to add,\s*(\d+) to change,\s*(\d+) to destroy"
PLAN_RESOURCE_PATTERN = r"^\s*[#~+\-]\s+([\w.]+)\s+will be"
PLAN_EXIT_ERROR = 1
PLAN_EXIT_DRIFT = 2

# --- Fixed values: ingest ----------------------------------------------------

REST_SOURCE = "github_rest"
UNKNOWN_ID = "UNKNOWN"
PAGE_SIZE = 100

# --- Fixed values: history snapshots (key, checked columns) -----------------

SNAP_TIME = "snapshotted_at"
SNAP_ECOSYSTEM_KEY = "ecosystem_name"
SNAP_ECOSYSTEM_CHECKS = ["total_vulnerabilities", "critical_count", "avg_risk_score", "max_risk_score"]
SNAP_ECOSYSTEM_COLUMNS = ["ecosystem_name", "total_vulnerabilities", "critical_count", "high_count",
                          "avg_risk_score", "max_risk_score"]
SNAP_HEALTH_KEY = "source_table"
SNAP_HEALTH_CHECKS = ["pipeline_status", "total_rows", "hours_since_last_load"]
SNAP_HEALTH_COLUMNS = ["source_table", "pipeline_status", "total_rows", "rows_last_24h", "rows_last_7d",
                       "hours_since_last_load", "is_fresh", "is_row_count_normal", "last_ingested_at"]
SNAP_PII_CHECKS = ["exposure_status", "pii_classification"]
SNAP_PII_COLUMNS = ["table_name", "column_name", "pii_classification", "exposure_status", "checked_at"]

# --- Fixed values: declared data tests (model → columns) ---------------------

NOT_NULL_TESTS = {
    "stg_github_advisories": ["advisory_id", "severity", "published_at"],
    "int_vulnerabilities_enriched": ["advisory_id", "age_bucket", "age_risk_multiplier",
                                     "vulnerability_category", "composite_risk_score"],
    "mart_vulnerability_summary": ["severity", "age_bucket", "vulnerability_category", "total_count"],
    "mart_ecosystem_risk": ["ecosystem_name", "total_vulnerabilities"],
    "mart_critical_vulnerabilities": ["advisory_id", "severity", "cvss_score", "composite_risk_score"],
    "mart_pipeline_health": ["source_table", "last_ingested_at", "pipeline_status"],
}
UNIQUE_TESTS = {
    "stg_github_advisories": "advisory_id",
    "int_vulnerabilities_enriched": "advisory_id",
    "mart_ecosystem_risk": "ecosystem_name",
    "mart_critical_vulnerabilities": "advisory_id",
}
ACCEPTED_TESTS = {
    "stg_github_advisories": ("severity", SEVERITIES),
    "int_vulnerabilities_enriched": ("age_bucket", AGE_LABELS),
    "mart_pipeline_health": ("pipeline_status", HEALTH_STATUSES),
}
