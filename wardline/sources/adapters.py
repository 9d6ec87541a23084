"""Driver tables → the input schemas the operators take.

The test data is a TPC-H-like star schema plus an event log. Each function
here derives one input of the security workloads from those tables with
plain column expressions, so its size grows with the scale factor. Nothing is
sampled or capped. The same derivations are written in SQL in
``wardline.plans.oracles`` so DuckDB can check every result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as S
from ..functions.columns import word
from ..plans.layout import spread

# Fixture vocabularies (our own test inputs, not rules of the workload).
SUMMARY_WORDS = ["SQL Injection", "Remote code", "Resource use", "Privilege gain",
                 "Role escalation", "Info disclosure", "Data exposure", "Memory leak",
                 "Filter bypass", "Authentication gap", "Dir traversal", "Open path",
                 "Plain bug", "Crash"]
PACKAGE_ECOSYSTEMS = ["pip", "npm", "go", "maven", ""]
QUERY_TEXTS = ["select 1", "select Password from t", "select name", "select ssn"]
GRANT_ROLES = ["SYSADMIN", "ACCOUNTADMIN", "REPORTER", "ANALYST"]
COLUMN_NAMES = ["email", "home_phone", "ssn", "password", "secret_key", "address", "dob",
                "birth_date", "credit_card", "creditXcard", "salary", "income", "name", "size"]
COLUMN_SCHEMAS = ["RAW", "STAGING", "MARTS", "SECURITY", "INFORMATION_SCHEMA"]
DATA_TYPES = ["VARCHAR", "NUMBER", "DATE", "BOOLEAN"]
# Ecosystem list order for the ingest operators over events (rank = position).
EVENT_ECOSYSTEMS = ["view", "click", "purchase", "signup", "error"]

ORDERS_AS_OF = _dt.date(2001, 8, 15)
EVENTS_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
# Upsert / history fixtures: the target was loaded up to the first cutoff,
# the incoming batch re-fetches everything updated since the second.
TARGET_LOADED_BEFORE = _dt.date(2000, 1, 1)
BATCH_UPDATED_SINCE = _dt.date(1999, 7, 1)
HISTORY_FIRST_AS_OF = _dt.date(2000, 12, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ advisories

def _raw_advisory_columns() -> list[str]:
    """The RAW advisory columns as Spark SQL expressions over ``orders``."""
    return [
        "concat('ADV-', CAST(o_orderkey AS STRING)) AS ghsa_id",
        "CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE concat('CVE-', CAST(year(o_orderdate) AS STRING),"
        " '-', CAST(o_orderkey AS STRING)) END AS cve_id",
        f"concat({S.word('o_custkey', SUMMARY_WORDS, S.SPARK)}, ' in module ', CAST(o_custkey AS STRING)) AS summary",
        "concat('status ', o_orderstatus) AS description",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'"
        " WHEN '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS severity",
        "CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE)"
        " ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS DOUBLE) / CAST(10 AS DOUBLE) END AS cvss_score",
        "CAST(NULL AS STRING) AS cvss_vector_string",
        "o_orderdate AS published_at",
        "o_orderdate AS updated_at",
        "CASE WHEN o_orderkey % 29 = 0 THEN o_orderdate END AS withdrawn_at",
        "concat('https://advisories.example/ADV-', CAST(o_orderkey AS STRING)) AS html_url",
        "CAST(0 AS BIGINT) AS credits_count",
        "'github_rest' AS source_api",
        "o_orderdate AS ingested_at",
    ]


def raw_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW advisory rows (one per order), the surveyed column names, lower case."""
    return table(spark, sf_dir, "orders").selectExpr(*_raw_advisory_columns())


def advisory_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected packages in long form: one row per (advisory, package).

    This is what flattening the advisory's package array yields; it is built
    by a join (lineitem → part) rather than by collecting arrays per order, so
    no group is ever gathered into one row.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.concat(F.lit("ADV-"), F.col("l_orderkey").cast("string")).alias("ghsa_id"),
                    word("p_size", PACKAGE_ECOSYSTEMS).alias("ecosystem"),
                    F.col("p_name").alias("package_name")))


def advisory_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed REST advisory documents (one JSON text per order).

    Each document carries two affected packages taken from the order's own
    columns, so the nested arrays exist without any grouping.
    """
    o = spread(table(spark, sf_dir, "orders")).selectExpr(*_raw_advisory_columns(), "o_orderkey", "o_custkey")
    key = F.col("o_orderkey")
    vulns = F.array(
        F.struct(F.struct(word("o_custkey", PACKAGE_ECOSYSTEMS).alias("ecosystem"),
                          F.concat(F.lit("pkg"), F.col("o_custkey").cast("string")).alias("name")
                          ).alias("package")),
        F.struct(F.struct(word(key, PACKAGE_ECOSYSTEMS).alias("ecosystem"),
                          F.concat(F.lit("lib"), key.cast("string")).alias("name")
                          ).alias("package")))
    doc = F.struct(
        F.col("ghsa_id"), F.col("cve_id"), F.col("summary"), F.col("description"),
        F.col("severity"),
        F.when(F.col("cvss_score").isNotNull(),
               F.struct(F.col("cvss_score").alias("score"),
                        F.concat(F.lit("CVSS:3.1/AV:N/S:"), F.col("severity")).alias("vector_string"))
               ).alias("cvss"),
        F.when(key % 3 == 0, F.array(F.struct(F.lit("CWE-79").alias("cwe_id")))).alias("cwes"),
        F.when(key % 5 != 0, vulns).alias("vulnerabilities"),
        F.when(key % 4 == 0, F.array(F.struct(F.lit("finder").alias("login")),
                                     F.struct(F.lit("fixer").alias("login")))).alias("credits"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.when(key % 13 == 0, F.lit("unknown"))
        .otherwise(F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("updated_at"),
        F.date_format("withdrawn_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("withdrawn_at"),
        F.col("html_url"),
    )
    return o.select(F.col("ghsa_id").alias("doc_id"), F.to_json(doc).alias("json"))


def repeated_advisory_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed documents with what a feed adds: each a second time as an older version with a time zone and
    another severity, some without an id, and one broken document for every fourth."""
    docs = advisory_json(spark, sf_dir).select("doc_id", "json")
    number = F.substring("doc_id", 5, 20).cast("long")
    older = F.regexp_replace("json", '"updated_at":"[^"]*"', '"updated_at":"1990-01-01T00:30:00+05:30"')
    older = F.regexp_replace(older, '"severity":"[A-Z]*"', '"severity":"CRITICAL"')
    broken = F.when(number % 4 == 0, F.expr("substring(json, 1, length(json) - 1)"))
    nameless = F.when(number % 3 == 0, F.regexp_replace("json", '"ghsa_id":"[^"]*",', ""))
    each = F.array(F.col("json"), older, broken, nameless)
    return docs.select(F.explode(F.filter(each, lambda j: j.isNotNull())).alias("json"))


def cve_page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CVE result pages: one page per order holding two CVE items.

    Pages of even orders wrap each item as ``{"cve": {...}}``; odd ones hold
    bare items. The second item of every page carries a ``-R`` id suffix.
    """
    o = spread(table(spark, sf_dir, "orders"))

    def item(suffix: str):
        return F.struct(
            F.concat(F.lit("CVE-"), F.year("o_orderdate").cast("string"), F.lit("-"),
                     F.col("o_orderkey").cast("string"), F.lit(suffix)).alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("published"),
            F.col("o_orderstatus").alias("vulnStatus"))

    wrapped = F.array(F.struct(item("").alias("cve")), F.struct(item("-R").alias("cve")))
    bare = F.array(item(""), item("-R"))
    page = lambda items: F.to_json(F.struct(F.lit(2).alias("totalResults"),
                                            items.alias("vulnerabilities")))
    return o.select(
        F.col("o_orderkey").alias("page_id"),
        F.when(F.col("o_orderkey") % 2 == 0, page(wrapped)).otherwise(page(bare)).alias("json"),
        F.col("o_orderdate").alias("fetched_at"))


def graphql_page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed GraphQL result pages: one page per order holding two advisory nodes."""
    o = spread(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey").cast("string")

    def node(suffix: str, severity):
        return F.struct(F.concat(F.lit("ADV-"), k, F.lit(suffix)).alias("ghsaId"),
                        severity.alias("severity"),
                        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updatedAt"))

    page = F.struct(F.struct((F.col("o_orderkey") % 2 == 0).alias("hasNextPage"),
                             F.concat(F.lit("c"), k).alias("endCursor")).alias("pageInfo"),
                    F.array(node("", F.col("o_orderpriority")), node("-R", F.lit("LOW"))).alias("nodes"))
    return o.select(F.col("o_orderkey").alias("page_id"), F.to_json(page).alias("json"),
                    F.col("o_orderdate").alias("fetched_at"))


# ------------------------------------------------------------------ ingest lists

def advisory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged advisory listings per ecosystem, from the event log.

    event_type plays the ecosystem, event_id the position in the listing,
    user_id the advisory id; severity is derived from the event value.
    """
    e = table(spark, sf_dir, "events")
    sev = (F.when(F.col("value") >= 300, "CRITICAL")
           .when(F.col("value") >= 100, "High")
           .when(F.col("value") >= 20, "moderate")
           .otherwise("low"))
    return e.select(
        F.col("event_type").alias("ecosystem"),
        F.col("event_id").alias("position"),
        F.concat(F.lit("ADV-"), F.col("user_id").cast("string")).alias("ghsa_id"),
        F.when(F.col("props").contains("\"k\": 0}"), F.lit(None).cast("string"))
        .otherwise(sev).alias("severity"),
        F.col("ts").alias("updated_at"),
    )


# ------------------------------------------------------------------ security logs

def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("query_id"),
        F.col("user_id").cast("string").alias("user_name"),
        F.upper(F.col("event_type")).alias("role_name"),
        word("user_id", QUERY_TEXTS).alias("query_text"),
        F.floor(F.col("value") * 20000000).cast("long").alias("bytes_scanned"),
        F.floor(F.col("value") * 5000).cast("long").alias("rows_produced"),
        F.col("ts").alias("start_time"),
        F.lit("SUCCESS").alias("execution_status"),
    )


def grants_to_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_name").alias("grantee_name"),
        word("c_nationkey", GRANT_ROLES).alias("role"),
        F.lit("SECURITYADMIN").alias("granted_by"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_on"),
    )


def login_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("c_name").alias("user_name"),
                    F.col("o_orderdate").alias("event_timestamp"),
                    F.when(F.col("o_orderstatus") == "P", "NO").otherwise("YES").alias("is_success")))


def column_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A warehouse column inventory (information-schema shape), from part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.lit("ANALYTICS").alias("table_catalog"),
        word("p_size", COLUMN_SCHEMAS).alias("table_schema"),
        F.col("p_type").alias("table_name"),
        F.concat(word("p_partkey", COLUMN_NAMES), F.lit("_"),
                 F.col("p_partkey").cast("string")).alias("column_name"),
        word("p_partkey", DATA_TYPES).alias("data_type"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("phone"),
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("ssn"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main Street")).alias("address"),
    )


# ------------------------------------------------------------------ plan logs

def plan_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terraform-plan outputs, one run per order; exit code = orderkey % 3."""
    o = spread(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    nl = F.lit("\n")
    res1 = F.concat(F.lit("  # m.t"), c.cast("string"), F.lit(" will be created"))
    res2 = F.concat(F.lit("  ~ m.u"), (k % 4).cast("string"), F.lit(" will be updated in-place"))
    res3 = F.concat(F.lit("  # m.q[\"k"), (k % 3).cast("string"), F.lit("\"] will be destroyed"))
    summary = F.concat(F.lit("Plan: "), (c % 5).cast("string"), F.lit(" to add, "),
                       (k % 4).cast("string"), F.lit(" to change, "),
                       (k % 2).cast("string"), F.lit(" to destroy."))
    text = (F.when(F.col("o_orderstatus") == "F",
                   F.lit("No changes. Your infrastructure matches the configuration."))
            .otherwise(F.concat(F.lit("Terraform will perform the following actions:"), nl, nl,
                                res1, nl, res2, nl, res3, nl, res1, nl, nl, summary)))
    return o.select(
        k.alias("run_id"),
        (k % 3).cast("int").alias("exit_code"),
        text.alias("stdout"),
        F.col("o_orderdate").alias("checked_at"),
        (c % 10).cast("string").alias("environment"),
    )


# ------------------------------------------------------------------ history

def customer_order_stats(spark: SparkSession, sf_dir: str, up_to: _dt.date | None,
                         since: _dt.date | None = None) -> DataFrame:
    """Per-customer order count and max price, optionally up to or from a date."""
    o = table(spark, sf_dir, "orders")
    if since is not None:
        o = o.where(F.col("o_orderdate") >= F.lit(since.isoformat()).cast("timestamp_ntz"))
    if up_to is not None:
        o = o.where(F.col("o_orderdate") <= F.lit(up_to.isoformat()).cast("timestamp_ntz"))
    return (o.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.max("o_totalprice").alias("max_price"),
                 F.max("o_orderdate").alias("last_order_date"))
            .withColumnRenamed("o_custkey", "custkey"))
