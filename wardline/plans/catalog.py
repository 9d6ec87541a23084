"""Query catalog: one callable per query key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables in full (through the adapters) and then
runs the operators of the package on them. Parameters (as-of times, ecosystem
lists, caps) are the fixed fixture values of ``wardline.sources.adapters``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import rules as R
from ..functions.columns import ts_ntz
from ..operators import brief as B
from ..operators import drift as D
from ..operators import history as N
from ..operators import ingest as I
from ..operators import landing as LA
from ..operators import marts as M
from ..operators import outliers as Z
from ..operators import quality as K
from ..operators import security as SEC
from ..operators import staging as T
from ..operators import upsert as U
from ..sources import adapters as A
from ..sources import landing as L
from ..sources import parts as P
from .layout import new_folder, written

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_AS_OF_TS = _dt.datetime.combine(A.ORDERS_AS_OF, _dt.time())
Z_DIGITS = 6
LOW_Z = 1.5                    # some advisories of the fixture stand out this far, none at the usual bound
# Fetch settings of the ingest run: ecosystems in list order, severities, pages.
FETCH_SEVERITIES = ["critical", "high"]
FETCH_PAGES = 2
WINDOW_LO = _dt.date(1997, 1, 1)
WINDOW_HI = _dt.date(1997, 12, 31)
AS_OF_READ = _dt.date(2001, 1, 15)
UPSERT_PARTS = 16
FIRST_POSITIONS = 100_000


# ------------------------------------------------------------------ advisories

def staged(spark: SparkSession, d: str) -> DataFrame:
    return T.stage_advisories(A.raw_advisories(spark, d), A.ORDERS_AS_OF)


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return T.enrich_vulnerabilities(staged(spark, d))


def critical(spark: SparkSession, d: str) -> DataFrame:
    return M.mart_critical(enriched(spark, d))


def summary(spark: SparkSession, d: str) -> DataFrame:
    return M.mart_summary(enriched(spark, d))


def ecosystem_risk(spark: SparkSession, d: str) -> DataFrame:
    return M.mart_ecosystem_risk(enriched(spark, d), A.advisory_packages(spark, d))


def advisory_health(spark: SparkSession, d: str) -> DataFrame:
    return M.pipeline_health(A.raw_advisories(spark, d), "RAW_GITHUB_ADVISORIES", "ingested_at",
                             ORDERS_AS_OF_TS)


def events_health(spark: SparkSession, d: str) -> DataFrame:
    return M.pipeline_health(A.table(spark, d, "events"), "events", "ts", A.EVENTS_AS_OF)


# ------------------------------------------------------------------ landing

def flattened(spark: SparkSession, d: str) -> DataFrame:
    return L.flatten_advisories(A.advisory_json(spark, d), ORDERS_AS_OF_TS)


def flatten_view(spark: SparkSession, d: str) -> DataFrame:
    f = flattened(spark, d)
    return f.select(
        "ghsa_id", "cve_id", "summary", "description", "severity", "cvss_score", "cvss_vector_string",
        F.size(F.from_json("cwes", "array<string>")).cast("long").alias("cwe_count"),
        F.size(F.from_json("affected_packages", "array<string>")).cast("long").alias("package_count"),
        "published_at", "updated_at", "withdrawn_at", "html_url", "credits_count", "source_api",
        "ingested_at")


def exploded_packages(spark: SparkSession, d: str) -> DataFrame:
    e = M.explode_packages(flattened(spark, d))
    return e.where(F.col("ecosystem").isNotNull() & (F.col("ecosystem") != ""))


def typed_view(spark: SparkSession, d: str) -> DataFrame:
    t = L.typed_advisories(L.parse_documents(A.advisory_json(spark, d)), ORDERS_AS_OF_TS)
    return t.select(
        "ghsa_id", "published_at", "updated_at", "withdrawn_at", "ingested_at",
        F.variant_get("affected_packages", "$[0].package.ecosystem", "string").alias("first_ecosystem"),
        F.variant_get("cwes", "$[0].cwe_id", "string").alias("first_cwe"),
        F.variant_get("raw_json", "$.cvss.score", "double").alias("raw_cvss_score"))


def cve_items(spark: SparkSession, d: str) -> DataFrame:
    return L.unwrap_cves(A.cve_page_json(spark, d))


def cve_item_view(spark: SparkSession, d: str) -> DataFrame:
    return cve_items(spark, d).select(
        "cve_id", F.get_json_object("record", "$.published").alias("published"),
        F.get_json_object("record", "$.vulnStatus").alias("vuln_status"), "fetched_at")


def node_view(spark: SparkSession, d: str) -> DataFrame:
    return L.unwrap_nodes(A.graphql_page_json(spark, d)).select(
        "ghsa_id", F.get_json_object("record", "$.severity").alias("severity"), "fetched_at")


# ------------------------------------------------------------------ ingest

def listing(spark: SparkSession, d: str) -> DataFrame:
    return I.ecosystem_listing(A.advisory_listing(spark, d), A.EVENT_ECOSYSTEMS)


def severity_filtered(spark: SparkSession, d: str) -> DataFrame:
    return I.filter_in_ci(listing(spark, d), "severity", FETCH_SEVERITIES)


def capped(spark: SparkSession, d: str) -> DataFrame:
    return I.cap_per_group(listing(spark, d), "ecosystem", ["position"], FETCH_PAGES * R.PAGE_SIZE)


def fetched(spark: SparkSession, d: str) -> DataFrame:
    return I.fetch_advisories(A.advisory_listing(spark, d), A.EVENT_ECOSYSTEMS, FETCH_SEVERITIES)


def landed(spark: SparkSession, d: str) -> DataFrame:
    typed, _ = LA.land_advisories(A.repeated_advisory_json(spark, d), ORDERS_AS_OF_TS, FETCH_SEVERITIES)
    return typed.select("ghsa_id", "cve_id", "severity", "cvss_score", "published_at", "updated_at", "withdrawn_at")


def landing_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = LA.land_advisories(A.repeated_advisory_json(spark, d), ORDERS_AS_OF_TS, FETCH_SEVERITIES)
    return rejects.select(F.regexp_extract("raw_json", '"ghsa_id":"([^"]*)"', 1).alias("named"), "reject_reason")


def upsert_target(spark: SparkSession, d: str) -> DataFrame:
    raw = A.raw_advisories(spark, d)
    return raw.where(F.col("updated_at") < F.lit(A.TARGET_LOADED_BEFORE.isoformat()).cast("timestamp_ntz"))


def upsert_batch(spark: SparkSession, d: str) -> DataFrame:
    """Re-fetched advisories: everything updated since a date, with new scores."""
    raw = I.since(A.raw_advisories(spark, d), "updated_at", A.BATCH_UPDATED_SINCE)
    bumped = F.when(F.col("cvss_score").isNotNull(), F.least(F.col("cvss_score") + 1.0, F.lit(10.0)))
    return (raw.withColumn("cvss_score", bumped)
            .withColumn("ingested_at", F.lit(ORDERS_AS_OF_TS.isoformat(" ")).cast("timestamp_ntz")))


def upsert_merged(spark: SparkSession, d: str) -> DataFrame:
    """The target stored in parts, the batch upserted into it, and what is stored then."""
    path = new_folder(spark, "upsert-target")
    target = upsert_target(spark, d)
    for batch in (target, upsert_batch(spark, d)):
        P.upsert_parts(spark, path, batch, "ghsa_id", parts=UPSERT_PARTS, dedupe_order=["updated_at", "ingested_at"])
    stored = T_.StructType([*target.schema.fields, T_.StructField(P.KEY_PART, T_.IntegerType())])
    return P.read_parts(spark, path, stored, [P.KEY_PART]).drop(P.KEY_PART)


def records_merged(spark: SparkSession, d: str) -> DataFrame:
    pages = A.cve_page_json(spark, d)
    cutoff = F.lit(A.TARGET_LOADED_BEFORE.isoformat()).cast("timestamp_ntz")
    since = F.lit(A.BATCH_UPDATED_SINCE.isoformat()).cast("timestamp_ntz")
    target = (L.unwrap_cves(pages.where(F.col("fetched_at") < cutoff))
              .select("cve_id", "record", "fetched_at", F.col("fetched_at").alias("loaded_at")))
    batch = L.unwrap_cves(pages.where(F.col("fetched_at") >= since))
    merged = U.upsert_records(target, batch, "cve_id", ORDERS_AS_OF_TS)
    return merged.select("cve_id", F.get_json_object("record", "$.vulnStatus").alias("vuln_status"),
                         "fetched_at", "loaded_at")


# ------------------------------------------------------------------ security

def anomalous(spark: SparkSession, d: str) -> DataFrame:
    return SEC.anomalous_queries(A.query_history(spark, d), A.EVENTS_AS_OF)


def roles(spark: SparkSession, d: str) -> DataFrame:
    return SEC.role_audit(A.grants_to_users(spark, d), A.login_history(spark, d), A.ORDERS_AS_OF)


def exposure(spark: SparkSession, d: str) -> DataFrame:
    return SEC.pii_exposure(A.column_listing(spark, d), A.EVENTS_AS_OF)


def sec_summary(spark: SparkSession, d: str) -> DataFrame:
    return SEC.security_summary(anomalous(spark, d), roles(spark, d), exposure(spark, d), A.EVENTS_AS_OF)


# ------------------------------------------------------------------ outliers

def summary_outliers(spark: SparkSession, d: str) -> DataFrame:
    return Z.summary_anomalies(summary(spark, d), ORDERS_AS_OF_TS, digits=Z_DIGITS)


# ------------------------------------------------------------------ brief

def brief_facts(spark: SparkSession, d: str) -> DataFrame:
    e = written(enriched(spark, d), "enriched")
    return B.brief_facts(M.mart_summary(e), M.mart_ecosystem_risk(e, A.advisory_packages(spark, d)),
                         advisory_health(spark, d))


def threat_brief(spark: SparkSession, d: str) -> DataFrame:
    e = written(enriched(spark, d), "enriched")
    eco = written(M.mart_ecosystem_risk(e, A.advisory_packages(spark, d)), "ecosystem-risk")
    return B.threat_brief(M.mart_summary(e), M.mart_critical(e), eco, advisory_health(spark, d), ORDERS_AS_OF_TS)


# ------------------------------------------------------------------ drift

def drift(spark: SparkSession, d: str) -> DataFrame:
    return D.drift_records(A.plan_logs(spark, d))


# ------------------------------------------------------------------ history

HISTORY_KEY = "custkey"
HISTORY_CHECKS = ["order_count", "max_price"]


def _stored(spark: SparkSession, snapshots: list[tuple[DataFrame, object]], key: str, checks: list[str],
            invalidate_hard_deletes: bool = False) -> DataFrame:
    """The history that these snapshots (rows, time) leave in storage, read back."""
    path = new_folder(spark, "history")
    for rows, at in snapshots:
        P.snapshot_parts(spark, path, rows, key, checks, at, invalidate_hard_deletes)
    return P.history_parts(spark, path, N.scd2_initial(snapshots[0][0], key, snapshots[0][1]).schema)


def history(spark: SparkSession, d: str) -> DataFrame:
    return _stored(spark, [(A.customer_order_stats(spark, d, A.HISTORY_FIRST_AS_OF), A.HISTORY_FIRST_AS_OF),
                           (A.customer_order_stats(spark, d, None), A.ORDERS_AS_OF)], HISTORY_KEY, HISTORY_CHECKS)


def history_with_deletes(spark: SparkSession, d: str) -> DataFrame:
    """The later snapshot holds only customers with an order since a date; the others' rows are closed."""
    return _stored(spark, [(A.customer_order_stats(spark, d, A.HISTORY_FIRST_AS_OF), A.HISTORY_FIRST_AS_OF),
                           (A.customer_order_stats(spark, d, None, since=A.BATCH_UPDATED_SINCE), A.ORDERS_AS_OF)],
                   HISTORY_KEY, HISTORY_CHECKS, invalidate_hard_deletes=True)


def _two_snapshots(first: DataFrame, now: DataFrame, key: str, checks: list[str]) -> DataFrame:
    at = lambda df, when: (df.withColumn(R.SNAP_TIME, ts_ntz(when)), when)
    return _stored(now.sparkSession, [at(first, A.HISTORY_FIRST_AS_OF), at(now, A.ORDERS_AS_OF)], key, checks)


def snap_ecosystem(spark: SparkSession, d: str) -> DataFrame:
    """The ecosystem mart over the advisories published before a date, then over all of them."""
    e = written(enriched(spark, d), "enriched")
    packages = A.advisory_packages(spark, d)
    before = e.where(F.col("published_at") < ts_ntz(A.TARGET_LOADED_BEFORE))
    first, now = (M.mart_ecosystem_risk(x, packages).select(*R.SNAP_ECOSYSTEM_COLUMNS) for x in (before, e))
    return _two_snapshots(first, now, R.SNAP_ECOSYSTEM_KEY, R.SNAP_ECOSYSTEM_CHECKS)


def snap_health(spark: SparkSession, d: str) -> DataFrame:
    # one row each, written as in the cycle: the join on the source's name is then one of two columns, not of constants
    first, now = (written(M.pipeline_health(A.raw_advisories(spark, d), "RAW_GITHUB_ADVISORIES", "ingested_at", when)
                          .select(*R.SNAP_HEALTH_COLUMNS), "health")
                  for when in (_dt.datetime.combine(A.HISTORY_FIRST_AS_OF, _dt.time()), ORDERS_AS_OF_TS))
    return _two_snapshots(first, now, R.SNAP_HEALTH_KEY, R.SNAP_HEALTH_CHECKS)


def snap_exposure(spark: SparkSession, d: str) -> DataFrame:
    """The exposure list before and after every schema but RAW joined the inventory."""
    pii = exposure(spark, d).select(F.concat_ws("|", "column_name", "table_name", "schema_name").alias("pii_key"),
                                    "schema_name", *R.SNAP_PII_COLUMNS)
    first = pii.where(F.col("schema_name") == A.COLUMN_SCHEMAS[0])
    return _two_snapshots(first, pii, "pii_key", R.SNAP_PII_CHECKS)


# ------------------------------------------------------------------ quality

NOT_NULL_TESTS = R.NOT_NULL_TESTS
UNIQUE_TESTS = R.UNIQUE_TESTS
ACCEPTED_TESTS = R.ACCEPTED_TESTS


def models(spark: SparkSession, d: str, names) -> dict[str, DataFrame]:
    """The named models. The enriched table is written once if several marts are built from it, as the cycle does."""
    of_enriched = {"int_vulnerabilities_enriched", "mart_vulnerability_summary", "mart_ecosystem_risk",
                   "mart_critical_vulnerabilities"} & set(names)
    s = staged(spark, d)
    several = len(of_enriched - {"int_vulnerabilities_enriched"}) > 1
    e = written(T.enrich_vulnerabilities(s), "enriched") if several else T.enrich_vulnerabilities(s)
    build = {
        "stg_github_advisories": lambda: e.select(*s.columns) if several else s,     # enrichment keeps every staged row
        "int_vulnerabilities_enriched": lambda: e,
        "mart_vulnerability_summary": lambda: M.mart_summary(e),
        "mart_ecosystem_risk": lambda: M.mart_ecosystem_risk(e, A.advisory_packages(spark, d)),
        "mart_critical_vulnerabilities": lambda: M.mart_critical(e),
        "mart_pipeline_health": lambda: advisory_health(spark, d),
    }
    return {name: build[name]() for name in names}


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    m = models(spark, d, NOT_NULL_TESTS)
    return _union([K.expect_not_null(m[name], cols, name) for name, cols in NOT_NULL_TESTS.items()])


def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    m = models(spark, d, UNIQUE_TESTS)
    return _union([K.expect_unique(m[name], key, name) for name, key in UNIQUE_TESTS.items()])


def dq_accepted(spark: SparkSession, d: str) -> DataFrame:
    m = models(spark, d, ACCEPTED_TESTS)
    return _union([K.expect_in(m[name], col, vals, name) for name, (col, vals) in ACCEPTED_TESTS.items()])


def dq_listing(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of declared test over the advisory listing as it comes, which fails them."""
    listed = A.advisory_listing(spark, d).withColumn("severity", F.lower("severity"))
    return _union([K.expect_not_null(listed, ["ghsa_id", "severity", "updated_at"], "listing"),
                   K.expect_unique(listed, "ghsa_id", "listing"),
                   K.expect_in(listed, "severity", R.SEVERITIES, "listing")])


LISTING_CONTRACT = T_.StructType([T_.StructField("ghsa_id", T_.StringType(), False),
                                  T_.StructField("severity", T_.StringType(), False),
                                  T_.StructField("updated_at", T_.TimestampNTZType(), False)])


def dq_contract(spark: SparkSession, d: str) -> DataFrame:
    """NULLs under a contract, as the writes count them: a mart that keeps its contract, a listing that breaks its own."""
    found = []
    for model, rows, contract in (
            ("mart_critical_vulnerabilities", critical(spark, d), K.CRITICAL_CONTRACT),
            ("listing", A.advisory_listing(spark, d).select(*LISTING_CONTRACT.names), LISTING_CONTRACT)):
        watched = K.ObservedContract(contract, model)
        written(watched.watch(rows), model)
        found += [(model, column, n) for column, n in watched.nulls().items()]
    return spark.createDataFrame(found, "model string, column_name string, failures long")


def dq_freshness(spark: SparkSession, d: str) -> DataFrame:
    return K.freshness(A.table(spark, d, "events"), "events", "ts", A.EVENTS_AS_OF).unionByName(
        K.freshness(A.raw_advisories(spark, d), "RAW_GITHUB_ADVISORIES", "ingested_at", ORDERS_AS_OF_TS))


# ------------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {
    # sources
    "flatten_advisory_json": flatten_view,
    "explode_packages": exploded_packages,
    "unwrap_cve_pages": cve_item_view,
    "unwrap_advisory_nodes": node_view,
    "typed_load": typed_view,
    # ingest
    "severity_filter": severity_filtered,
    "cap_per_ecosystem": capped,
    "first_positions": lambda s, d: I.first_per_group(listing(s, d), "ecosystem", "position", FIRST_POSITIONS),
    "first_seen_dedupe": fetched,
    "incremental_since": lambda s, d: I.since(A.raw_advisories(s, d), "updated_at", A.BATCH_UPDATED_SINCE),
    "incremental_window": lambda s, d: I.between_optional(A.raw_advisories(s, d), "published_at",
                                                          WINDOW_LO, WINDOW_HI),
    "land_advisories": landed,
    "landing_rejects": landing_rejects,
    "upsert_merge": upsert_merged,
    "upsert_records": records_merged,
    # staging and marts
    "stage_advisories": staged,
    "enrich_vulnerabilities": enriched,
    "mart_critical": critical,
    "mart_summary": summary,
    "mart_ecosystem_risk": ecosystem_risk,
    "pipeline_health": events_health,
    # security audit
    "anomalous_queries": anomalous,
    "role_audit": roles,
    "pii_exposure": exposure,
    "masked_customers": lambda s, d: SEC.masked_view(A.customers(s, d), "REPORTER"),
    "security_summary": sec_summary,
    # outliers
    "zscore_outliers": lambda s, d: Z.group_value_outliers(A.table(s, d, "events"), "event_type", "user_id",
                                                           "value", digits=Z_DIGITS),
    "summary_anomalies": summary_outliers,
    "anomaly_counts": lambda s, d: Z.anomaly_counts(summary_outliers(s, d)),
    "advisory_outliers": lambda s, d: Z.advisory_outliers(enriched(s, d), A.advisory_packages(s, d),
                                                          ORDERS_AS_OF_TS, digits=Z_DIGITS),
    "advisory_outliers_low": lambda s, d: Z.advisory_outliers(enriched(s, d), A.advisory_packages(s, d),
                                                              ORDERS_AS_OF_TS, threshold=LOW_Z, digits=Z_DIGITS),
    # brief
    "brief_top_threats": lambda s, d: B.top_threats(critical(s, d)),
    "brief_top_ecosystems": lambda s, d: B.top_ecosystems(ecosystem_risk(s, d)),
    "brief_severity": lambda s, d: B.severity_rollup(summary(s, d)),
    "brief_age": lambda s, d: B.age_rollup(summary(s, d)),
    "brief_facts": brief_facts,
    "brief_actions": lambda s, d: B.brief_actions(brief_facts(s, d)),
    "threat_brief": threat_brief,
    # drift
    "drift_records": drift,
    "drift_episodes": lambda s, d: D.drift_episodes(drift(s, d)),
    # history
    "scd2_snapshot": history,
    "scd2_hard_deletes": history_with_deletes,
    "snap_ecosystem_risk": snap_ecosystem,
    "snap_pipeline_health": snap_health,
    "snap_pii_exposure": snap_exposure,
    "scd2_as_of": lambda s, d: N.as_of_view(history(s, d), AS_OF_READ),
    # quality
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted,
    "dq_listing": dq_listing,
    "dq_contract": dq_contract,
    "dq_freshness": dq_freshness,
}
