"""One full cycle: RAW → staged → enriched → marts → checks → outliers →
brief → drift → history, written to the session catalog.

This is the command-line run of the surveyed system as a sequence of Spark
jobs. ``enriched`` is written once as a table (it feeds three marts), every
mart is written once, and later steps read the written tables, so no step
recomputes an earlier one. Only one-row results and the bounded brief
touch the driver (for the returned summary of counts).
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import ts_ntz
from ..operators import brief as B
from ..operators import drift as D
from ..operators import history as N
from ..operators import marts as M
from ..operators import outliers as Z
from ..operators import quality as K
from ..operators import security as SEC
from ..operators import staging as T
from ..sources import parts as P
from ..sources import tables as TB

log = logging.getLogger(__name__)


def _snapshot(spark: SparkSession, name: str, current: DataFrame, key: str, checks: list[str],
              as_of: _dt.datetime) -> None:
    """Apply a check-strategy snapshot to the stored history ``name``.

    The snapshot must be unique on its key (checked first: a duplicate key
    would open two versions at once). The history grows by its changes (``parts.snapshot_parts``).
    """
    dups = K.expect_unique(current, key, name).first().failures
    if dups:
        raise K.ContractError(f"{name}: {dups} duplicate values of {key} in the snapshot")
    P.snapshot_parts(spark, TB.parts_path(spark, name), current, key, checks, as_of)
    TB.parts_view(spark, name, [*current.columns, N.VALID_FROM, N.VALID_TO, N.SCD_ID])


def run_cycle(spark: SparkSession, raw: DataFrame, as_of: _dt.datetime,
              packages: DataFrame | None = None,
              query_log: DataFrame | None = None, grants: DataFrame | None = None,
              logins: DataFrame | None = None, columns: DataFrame | None = None,
              plan_logs: DataFrame | None = None, brief_path: str | None = None,
              skip_anomaly: bool = False, skip_brief: bool = False, skip_drift: bool = False) -> dict:
    """Run the cycle once for ``as_of``; returns a few one-row facts."""
    for layer in ("intermediate", "marts", "monitoring", "security", "snapshots"):
        TB.ensure_schema(spark, layer)

    staged = T.stage_advisories(raw, as_of.date())
    # bucketed like the RAW table (by advisory id), so the package join is co-located
    buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), "advisory_id")
    enriched = TB.materialize(T.enrich_vulnerabilities(staged), "intermediate", "int_vulnerabilities_enriched",
                              bucket_by=buckets)
    if packages is None:
        packages = M.explode_packages(raw)

    # contracts: names/types checked before writing, NULLs counted by the write; nothing is read for them
    critical = TB.materialize(M.mart_critical(enriched), "marts", "mart_critical_vulnerabilities",
                              contract=K.ObservedContract(K.CRITICAL_CONTRACT, "mart_critical_vulnerabilities"))
    summary = TB.materialize(M.mart_summary(enriched), "marts", "mart_vulnerability_summary")
    eco = TB.materialize(M.mart_ecosystem_risk(enriched, packages), "marts", "mart_ecosystem_risk")
    health = TB.materialize(M.pipeline_health(raw, "RAW_GITHUB_ADVISORIES", "ingested_at", as_of), "monitoring",
                            "mart_pipeline_health", contract=K.ObservedContract(K.HEALTH_CONTRACT, "mart_pipeline_health"))

    checks = K.declared_tests({
        "stg_github_advisories": staged, "int_vulnerabilities_enriched": enriched,
        "mart_vulnerability_summary": summary, "mart_ecosystem_risk": eco,
        "mart_critical_vulnerabilities": critical, "mart_pipeline_health": health})
    TB.append_run(checks, "monitoring.dq_results", as_of)
    TB.append_run(K.freshness(raw, "RAW_GITHUB_ADVISORIES", "ingested_at", as_of), "monitoring.source_freshness",
                  as_of)

    if not skip_anomaly:
        TB.append_run(Z.summary_anomalies(summary, as_of), "security.vulnerability_anomalies", as_of)

    brief = B.threat_brief(summary, critical, eco, health, as_of)
    if not skip_brief:
        TB.append_run(brief, "security.threat_briefs", as_of)
        if brief_path:
            TB.write_text(brief, f"{brief_path}/threat_brief_{as_of.date().isoformat()}")

    if plan_logs is not None and not skip_drift:
        TB.append_run(D.drift_records(plan_logs), "security.infrastructure_drift", as_of)
        if {"run_id", "environment"} <= set(plan_logs.columns):
            # a plan run read again in a later cycle is one run
            stored = spark.table("security.infrastructure_drift").select(
                "environment", "checked_at", "run_id", "drift_detected").distinct()
            TB.materialize(D.drift_episodes(stored), "security", "drift_episodes")

    taken = ts_ntz(as_of).alias(R.SNAP_TIME)
    _snapshot(spark, "snapshots.snap_ecosystem_risk", eco.select(*R.SNAP_ECOSYSTEM_COLUMNS, taken),
              R.SNAP_ECOSYSTEM_KEY, R.SNAP_ECOSYSTEM_CHECKS, as_of)
    _snapshot(spark, "snapshots.snap_pipeline_health", health.select(*R.SNAP_HEALTH_COLUMNS, taken),
              R.SNAP_HEALTH_KEY, R.SNAP_HEALTH_CHECKS, as_of)

    facts = {}
    if query_log is not None and grants is not None and logins is not None and columns is not None:
        exposure = TB.materialize(SEC.pii_exposure(columns, as_of), "security", "sec_pii_exposure")
        anomalous = TB.materialize(SEC.anomalous_queries(query_log, as_of), "security", "sec_anomalous_queries")
        roles = TB.materialize(SEC.role_audit(grants, logins, as_of.date()), "security", "sec_role_audit")
        TB.materialize(SEC.security_summary(anomalous, roles, exposure, as_of), "security", "sec_summary")
        # the key adds the schema so same-named tables in two schemas do not collide
        pii = exposure.select(F.concat_ws("|", "column_name", "table_name", "schema_name").alias("pii_key"),
                              *R.SNAP_PII_COLUMNS)
        _snapshot(spark, "snapshots.sec_pii_snapshot", pii, "pii_key", R.SNAP_PII_CHECKS, as_of)
        facts["security"] = spark.table("security.sec_summary").first().asDict()

    written = (spark.table("security.threat_briefs").where(F.col("run_at") == ts_ntz(as_of))
               if not skip_brief else brief)       # read back what was written instead of recomputing
    row = written.select("cve_count", "critical_count", "top_ecosystem", "pipeline_status").first()
    facts.update(row.asDict())
    if not skip_anomaly:
        facts["anomalies"] = spark.table("security.vulnerability_anomalies").where(
            F.col("detected_at") == ts_ntz(as_of)).count()
    log.info("cycle %s: %s", as_of, facts)
    return facts
