"""End-to-end cycle and command line, on the smallest driver tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from wardline.plans.cycle import run_cycle
from wardline.sources import adapters as A

from .conftest import SF_SMALL


def test_cycle_twice_builds_tables_and_history(spark, scratch):
    d = SF_SMALL
    raw = A.raw_advisories(spark, d)
    kw = dict(packages=A.advisory_packages(spark, d), query_log=A.query_history(spark, d),
              grants=A.grants_to_users(spark, d), logins=A.login_history(spark, d),
              columns=A.column_listing(spark, d), plan_logs=A.plan_logs(spark, d),
              brief_path=os.path.join(scratch, "briefs"))
    f1 = run_cycle(spark, raw, dt.datetime(2001, 8, 15), **kw)
    f2 = run_cycle(spark, raw, dt.datetime(2001, 9, 15), **kw)
    assert f1["cve_count"] == spark.table("intermediate.int_vulnerabilities_enriched").count() == 1448
    assert f1["pipeline_status"] == "stale"
    assert f1["security"]["security_health_status"].startswith("AMBER")
    # the summary mart adds up to the enriched rows
    assert spark.table("marts.mart_vulnerability_summary").agg(F.sum("total_count")).first()[0] == 1448
    # health history: the check columns changed (hours since load), so a second version opened
    snap = spark.table("snapshots.snap_pipeline_health")
    assert snap.count() == 2 and snap.where(F.col("valid_to").isNull()).count() == 1
    # ecosystem history: nothing changed between the runs but the ages, so scores moved or not;
    # either way each ecosystem has exactly one open version
    eco = spark.table("snapshots.snap_ecosystem_risk")
    assert eco.where(F.col("valid_to").isNull()).groupBy("ecosystem_name").count().where("count > 1").count() == 0
    assert spark.table("security.threat_briefs").count() == 2
    assert spark.table("security.infrastructure_drift").count() == 2 * A.plan_logs(spark, d).where(
        "exit_code != 1").count()
    assert os.path.isdir(os.path.join(scratch, "briefs", "threat_brief_2001-08-15"))
    # the stored plan runs of both cycles are the same runs: their episodes are those of one of them
    from wardline.operators.drift import drift_episodes, drift_records
    once = drift_episodes(drift_records(A.plan_logs(spark, d)))
    assert sorted(spark.table("security.drift_episodes").collect()) == sorted(once.collect())
    assert {"snapshotted_at"} <= set(snap.columns) and {"snapshotted_at"} <= set(eco.columns)
    assert f2["cve_count"] == f1["cve_count"]
    fresh = {r.run_at.month: r.status for r in spark.table("monitoring.source_freshness").collect()}
    assert fresh == {8: "error", 9: "error"}


def test_command_line_run(spark, scratch):
    from wardline.__main__ import main
    landing = os.path.join(scratch, "cli_landing")
    A.advisory_json(spark, SF_SMALL).select(F.col("json").alias("value")).write.text(landing)
    plans = os.path.join(scratch, "plans")
    A.plan_logs(spark, SF_SMALL).write.parquet(plans)
    facts = main(["--landing", landing, "--as-of", "2001-08-15T00:00:00", "--since", "1998-01-01",
                  "--plans", plans, "--skip-brief"])
    raw = spark.table("raw.raw_github_advisories")
    assert raw.where("lower(severity) NOT IN ('critical', 'high')").count() == 0
    assert raw.where("updated_at < TIMESTAMP_NTZ'1998-01-01 00:00:00'").count() == 0
    assert raw.count() > 0 and facts["cve_count"] <= raw.count()
    assert dict(raw.dtypes)["affected_packages"] == "variant"
    assert spark.table("marts.mart_ecosystem_risk").count() == 4


def test_rerun_of_same_cycle_is_idempotent(spark, scratch):
    from wardline.sources.tables import append_run
    import datetime as _dt
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    append_run(df, "rerun_probe", _dt.datetime(2024, 1, 1))
    append_run(df, "rerun_probe", _dt.datetime(2024, 1, 2))
    append_run(df.limit(1), "rerun_probe", _dt.datetime(2024, 1, 1))     # retry of run 1 replaces it
    got = {(str(r.run_at), r.k) for r in spark.table("rerun_probe").collect()}
    assert got == {("2024-01-01 00:00:00", "a"), ("2024-01-02 00:00:00", "a"), ("2024-01-02 00:00:00", "b")}


def test_cycle_records_every_declared_test(spark):
    if not spark.catalog.tableExists("monitoring.dq_results"):
        import datetime as _dt
        run_cycle(spark, A.raw_advisories(spark, SF_SMALL), _dt.datetime(2001, 8, 15),
                  packages=A.advisory_packages(spark, SF_SMALL))
    res = spark.table("monitoring.dq_results")
    runs = [r.run_at for r in res.select("run_at").distinct().collect()]
    one = res.where(F.col("run_at") == runs[0])
    assert one.count() == 21 + 4 + 3
    assert one.where("failures > 0").count() == 0


def test_command_line_security_audit_over_catalog(spark, scratch):
    from wardline.__main__ import main
    landing = os.path.join(scratch, "cli_landing2")
    A.advisory_json(spark, SF_SMALL).select(F.col("json").alias("value")).write.text(landing)
    paths = {}
    for name, df in {"qlog": A.query_history(spark, SF_SMALL), "grants": A.grants_to_users(spark, SF_SMALL),
                     "logins": A.login_history(spark, SF_SMALL)}.items():
        paths[name] = os.path.join(scratch, name)
        df.write.parquet(paths[name])
    facts = main(["--landing", landing, "--as-of", "2001-08-15T00:00:00", "--skip-brief",
                  "--query-log", paths["qlog"], "--grants", paths["grants"], "--logins", paths["logins"]])
    assert "security" in facts
    # the catalog holds no column named like PII, so nothing is exposed; roles are flagged
    expo = spark.table("security.sec_pii_exposure")
    assert expo.where("exposure_status = 'EXPOSED - ACTION REQUIRED'").count() == 0
    assert facts["security"]["total_role_risks"] > 0
