"""Command line: land advisories and CVE or advisory pages, upsert RAW, run one full cycle.

    python -m wardline --landing DIR --as-of 2024-01-31T00:00:00 \\
        [--since 2024-01-01] [--severities critical,high] [--plans PATH | --plan-files DIR] \\
        [--brief-dir DIR] [--skip-anomaly] [--skip-brief] [--skip-drift]
        [--query-log PATH --grants PATH --logins PATH [--columns PATH]]
        [--cves DIR [--modified-since DATE] [--modified-until DATE] [--published-since DATE] [--published-until DATE]]
        [--nodes DIR]

Steps, as jobs on the session the command gets (or creates): landed JSON
documents (one per line) → flatten → typed → ``updated_at >= since`` →
severity filter → upsert into ``raw.raw_github_advisories`` → the cycle of
``wardline.plans.cycle`` (marts, checks, outliers, brief, drift, history).
CVE result pages (``--cves``) and pages of advisory nodes (``--nodes``), one
JSON page per line, are upserted record by record into ``raw.raw_nvd_cves``
and ``raw.raw_advisory_records``.
Plan logs (``--plans``) are Parquet with run_id, exit_code, stdout,
checked_at; ``--plan-files`` takes the outputs themselves. With query, grant and login logs the security audit runs too;
its column inventory defaults to the columns of the session catalog (the
tables this command writes included). Prints the cycle's one-row facts as JSON.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pyspark.sql import functions as F
from pyspark.sql import SparkSession

from .operators import upsert as U
from .operators.landing import land_advisories, land_records
from .functions.columns import ts_ntz
from .plans.cycle import run_cycle
from .session import BASE_CONF, checkpoint_dir
from .sources import landing as L
from .sources import parts as P
from .sources import tables as TB

RAW_TABLE = "raw.raw_github_advisories"
RAW_PARTS = 64                 # of the stored table: the same in every run
REJECT_TABLE = "raw.github_advisories_rejects"
CVE_TABLE = "raw.raw_nvd_cves"
NODE_TABLE = "raw.raw_advisory_records"


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="wardline", description=__doc__.split("\n")[0])
    p.add_argument("--landing", required=True, help="folder of landed advisory JSON documents, one per line")
    p.add_argument("--as-of", required=True, type=_dt.datetime.fromisoformat, help="run time (UTC)")
    p.add_argument("--since", type=_dt.date.fromisoformat, help="only advisories updated on or after")
    p.add_argument("--severities", default="critical,high", help="comma-separated severities to keep")
    p.add_argument("--plans", help="Parquet plan logs for drift records")
    p.add_argument("--plan-files", help="folder of plan outputs, one text file a run, a folder per environment")
    p.add_argument("--query-log", help="Parquet query history for the security audit")
    p.add_argument("--grants", help="Parquet role grants (grantee_name, role, ...)")
    p.add_argument("--logins", help="Parquet login history (user_name, event_timestamp, is_success)")
    p.add_argument("--columns", help="Parquet column inventory (information-schema shape); "
                                     "default: the columns of this session's catalog")
    p.add_argument("--cves", help="folder of CVE result pages, one JSON page per line")
    p.add_argument("--nodes", help="folder of pages of advisory nodes, one JSON page per line")
    for name in ("modified", "published"):
        p.add_argument(f"--{name}-since", type=_dt.date.fromisoformat, help=f"only CVEs {name} on or after")
        p.add_argument(f"--{name}-until", type=_dt.date.fromisoformat, help=f"only CVEs {name} up to this time")
    p.add_argument("--brief-dir", help="folder for the daily brief text")
    p.add_argument("--skip-anomaly", action="store_true")
    p.add_argument("--skip-brief", action="store_true")
    p.add_argument("--skip-drift", action="store_true")
    return p.parse_args(argv)


def land(spark: SparkSession, landing: str, as_of: _dt.datetime, since: _dt.date | None,
         severities: list[str]) -> list[int]:
    """Landed documents → RAW upsert; returns the parts of RAW that were rewritten."""
    docs = spark.read.text(landing).select(F.col("value").alias("json"))
    typed, rejects = land_advisories(docs, as_of, severities, since)
    TB.ensure_schema(spark, "raw")
    TB.append_run(rejects, REJECT_TABLE, as_of)
    path = TB.parts_path(spark, RAW_TABLE)
    P.ensure_parts(spark, path, L.RAW_ADVISORY)
    rewritten = P.upsert_parts(spark, path, typed, "ghsa_id", parts=RAW_PARTS)
    TB.parts_view(spark, RAW_TABLE, L.RAW_ADVISORY.names)
    return rewritten


def land_pages(spark: SparkSession, pages: str, table: str, id_col: str, as_of: _dt.datetime, unwrap, id_field: str = "id",
               bounds: dict[str, tuple] | None = None) -> int:
    """Landed result pages → record upsert into ``table``; returns its version. Unreadable pages go to a reject table."""
    read = spark.read.text(pages).select(F.col("value").alias("json"), ts_ntz(as_of).alias("fetched_at"))
    records, rejects = land_records(read, unwrap, bounds)
    TB.ensure_schema(spark, "raw")
    TB.append_run(rejects, f"{table}_rejects", as_of)
    stored = (spark.table(table) if TB.current_version(spark, table) is not None else spark.createDataFrame(
        [], f"{id_col} string, record string, fetched_at timestamp_ntz, loaded_at timestamp_ntz"))
    merged = U.upsert_records(stored, records, id_col, as_of, U.record_id(F.col("record"), id_field))
    return TB.commit_version(merged, table, bucket_by=(int(spark.conf.get("spark.sql.shuffle.partitions")), id_col), keep=2)


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(argv)
    builder = SparkSession.builder.appName("wardline")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    land(spark, args.landing, args.as_of, args.since, [s.strip() for s in args.severities.split(",") if s.strip()])
    if args.cves:
        land_pages(spark, args.cves, CVE_TABLE, "cve_id", args.as_of, L.unwrap_cves,
                   bounds={"lastModified": (args.modified_since, args.modified_until),
                           "published": (args.published_since, args.published_until)})
    if args.nodes:
        land_pages(spark, args.nodes, NODE_TABLE, "ghsa_id", args.as_of, L.unwrap_nodes, id_field="ghsaId")
    read = lambda path: TB.read_source(spark, path=path) if path else None
    audit = {}
    if args.query_log and args.grants and args.logins:
        audit = {"query_log": read(args.query_log), "grants": read(args.grants), "logins": read(args.logins),
                 "columns": read(args.columns) if args.columns else TB.column_inventory(spark)}
    plan_logs = L.plan_files(spark, args.plan_files) if args.plan_files else read(args.plans)
    facts = run_cycle(spark, spark.table(RAW_TABLE), args.as_of, plan_logs=plan_logs,
                      brief_path=args.brief_dir, skip_anomaly=args.skip_anomaly, skip_brief=args.skip_brief,
                      skip_drift=args.skip_drift, **audit)
    print(json.dumps(facts, default=str))
    return facts


if __name__ == "__main__":
    main(sys.argv[1:])
