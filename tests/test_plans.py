"""Physical-plan properties that matter at scale (checked on the small tables).

These pin down the plan shapes the operators are written for: filters and
column lists reaching the scan, partial aggregation / group limits before the
shuffle, no cartesian products, and no window that spans a whole hot group.
"""

import re

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(fn(spark, SF_SMALL)) for k, fn in E.queries().items()}


def test_no_cartesian_products(plans):
    bad = [k for k, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_incremental_filter_reaches_the_scan(plans):
    p = plans["incremental_since"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", p)
    q = plans["anomalous_queries"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", q)


def test_scan_reads_only_needed_columns(plans):
    p = plans["mart_ecosystem_risk"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p


def test_cap_limits_before_shuffle(plans):
    p = plans["cap_per_ecosystem"]
    assert "WindowGroupLimit" in p and "Partial" in p


def test_partial_aggregation_before_exchange(plans):
    for key in ("mart_summary", "mart_ecosystem_risk", "first_seen_dedupe", "role_audit", "dq_unique"):
        p = plans[key]
        assert "partial_" in p, key


def test_group_statistics_are_not_windows(plans):
    # z-scores: grouped statistics joined back, not a window over a whole category
    for key in ("zscore_outliers", "summary_anomalies", "advisory_outliers"):
        assert "Window [" not in plans[key], key
    # first-seen dedupe: a partial min over (rank, position, row) per id, not a window over each id
    assert "partial_min(struct(" in plans["first_seen_dedupe"]
    assert "windowspecdefinition(ghsa_id" not in plans["first_seen_dedupe"]


def test_episode_windows_are_per_slice(spark):
    from wardline.operators.drift import drift_episodes, drift_records
    from wardline.sources.adapters import plan_logs
    p = plan(drift_episodes(drift_records(plan_logs(spark, SF_SMALL))))
    windows = re.findall(r"windowspecdefinition\(([^)]*)", p)
    assert windows and all("_b" in w or "environment" not in w for w in windows)


def test_day_partitioned_log_is_pruned(spark, scratch):
    import datetime as dt
    import os

    from pyspark.sql import functions as F

    from wardline.operators.security import anomalous_queries
    from wardline.sources.adapters import query_history
    path = os.path.join(scratch, "qlog")
    query_history(spark, SF_SMALL).withColumn("day", F.to_date("start_time")).write.partitionBy("day").parquet(path)
    df = anomalous_queries(spark.read.parquet(path), dt.datetime(2024, 1, 31), day_col="day")
    p = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*day", p)
    full = anomalous_queries(query_history(spark, SF_SMALL), dt.datetime(2024, 1, 31))
    assert df.count() == full.count()


@pytest.mark.parametrize("key", ["threat_brief", "brief_facts", "brief_actions", "dq_not_null", "dq_unique"])
def test_models_with_several_consumers_are_written_once(plans, key):
    # the orders are read once for the written table and at most once more (health looks at withdrawn rows too)
    scans = re.findall(r"Location: [^\n]*?/([a-z]+)\.parquet\]", plans[key])
    assert scans and scans.count("orders") <= 1 and scans.count("lineitem") <= 1, scans


def test_statistics_are_joined_on_group_and_salt(plans):
    for key in ("zscore_outliers", "advisory_outliers"):
        assert re.search(r"pmod\(xxhash64\(", plans[key]), key


def test_hot_group_statistics_are_exact(spark):
    from pyspark.sql import functions as F

    from wardline.operators.outliers import zscore
    rows = spark.range(3000).select(F.when(F.col("id") % 10 < 9, "hot").alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    got = zscore(rows, "g", "v")
    assert got.columns == ["g", "v", "mean", "stddev", "z_score"] and got.count() == 3000
    want = {r.g: (r.m, r.s) for r in rows.groupBy("g").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).collect()}
    for r in got.select("g", "mean", "stddev").distinct().collect():
        assert abs(r["mean"] - want[r.g][0]) < 1e-12 and abs(r.stddev - want[r.g][1]) < 1e-12
