"""Hot keys: one key holding about a third of the rows must not change results.

Skewed inputs are derived by Spark from the driver tables (a third of the
rows re-keyed onto one value), written to a scratch folder, and the operator
results are compared with plain SQL over the same files in DuckDB.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from wardline.operators import drift as D
from wardline.operators import ingest as I
from wardline.operators import marts as M
from wardline.operators import outliers as Z
from wardline.plans import catalog as C
from wardline.sources import adapters as A

from .conftest import SF_SMALL


def _rows(df_rows, cols):
    return sorted(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in cols) for r in df_rows)


def _duck(path_by_name):
    con = duckdb.connect()
    for name, path in path_by_name.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con


def test_hot_advisory_in_ecosystem_mart(spark, scratch):
    pk = A.advisory_packages(spark, SF_SMALL)
    hot = pk.withColumn("ghsa_id", F.when(F.xxhash64("package_name", "ghsa_id") % 3 == 0, F.lit("ADV-1"))
                        .otherwise(F.col("ghsa_id")))
    enr = C.enriched(spark, SF_SMALL).select("advisory_id", "severity", "composite_risk_score")
    hp, ep = os.path.join(scratch, "pk"), os.path.join(scratch, "enr")
    hot.write.parquet(hp)
    enr.write.parquet(ep)
    got = M.mart_ecosystem_risk(spark.read.parquet(ep), spark.read.parquet(hp)).collect()
    con = _duck({"pkg": hp, "enr": ep})
    want = con.execute("""
        SELECT p.ecosystem AS ecosystem_name, count(DISTINCT e.advisory_id) AS total_vulnerabilities,
               sum(CASE WHEN e.severity = 'critical' THEN 1 ELSE 0 END) AS critical_count,
               sum(CASE WHEN e.severity = 'high' THEN 1 ELSE 0 END) AS high_count,
               CAST((2 * sum(CAST(round(e.composite_risk_score * 100) AS BIGINT)) + count(*)) // (2 * count(*))
                    AS DOUBLE) / 100 AS avg_risk_score,
               max(e.composite_risk_score) AS max_risk_score
        FROM enr e JOIN pkg p ON p.ghsa_id = e.advisory_id
        WHERE p.ecosystem IS NOT NULL AND p.ecosystem <> '' GROUP BY 1""").fetchall()
    cols = ["ecosystem_name", "total_vulnerabilities", "critical_count", "high_count", "avg_risk_score",
            "max_risk_score"]
    assert _rows([r.asDict() for r in got], cols) == _rows([dict(zip(cols, w)) for w in want], cols)


def test_hot_group_zscores_and_first_seen(spark, scratch):
    ev = A.table(spark, SF_SMALL, "events")
    hot = (ev.withColumn("event_type", F.when(F.col("event_id") % 3 == 0, F.lit("view")).otherwise(F.col("event_type")))
           .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))))
    path = os.path.join(scratch, "events")
    hot.write.parquet(path)
    got = Z.group_value_outliers(spark.read.parquet(path), "event_type", "user_id", "value", threshold=1.0,
                                 digits=6).collect()
    con = _duck({"events": path})
    want = con.execute("""
        WITH g AS (SELECT event_type, user_id,
                          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (count(value) * 100.0::DOUBLE) AS v
                   FROM events GROUP BY 1, 2),
        s AS (SELECT *, avg(v) OVER (PARTITION BY event_type) AS m, stddev_samp(v) OVER (PARTITION BY event_type) AS sd
              FROM g)
        SELECT event_type, user_id, round(CASE WHEN sd IS NULL OR sd = 0 THEN 0 ELSE (v - m) / sd END, 6) AS z
        FROM s WHERE abs(CASE WHEN sd IS NULL OR sd = 0 THEN 0 ELSE (v - m) / sd END) > 1.0""").fetchall()
    assert sorted((r.event_type, r.user_id, r.z_score) for r in got) == sorted(want)

    listing = A.advisory_listing(spark, SF_SMALL)
    hot_l = listing.withColumn("ghsa_id", F.when(F.col("position") % 3 == 0, F.lit("ADV-7")).otherwise(F.col("ghsa_id")))
    lp = os.path.join(scratch, "listing")
    hot_l.write.parquet(lp)
    got = I.first_seen(I.ecosystem_listing(spark.read.parquet(lp), A.EVENT_ECOSYSTEMS), "ghsa_id",
                       ["ecosystem_rank", "position"]).collect()
    con = _duck({"lst": lp})
    rank = " ".join(f"WHEN '{e}' THEN {i + 1}" for i, e in enumerate(A.EVENT_ECOSYSTEMS))
    want = con.execute(f"""
        SELECT ghsa_id, ecosystem, position FROM (
          SELECT *, row_number() OVER (PARTITION BY ghsa_id ORDER BY CASE ecosystem {rank} END, position) AS rn
          FROM lst WHERE ecosystem IN ({', '.join(repr(e) for e in A.EVENT_ECOSYSTEMS)})) WHERE rn = 1""").fetchall()
    assert sorted((r.ghsa_id, r.ecosystem, r.position) for r in got) == sorted(want)


@pytest.mark.parametrize("buckets", [1, 3, 7, 16])
def test_hot_environment_episodes_any_slicing(spark, scratch, buckets):
    plans = A.plan_logs(spark, SF_SMALL)
    hot = plans.withColumn("environment", F.when(F.col("run_id") % 3 == 0, F.lit("prod"))
                           .otherwise(F.col("environment")))
    recs = D.drift_records(hot)
    path = os.path.join(scratch, f"drift{buckets}")
    recs.select("environment", "checked_at", "run_id", "drift_detected").write.parquet(path)
    got = D.drift_episodes(spark.read.parquet(path), buckets=buckets).collect()
    con = _duck({"drift": path})
    want = con.execute("""
        WITH w AS (
          SELECT *, lag(drift_detected) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS prev,
                 lead(drift_detected) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS nxt,
                 lead(checked_at) OVER (PARTITION BY environment ORDER BY checked_at, run_id) AS next_at
          FROM drift),
        s AS (SELECT *, sum(CASE WHEN drift_detected AND coalesce(NOT prev, true) THEN 1 ELSE 0 END)
                          OVER (PARTITION BY environment ORDER BY checked_at, run_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w)
        SELECT environment, island, min(checked_at), max(checked_at), count(*),
               max(CASE WHEN coalesce(NOT nxt, true) THEN next_at END)
        FROM s WHERE drift_detected GROUP BY environment, island""").fetchall()
    got_t = sorted((r.environment, r.episode_no, r.drift_started_at, r.last_drift_at, r.drifted_checks,
                    r.resolved_at) for r in got)
    assert got_t == sorted(want)
