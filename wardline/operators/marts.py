"""Marts: critical list, summary, ecosystem risk, pipeline health.

Aggregates are written so that Spark can combine map-side (partial
aggregation) before any shuffle: sums of exact integer hundredths, counts and
maxima. Averages are rounded from those exact sums, so the result does not
depend on the order in which partial sums meet.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.columns import avg_round2, div_round_half_up, hour_boundaries, hundredths, ts_ntz

CRITICAL_COLUMNS = ["advisory_id", "cve_id", "summary", "severity", "cvss_score",
                    "composite_risk_score", "age_bucket", "days_since_published",
                    "vulnerability_category", "published_at"]


def mart_critical(enriched: DataFrame, ordered: bool = False) -> DataFrame:
    """Advisories with composite score >= 9.0 (the contract is checked by K4).

    ``ordered`` sorts by score descending; a stored table keeps no order, so
    the sort is only worth its global shuffle when the rows are shown.
    """
    out = enriched.where(F.col("composite_risk_score") >= R.CRITICAL_MART_SCORE).select(*CRITICAL_COLUMNS)
    if ordered:
        out = out.orderBy(F.col("composite_risk_score").desc(), F.col("advisory_id"))
    return out


def mart_summary(enriched: DataFrame) -> DataFrame:
    """Per (severity, age bucket, category): counts, rounded averages, max, criticals."""
    cvss_h = hundredths("cvss_score")
    score_h = hundredths("composite_risk_score")
    agg = (enriched
           .groupBy("severity", "age_bucket", "vulnerability_category")
           .agg(F.count(F.lit(1)).alias("total_count"),
                F.sum(cvss_h).alias("_cvss_h"),
                F.count("cvss_score").alias("_cvss_n"),
                F.sum(score_h).alias("_score_h"),
                F.max("composite_risk_score").alias("max_composite_risk_score"),
                F.sum(F.col("is_critical").cast("long")).alias("critical_count")))
    return agg.select(
        "severity", "age_bucket", "vulnerability_category", "total_count",
        avg_round2("_cvss_h", "_cvss_n").alias("avg_cvss_score"),
        avg_round2("_score_h", "total_count").alias("avg_composite_risk_score"),
        "max_composite_risk_score", "critical_count")


# --------------------------------------------------------------- packages



def explode_packages(raw: DataFrame, packages_col: str = "affected_packages",
                     id_col: str = "ghsa_id") -> DataFrame:
    """Lateral flatten of the affected-package array → (id, ecosystem, package_name).

    Accepts the array as JSON text, VARIANT or ``array<struct<package:...>>``.
    Not outer: an empty array, a JSON null or a SQL NULL yields no rows. Rows
    whose ecosystem is NULL or '' stay here; the mart drops them.
    """
    dtype = raw.schema[packages_col].dataType
    col = F.col(packages_col)
    if isinstance(dtype, T.StringType):
        # element by element: one odd element does not take the others with it
        each = raw.select(F.col(id_col).alias("ghsa_id"), F.explode(F.from_json(col, "array<string>")).alias("p"))
        return each.select("ghsa_id", F.get_json_object("p", "$.package.ecosystem").alias("ecosystem"),
                           F.get_json_object("p", "$.package.name").alias("package_name"))
    if isinstance(dtype, T.VariantType):
        each = raw.select(F.col(id_col).alias("ghsa_id"),
                          F.explode(F.try_variant_get(col, "$", "array<variant>")).alias("p"))
        return each.select("ghsa_id", F.try_variant_get("p", "$.package.ecosystem", "string").alias("ecosystem"),
                           F.try_variant_get("p", "$.package.name", "string").alias("package_name"))
    arr = col
    return (raw.select(F.col(id_col).alias("ghsa_id"), F.explode(arr).alias("p"))
            .select("ghsa_id",
                    F.col("p.package.ecosystem").alias("ecosystem"),
                    F.col("p.package.name").alias("package_name")))


def mart_ecosystem_risk(enriched: DataFrame, packages: DataFrame) -> DataFrame:
    """Per ecosystem: distinct advisories, and package-weighted counts/avg/max.

    An advisory with three packages in one ecosystem counts once in
    ``total_vulnerabilities`` but three times in the critical/high counts and
    the average, exactly like grouping the flattened join.

    Plan: package rows are first collapsed to (advisory, ecosystem, n) with a
    map-side partial aggregate, so a hot advisory shrinks to a handful of rows
    before the shuffle; the join then meets one row per advisory and ecosystem
    instead of one per package, and the final per-ecosystem aggregate is again
    combined map-side.
    """
    pk = (packages
          .where(F.col("ecosystem").isNotNull() & (F.col("ecosystem") != ""))
          .groupBy("ghsa_id", "ecosystem")
          .agg(F.count(F.lit(1)).alias("n_pkg")))
    adv = enriched.select("advisory_id", "severity", "composite_risk_score")
    j = adv.join(pk, adv.advisory_id == pk.ghsa_id)
    n = F.col("n_pkg")
    agg = (j.groupBy(F.col("ecosystem").alias("ecosystem_name"))
           .agg(F.count(F.lit(1)).alias("total_vulnerabilities"),
                F.sum(F.when(F.col("severity") == "critical", n).otherwise(0)).alias("critical_count"),
                F.sum(F.when(F.col("severity") == "high", n).otherwise(0)).alias("high_count"),
                F.sum(hundredths("composite_risk_score") * n).alias("_score_h"),
                F.sum(n).alias("_n"),
                F.max("composite_risk_score").alias("max_risk_score")))
    return agg.select(
        "ecosystem_name", "total_vulnerabilities",
        F.col("critical_count").cast("long").alias("critical_count"),
        F.col("high_count").cast("long").alias("high_count"),
        avg_round2("_score_h", "_n").alias("avg_risk_score"),
        "max_risk_score")


# --------------------------------------------------------------- health

def _health_status(fresh: Column, normal: Column) -> Column:
    return (F.when(fresh & normal, "healthy")
            .when(fresh & ~normal, "low_volume_warning")
            .when(~fresh, "stale")
            .otherwise("unknown"))


def pipeline_health(df: DataFrame, source_table: str, ts_col: str,
                    as_of: _dt.datetime) -> DataFrame:
    """One-row freshness/volume snapshot of a landed table (a global aggregate)."""
    now = ts_ntz(as_of)
    ts = F.col(ts_col)
    m = df.agg(
        F.max(ts).alias("last_ingested_at"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(ts >= now - F.expr("INTERVAL 24 HOURS"), 1)).alias("rows_last_24h"),
        F.count(F.when(ts >= now - F.expr("INTERVAL 7 DAYS"), 1)).alias("rows_last_7d"))
    hours = hour_boundaries(F.col("last_ingested_at"), now)
    avg_daily = div_round_half_up("rows_last_7d", 7)
    fresh = F.coalesce(hours <= R.FRESH_HOURS, F.lit(False))
    normal = F.coalesce(F.col("rows_last_24h") >= avg_daily * R.NORMAL_VOLUME_RATIO, F.lit(False))
    return m.select(
        F.lit(source_table).alias("source_table"),
        "last_ingested_at", hours.alias("hours_since_last_load"), "total_rows", "rows_last_24h",
        "rows_last_7d", avg_daily.alias("avg_daily_rows_7d"), fresh.alias("is_fresh"),
        normal.alias("is_row_count_normal"), _health_status(fresh, normal).alias("pipeline_status"),
        now.alias("checked_at"))
