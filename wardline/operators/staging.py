"""Staging and enrichment of advisories (projection, filter, scalar rules).

Both steps are narrow: no shuffle, one codegen stage per partition. The
withdrawn filter and the column list reach the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import bucketize, date_lit, day_boundaries, keyword_class, map_values


def stage_advisories(raw: DataFrame, as_of: _dt.date) -> DataFrame:
    """Drop withdrawn rows, rename, lower-case severity, flag critical, age in days."""
    cvss = F.col("cvss_score").cast("double")
    return (raw.where(F.col("withdrawn_at").isNull())
            .select(F.col("ghsa_id").alias("advisory_id"),
                    F.col("cve_id"),
                    F.col("summary"),
                    F.col("description"),
                    F.lower("severity").alias("severity"),
                    cvss.alias("cvss_score"),
                    F.col("published_at"),
                    F.col("updated_at"),
                    F.col("ingested_at"),
                    F.coalesce(cvss >= R.CRITICAL_CVSS, F.lit(False)).alias("is_critical"),
                    day_boundaries(F.col("published_at"), date_lit(as_of)).alias("days_since_published")))


def age_bucket(days: str = "days_since_published") -> "F.Column":
    return bucketize(days, R.AGE_BUCKETS, R.AGE_BUCKET_ELSE)


def vulnerability_category(summary: str = "summary") -> "F.Column":
    return keyword_class(summary, R.CATEGORY_RULES, R.CATEGORY_ELSE)


def enrich_vulnerabilities(staged: DataFrame) -> DataFrame:
    """Age bucket, its multiplier, keyword category and composite risk score."""
    out = staged.select("*", age_bucket().alias("age_bucket"),
                        vulnerability_category().alias("vulnerability_category"))
    mult = map_values("age_bucket", R.AGE_MULTIPLIERS).cast("double")
    score = F.round(F.coalesce(F.col("cvss_score"), F.lit(0.0)) * mult, 2)
    cols = [c for c in staged.columns] + ["age_bucket"]
    return out.select(*cols, mult.alias("age_risk_multiplier"), "vulnerability_category",
                      score.alias("composite_risk_score"))
