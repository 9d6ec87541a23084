"""Per-group z-scores and outlier records.

The surveyed job uses whole-partition window aggregates (AVG/STDDEV OVER
PARTITION BY category). A window puts every row of a category into one task,
and a category may hold a third of all rows. Here the statistics are a
grouped aggregate instead (partial aggregation map-side, one small row per
category), copied once per salt and joined back on category and salt. A hot
category is thus dealt over ``STAT_SALTS`` tasks even if the join shuffles;
AQE may still broadcast the statistics after measuring them. The result is the
same as the window's.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..functions import rules as R
from ..functions.columns import ts_ntz


STAT_SALTS = 64


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def zscore(df: DataFrame, partition: str, value: str, mean_col: str = "mean",
           stddev_col: str = "stddev", z_col: str = "z_score") -> DataFrame:
    """Add partition mean, sample stddev and z (0.0 when stddev is NULL or 0)."""
    stats = (df.groupBy(F.col(partition).alias("_zkey"))
             .agg(F.avg(value).alias(mean_col), F.stddev_samp(value).alias(stddev_col))
             .withColumn("_zpart", F.explode(F.sequence(F.lit(0), F.lit(STAT_SALTS - 1)))))
    # the salt follows from the row's values, so a repeated task deals its rows the same way
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    dealt = df.withColumn("_zsalt", F.pmod(F.xxhash64(*hashed), F.lit(STAT_SALTS)).cast("int"))
    j = dealt.join(stats, (F.col("_zsalt") == F.col("_zpart")) & F.col(partition).eqNullSafe(F.col("_zkey")))
    j = j.drop("_zkey", "_zpart", "_zsalt")
    sd = F.col(stddev_col)
    z = (F.when(sd.isNull() | (sd == 0), F.lit(0.0))
         .otherwise((F.col(value) - F.col(mean_col)) / sd))
    return j.withColumn(z_col, z)


def outlier_records(scored: DataFrame, id_col: Column, group_col: str, value_col: str,
                    as_of: _dt.datetime, threshold: float = R.Z_THRESHOLD,
                    digits: int | None = None) -> DataFrame:
    """Rows with |z| > threshold in the anomaly-table layout."""
    return (scored.where(F.abs(F.col("z_score")) > threshold)
            .select(id_col.alias("advisory_id"),
                    F.col(group_col).alias("ecosystem"),
                    F.col(value_col).alias("composite_risk_score"),
                    _r(F.col("ecosystem_mean"), digits).alias("ecosystem_mean"),
                    _r(F.col("ecosystem_stddev"), digits).alias("ecosystem_stddev"),
                    _r(F.col("z_score"), digits).alias("z_score"),
                    F.lit(R.OUTLIER_LABEL).alias("anomaly_type"),
                    ts_ntz(as_of).alias("detected_at")))


def summary_anomalies(summary: DataFrame, as_of: _dt.datetime, threshold: float = R.Z_THRESHOLD,
                      digits: int | None = None) -> DataFrame:
    """Summary groups whose average score is an outlier within their category.

    The id is ``severity_age_category`` built with NULL-propagating concat.
    """
    scored = zscore(summary, "vulnerability_category", "avg_composite_risk_score",
                    "ecosystem_mean", "ecosystem_stddev")
    ident = F.concat(F.col("severity"), F.lit("_"), F.col("age_bucket"), F.lit("_"),
                     F.col("vulnerability_category"))
    return outlier_records(scored, ident, "vulnerability_category", "avg_composite_risk_score",
                           as_of, threshold, digits)


def advisory_outliers(enriched: DataFrame, packages: DataFrame, as_of: _dt.datetime,
                      threshold: float = R.Z_THRESHOLD, digits: int | None = None) -> DataFrame:
    """Advisory score against the mean of its ecosystem (one row per advisory and ecosystem)."""
    pairs = (packages.where(F.col("ecosystem").isNotNull() & (F.col("ecosystem") != ""))
             .select("ghsa_id", F.col("ecosystem").alias("ecosystem_name")).distinct())
    adv = enriched.select("advisory_id", "composite_risk_score")
    j = adv.join(pairs, adv.advisory_id == pairs.ghsa_id).drop("ghsa_id")
    scored = zscore(j, "ecosystem_name", "composite_risk_score", "ecosystem_mean", "ecosystem_stddev")
    return outlier_records(scored, F.col("advisory_id"), "ecosystem_name", "composite_risk_score",
                           as_of, threshold, digits)


def anomaly_counts(anomalies: DataFrame, ordered: bool = False) -> DataFrame:
    """Outliers per group; ``ordered`` lists the most frequent first (for display)."""
    out = anomalies.groupBy("ecosystem").agg(F.count(F.lit(1)).alias("anomaly_count"))
    if ordered:
        out = out.orderBy(F.col("anomaly_count").desc(), F.col("ecosystem"))
    return out


def group_value_outliers(df: DataFrame, partition: str, key: str, value: str,
                         threshold: float = R.Z_THRESHOLD, digits: int | None = None) -> DataFrame:
    """Average ``value`` per (partition, key), then z-score the averages per partition.

    Values are added as decimals with six places, so a group's sum is exact and the same in any order.
    """
    avg = (df.groupBy(partition, key)
           .agg(F.sum(F.col(value).cast("decimal(24,6)")).alias("_s"), F.count(value).alias("_n"))
           .where(F.col("_n") > 0)
           .select(partition, key, (F.col("_s").cast("double") / F.col("_n")).alias("avg_value")))
    scored = zscore(avg, partition, "avg_value", "mean_value", "stddev_value")
    return (scored.where(F.abs(F.col("z_score")) > threshold)
            .select(partition, key, "avg_value",
                    _r(F.col("mean_value"), digits).alias("mean_value"),
                    _r(F.col("stddev_value"), digits).alias("stddev_value"),
                    _r(F.col("z_score"), digits).alias("z_score")))
