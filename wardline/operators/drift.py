"""Infrastructure drift records from plan outputs, and drift episodes.

The input is a table of plan runs (run_id, exit_code, stdout, checked_at,
optionally environment). Parsing is per row with JVM regex functions; the
episode operator is a gaps-and-islands window per environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R


def parse_plans(df: DataFrame, text_col: str = "stdout") -> DataFrame:
    """Add add/change/destroy counts (first summary line; none → 0) and resources.

    Resources are names on lines ``[#~+-] name will be``, matched per line
    from its start, deduplicated keeping first occurrence order.
    """
    text = F.col(text_col)
    counts = [F.coalesce(F.regexp_extract(text, R.PLAN_SUMMARY_PATTERN, i).try_cast("long"), F.lit(0))
              for i in (1, 2, 3)]
    lines = F.split(text, r"\r\n|\r|\n")
    names = F.transform(lines, lambda ln: F.regexp_extract(ln, R.PLAN_RESOURCE_PATTERN, 1))
    resources = F.array_distinct(F.filter(names, lambda n: n != ""))
    return df.select(
        "*",
        counts[0].alias("resources_to_add"),
        counts[1].alias("resources_to_change"),
        counts[2].alias("resources_to_destroy"),
        resources.alias("changed_resources"))


def drift_records(plans: DataFrame) -> DataFrame:
    """Records of successful plan runs: drift flag, counts, details JSON, whole text.

    Runs that errored (exit 1) leave no record.
    """
    p = parse_plans(plans.where(F.col("exit_code") != R.PLAN_EXIT_ERROR))
    extra = [c for c in ("run_id", "environment") if c in plans.columns]
    return p.select(
        *extra,
        F.col("checked_at"),
        (F.col("exit_code") == R.PLAN_EXIT_DRIFT).alias("drift_detected"),
        "resources_to_add", "resources_to_change", "resources_to_destroy",
        F.to_json(F.struct(F.col("changed_resources"))).alias("drift_details"),
        F.col("stdout").alias("raw_plan_output"))


def drift_episodes(records: DataFrame, partition: str = "environment",
                   order: tuple[str, ...] = ("checked_at", "run_id"),
                   buckets: int | None = None) -> DataFrame:
    """Maximal runs of consecutive drifted checks per environment.

    One row per episode: its first and last drifted check, the number of
    drifted checks, and when it ended (the first clean check after it; NULL
    while it lasts). Episodes are numbered per environment in time order.

    Gaps and islands without a window over a whole environment (one hot
    environment would land in one task):

    1. range-partition the records by (environment, time) into ``buckets``
       balanced slices — a hot environment is spread over many slices — and
       checkpoint them so the slice ids stay fixed if a task is retried;
    2. inside each slice, number the local islands with a running count of
       island starts (a window over one slice only);
    3. per slice keep a one-row summary (first/last row, local starts); a
       window over these few summary rows per environment gives each slice
       its island offset and whether its first island continues the
       previous slice's last one;
    4. global island = offset + local island − continuation; the episodes are
       a grouped aggregate over (environment, island), combined map-side.
    """
    from ..session import checkpoint_dir

    spark = records.sparkSession
    checkpoint_dir(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    drift = F.col("drift_detected")
    r = (records.select(partition, *order, "drift_detected")
         .repartitionByRange(n, partition, *order)
         .withColumn("_b", F.spark_partition_id())
         .checkpoint())

    w = Window.partitionBy(partition, "_b").orderBy(*order)
    local = (r.withColumn("_prev", F.lag("drift_detected").over(w))
             .withColumn("_next_at", F.lead("checked_at").over(w))
             .withColumn("_start", (drift & F.coalesce(~F.col("_prev"), F.lit(True))).cast("long"))
             .withColumn("_li", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))))

    row = F.struct(*[F.col(c) for c in order], drift.alias("d"), F.col("checked_at").alias("at"))
    summ = local.groupBy(partition, "_b").agg(F.min(row).alias("_first"), F.max(row).alias("_last"),
                                               F.sum("_start").alias("_starts"))
    ws = Window.partitionBy(partition).orderBy("_b")
    cont = (F.col("_first.d") & F.coalesce(F.lag("_last.d").over(ws), F.lit(False))).cast("long")
    summ = (summ.withColumn("_cont", cont)
            .withColumn("_next_first_at", F.lead("_first.at").over(ws))
            .withColumn("_gstarts", F.col("_starts") - F.col("_cont")))
    summ = summ.withColumn(
        "_offset", F.coalesce(F.sum("_gstarts").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    summ = summ.select(partition, "_b", "_cont", "_offset", "_next_first_at")

    j = local.where(drift).join(summ, [partition, "_b"])
    island = F.col("_offset") + F.col("_li") - F.col("_cont")
    next_at = F.coalesce(F.col("_next_at"), F.col("_next_first_at"))
    d = j.select(partition, *order, island.alias("_island"), next_at.alias("_next"))
    ep = d.groupBy(partition, "_island").agg(
        F.min("checked_at").alias("drift_started_at"),
        F.max("checked_at").alias("last_drift_at"),
        F.count(F.lit(1)).alias("drifted_checks"),
        F.max(F.struct(*[F.col(c) for c in order], F.col("_next").alias("n"))).alias("_last"))
    return ep.select(
        partition,
        F.col("_island").cast("long").alias("episode_no"),
        "drift_started_at", "last_drift_at", "drifted_checks",
        F.col("_last.n").alias("resolved_at"))
