"""Partition layout helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared checkpoint folder."""
    base = checkpoint_dir(spark) or spark.conf.get("spark.checkpoint.dir")
    return f"{base.rstrip('/')}/wardline-models/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    For a model with several consumers in one query: they read its files with
    only the columns they need, instead of each computing it from the source.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over the cluster when the input has too few splits.

    Meant for CPU-heavy per-row work (JSON building and parsing, regex over
    long texts) that would otherwise run in the few tasks the scan produced —
    e.g. one task per single-row-group file. When the input already has at
    least ``min_partitions`` splits (the normal case for large, many-file
    inputs) nothing is added, so no shuffle is paid at scale.
    """
    target = min_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        splits = df.rdd.getNumPartitions()      # planning metadata only, no job
    except Exception:                           # no RDD view (e.g. Spark Connect): leave as is
        return df
    return df if splits >= target else df.repartition(target)
