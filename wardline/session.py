"""Spark session settings shared by the library, the tests and the bench.

The library never creates a session on its own inside operators; callers pass
one in. ``get_session`` is a convenience for scripts and tests: on a cluster
the submitting job owns the session and its configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run relies on. UTC keeps hour/date functions and the DuckDB
# oracle in agreement; AQE re-plans joins and coalesces partitions at runtime
# and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "wardline",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Shared folder for lineage cuts and versioned tables.

    The cluster names it in ``spark.checkpoint.dir``; only a local session
    may leave that unset and gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="wardline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
