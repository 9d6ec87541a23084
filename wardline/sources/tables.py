"""Reading sources, writing results, versioned tables, catalog metadata.

Tables live in the session catalog (its warehouse directory is the shared
location the cluster configures). A table that is rewritten by an upsert or
a history step is versioned: each commit writes a new physical table
``<name>__v<N>`` and then repoints the view ``<name>`` at it. The table being
read is never overwritten, readers see either the old or the new version,
and an interrupted commit leaves the previous version in place.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layer → schema (database) of the catalog.
LAYERS = {"raw": "raw", "staging": "staging", "intermediate": "intermediate",
          "marts": "marts", "security": "security", "snapshots": "snapshots"}


def read_source(spark: SparkSession, name: str | None = None, path: str | None = None) -> DataFrame:
    """A landed table by catalog name, or Parquet files at ``path``."""
    return spark.read.parquet(path) if path else spark.table(name)


def ensure_schema(spark: SparkSession, layer: str) -> str:
    db = LAYERS.get(layer, layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return db


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> None:
    """Create an empty Parquet table with ``schema`` when it does not exist."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").partitionBy(*partition_by).saveAsTable(name)


def append_run(df: DataFrame, name: str, run_at, run_col: str = "run_at") -> None:
    """Add one run's rows to a result table partitioned by run time.

    Writing the same run again replaces that run's partition (dynamic
    partition overwrite) instead of duplicating its rows, so a retried cycle
    is idempotent; other runs are untouched.
    """
    from ..functions.columns import ts_ntz

    out = df.withColumn(run_col, ts_ntz(run_at))
    spark = df.sparkSession
    ensure_table(spark, name, out.schema, (run_col,))
    cols = [f.name for f in spark.table(name).schema.fields]
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        out.select(*cols).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)


def write_text(df: DataFrame, path: str, text_col: str = "brief_text") -> None:
    """Write a small text result (one row per line file) to ``path``."""
    df.select(F.col(text_col).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def materialize(df: DataFrame, layer: str, name: str, kind: str = "table", keep: int = 2,
                bucket_by: tuple[int, str] | None = None, validate=None, contract=None) -> DataFrame:
    """A model as a view (recomputed on read) or a table (written once, lineage cut).

    Tables are committed as a new version (see ``commit_version``), so a
    failed rebuild leaves the previous model readable. ``bucket_by`` stores
    the table bucketed by a key (joins on that key then skip its shuffle).
    ``contract`` (``quality.ObservedContract``) is checked in the pass that
    writes, ``validate`` on the written version before it becomes visible; if
    either raises, the version is dropped.
    """
    spark = df.sparkSession
    db = ensure_schema(spark, layer)
    full = f"{db}.{name}"
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    commit_version(df, full, keep=keep, bucket_by=bucket_by, validate=validate, contract=contract)
    return spark.table(full)


# ------------------------------------------------------------------ versions

def _versions(spark: SparkSession, name: str) -> list[int]:
    db, _, base = name.rpartition(".")
    tables = spark.catalog.listTables(db) if db else spark.catalog.listTables()
    pat = re.compile(rf"^{re.escape(base)}__v(\d+)$", re.IGNORECASE)
    return sorted(int(m.group(1)) for t in tables if (m := pat.match(t.name)))


def current_version(spark: SparkSession, name: str) -> int | None:
    """The version that readers of ``name`` see: the one its view selects from."""
    if not spark.catalog.tableExists(name):
        return None
    text = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "View Text"]
    found = re.search(r"__v(\d+)\s*$", text[0]) if text else None
    return int(found.group(1)) if found else None


def commit_version(df: DataFrame, name: str, partition_by: list[str] | None = None,
                   bucket_by: tuple[int, str] | None = None, keep: int | None = None,
                   validate=None, contract=None) -> int:
    """Write ``df`` as the next version of ``name`` and repoint the view at it.

    ``bucket_by=(n, key)`` stores the version in ``n`` buckets sorted by
    ``key``: the next upsert or history step joins on that key without
    shuffling the stored side (only the incoming batch is shuffled).
    ``keep`` drops all but the newest ``keep`` versions after the switch.
    ``contract`` counts its NULLs in the pass that writes; ``validate(df)``
    runs on the written version before the switch. If either raises, the
    version is dropped and the previous one stays current.
    """
    spark = df.sparkSession
    if contract is not None:
        df = contract.watch(df)
    nxt = max(_versions(spark, name), default=0) + 1     # an interrupted commit may have left a higher one
    if bucket_by:                                        # one file per bucket, not one per task and bucket
        df = df.repartition(*bucket_by)
    w = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, key = bucket_by
        w = w.bucketBy(n, key).sortBy(key)
    w.saveAsTable(f"{name}__v{nxt}")
    try:
        if contract is not None:
            contract.verify()
        if validate is not None:
            validate(spark.table(f"{name}__v{nxt}"))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{nxt}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__v{nxt}")
    if keep:
        # what an interrupted commit left behind, and all but the newest versions
        for old in [v for v in _versions(spark, name) if v < nxt][:max(0, len(_versions(spark, name)) - keep)]:
            spark.sql(f"DROP TABLE IF EXISTS {name}__v{old}")
    return nxt


def upsert_table(spark: SparkSession, name: str, source: DataFrame, key: str,
                 update_cols: list[str] | None = None, dedupe_order: list[str] | None = None,
                 buckets: int | None = None) -> int:
    """Upsert ``source`` into the table ``name`` by ``key``.

    Tables of a format with row-level MERGE (a v2 catalog table) take a
    ``MERGE INTO``; the plain Parquet tables of this package take the
    set-based upsert written as a new bucketed version. Returns the new
    version number (0 when the table merged in place). An empty source is a
    no-op that returns the current version.
    """
    from ..operators.upsert import newest_per_key, unique_or_fail, upsert

    if source.isEmpty():                       # nothing landed: no rewrite, no new version
        return current_version(spark, name) or 0
    src = newest_per_key(source, key, dedupe_order) if dedupe_order else source
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if current_version(spark, name) is None and not spark.catalog.tableExists(name):
        first = src if dedupe_order else unique_or_fail(src, key)
        return commit_version(first, name, bucket_by=(n, key))
    if update_cols is None and _merges(spark, name):
        (src.alias("source").mergeInto(name, F.expr(f"{name}.{key} = source.{key}"))
         .whenMatched().updateAll().whenNotMatched().insertAll().merge())
        return 0
    merged = upsert(spark.table(name), src, key, update_cols=update_cols)
    return commit_version(merged, name, bucket_by=(n, key), keep=2)


def _merges(spark: SparkSession, name: str) -> bool:
    """Whether the table's format has a row-level MERGE: none of Spark's own file formats and no view has."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return (rows.get("Type", "").upper() != "VIEW"
            and rows.get("Provider", "").lower() not in ("", "parquet", "orc", "csv", "json", "text", "avro", "hive"))


def parts_path(spark: SparkSession, name: str) -> str:
    """Where the table in parts ``name`` (see ``sources.parts``) keeps its files: in the folder of its schema."""
    db, _, base = name.rpartition(".")
    return f"{spark.catalog.getDatabase(db or 'default').locationUri}/{base}__parts"


def parts_view(spark: SparkSession, name: str, columns: list[str]) -> None:
    """A view over a table in parts, without the part columns. Redefined after each change, as its files change."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM parquet.`{parts_path(spark, name)}`")


# ------------------------------------------------------------------ metadata

def column_inventory(spark: SparkSession, catalog_name: str = "spark_catalog") -> DataFrame:
    """Columns of every table in the session catalog, information-schema shape.

    Metadata only (a listing of names and types, not data), gathered on the
    driver and returned as a small DataFrame.
    """
    rows = []
    for db in spark.catalog.listDatabases():
        for t in spark.catalog.listTables(db.name):
            if t.isTemporary or re.search(r"__v\d+$", t.name):      # a version is seen through its view
                continue
            for c in spark.catalog.listColumns(f"{db.name}.{t.name}"):
                rows.append((catalog_name, db.name, t.name, c.name, c.dataType))
    schema = "table_catalog string, table_schema string, table_name string, column_name string, data_type string"
    return spark.createDataFrame(rows, schema)
