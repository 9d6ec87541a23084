"""Parquet tables in parts: a write replaces the parts it has rows of and leaves the files of all others alone.

A part is a partition folder. A change is written beside the table first (``_staged``, which readers pass over) and then
put in place by dynamic partition overwrite. A change that was interrupted while it was put in place is whole in
``_staged`` and is put in place again by the next operation on the table, before anything is read; one that was
interrupted earlier is dropped and changed nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history as N
from ..operators.upsert import newest_per_key, unique_or_fail, upsert

STAGED = "_staged"
KEY_PART = "key_part"
CLOSED_MONTH, CLOSED_AT, OPEN = "closed_month", "closed_at", "open"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _put_in_place(spark: SparkSession, staged: str, schema: T.StructType, path: str, by: list[str]) -> None:
    (spark.read.schema(schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def recover(spark: SparkSession, path: str, schema: T.StructType, by: list[str]) -> None:
    """Put whole staged changes of ``path`` in place and drop unfinished ones."""
    files, staged = _file_system(spark, f"{path}/{STAGED}")
    if not files.exists(staged):
        return
    for change in files.listStatus(staged):
        name = change.getPath().toString()
        if files.exists(_file_system(spark, f"{name}/_SUCCESS")[1]):
            _put_in_place(spark, name, schema, path, by)
        files.delete(change.getPath(), True)


def replace_parts(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the parts of ``path`` that ``df`` has rows of; ``df`` may read the table itself."""
    spark = df.sparkSession
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(staged)
    _put_in_place(spark, staged, df.schema, path, by)
    files, place = _file_system(spark, staged)
    files.delete(place, True)


def read_parts(spark: SparkSession, path: str, schema: T.StructType, by: list[str]) -> DataFrame:
    """The table with its part columns; without rows where nothing was written yet."""
    recover(spark, path, schema, by)
    files, place = _file_system(spark, path)
    if not files.exists(place):
        files.mkdirs(place)
    return spark.read.schema(schema).parquet(path)


def ensure_parts(spark: SparkSession, path: str, schema: T.StructType, part: str = KEY_PART) -> None:
    """Where nothing is stored yet, one empty part with the declared columns, so that readers find them."""
    files, place = _file_system(spark, path)
    if not files.exists(place) or not any(f.getPath().getName().startswith(f"{part}=") for f in files.listStatus(place)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{part}=0")


# ------------------------------------------------------------------ upsert

def _key_part(schema: T.StructType, key: str, parts: int):
    """Part of a row: by its key; rows without one are dealt by their contents, so they are no hot part."""
    plain = [f.name for f in schema.fields if isinstance(f.dataType, T.AtomicType) and f.name != KEY_PART
             and not isinstance(f.dataType, T.VariantType)]
    return F.pmod(F.coalesce(F.when(F.col(key).isNotNull(), F.xxhash64(key)), F.xxhash64(*plain)), F.lit(parts)).cast("int")


def upsert_parts(spark: SparkSession, path: str, batch: DataFrame, key: str, parts: int = 64,
                 dedupe_order: list[str] | None = None) -> list[int]:
    """Upsert ``batch`` into the table at ``path`` by ``key``; the parts that were rewritten.

    The table is cut into ``parts`` parts by a hash of the key, the same number in every call. Only parts that the batch
    has keys of are read, merged and rewritten; an empty batch rewrites none. The batch is computed once. Repeated keys
    fail, unless ``dedupe_order`` tells the newest row. Rows without a key match nothing and are inserted.
    """
    from ..plans.layout import written

    one = newest_per_key(batch, key, dedupe_order) if dedupe_order else unique_or_fail(batch, key)
    staged = written(one.withColumn(KEY_PART, _key_part(one.schema, key, parts)), "upsert-batch")
    touched = sorted(r[0] for r in staged.select(KEY_PART).distinct().collect())        # at most ``parts`` numbers
    if not touched:
        return []
    stored = read_parts(spark, path, staged.schema, [KEY_PART]).where(F.col(KEY_PART).isin(*touched))
    kept = stored.join(staged.where(F.col(key).isNotNull()).select(KEY_PART, key), [KEY_PART, key], "left_anti")
    merged = kept.select(*staged.columns).unionByName(staged)
    replace_parts(merged.repartition(len(touched), KEY_PART), path, [KEY_PART])
    return touched


# ------------------------------------------------------------------ history

def snapshot_parts(spark: SparkSession, path: str, current: DataFrame, key: str, check_cols: list[str], as_of,
                   invalidate_hard_deletes: bool = False) -> None:
    """Apply a check-strategy snapshot to the type-2 history at ``path``, which grows by its changes.

    Open rows are one part, rewritten by each snapshot. Rows that this snapshot closes are a part of their own, in the
    folder of its month: closed rows are never read or written again, and repeating a snapshot repeats nothing.
    """
    by = [CLOSED_MONTH, CLOSED_AT]
    opened = N.scd2_initial(current, key, as_of)
    closed = F.col(N.VALID_TO).isNotNull()
    # letters in front keep the folder names from being read as dates
    month = F.when(closed, F.date_format(N.VALID_TO, "'m'yyyy-MM")).otherwise(F.lit(OPEN))
    at = F.when(closed, F.date_format(N.VALID_TO, "'t'yyyyMMddHHmmss")).otherwise(F.lit(OPEN))
    schema = opened.withColumn(CLOSED_MONTH, month).withColumn(CLOSED_AT, at).schema
    stored = read_parts(spark, path, schema, by).where(F.col(CLOSED_MONTH) == OPEN).drop(*by)
    after = N.scd2_check(stored, current, key, check_cols, as_of, invalidate_hard_deletes)
    replace_parts(after.withColumn(CLOSED_MONTH, month).withColumn(CLOSED_AT, at), path, by)


def history_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole history at ``path``; ``schema`` is that of its rows (see ``history.scd2_initial``)."""
    by = [CLOSED_MONTH, CLOSED_AT]
    stored = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in by)])
    return read_parts(spark, path, stored, by).drop(*by)
