"""Helpers shared by the training-data operators: the shared folder, written intermediate tables, Arrow batching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BATCH = 500
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_TEXTS_PER_STEP = 256
_CHARS_PER_STEP = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a local session (tests) gets one of its own; any other session must name it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="wardline-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wardline-llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage is cut, executors may be lost.

    The folder stays until whoever owns ``spark.checkpoint.dir`` clears it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def map_texts(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches fit for rows that hold whole texts.

    Spark's default of 10,000 rows a batch can be gigabytes of long texts, in the JVM and in Python; the session's
    setting is lowered to ``ROWS_PER_BATCH`` where it is higher.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_ROWS)) > ROWS_PER_BATCH:
        conf.set(_BATCH_ROWS, str(ROWS_PER_BATCH))
    return df.mapInArrow(run, schema)


def steps(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of bounded total text size, so that memory does not follow the batch size."""
    for batch in batches:
        column = batch.column(text)
        if isinstance(column, (pa.ListArray, pa.LargeListArray)):
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        else:
            sizes = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and (total + n > _CHARS_PER_STEP or i - start >= _TEXTS_PER_STEP):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
