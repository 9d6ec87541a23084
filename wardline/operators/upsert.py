"""Upserts (MERGE by key) for file tables, as DataFrame steps.

Parquet tables have no MERGE, so an upsert is expressed as
``source ∪ (target ⟕anti keys(source))``: matched rows take every non-key
column from the source, unmatched target rows are kept, new keys are
inserted. The result is written as a new table version by
``wardline.sources.tables.commit_version`` (never over the table being read).

A source with repeated keys is reduced to its newest row per key first, with
a max over a struct (combined map-side, so a hot key never gathers in one
task).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import ts_ntz


def newest_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_cols`` (then by all other columns)."""
    rest = [c for c in df.columns if c != key and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(packed).alias("_b"))
    best = best.select(*[F.col(key) if c == key else F.col(f"_b.{c}").alias(c) for c in df.columns])
    return best.unionByName(df.where(F.col(key).isNull()))      # a missing key is no key: such rows stay apart


def unique_or_fail(df: DataFrame, key: str) -> DataFrame:
    """``df`` unchanged; the job fails if two rows share a key (rows without a key may repeat)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.any_value(row).alias("_b"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit(f"several source rows for {key} "), F.col(key).cast("string"))
    one = one.where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    return one.select(*[F.col(f"_b.{c}").alias(c) for c in df.columns]).unionByName(df.where(F.col(key).isNull()))


def upsert(target: DataFrame, source: DataFrame, key: str,
           update_cols: Sequence[str] | None = None,
           dedupe_order: Sequence[str] | None = None) -> DataFrame:
    """MERGE source into target on ``key``.

    Source rows that share a key fail the job, unless ``dedupe_order`` says
    which of them is the newest. Source rows without a key match nothing and
    are all inserted.

    ``update_cols`` lists the columns a match replaces (default: all non-key
    columns); the others keep the target's value on a match. An empty source
    leaves the target unchanged.
    """
    cols = target.columns
    src = source.select(*cols)
    if dedupe_order:
        src = newest_per_key(src, key, dedupe_order)
    else:
        src = unique_or_fail(src, key)
    if update_cols is None or set(update_cols) >= set(c for c in cols if c != key):
        kept = target.join(src.select(key), key, "left_anti")
        return kept.unionByName(src)
    # partial update: matched rows mix source and target columns
    t, s = target.alias("t"), src.alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    matched = F.col(f"s.{key}").isNotNull()
    out = []
    for c in cols:
        if c == key:
            out.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col(f"t.{key}").isNotNull(), F.col(f"t.{c}"))
                       .otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def record_id(record_json: Column, field: str = "id", default: str = R.UNKNOWN_ID) -> Column:
    """Id taken from a JSON record; missing → 'UNKNOWN'."""
    return F.coalesce(F.get_json_object(record_json, f"$.{field}"), F.lit(default))


def upsert_records(target: DataFrame, records: DataFrame, id_col: str, as_of: _dt.datetime,
                   id_expr: Column | None = None) -> DataFrame:
    """Generic record upsert: (id, record, fetched_at, loaded_at).

    ``records`` holds ``record`` (JSON text) and ``fetched_at``; the id comes
    from ``id_expr`` (default: the record's ``id`` field, else 'UNKNOWN').
    ``loaded_at`` is ``as_of`` for every inserted or updated row; rows the
    batch does not touch keep theirs. Several records with one id keep the
    newest fetch; records without one are all kept, as 'UNKNOWN'.
    """
    ident = id_expr if id_expr is not None else record_id(F.col("record"))
    src = records.select(F.nullif(ident, F.lit(R.UNKNOWN_ID)).alias(id_col), F.col("record"), F.col("fetched_at"),
                         ts_ntz(as_of).alias("loaded_at"))
    src = newest_per_key(src, id_col, ["fetched_at"]).withColumn(id_col, F.coalesce(id_col, F.lit(R.UNKNOWN_ID)))
    named = src.where(F.col(id_col) != R.UNKNOWN_ID)
    kept = target.select(id_col, "record", "fetched_at", "loaded_at").join(named.select(id_col), id_col, "left_anti")
    return kept.unionByName(src)
