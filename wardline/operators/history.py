"""Slowly-changing history (type 2, check strategy) and as-of reads.

``scd2_check`` is a pure DataFrame → DataFrame step: it takes the stored
history and the current snapshot and returns the next history. Closed rows
never change, so they pass through untouched (a narrow filter); only the open
rows meet the snapshot, in one full outer join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ts_ntz

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
SCD_ID = "scd_id"


def _as_ts(as_of) -> Column:
    return ts_ntz(as_of)


def scd_id(key: Column, valid_from: Column) -> Column:
    """Row id: hash of key and the time the version opened."""
    return F.md5(F.concat(key.cast("string"), F.lit("|"), valid_from.cast("string")))


def scd2_initial(current: DataFrame, key: str, as_of) -> DataFrame:
    """First snapshot: every row opens a version."""
    t = _as_ts(as_of)
    return current.select("*", t.alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
                          scd_id(F.col(key), t).alias(SCD_ID))


def scd2_check(history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str],
               as_of, invalidate_hard_deletes: bool = False) -> DataFrame:
    """Apply one snapshot to a type-2 history.

    New key → open row. Any check column distinct (NULL-safe) → close the open
    row at ``as_of`` and open a new one. Unchanged → keep the open row as is
    (columns that are carried but not checked keep their stored value).
    Keys missing from the snapshot stay open unless ``invalidate_hard_deletes``.
    """
    t = _as_ts(as_of)
    cols = list(current.columns)
    closed = history.where(F.col(VALID_TO).isNotNull())
    j = _snapshot_join(history, current, key, check_cols)

    state = F.col("_state")
    null_ts = F.lit(None).cast("timestamp_ntz")
    # the stored row: kept open, or closed now
    old_row = F.struct(*[F.col(f"h.{x}").alias(x) for x in cols],
                       F.col(f"h.{VALID_FROM}").alias(VALID_FROM),
                       F.when(state == "changed", t)
                       .when((state == "vanished") & F.lit(invalidate_hard_deletes), t)
                       .otherwise(null_ts).alias(VALID_TO),
                       F.col(f"h.{SCD_ID}").alias(SCD_ID))
    # the snapshot row: opened now
    new_row = F.struct(*[F.col(f"c.{x}").alias(x) for x in cols], t.alias(VALID_FROM), null_ts.alias(VALID_TO),
                       scd_id(F.col(f"c.{key}"), t).alias(SCD_ID))
    # one pass over the join: each key emits its stored row, its new row, or both
    rows = F.filter(F.array(F.when(state.isin("changed", "unchanged", "vanished"), old_row),
                            F.when(state.isin("changed", "new"), new_row)),
                    lambda r: r.isNotNull())
    order = cols + [VALID_FROM, VALID_TO, SCD_ID]
    return closed.select(*order).unionByName(j.select(F.inline(rows)).select(*order))


def as_of_view(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: valid_from <= ts < valid_to (open rows have no end)."""
    t = _as_ts(ts)
    return history.where((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (t < F.col(VALID_TO))))


def _snapshot_join(history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Open history rows (alias ``h``) full-outer-joined to the snapshot (alias ``c``) with a ``_state``."""
    h = history.where(F.col(VALID_TO).isNull()).alias("h")
    c = current.alias("c")
    j = h.join(c, F.col(f"h.{key}") == F.col(f"c.{key}"), "full_outer")
    changed = None
    for col in check_cols:
        d = ~F.col(f"h.{col}").eqNullSafe(F.col(f"c.{col}"))
        changed = d if changed is None else (changed | d)
    in_h, in_c = F.col(f"h.{key}").isNotNull(), F.col(f"c.{key}").isNotNull()
    state = (F.when(in_h & in_c & changed, "changed").when(in_h & in_c, "unchanged")
             .when(in_c, "new").otherwise("vanished"))
    return j.withColumn("_state", state)


def key_states(history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Diagnostic: state of each key (changed / unchanged / new / vanished) for a snapshot."""
    j = _snapshot_join(history, current, key, check_cols)
    return j.select(F.coalesce(F.col(f"h.{key}"), F.col(f"c.{key}")).alias(key), F.col("_state").alias("state"))
