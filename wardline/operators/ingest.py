"""Ingest-side relational steps: severity filter, per-ecosystem cap,
first-seen dedupe and incremental windows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from ..functions.columns import order_rank, ts_ntz
from ..plans.layout import written


def filter_in_ci(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose lower-cased value is in the set; NULL counts as '' and is dropped."""
    return df.where(F.lower(F.coalesce(F.col(col), F.lit(""))).isin(*[v.lower() for v in values]))


def cap_per_group(df: DataFrame, group: str, order: Sequence[str], n: int, salts: int = 16) -> DataFrame:
    """At most ``n`` rows per group, the first ones by ``order``.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    each shuffle, so map tasks forward at most ``n`` rows per group. With
    ``salts`` > 1 the limit runs twice: first per (group, salt) where the salt
    is a hash of the row's order key, then per group over the survivors. The
    first n of a group are among the first n of each salt slice, so the
    result is the same, but the last task of a hot group sees at most
    ``n * salts`` rows instead of ``n`` per map task of the whole input.
    """
    keys = [F.col(c) for c in order]
    out = df
    if salts > 1:
        salt = F.pmod(F.xxhash64(*keys), F.lit(salts))
        w1 = Window.partitionBy(F.col(group), salt).orderBy(*keys)
        out = out.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") <= n).drop("_rn")
    w = Window.partitionBy(group).orderBy(*keys)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_per_group(df: DataFrame, group: str, position: str, n: int, bins: int = 1024) -> DataFrame:
    """At most ``n`` rows per group, the first ones by the whole number ``position``, for any ``n``.

    No group is sorted. The value of the n-th position is found by counting: each round cuts the open range of
    a group's positions into ``bins`` equal parts, counts rows in them (combined in each task) and goes on in the part that
    holds the n-th row; the range shrinks by ``bins`` each time, so a few scans of two columns do. The rows then follow
    from a filter. Of rows with the same position as the n-th, those with the smaller content hash stay, found in the same
    way, and of wholly equal rows any. Rows without a position come first, as they sort first. Null is a group.
    """
    at = F.coalesce(F.col(position).cast("long"), F.lit(-2**63))
    content = F.xxhash64(*[f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)
                           and not isinstance(f.dataType, VariantType)])
    by_position = _nth_value(df.select(F.col(group).alias("g"), at.alias("x")), n, bins)
    bound = by_position.select(F.col("g").alias("_g"), F.col("cut").alias("_cut"), (F.lit(n) - F.col("before")).alias("_left"))
    marked = df.join(bound, F.col(group).eqNullSafe(F.col("_g")))
    sure = marked.where(at < F.col("_cut"))
    tied = marked.where(at == F.col("_cut")).withColumn("_x", content)
    ties = _nth_value(tied.select(F.col("_g").alias("g"), F.col("_x").alias("x"), "_left"), None, bins)
    last = ties.select(F.col("g").alias("_tg"), F.col("cut").alias("_tcut"))
    tied = tied.join(last, F.col("_g").eqNullSafe(F.col("_tg"))).where(F.col("_x") <= F.col("_tcut"))
    return sure.select(*df.columns).unionByName(tied.select(*df.columns))


def _nth_value(rows: DataFrame, n: int | None, bins: int) -> DataFrame:
    """(g, cut, before): the value of the n-th smallest ``x`` of each group and how many are smaller; the greatest value
    and 0 where a group has no more. ``n`` None: the number is the rows' own ``_left``."""
    number = F.lit(n) if n is not None else F.max("_left")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    state = written(rows.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("rows"),
                                          number.cast("long").alias("n"))
                    .withColumn("n", F.least("n", "rows")).withColumn("before", F.lit(0).cast("long"))
                    # a group that is wanted whole is cut at its end
                    .withColumn("lo", F.when(F.col("n") == F.col("rows"), F.col("hi")).otherwise(F.col("lo"))), "ranges")
    while not state.where("lo < hi").isEmpty():
        width = F.ceil((wide("hi") - wide("lo") + 1) / bins)
        opened = state.where("lo < hi").select(F.col("g").alias("_g"), "lo", "hi", "n", "before", width.alias("width"))
        met = rows.select("g", "x").join(opened, F.col("g").eqNullSafe(F.col("_g")) & F.col("x").between(F.col("lo"), F.col("hi")))
        part = F.expr("cast((cast(x as decimal(38,0)) - cast(lo as decimal(38,0))) div width as long)")
        counts = met.groupBy("g", "lo", "hi", "n", "before", "width", part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
        so_far = Window.partitionBy("g").orderBy("part")                  # at most ``bins`` rows a group
        counts = counts.withColumn("upto", F.col("before") + F.sum("c").over(so_far)).where("upto >= n")
        first = counts.groupBy("g", "lo", "hi", "n", "width").agg(F.min(F.struct("part", "upto", "c")).alias("f"))
        start = wide("lo") + F.col("f.part") * F.col("width")
        narrowed = first.select("g", start.cast("long").alias("lo"),
                                F.least(wide("hi"), start + F.col("width") - 1).cast("long").alias("hi"), "n",
                                (F.col("f.upto") - F.col("f.c")).alias("before"))
        state = written(narrowed.unionByName(state.where("lo = hi").drop("rows"), allowMissingColumns=True)
                        .select("g", "lo", "hi", "n", "before"), "ranges")
    return state.select("g", F.col("lo").alias("cut"), "before")


def first_seen(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Keep, per key, the row that comes first by ``order`` (not an arbitrary one).

    A min over a struct (order columns first, then the row) is combined
    map-side, so a hot key is reduced before it is shuffled.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)],
                      *[F.col(c) for c in df.columns if c != key])
    best = df.groupBy(key).agg(F.min(packed).alias("_b"))
    return best.select(*[F.col(key) if c == key else F.col(f"_b.{c}").alias(c) for c in df.columns])


def ecosystem_listing(df: DataFrame, ecosystems: Sequence[str], eco_col: str = "ecosystem") -> DataFrame:
    """Only the listed ecosystems, with their list position as ``ecosystem_rank``."""
    return (df.where(F.col(eco_col).isin(*ecosystems))
            .withColumn("ecosystem_rank", order_rank(F.col(eco_col), ecosystems).cast("int")))


def fetch_advisories(listing: DataFrame, ecosystems: Sequence[str], severities: Sequence[str],
                     limit: int | None = None) -> DataFrame:
    """The fetch as a job: the severity filter over the whole listing, then first-seen
    dedupe in ecosystem-list order. ``limit`` keeps only the first rows of each
    ecosystem's listing, for a caller that asks for a page limit."""
    lst = ecosystem_listing(listing, ecosystems)
    if limit is not None:
        lst = cap_per_group(lst, "ecosystem", ["position"], limit)
    kept = filter_in_ci(lst, "severity", severities)
    return first_seen(kept, "ghsa_id", ["ecosystem_rank", "position"])


def since(df: DataFrame, col: str, from_: _dt.date | _dt.datetime, day_col: str | None = None) -> DataFrame:
    """Rows updated on or after ``from_`` (a literal bound: pushed to the scan).

    ``day_col`` names a day partition column to prune on as well.
    """
    if day_col is not None:
        df = df.where(F.col(day_col) >= F.to_date(ts_ntz(from_)))
    return df.where(F.col(col) >= ts_ntz(from_))


def between_optional(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Closed range on ``col``; only the bounds that are given apply."""
    if lo is not None:
        df = df.where(F.col(col) >= ts_ntz(lo))
    if hi is not None:
        df = df.where(F.col(col) <= ts_ntz(hi))
    return df
