"""Nearest neighbours by inner product, with a hash-prefix forest.

Every tree gives each vector a 64-bit label (signs of random projections) and keeps the labels as one sorted array.
A query descends to its place in each array, where the longest shared prefixes are, and all trees then ascend
together: the prefix length is lowered until the trees hold, on average, ``reach`` vectors that share it. Those are
scored exactly.

On Spark a tree's array is sorted by range and cut into blocks of equal rank ranges. Equal labels are ordered by a hash
that differs from tree to tree, so that each tree has other neighbours beside a query. A query goes to the blocks that
its window overlaps, which reaches over all entries with the query's full label; a block reports how many of its entries share each prefix length and the best scored ones for
each. Blocks, and the queries sent to one copy of a block, are bounded, so no task follows the table.

Identical vectors are one entry: a class named by its smallest id, with its ``k + 1`` smallest ids (no query can
return more of them).

``reach`` is a share of the index. Vectors without any structure need such a share (on isotropic 64-dimensional
data 20 neighbours at recall 0.9 take about the same share at any size); clustered ones do with a far smaller one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import settle

TREES = 20
BITS = 64
SHARE = 0.04
LEAST_REACH = 1000
BLOCK = 1 << 14
QUERIES_PER_COPY = 1 << 11
SEED = 42

_ENTRY = "tree int, label bigint, class_id {id}, is_query boolean"
_FOUND = "query bigint, counts array<bigint>, hits array<struct<shared:int,class_id:bigint,score:double>>"


def _planes(dim: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((trees, dim, BITS))


def _labels(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """64-bit labels; the first projection is the most significant bit."""
    signs = np.packbits(vectors @ planes > 0, axis=1)
    return signs.view(">u8")[:, 0].astype(np.uint64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _valid(embedding: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embedding.isNotNull() & fine & F.exists(embedding, lambda x: x != 0)


def _shared(labels: np.ndarray, label: np.uint64) -> np.ndarray:
    """Length of the common prefix of each label with ``label``."""
    x = labels ^ label
    high = (x >> np.uint64(32)).astype(np.float64)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1])


def _best(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k of ``at`` with the largest scores, ties to smaller ids."""
    if len(at) > k:
        edge = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= edge]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def search(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, share: float = SHARE,
           least_reach: int = LEAST_REACH, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``is_query`` holds, among all
    other rows, by inner product; nearest first, ties to the smaller id.

    Rows whose id is null, or whose vector is null, zero, holds null or non-finite components or has another length
    than most, take no part. Repeated ids count once per different vector; an id is never its own neighbour. Other
    columns are read by ``is_query`` only. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    dim = rows.select(F.mode(F.size("embedding"), deterministic=True)).first()[0]
    if dim is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("embedding") == dim)

    alike = Window.partitionBy("embedding").orderBy("vec_id")
    members = rows.select("vec_id", "embedding").distinct()
    members = settle(members.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1), "members")
    classes = members.where("place = 1").select(F.col("vec_id").alias("class_id"), "embedding")
    asked = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asked = settle(asked.join(classes, "embedding").select("query_id", "class_id"), "queries")
    named = members.join(classes, "embedding").select("class_id", "vec_id")
    asking = asked.select("class_id").distinct().withColumn("is_query", F.lit(True))
    classes = settle(classes.join(asking, "class_id", "left").withColumn("is_query", F.col("is_query").isNotNull()),
                     "classes")
    size = classes.count()
    reach = min(size, max(least_reach, int(np.ceil(share * size))))
    found = _search_forest(classes, dim, size, reach, trees, k + 1)

    # back from classes to ids: the k + 1 best of a query class serve each of its members
    hits = found.select("query", F.explode("hits").alias("hit")).select("query", "hit.class_id", "hit.score")
    hits = hits.join(named, "class_id").groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k + 1).alias("hits"))
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    done = asked.join(hits, asked["class_id"] == hits["query"]).select("query_id", F.posexplode(others).alias("at", "hit"))
    return done.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id",
                       (-F.col("hit.far")).alias("score"))


def _search_forest(classes: DataFrame, dim: int, size: int, reach: int, trees: int, k: int) -> DataFrame:
    """(query, hits) for the classes marked as queries: the ``k`` best classes the forest holds within reach."""
    planes = _planes(dim, trees)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree, np.int32)), pa.array(_labels(x, planes[tree]).view(np.int64)),
                     batch.column(0), batch.column(2)], ["tree", "label", "class_id", "is_query"])

    entries = classes.select("class_id", "embedding", "is_query").mapInArrow(label, _ENTRY.format(id="bigint"))
    # labels are unsigned: their sign bit is flipped for sorting
    entries = entries.withColumn("label", F.col("label").bitwiseXOR(F.lit(-(1 << 63))))
    order = ["tree", "label", F.xxhash64("tree", "class_id"), "class_id"]
    ordered = entries.repartitionByRange(*order).sortWithinPartitions(*order)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, after, part = -1, 0, TaskContext.get().partitionId()
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.arange(len(names), dtype=np.int64)
            first = np.searchsorted(names, names)                    # sorted: where each tree starts in this batch
            at = at - first + np.where(names == tree, after, 0)
            if len(names):
                after, tree = int(at[-1]) + 1, int(names[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(names), part, np.int32)),
                                              pa.array(at)], [*batch.schema.names, "slice", "at"])

    ordered = settle(ordered.mapInArrow(place, _ENTRY.format(id="bigint") + ", slice int, at bigint"), "forest")
    before = Window.partitionBy("tree").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("tree", "slice").count().select(       # one row per tree and slice
        "tree", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    ranked = ordered.join(F.broadcast(offsets), ["tree", "slice"]).select(
        "tree", "label", "class_id", "is_query", (F.col("at") + F.col("offset")).alias("place"))

    window = min(size, 2 * reach)
    blocks = (size - 1) // BLOCK
    # runs of one label that a window may not span: at most size / window a tree
    equal = ranked.groupBy("tree", "label").agg(F.min("place").alias("run_first"), F.max("place").alias("run_last"))
    equal = settle(equal.where(F.col("run_last") - F.col("run_first") > window), "equal-labels")
    longest = equal.agg(F.max(F.col("run_last") - F.col("run_first"))).first()[0] or 0
    ranked = ranked.join(F.broadcast(equal), ["tree", "label"], "left").select(
        "tree", "label", "class_id", "is_query", "place",
        F.least(F.col("place") - window, F.col("run_first")).alias("lo"),
        F.greatest(F.col("place") + window, F.col("run_last")).alias("hi"))
    ranked = ranked.join(classes.select("class_id", "embedding"), "class_id")
    per_block = max(1, int(classes.where("is_query").count() * min(1.0, (BLOCK + 2 * max(window, longest)) / size)))
    copies = max(1, -(-per_block // QUERIES_PER_COPY))
    copy = F.pmod(F.xxhash64("class_id"), F.lit(copies)).cast("int")
    index = ranked.select("tree", F.floor(F.col("place") / BLOCK).cast("long").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(False).alias("asks"),
                          "label", "class_id", "place", F.col("place").alias("lo"), F.col("place").alias("hi"), "embedding")
    first = F.greatest(F.lit(0), F.floor(F.col("lo") / BLOCK)).cast("long")
    last = F.least(F.lit(blocks), F.floor(F.col("hi") / BLOCK)).cast("long")
    queries = ranked.where("is_query").select("tree", F.explode(F.sequence(first, last)).alias("block"),
                                              copy.alias("copy"), F.lit(True).alias("asks"), "label", "class_id",
                                              "place", "lo", "hi", "embedding")

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        labels = table.column("label").to_numpy().view(np.uint64)
        ids, places, lows, highs = (table.column(c).to_numpy() for c in ("class_id", "place", "lo", "hi"))
        x = _matrix(table.column("embedding").combine_chunks(), dim)
        order = np.flatnonzero(~asks)
        order = order[np.argsort(places[order])]
        labels_in, ids_in, places_in, x_in = labels[order], ids[order], places[order], x[order]
        out_query, out_counts, out_hits = [], [], []
        for q in np.flatnonzero(asks):
            lo, hi = np.searchsorted(places_in, [lows[q], highs[q] + 1])
            if lo == hi:
                continue
            shared = _shared(labels_in[lo:hi], labels[q])
            scores = x_in[lo:hi] @ x[q]
            kept = np.zeros(0, np.int64)
            hits: dict[int, tuple] = {}
            for level in np.unique(shared)[::-1]:
                kept = _best(scores, ids_in[lo:hi], np.concatenate([kept, np.flatnonzero(shared == level)]), k)
                for i in kept.tolist():
                    if i not in hits:
                        hits[i] = (int(shared[i]), int(ids_in[lo + i]), float((x_in[lo + i] * x[q]).sum()))
            out_query.append(int(ids[q]))
            out_counts.append(np.bincount(shared, minlength=BITS + 1).tolist())
            out_hits.append([{"shared": s, "class_id": c, "score": p} for s, c, p in hits.values()])
        hit = pa.struct([("shared", pa.int32()), ("class_id", pa.int64()), ("score", pa.float64())])
        return pa.table({"query": pa.array(out_query, pa.int64()), "counts": pa.array(out_counts, pa.list_(pa.int64())),
                         "hits": pa.array(out_hits, pa.list_(hit))})

    found = index.union(queries).groupBy("tree", "block", "copy").applyInArrow(meet, _FOUND)

    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, chosen = [], []
            for row in batch.to_pylist():
                held = np.cumsum(np.array(row["counts"], np.int64).sum(axis=0)[::-1])[::-1]   # sharing at least ...
                enough = np.flatnonzero(held >= min(reach * trees, held[0]))
                level = int(enough[-1])
                best = {h["class_id"]: h["score"] for hits in row["hits"] for h in hits if h["shared"] >= level}
                names.append(row["query"])
                chosen.append([{"class_id": c, "score": s}
                               for c, s in sorted(best.items(), key=lambda h: (-h[1], h[0]))[:k]])
            kind = pa.list_(pa.struct([("class_id", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(chosen, kind)], ["query", "hits"])

    # a query has one row per tree and block that its window touches
    gathered = found.groupBy("query").agg(F.collect_list("counts").alias("counts"), F.collect_list("hits").alias("hits"))
    return gathered.mapInArrow(ascend, "query bigint, hits array<struct<class_id:bigint,score:double>>")
