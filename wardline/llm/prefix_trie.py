"""Conversation prefix trie by depth-band rollup.

A node is a distinct sequence of first turns. It is named by its depth and a 128-bit digest: the exclusive or of the
digests of its turns, each taken together with its place. Such digests are prefix sums, so they are found over sorted
slices of all turns and one carry per slice, however long a conversation is.

Subtree totals need every node's ancestors. Depths are cut into bands of ``BAND``; a node meets its ancestors inside its
band only, through the path of its smallest member there. Before that, each band gives one sum to its root, and the
roots, a band apart, form a trie of their own that is rolled up in the same way: a root's completed total then counts for
its ancestors in the band above. Rounds follow the logarithm of the greatest depth, and no node gives more than ``BAND``
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import settle

BAND = 16
SALTS = 256
IDS_PER_CHUNK = 50_000
KEY = ["depth", "x1", "x2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()
_WORDS = r"[^\x20\x09-\x0D]+"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, c1, c2, words): each turn as a digest of its role and text and its number of words.

    Null role or text counts as empty. A row without conv_id is part of no conversation and is left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long"), "turn", digest.alias("digest"),
                       F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words"))
    half = [F.conv(F.substring("digest", at, 16), 16, -10).cast("long") for at in (1, 17)]
    return rows.select("conv_id", "turn", half[0].alias("c1"), half[1].alias("c2"), "words")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``no``: the number of the row among those of its conv_id, which are in a row; conv_id is column 0."""
    last, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]]))
        at = np.arange(1, len(ids) + 1)
        base = np.zeros(len(ids), np.int64)
        base[starts] = np.diff(np.concatenate([[0], starts]))
        no = at - np.cumsum(base) + np.where(at <= (starts[0] if len(starts) else len(ids)), n, 0)
        last, n = ids[-1], int(no[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(no)], [*batch.schema.names, "no"])


def _numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (conv_id first) with slice, no, place and ``final``.

    Rows are sorted over all slices by conv_id and ``order``; ``no`` counts those of a conversation in its slice, place
    all of them from 1; ``final`` tells that the conversation goes on in no later slice. Only the first conversation of a
    slice goes on from an earlier one, so what is joined back has at most two rows a slice.
    """
    sorted_rows = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    sorted_rows = sorted_rows.withColumn("slice", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_rows.schema)
    placed = settle(sorted_rows.mapInArrow(_runs, f"{schema}, no bigint"), name)
    runs = placed.groupBy("slice", "conv_id").agg(F.max("no").alias("n"))
    by_slice = Window.partitionBy("conv_id").orderBy("slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("slice", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.lead("slice").over(by_slice).isNull().alias("final"))
    split = runs.where((F.col("before") > 0) | ~F.col("final"))
    joined = placed.join(F.broadcast(split), ["slice", "conv_id"], "left")
    return joined.select(*placed.columns, (F.col("no") + F.coalesce("before", F.lit(0))).alias("place"),
                         F.coalesce("final", F.lit(True)).alias("final"))


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, number, c1, c2, words): turns in order, null first; equal turns by their digest, equal rows one after
    the other."""
    # digests are taken once, not again for the sample that cuts the slices; equal rows may go to different slices
    rows = settle(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    numbered = _numbered(rows, [F.col(c) for c in ("turn", "c1", "c2", "row")], "numbered-turns")
    return numbered.select("conv_id", F.col("place").alias("number"), "c1", "c2", "words")


def rebuild(numbered: DataFrame, family: int, most: int) -> DataFrame:
    """Conversations that begin as the first of their family: (conv_id, part, number, c1, c2, words).

    Conversation c gets the first h turns of conversation c - c mod family (all if there are fewer, none if it is absent),
    then its own turns after its first h; h is the crc32 of its id modulo ``most``. Part 0 is a row for c itself.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    ids = numbered.where("number = 1").select("conv_id", h.alias("h"), F.pmod("conv_id", F.lit(family)).alias("off"))
    heads = numbered.where((F.col("number") < most) & (F.col("conv_id") % family == 0))
    heads = heads.select(F.col("conv_id").alias("first"), "number", "c1", "c2", "words")
    copied = ids.join(heads, (F.col("conv_id") - F.col("off") == F.col("first")) & (F.col("number") <= F.col("h")))
    own = numbered.where(F.col("number") > h)
    columns = ["number", "c1", "c2", "words"]
    none = [F.lit(0).cast("long").alias(c) for c in columns]
    return reduce(DataFrame.unionByName, [ids.select("conv_id", F.lit(0).alias("part"), *none),
                                          copied.select("conv_id", F.lit(1).alias("part"), *columns),
                                          own.select("conv_id", F.lit(2).alias("part"), *columns)])


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, p1, p2, words, ends): every prefix of every conversation, the empty one included.

    ``rows`` are (conv_id, part, number, c1, c2, words) in the order of part and number, one of part 0 for each
    conversation. x1 and x2 name the prefix, p1 and p2 the one before; ``ends`` tells that nothing follows.
    """
    placed = _numbered(rows, [F.col("part"), F.col("number")], "rebuilt-turns")
    depth = F.col("place") - 1
    named = placed.select("slice", "conv_id", "no", "final", "words", depth.alias("depth"),
                          F.when(depth > 0, F.xxhash64(depth, "c1", "c2")).otherwise(F.lit(0)).alias("e1"),
                          F.when(depth > 0, F.xxhash64("c2", "c1", depth, F.lit(1))).otherwise(F.lit(0)).alias("e2"))
    run = Window.partitionBy("slice", "conv_id")
    so_far = run.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    local = named.select("slice", "conv_id", "depth", "words", "e1", "e2",
                         *(F.bit_xor(e).over(so_far).alias(y) for e, y in (("e1", "y1"), ("e2", "y2"))),
                         (F.col("final") & (F.col("no") == F.max("no").over(run))).alias("ends"))
    local = settle(local, "turn-digests")
    runs = local.groupBy("slice", "conv_id").agg(F.min("depth").alias("from"), F.bit_xor("e1").alias("r1"),
                                                 F.bit_xor("e2").alias("r2"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select("slice", "conv_id", "from", F.bit_xor("r1").over(before).alias("b1"),
                        F.bit_xor("r2").over(before).alias("b2")).where("from > 0").drop("from")
    whole = local.join(F.broadcast(carry), ["slice", "conv_id"], "left")       # at most one row a slice
    x = [F.col(f"y{i}").bitwiseXOR(F.coalesce(F.col(f"b{i}"), F.lit(0))) for i in (1, 2)]
    return whole.select("conv_id", "depth", x[0].alias("x1"), x[1].alias("x2"), x[0].bitwiseXOR(F.col("e1")).alias("p1"),
                        x[1].bitwiseXOR(F.col("e2")).alias("p2"), "words", "ends")


def _paths(steps: DataFrame) -> DataFrame:
    """(conv_id, band, path): the prefixes of one conversation in one band, shallowest first."""
    band = F.floor(F.col("depth") / BAND).alias("band")
    path = F.array_sort(F.collect_list(F.struct(*KEY))).alias("path")
    return steps.groupBy("conv_id", band).agg(path)


def _rollup(nodes: DataFrame, steps: DataFrame, deepest: int, sums: list[str]) -> DataFrame:
    """(depth, x1, x2, *sums) summed over subtrees. ``nodes``: (conv_id, depth, *sums), conv_id the smallest member;
    ``steps``: (conv_id, depth, x1, x2) of every conversation."""
    add = [F.sum(s).alias(s) for s in sums]
    paths = _paths(steps)
    band = F.floor(F.col("depth") / BAND)
    work = nodes.select("conv_id", F.col("depth").alias("to"), band.alias("band"), *sums)
    if deepest >= BAND:
        roots = work.join(paths, ["conv_id", "band"]).select(F.col("path")[0].alias("root"), *sums)
        roots = roots.groupBy("root").agg(*add).select("root.*", *sums)
        members = nodes.where(F.col("depth") % BAND == 0).select("conv_id", *KEY)
        roots = roots.join(members, KEY).select("conv_id", (F.col("depth") / BAND).cast("long").alias("depth"),
                                                "x1", "x2", *sums)
        roots = settle(roots, "band-roots")
        above = steps.where(F.col("depth") % BAND == 0).withColumn("depth", (F.col("depth") / BAND).cast("long"))
        done = _rollup(roots, above, deepest // BAND, sums)
        done = done.join(roots.select("conv_id", *KEY), KEY).where("depth > 0")
        work = work.unionByName(done.select("conv_id", (F.col("depth") * BAND - 1).alias("to"),
                                            (F.col("depth") - 1).alias("band"), *sums))
    met = work.join(paths, ["conv_id", "band"])
    up = met.select(F.explode(F.filter("path", lambda p: p["depth"] <= F.col("to"))).alias("node"), *sums)
    return settle(up.groupBy("node").agg(*add).select("node.*", *sums), "subtree-sums")


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x1, x2, conv_id) → (depth, x1, x2, first, ids): decimal ids of one node, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        ids = batch.column(3).to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts = np.union1d(np.concatenate([[0], new]), np.arange(0, len(ids), most))
        texts = [",".join(map(str, part.tolist())) for part in np.split(ids, starts[1:])]
        columns = [pa.array(key[starts, i]) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(ids[starts]), pa.array(texts)], [*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order → (depth, x1, x2, ends_sha256), one chunk held at a time."""
    node, sha, done = None, None, []

    def rows() -> pa.RecordBatch:
        columns = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])],
                                          [*KEY, "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if key != node:
                if node:
                    done.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield rows()
    if node:
        done.append((*node, sha.hexdigest()))
        yield rows()


def _ends(steps: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes where conversations end.

    Ids are sorted and written out in slices; what is left for one task is to hash the chunks of a node, as SHA-256 can
    only be taken from front to back.
    """
    ends = steps.where("ends").select(*KEY, "conv_id")
    sliced = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    most = IDS_PER_CHUNK
    chunks = settle(sliced.mapInArrow(lambda batches: _chunks(batches, most),
                                      "depth bigint, x1 bigint, x2 bigint, first bigint, ids string"), "ends")
    ordered = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return ordered.mapInArrow(_digests, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of ``rows`` (as ``prefixes`` takes them).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): conv_id is the smallest
    member; parent_conv_id is null for the root; n_leaves and saved_tokens are sums over the subtree, saved_tokens of
    (n_convs - 1) times the words of each node's last turn; ends_sha256 is taken of the ids of the conversations that end
    there. No rows give no nodes, not even a root.
    """
    steps = settle(prefixes(rows), "prefixes")
    nodes = settle(steps.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words")), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    weighted = nodes.select("conv_id", *KEY, (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
                            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    sums = _rollup(weighted, steps.select("conv_id", *KEY), deepest, ["n_leaves", "saved_tokens"])

    # a parent may have any number of children: they meet it in groups, which salts split
    salt = F.pmod(F.col("x1"), F.lit(SALTS)).cast("int")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), salt.alias("salt")]
    below = nodes.where("depth > 0").select(*above, F.struct(*KEY).alias("child"))
    groups = settle(below.groupBy(*KEY, "salt").agg(F.count(F.lit(1)).alias("n")), "children")
    named = groups.join(nodes.select(*KEY, "conv_id"), KEY).select(*KEY, "salt", F.col("conv_id").alias("parent_conv_id"))
    parents = below.join(named, [*KEY, "salt"]).select("child.*", "parent_conv_id")
    children = groups.groupBy(*KEY).agg(F.sum("n").alias("n_children"))
    found = nodes.select(*KEY, "conv_id", "n_convs").join(sums, KEY).join(parents, KEY, "left")
    found = found.join(children, KEY, "left").join(_ends(steps), KEY, "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, family: int | None = None, most: int = 4) -> DataFrame:
    """``trie`` of a table (conv_id, turn, role, text); with ``family``, of its conversations as ``rebuild`` makes them.

    Turns are ordered by turn, null first; turns with the same number by a digest of role and text. Null role or text
    counts as empty; repeated rows are turns of their own; rows without conv_id are left out; other columns are not read.
    """
    numbered = number_turns(turn_rows(conversations))
    if family:
        return trie(rebuild(settle(numbered, "own-turns"), family, most))
    ids = numbered.where("number = 1")
    none = [F.lit(0).cast("long").alias(c) for c in ("number", "c1", "c2", "words")]
    return trie(ids.select("conv_id", F.lit(0).alias("part"), *none).unionByName(
        numbered.select("conv_id", F.lit(1).alias("part"), "number", "c1", "c2", "words")))
