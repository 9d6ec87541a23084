"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``distance`` bits apart meet in a value that is at most half that distance from
each. Every distinct fingerprint emits all values in its ball of that radius (2,081 for four bits); values are
dealt to buckets, equal values collide, and colliding fingerprints are verified and linked.

The bucket of a value folds its bits: every bucket bit is the exclusive or of some of them, each value bit is part of
one at most. The values that a fingerprint sends to one bucket follow from the fingerprint alone, and with b bucket bits
a ball of radius 2 reaches 1 + b + b (b - 1) / 2 buckets only. What goes through the shuffle is therefore one
fingerprint per bucket it reaches, packed per task and bucket, and each bucket writes out the values of its own. The
number of buckets follows the number of fingerprints, so that a bucket holds about ``VALUES_PER_BUCKET`` values at any
size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, settle, steps
from wardline.llm.components import connected_components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
VALUES_PER_BUCKET = 1 << 22
LEAST_BUCKET_BITS = 5
PASS_BITS = 2
_HASHES_PER_STEP = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text, unsigned: ASCII lower case, words between ASCII white space, hashed word shingles."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        starts = (ends - np.fromiter(map(len, tokens), np.int64, len(tokens)) - 1).tolist()
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[words - 1:] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHES_PER_STEP):
        part = np.array(hashes[at:at + _HASHES_PER_STEP], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row, whole texts; fp is the fingerprint as a signed long, 0 for null or wordless text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, 1):
            fps = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps)], ["doc_id", "fp"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, run, f"doc_id {id_type}, fp bigint")


@lru_cache(maxsize=4)
def _ball(radius: int) -> np.ndarray:
    """Every 64-bit mask of at most ``radius`` set bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r)], np.uint64)


@lru_cache(maxsize=4)
def _bucket_tables(bits: int) -> np.ndarray:
    """Linear map from 64 to ``bits`` + ``PASS_BITS`` bits, as one table of 256 per byte: bit i goes to bit i modulo
    their number. The low ``bits`` name the bucket, the others a part of it."""
    columns = [1 << i % (bits + PASS_BITS) for i in range(64)]
    tables = np.zeros((8, 256), np.int64)
    for byte in range(8):
        for value in range(256):
            for b in range(8):
                if value >> b & 1:
                    tables[byte, value] ^= columns[8 * byte + b]
    return tables


def _bucket(values: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each value."""
    return _part(values, bits) & ((1 << bits) - 1)


def _part(values: np.ndarray, bits: int) -> np.ndarray:
    """The bucket and, in the bits above, the part of it."""
    tables = _bucket_tables(bits)
    out = np.zeros(len(values), np.int64)
    for byte in range(8):
        out ^= tables[byte][((values >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)]
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the edges (a, b), for indices below n."""
    parent = np.arange(n)
    while True:
        x, y = parent[a], parent[b]
        if (x == y).all():
            return parent
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def _collide(fps: np.ndarray, bucket: int, bits: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one bucket: each fingerprint that collides with another, and the smallest one it is tied to.

    The bucket's values are gone through in ``1 << PASS_BITS`` parts, of which one is held at a time.
    """
    ball = _ball(distance // 2)
    where = _part(ball, bits)
    order = np.argsort(where, kind="stable")
    masks, kinds = ball[order], where[order]
    fps = np.unique(fps)
    unsigned = fps.view(np.uint64)
    home = _part(unsigned, bits)
    links = [np.zeros(0, np.int64)]
    for part in range(1 << PASS_BITS):
        shift = home ^ (bucket | part << bits)
        start = np.searchsorted(kinds, shift, "left")
        counts = np.searchsorted(kinds, shift, "right") - start
        owner = np.repeat(np.arange(len(fps), dtype=np.int32), counts)
        place = np.arange(len(owner)) + np.repeat(start - np.cumsum(counts) + counts, counts)
        values = unsigned[owner] ^ masks[place]
        del place
        by_value = np.argsort(values)
        same = np.flatnonzero(values[by_value[1:]] == values[by_value[:-1]])
        a, b = owner[by_value[same]].astype(np.int64), owner[by_value[same + 1]].astype(np.int64)
        links.append(np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b)))
    pairs = np.unique(np.concatenate(links))
    a, b = pairs // max(1, len(fps)), pairs % max(1, len(fps))
    near = np.bitwise_count(unsigned[a] ^ unsigned[b]) <= distance
    root = _roots(len(fps), a[near], b[near])
    tied = np.flatnonzero(root != np.arange(len(fps)))
    return fps[tied], fps[root[tied]]


def near_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` of ``distinct`` at most ``distance`` bits apart.

    Fingerprints of one bucket are tied to the smallest they reach in it, so a dense cluster gives a link per
    fingerprint and bucket, not all its pairs.
    """
    ball = len(_ball(distance // 2))
    if distance % 2:
        raise ValueError("an even distance is needed to halve it")
    bits = max(LEAST_BUCKET_BITS, math.ceil(math.log2(max(1, distinct.count()) * ball / VALUES_PER_BUCKET)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = np.unique(_bucket(_ball(distance // 2), bits))
        rows_per_step = max(1, (1 << 22) // len(reach))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), rows_per_step):
                part = fps[at:at + rows_per_step]
                buckets = (_bucket(part.view(np.uint64), bits)[:, None] ^ reach[None, :]).ravel()
                order = np.argsort(buckets, kind="stable")
                dealt = np.repeat(part, len(reach))[order]
                names, first = np.unique(buckets[order], return_index=True)
                packs = [p.tobytes() for p in np.split(dealt, first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(packs, pa.binary())], ["bucket", "pack"])

    def meet(table: pa.Table) -> pa.Table:
        fps = np.frombuffer(b"".join(table.column("pack").to_pylist()), np.int64)
        a, b = _collide(fps, table.column("bucket")[0].as_py(), bits, distance)
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    packs = distinct.select("fp").mapInArrow(deal, "bucket bigint, pack binary")
    return packs.groupBy("bucket").applyInArrow(meet, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable over fingerprints at most ``distance``
    bits apart.

    Null, empty and wordless texts have fingerprint 0, linked like any other. Repeated rows stay; null ids never
    name a component unless it has no other. Only ids and fingerprints are shuffled; columns other than the two
    named are not read.
    """
    fps = settle(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    linked = connected_components(near_links(distinct, distance))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(least, "root").select("fp", "least")
    named = distinct.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    named = settle(named, "components")              # an input of its own, so that a hot fingerprint can be split
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
