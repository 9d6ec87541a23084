"""Phrase collocation mining with Misra-Gries summaries.

First pass. Occurrences of n-grams are hashed, the hash space is cut into partitions, and each partition keeps a
Misra-Gries summary with more counters than its mass (the occurrences dealt to it) divided by the threshold. Such a
summary loses less than the threshold of any n-gram, also when it is merged from parts, so every n-gram that reaches the
threshold survives. The number of partitions follows the mass, which bounds a summary. Survivors set bits in a filter of
fixed size, a partition one stretch of it; the filter is all that is ever sent to tasks. An n-gram is only dealt if the
shorter ones in it have survived, order by order.

Second pass. What passes the filter is counted exactly, by its words: in each task by numbers that stand for them, then
by the phrase in its hash partition. So neither hashes that meet nor a filter that is full change a result, they only cost time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, new_folder, settle, steps

THRESHOLD = 100
LONGEST = 5
TOP = 2000
FILTER_BITS = 27
MASS_PER_PARTITION = 1 << 23
LEAST_PARTITION_BITS, MOST_PARTITION_BITS = 5, 20
HASHES_PER_FLUSH = 1 << 22
CHARS_AT_ONCE = 8_000_000
SALTS = 64
LEVELS = ((1,), (2,), (3, 4, 5))        # orders dealt in one pass over the texts
BORDER = 0                              # number and hash of the border between pieces
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(0xff if b in _ENDS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_A, _B = np.uint64(0x9e3779b97f4a7c15), np.uint64(0xc2b2ae3d27d4eb4f)


class Words(dict):
    """Word (bytes) → number from 1 on; ``hashes`` has one hash per number. 0 is the border."""

    def __init__(self):
        super().__init__({b"\xff": BORDER})
        self.spelled: list[bytes] = [b"\xff"]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.spelled)
        self.spelled.append(word)
        return number

    def hashes(self, seed: int) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(w, seed) for w in self.spelled), np.uint64, len(self.spelled))


def word_numbers(texts: list[str], words: Words) -> np.ndarray:
    """The words of some texts in order, by number, with borders where pieces and texts end."""
    # 0xff is in no UTF-8 text
    data = b"\xff".join(t.encode("utf-8", "surrogatepass") for t in texts) + b"\xff"
    parts = data.translate(_FOLD).replace(b"\xff", b" \xff ").split()
    return np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))


def _longer(before: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams, from those of the (n-1)-grams at the same places."""
    size = max(0, len(hashes) - n + 1)
    mixed = before[:size] * _B
    mixed ^= mixed >> np.uint64(29)
    return (mixed + hashes[n - 1:]) * _A


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(65 - (8 * len(bits)).bit_length())
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _places(numbers: np.ndarray, words: Words, lang: str, filters: dict[int, np.ndarray], longest: int
            ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hashes of all n-grams, whether one is inside a piece and all it contains may have survived), n ascending.

    For an order that has a filter itself, it must have passed that too.
    """
    by_number = words.hashes(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))) * _A
    own = by_number[numbers]
    inside = numbers != BORDER
    fits, hashes = inside, own
    for n in range(1, longest + 1):
        if n > 1:
            hashes = _longer(hashes, own, n)
            fits = fits[:-1] & fits[1:]
        if n in filters:
            at = np.flatnonzero(fits)
            fits = fits.copy()
            fits[at] = _passes(filters[n], hashes[at])
        yield n, hashes, fits


def _pack(values: np.ndarray) -> bytes:
    """Numbers of 32 bits with like bytes side by side, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def merge_summaries(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, more_counts: np.ndarray, capacity: int
                    ) -> tuple[np.ndarray, np.ndarray]:
    """A Misra-Gries summary of ``capacity`` counters from two: equal keys add up, then all counters sink by that of the
    greatest one beyond the capacity, and those at zero go."""
    both, sums = np.concatenate([keys, more]), np.concatenate([counts, more_counts])
    order = np.argsort(both, kind="stable")
    both, sums = both[order], sums[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    both, sums = both[first], np.add.reduceat(sums, first) if len(first) else sums
    if len(both) > capacity:
        beyond = len(both) - capacity - 1
        sums = sums - np.partition(sums, beyond)[beyond]
        both, sums = both[sums > 0], sums[sums > 0]
    return both, sums


def _texts(docs: DataFrame) -> DataFrame:
    """(lang, text) without empty texts."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.where(F.length("text") > 0)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language at a time, about ``CHARS_AT_ONCE`` characters if they are not longer."""
    held: dict[str, list[str]] = {}
    size = 0
    for part in steps(batches, 1):
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size >= CHARS_AT_ONCE:
            yield from held.items()
            held, size = {}, 0
    yield from held.items()


def _read_filter(broadcast) -> np.ndarray:
    return np.frombuffer(broadcast.value, np.uint8)


def survivors(texts: DataFrame, orders: tuple[int, ...], filters: dict, threshold: int, partition_bits: int,
              filter_bits: int) -> bytes:
    """The filter of all n-grams of these orders that may occur ``threshold`` times: 2 to the ``filter_bits`` bits.

    ``filters``: order → broadcast filter of shorter orders.
    """
    shift = np.uint64(64 - partition_bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {n: _read_filter(f) for n, f in filters.items()}
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            parts = (hashes >> shift).astype(np.int64)
            keys = (hashes >> np.uint64(32 - partition_bits)).astype(np.uint32)
            names, first = np.unique(parts, return_index=True)
            packs = [(_pack(np.diff(k, prepend=np.uint32(0))), _pack(c)) for k, c in
                     zip(np.split(keys, first[1:]), np.split(counts, first[1:]))]
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([k for k, _ in packs], pa.binary()), pa.array([c for _, c in packs], pa.binary())],
                ["part", "keys", "counts"])

        for lang, some in _by_lang(batches):
            words = Words()
            numbers = word_numbers(some, words)
            for n, hashes, fits in _places(numbers, words, lang, bits, max(orders)):
                if n in orders:
                    held.append(hashes[fits])
                    size += len(held[-1])
            if size >= HASHES_PER_FLUSH:
                yield flush()
                size = 0
        if size:
            yield flush()

    def summarise(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        packs = [(np.cumsum(_unpack(k), dtype=np.uint32), _unpack(c).astype(np.int64))
                 for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())]
        mass = int(sum(c.sum() for _, c in packs))
        capacity = mass // threshold + 1
        keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        while packs:
            some, packs = packs[:16], packs[16:]
            keys, counts = merge_summaries(keys, counts, np.concatenate([k for k, _ in some]),
                                           np.concatenate([c for _, c in some]), capacity)
        # a counter is short of the truth by less than what the lost mass gives each counter
        lost = (mass - int(counts.sum())) // (capacity + 1)
        keys = keys[counts + lost >= threshold]
        stretch = np.zeros(1 << filter_bits - partition_bits, np.uint8)
        stretch[(keys >> np.uint32(32 - filter_bits + partition_bits)).astype(np.int64)] = 1
        return pa.table({"part": pa.array([part]), "bits": pa.array([np.packbits(stretch, bitorder="little").tobytes()], pa.binary())})

    packs = map_texts(texts, deal, "part bigint, keys binary, counts binary")
    stretches = settle(packs.groupBy("part").applyInArrow(summarise, "part bigint, bits binary"), "survivors")
    size = 1 << filter_bits - partition_bits - 3
    whole = bytearray(1 << filter_bits - 3)
    for row in stretches.collect():         # 16 MB in all, at any size of the input
        whole[row["part"] * size:(row["part"] + 1) * size] = row["bits"]
    return bytes(whole)


def _local_counts(numbers: np.ndarray, fits: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first places, counts) of the phrases that fit, told apart by their words' numbers: an n-gram is the pair of its
    first n-1 words, by the number they got as a phrase, and its last word."""
    known = numbers
    for n in sorted(fits):
        if n > 1:
            size = len(fits[n])
            known = known[:size] << 32 | numbers[n - 1:n - 1 + size]
        at = np.flatnonzero(fits[n])
        _, first, number, counts = np.unique(known[at], return_index=True, return_inverse=True, return_counts=True)
        yield n, at[first], counts
        known = np.zeros(len(known), np.int64)
        known[at] = number


def exact_counts(texts: DataFrame, filters: dict, longest: int, threshold: int, partition_bits: int) -> DataFrame:
    """(lang, phrase, n, f): phrases that occur ``threshold`` times, and as n = 0 and phrase '' the number of words.

    What a task has counted goes to the phrases' hash partitions as one list each.
    """
    shift = np.uint64(64 - partition_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {n: _read_filter(f) for n, f in filters.items()}
        for lang, some in _by_lang(batches):
            words = Words()
            numbers = word_numbers(some, words)
            orders = {n: (hashes, fits) for n, hashes, fits in _places(numbers, words, lang, bits, longest)}
            total = np.array([(numbers != BORDER).sum()])
            phrases, parts, sizes, counts = [""], [np.zeros(1, np.int64)], [np.zeros(1, np.int32)], [total]
            for n, places, found in _local_counts(numbers, {n: fits for n, (_, fits) in orders.items()}):
                phrases += [b" ".join(map(words.spelled.__getitem__, numbers[p:p + n])).decode("utf-8", "surrogatepass")
                            for p in places.tolist()]
                parts.append((orders[n][0][places] >> shift).astype(np.int64))
                sizes.append(np.full(len(places), n, np.int32))
                counts.append(found)
            part = np.concatenate(parts)
            order = np.argsort(part, kind="stable")
            names, first = np.unique(part[order], return_index=True)
            ends = pa.array([*first.tolist(), len(part)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(column).take(pa.array(order)))
                     for column in (phrases, np.concatenate(sizes), np.concatenate(counts))]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([lang] * len(names), pa.string()), *lists],
                                             ["part", "lang", "phrases", "sizes", "counts"])

    def add_up(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).combine_chunks() for c in ("phrases", "sizes", "counts")}
        owner = np.repeat(np.arange(table.num_rows), columns["sizes"].value_lengths().to_numpy(zero_copy_only=False))
        rows = pa.table({"lang": table.column("lang").combine_chunks().take(pa.array(owner)),
                         "phrase": columns["phrases"].flatten(), "n": columns["sizes"].flatten(), "f": columns["counts"].flatten()})
        sums = rows.group_by(["lang", "phrase", "n"], use_threads=False).aggregate([("f", "sum")]).rename_columns(
            {"f_sum": "f"}).select(["lang", "phrase", "n", "f"])
        enough = pa.compute.or_(pa.compute.equal(sums.column("n"), 0), pa.compute.greater_equal(sums.column("f"), threshold))
        return sums.filter(enough)

    found = map_texts(texts, count, "part bigint, lang string, phrases array<string>, sizes array<int>, counts array<bigint>")
    return found.groupBy("part").applyInArrow(add_up, "lang string, phrase string, n int, f bigint")


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                  filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, n, f) of every phrase of 1 to ``longest`` words that occurs ``threshold`` times or more in its
    language, and one row of n = 0 a language with the number of its words."""
    texts = _texts(docs)
    spark = docs.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word and what parts it take two bytes at least
    wanted = max(1, size // 2 // MASS_PER_PARTITION)
    bits = min(MOST_PARTITION_BITS, max(LEAST_PARTITION_BITS, wanted.bit_length()))
    filters: dict = {}
    for level in LEVELS:
        orders = tuple(n for n in level if n <= longest)
        if orders:
            found = spark.sparkContext.broadcast(survivors(texts, orders, filters, threshold, bits, filter_bits))
            filters |= dict.fromkeys(orders, found)
    return settle(exact_counts(texts, filters, longest, threshold, bits), "phrase-counts")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of 2 to ``longest`` words that belong together most.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into words between spaces and
    tabs; null lang is ``und``. a, l and r count the phrase, its first and its remaining words at the cut of least score,
    the smallest first part on ties; n counts all words of the language; score is floor(1000 a n / (l r)), in decimals of
    38 digits. A phrase inside a longer one that occurs as often is left out. The ``top`` of each language stay,
    by score, a, then phrase. Null and empty texts hold no words; repeated rows count as often as they occur;
    columns other than lang and text are not read. An empty table gives no rows.
    """
    counts = phrase_counts(docs, threshold, longest)
    phrases = counts.where("n > 1")
    known = counts.where("n > 0").select("lang", F.col("phrase").alias("part"), "f")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substr(phrase, length(first) + 2)"))
    # many phrases share a first or last word: parts are looked up once each per salt
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = settle(cuts.withColumn("salt", salt), "cuts")
    needed = cuts.select("lang", F.col("first").alias("part"), "salt").union(cuts.select("lang", F.col("rest").alias("part"), "salt"))
    looked_up = settle(needed.distinct().join(known, ["lang", "part"]), "parts")
    left = looked_up.select("lang", F.col("part").alias("first"), "salt", F.col("f").alias("l"))
    right = looked_up.select("lang", F.col("part").alias("rest"), "salt", F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first", "salt"]).join(right, ["lang", "rest", "salt"])

    totals = counts.where("n = 0").select("lang", F.col("f").alias("total"))
    # one row a language; beyond the bound, the salted copies are joined like any other table
    few = totals.count() <= 10_000
    totals = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = cuts.join(F.broadcast(totals) if few else totals, ["lang", "salt"])
    for c in ("f", "l", "r", "total"):               # products of more than 64 bits
        cuts = cuts.withColumn(f"w_{c}", F.col(c).cast("decimal(17,0)"))
    score = F.expr("cast(1000 * w_f * w_total as decimal(38,0)) div cast(w_l * w_r as decimal(38,0))")
    best = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "f", "total").agg(best)

    # if a phrase is in a longer one as often, it is also in one that has one word more
    longer = phrases.where("n > 2").select("lang", "f", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', n - 1)"), F.expr("substr(phrase, instr(phrase, ' ') + 1)"))).alias("phrase"))
    inside = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where("most is null or most < f")
    rows = kept.select("lang", "phrase", F.col("f").alias("a"), F.col("best.l").alias("l"), F.col("best.r").alias("r"),
                       F.col("total").alias("n"), F.col("best.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    rows = settle(rows, "scored-phrases")
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= top).drop("rank")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
