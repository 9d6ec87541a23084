"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact verification.

A window of a document has as many words as the item it may hold (the whole document, if that is shorter). Windows
and items have SimHash fingerprints of their word shingles, each weighted by how often it occurs. Fingerprints are cut
into ``radius + 1`` blocks: two that differ in at most ``radius`` bits agree in a block, so looking up each block finds
every item within the radius. Candidates are verified by the exact weighted Jaccard similarity of the shingles.

A window without any shingle of an item has similarity 0, so only windows around such shingles are fingerprinted.

The items of a block of at most ``ITEM_BLOCK_CHARS`` characters go to every task; larger benchmarks are worked off
in several blocks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, settle, steps

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
ITEM_BLOCK_CHARS = 16_000_000
_FILTER_BITS = 22
_WINDOWS_PER_STEP = 1 << 14
_ODD = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\ufeff]")
_WORD_BYTE = np.array([(48 <= b <= 57) or (97 <= b <= 122) or b >= 128 for b in range(256)])
_WEIGHTS = np.random.default_rng(7).integers(0, 1 << 63, 1 << 12, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> bytes:
    """Lower case, UTF-8, with odd spaces and punctuation beyond ASCII blanked."""
    text = text.lower()
    return (text if text.isascii() else _ODD.sub(" ", text)).encode("utf-8", "surrogatepass")


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes (ASCII letters and digits, and all bytes beyond ASCII)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = data[np.repeat(starts, sizes) + offset].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(letters * _WEIGHTS[offset & 4095], np.cumsum(sizes) - sizes)
    return _scramble(sums)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole sequence, if it is shorter."""
    width = min(width, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ words[i:i + n]) * _MIX + np.uint64(i + 1)
    return _scramble(out)


def simhash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every run of ``width`` shingle hashes; a shingle weighs as often as it occurs."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    set_bits = (sums[width:] - sums[:-width]) * 2 > width
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: list[bytes], b: list[bytes], width: int = SHINGLE_WORDS) -> float:
    """Weighted Jaccard similarity of the word shingles of two word sequences."""
    x, y = _shingles(a, width), _shingles(b, width)
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both) if x and y else 0.0


def _shingles(words: list[bytes], width: int) -> Counter:
    width = min(width, len(words))
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if width else Counter()


class HammingIndex:
    """Fingerprints in blocks of bits: finds all within ``radius``, since those agree in one of radius + 1 blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            shift, mask = np.uint64(lo), np.uint64((1 << int(hi - lo)) - 1)
            keys = (prints >> shift) & mask
            order = np.argsort(keys, kind="stable")
            self.blocks.append((shift, mask, keys[order], order))

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, print, distance) of every pair within the radius."""
        pairs = []
        for shift, mask, keys, order in self.blocks:
            wanted = (queries >> shift) & mask
            lo, hi = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            n = hi - lo
            q = np.repeat(np.arange(len(queries)), n)
            p = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            close = np.bitwise_count(queries[q] ^ self.prints[p]) <= self.radius
            pairs.append(q[close] * len(self.prints) + p[close])
        pairs = np.unique(np.concatenate(pairs))
        q, p = pairs // len(self.prints), pairs % len(self.prints)
        return q, p, np.bitwise_count(queries[q] ^ self.prints[p]).astype(np.int64)


class Items:
    """A block of benchmark items, prepared for lookup."""

    def __init__(self, items: list[tuple[int, str]], width: int = SHINGLE_WORDS, radius: int = RADIUS):
        self.width = width
        self.words: dict[int, list[tuple[tuple[int, int], list[bytes]]]] = {}
        self.short: dict[int, dict[int, list[tuple[tuple[int, int], list[bytes]]]]] = {}     # size → hash → items
        prints: dict[int, list[int]] = {}
        owners: dict[int, set[int]] = {}
        for number, (item_id, text) in enumerate(items):
            name = (0, item_id) if item_id is not None else (1, number)
            raw = normal(text)
            data = np.frombuffer(raw, np.uint8)
            starts, ends = word_bounds(data)
            if not len(starts):
                continue
            size = len(starts)
            hashes = _shingle_hashes(_word_hashes(data, starts, ends), width)
            item = (name, [raw[s:e] for s, e in zip(starts, ends)])
            if size < width:
                self.short.setdefault(size, {}).setdefault(int(hashes[0]), []).append(item)
                continue
            self.words.setdefault(size, []).append(item)
            prints.setdefault(size, []).append(int(simhash_windows(hashes, len(hashes))[0]))
            for h in hashes.tolist():
                owners.setdefault(h, set()).add(size)
        self.index = {size: HammingIndex(np.array(p, np.uint64), radius) for size, p in prints.items()}
        self.sizes = owners                                  # shingle hash → sizes of the items that have it
        self.known = np.array(sorted(owners), np.uint64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places whose hash belongs to an item."""
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        return at[np.isin(hashes[at], self.known)] if len(at) else at

    def search(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, hits: np.ndarray,
               least: float) -> dict[tuple[int, int], tuple[int, int, int, float]]:
        """Item → (first word, words, distance, similarity): the best window of each item found in one document.

        ``hashes`` are the document's shingle hashes, ``hits`` the places among them that belong to an item.
        """
        wanted: dict[int, list[int]] = {}
        for at in hits.tolist():
            for size in self.sizes[int(hashes[at])]:
                wanted.setdefault(size, []).append(at)
        best: dict[tuple[int, int], tuple[int, int, int, float]] = {}
        for size, places in wanted.items():
            width = min(max(1, size - self.width + 1), len(hashes))
            reach = np.zeros(len(hashes) - width + 2, np.int64)      # window starts that hold a hit
            at = np.array(places)
            np.add.at(reach, np.maximum(at - width + 1, 0), 1)
            np.add.at(reach, np.minimum(at, len(hashes) - width) + 1, -1)
            windows = np.flatnonzero(np.cumsum(reach)[:-1])
            cut = (np.diff(windows) > 1) | (windows[1:] % _WINDOWS_PER_STEP == 0)
            together = np.split(windows, np.flatnonzero(cut) + 1)
            shown = np.concatenate([simhash_windows(hashes[g[0]:g[-1] + width], width) for g in together])
            known = self.words[size]
            for w, i, distance in zip(*(x.tolist() for x in self.index[size].near(shown))):
                first = int(windows[w])
                name, item = known[i]
                words = [raw[s:e] for s, e in zip(starts[first:first + size], ends[first:first + size])]
                alike = similarity(words, item, self.width)
                if alike >= least and (name not in best or (-alike, first) < (-best[name][3], best[name][0])):
                    best[name] = (first, len(words), distance, alike)
        return best


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, least: float = SIMILARITY,
          radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", block_chars: int = ITEM_BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity): one row per document and item it holds.

    Of several windows the most similar is given, the first on ties. Documents and items whose text is null, empty or
    without words match nothing; an item with fewer words than a shingle is found where just its words stand. Repeated
    document rows give repeated results, repeated items are searched each; items without an id are items of their own,
    given with a null item_id. Other columns are not read. Documents are read once per item
    block, and nothing of them is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, item_id bigint, first_word bigint, n_words bigint, distance bigint, similarity double")
    names = ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    found = None
    for items in _item_blocks(benchmark, item_col, item_text_col, block_chars):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            known = Items(items, width, radius)
            for part in steps(batches, 1):
                owner, out = _find(known, part.column(1).to_pylist(), least)
                if out:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)),
                                                      *(pa.array(c, t) for c, t in zip(zip(*out), types))], names)

        part = map_texts(rows, run, schema)
        found = part if found is None else found.union(part)
    return found


def _item_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters; one empty block, if there are none."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where(
        "text is not null")
    blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    for block in range(blocks):
        name = F.coalesce("item_id", F.xxhash64("text"))
        own = items.where(F.pmod(F.xxhash64(name), F.lit(blocks)) == block).orderBy("item_id", "text")
        yield [tuple(r) for r in own.collect()]


def _find(known: Items, texts: list[str | None], least: float) -> tuple[list[int], list[tuple]]:
    """Number of the text and (item_id, first word, words, distance, similarity) for every item found."""
    found: dict[int, dict] = {}
    width = known.width
    texts = [normal(t or "") for t in texts]
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_bounds(data)
    words = _word_hashes(data, starts, ends)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, edges)
    # all documents at once; shingles over a document's end are looked at only in its own pass
    near = known.hits(_shingle_hashes(words, width)) if len(words) >= width else np.zeros(0, np.int64)
    for row in np.unique(np.searchsorted(first, near, "right") - 1).tolist():
        lo, hi = first[row], first[row + 1]
        if hi - lo < width:
            continue
        hashes = _shingle_hashes(words[lo:hi], width)
        hits = known.hits(hashes)
        if len(hits):
            found[row] = known.search(texts[row], starts[lo:hi] - edges[row], ends[lo:hi] - edges[row], hashes, hits, least)
    for size, wanted in known.short.items():         # items under a shingle: equal runs of their own length
        hashes = _shingle_hashes(words, size) if len(words) >= size else np.zeros(0, np.uint64)
        for at in np.flatnonzero(np.isin(hashes, np.array(list(wanted), np.uint64))).tolist():
            row = int(np.searchsorted(first, at, "right")) - 1
            if at + size > first[row + 1]:
                continue
            shown = [data[s:e].tobytes() for s, e in zip(starts[at:at + size], ends[at:at + size])]
            place, best = int(at - first[row]), found.setdefault(row, {})
            for name, item in wanted[int(hashes[at])]:
                if item == shown and (name not in best or (-1.0, place) < (-best[name][3], best[name][0])):
                    best[name] = (place, size, 0, 1.0)
    rows = [(row, (None if name[0] else name[1], *window)) for row in sorted(found) for name, window in sorted(found[row].items())]
    return [row for row, _ in rows], [told for _, told in rows]


def without_leaks(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, least: float = SIMILARITY,
                  radius: int = RADIUS, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_chars: int = ITEM_BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns pass through.

    Each row is judged by its own text, in one narrow pass per item block; ids are not read, so null and repeated ones
    do no harm.
    """
    at = docs.columns.index(text_col)
    for items in _item_blocks(benchmark, item_col, item_text_col, block_chars):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            known = Items(items, width, radius)
            for part in steps(batches, at):
                owner, _ = _find(known, part.column(at).to_pylist(), least)
                clean = np.ones(part.num_rows, bool)
                clean[owner] = False
                yield part.filter(pa.array(clean))

        docs = map_texts(docs, run, docs.schema)
    return docs
