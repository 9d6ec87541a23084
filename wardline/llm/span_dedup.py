"""Substring dedup over sliding sentence spans.

At every sentence two runs of consecutive sentences are hashed, the shortest of at least ``sentences`` sentences and
``words`` words that starts there and the shortest that ends there: together they cover every sentence of every longer
repeated run. Runs are joined globally on their hash of 96 bits; all but the first occurrence (by id, then place) are
repeats, and sentences that a repeat covers are removed.

Sentences end at . ! or ? before white space, at the stops of other scripts, or at a line end. Where ``PIECE`` word
borders follow one another without a sentence end, the sentence is cut at the least of them: at a comma or the like if
there is one, by a hash of the two words otherwise. The cut depends on these words only, so equal passages are cut alike
except for at most ``PIECE`` words at their ends, whatever sentences they lie in, and no piece has more than ``PIECE``
words. A piece counts as a sentence. Pieces are compared in lower case with white space collapsed; in scripts without
spaces each character is a word. A text too short for a run is one run as a whole if it has enough words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, new_folder, remove, settle, steps

SENTENCES = 2
WORDS = 24              # a passage of 50 words holds them in whole pieces wherever it starts: 50 - 2 (PIECE - 1)
PIECE = 14
WHOLE = -1              # the place of the row that tells a document's number of sentences
_END = re.compile(r"[.!?]+[\"')\]]*\s+|[。！？．｡؟۔।॥]+[\"')\]」』）】”’»]*\s*|\s*\n\s*")
_UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(r"\S+")
_WORD_OR_CHARACTER = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")
_COMMAS = frozenset(",;:，、；：،؛")


def _cuts(words: list[str]) -> list[int]:
    """Numbers of the words before which a sentence is cut: the last least border of every ``PIECE`` successive ones."""
    hashes = [0]
    for before, after in zip(words, words[1:]):
        value = xxhash.xxh3_64_intdigest(f"{before} {after}".encode("utf-8", "surrogatepass"))
        hashes.append(value if before[-1] in _COMMAS else value | 1 << 64)
    out, best = [], 0
    for first in range(1, len(words) - PIECE + 1):
        newest = first + PIECE - 1
        if best < first:
            best = min(range(newest, first - 1, -1), key=hashes.__getitem__)
        elif hashes[newest] <= hashes[best]:
            best = newest
        if not out or out[-1] != best:
            out.append(best)
    return out


def _pieces(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words) of each piece, words in lower case; together they make up the text."""
    unspaced = not text.isascii() and _HAS_UNSPACED.search(text) is not None
    pattern = _WORD_OR_CHARACTER if unspaced else _WORD
    start = 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        if end == start:
            continue
        part = text[start:end].lower()
        words = pattern.findall(part) if unspaced else part.split()
        if len(words) > PIECE:
            cuts = _cuts(words)
            places = [m.start() for m in pattern.finditer(text, start, end)]
            borders = [start, *(places[i] for i in cuts), end]
            for s, e, i, j in zip(borders, borders[1:], [0, *cuts], [*cuts, len(words)]):
                yield s, e, words[i:j]
        else:
            yield start, end, words
        start = end


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence, or piece of a long one; together they make up the text. White space after a
    sentence belongs to it."""
    return [(s, e) for s, e, _ in _pieces(text)]


def _shortest(counts: list[int], least_sentences: int, least_words: int) -> list[tuple[int, int]]:
    """(first, number) of the shortest run from each sentence that has one."""
    out, end, held = [], 0, 0
    for i in range(len(counts)):
        while end < len(counts) and (end - i < least_sentences or held < least_words):
            held += counts[end]
            end += 1
        if end - i < least_sentences or held < least_words:
            break
        out.append((i, end - i))
        held -= counts[i]
    return out


def runs(counts: list[int], least_sentences: int = SENTENCES, least_words: int = WORDS) -> list[tuple[int, int]]:
    """(first, number) of the shortest runs that start and that end at each sentence, given the sentences' numbers of words."""
    out = set(_shortest(counts, least_sentences, least_words))
    out.update((len(counts) - i - n, n) for i, n in _shortest(counts[::-1], least_sentences, least_words))
    if not out and sum(counts) >= least_words:
        out.add((0, len(counts)))
    return sorted(out)


def _hashed(text: str, least_sentences: int, least_words: int) -> tuple[list[bytes], list[tuple[int, int]], int]:
    """Hashes and places of the runs of a text, and its number of sentences."""
    parts = [words for _, _, words in _pieces(text)]
    spans = runs(list(map(len, parts)), least_sentences, least_words)
    digest = xxhash.xxh3_128_digest
    digests = b"".join([digest(" ".join(p).encode("utf-8", "surrogatepass")) for p in parts])
    return [digest(digests[16 * i:16 * (i + n)]) for i, n in spans], spans, len(parts)


def remove_sentences(text: str, covered: list[tuple[int, int]]) -> tuple[str, int, int]:
    """Text without the sentences in the runs (first, number) of ``covered``; number of sentences, and of those removed."""
    spans = sentences(text)
    gone = np.zeros(len(spans) + 1, np.int64)
    for first, n in covered:
        gone[first] += 1
        gone[first + n] -= 1
    kept = np.cumsum(gone)[:-1] == 0
    return "".join(text[s:e] for (s, e), k in zip(spans, kept) if k), len(spans), int((~kept).sum())


def dedup_spans(docs: DataFrame, least_sentences: int = SENTENCES, least_words: int = WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_sentences, n_removed) for every row, ``text`` without the sentences of repeated runs; pieces of
    long sentences count one each.

    A row counts as the document (id, text): rows repeated with the same id and text are one document and are all
    treated alike; the same id with another text is another document. The first occurrence of a run has the smallest
    (id, text hash, place); a null id comes before others. Null text stays null with 0 sentences. Columns other
    than the two named are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, 1):
            hashes: list[bytes] = []
            places: list[tuple[int, int]] = []
            owner = np.zeros(part.num_rows, np.int64)
            for row, text in enumerate(part.column(1).to_pylist()):
                h, p, n = _hashed(text, least_sentences, least_words) if text else ([], [], 0)
                hashes += [*h, bytes(16)]
                places += [*p, (WHOLE, n)]
                owner[row] = len(p) + 1
            at = pa.array(np.repeat(np.arange(part.num_rows), owner))
            h = np.frombuffer(b"".join(hashes), [("h1", np.int64), ("h2", np.int32), ("more", np.int32)])
            p = np.array(places, np.int32).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h["h1"].copy()), pa.array(h["h2"].copy()), part.column(0).take(at), part.column(2).take(at),
                 pa.array(p[:, 0]), pa.array(p[:, 1])], ["h1", "h2", "doc_id", "version", "first", "n"])

    found = map_texts(rows, spans, f"h1 bigint, h2 int, doc_id {id_type}, version bigint, first int, n int")
    path = new_folder(docs.sparkSession, "sentence-runs")
    found.write.parquet(path)
    found = docs.sparkSession.read.schema(found.schema).parquet(path)
    runs_found = found.where(F.col("first") >= 0)
    place = F.struct("doc_id", "version", "first")
    repeated = (runs_found.groupBy("h1", "h2").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("times"))
                .where("times > 1").select("h1", "h2", "origin"))
    repeated = settle(repeated, "repeated-runs")     # an input of its own, so that a hot run's rows can be split
    again = runs_found.join(repeated, ["h1", "h2"]).where(~place.eqNullSafe(F.col("origin")))
    # one row a document: its number of sentences and its covers, of which there are no more than it has runs
    known = again.select("doc_id", "version", "first", "n").union(
        found.where(F.col("first") == WHOLE).select("doc_id", "version", "first", "n"))
    covers = known.groupBy("doc_id", "version").agg(
        F.max(F.when(F.col("first") == WHOLE, F.col("n"))).alias("total"),
        F.collect_set(F.when(F.col("first") >= 0, F.struct("first", "n"))).alias("covers"))
    covers = covers.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "total", "covers")
    covers = settle(covers, "covers")
    remove(docs.sparkSession, path)
    marked = rows.join(covers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only texts with covers are cut again."""
        for part in steps(batches, 1):
            done = [remove_sentences(t, [(c["first"], c["n"]) for c in cs]) if cs else (t, n or 0, 0)
                    for t, cs, n in zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))]
            texts, total, removed = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                ["doc_id", "text", "n_sentences", "n_removed"])

    return map_texts(marked.select("doc_id", "text", "covers", "total"), clean,
                     f"doc_id {id_type}, text string, n_sentences bigint, n_removed bigint")
