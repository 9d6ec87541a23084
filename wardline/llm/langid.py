"""Language identification with string kernels.

A text is the set of its letter n-grams of lengths 1 to 3 (blended spectrum, presence only); the kernel of two texts
is the size of the intersection over the geometric mean of the set sizes. Landmark texts give Nyström features
``K(x, L) K(L, L)^-1/2``; one-versus-rest kernel ridge regression learns a weight per feature and language. Scoring
multiplies the presence matrix of a block of texts with the matrix of landmark presences times those weights.

Letters are folded to 63 symbols by ``_symbol_table`` (feature hashing beyond Latin-1); everything else is one
boundary symbol. Training is on a bounded sample: ``per_language`` texts per language (those with the smallest hash
of their id), of which the first ``landmarks`` are landmarks; the driver holds their n-gram sets only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.llm.common import map_texts, steps

SYMBOLS = 64
FEATURES = SYMBOLS + SYMBOLS ** 2 + SYMBOLS ** 3
UNDETERMINED = "und"
PER_LANGUAGE = 300
LANDMARKS = 64
MAX_LANGUAGES = 500
RIDGE = 1e-2
_ROWS_PER_BLOCK = 16


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1-26 for a-z in either case, 27-63 for other letters."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            low = ord(chr(cp).lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return table


def _grams(text: str) -> np.ndarray | None:
    """Feature numbers of the n-grams of ``text``, with repetitions; None if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.zeros(len(codes) + 2, np.int32)
    s[1:-1] = _symbol_table()[codes]
    s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]     # runs of non-letters count as one boundary
    if not s.any():
        return None
    two = s[:-1] * SYMBOLS + s[1:]
    three = two[:-1] * SYMBOLS + s[2:]
    return np.concatenate([s, two + SYMBOLS, three + (SYMBOLS + SYMBOLS ** 2)])


@dataclass
class Model:
    languages: list[str]
    columns: np.ndarray     # the features that occur in a landmark
    weights: np.ndarray     # features x languages
    offset: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score in 0..1 of each text, in blocks of presence rows."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        present = np.zeros((_ROWS_PER_BLOCK, FEATURES), np.uint8)
        for start in range(0, len(texts), _ROWS_PER_BLOCK):
            present[:] = 0
            rows = []
            for i in range(start, min(start + _ROWS_PER_BLOCK, len(texts))):
                grams = _grams(texts[i]) if texts[i] else None
                if grams is not None:
                    present[i - start, grams] = 1
                    rows.append(i - start)
            if not rows:
                continue
            block = present[rows]
            sizes = block.sum(axis=1, dtype=np.int64)
            raw = block[:, self.columns].astype(np.float64) @ self.weights / np.sqrt(sizes)[:, None] + self.offset
            best = raw.argmax(axis=1)
            for row, k, values in zip(rows, best, raw):
                names[start + row] = self.languages[k]
                scores[start + row] = min(1.0, max(0.0, (values[k] + 1) / 2))
        return names, scores


def fit(sample: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on Nyström features; ``sample`` has (language, distinct feature numbers) in a fixed
    order, and the first ``landmarks`` of each language are the landmarks."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0))
    seen: dict[str, int] = {}
    chosen = []
    for i, (lang, _) in enumerate(sample):
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= landmarks:
            chosen.append(i)
    columns = np.unique(np.concatenate([sample[i][1] for i in chosen]))
    presence = np.zeros((len(sample), len(columns)), np.float32)
    for i, (_, grams) in enumerate(sample):
        at = np.searchsorted(columns, grams)
        hit = (at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == grams)
        presence[i, at[hit]] = 1
    norm = np.sqrt(np.array([len(g) for _, g in sample], np.float64))
    marks = presence[chosen].astype(np.float64) / norm[chosen][:, None]
    kernel = presence.astype(np.float64) @ marks.T / norm[:, None]
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    target = np.where(np.array([lang for lang, _ in sample])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean_x, mean_y = features.mean(axis=0), target.mean(axis=0)
    centred = features - mean_x
    solved = np.linalg.solve(centred.T @ centred + ridge * len(sample) * np.eye(len(chosen)) / len(chosen),
                             centred.T @ (target - mean_y))
    return Model(languages, columns, marks.T @ (root @ solved), mean_y - mean_x @ solved)


def train(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on the rows for which ``usable`` holds and whose language is not null: at most ``per_language`` texts of
    each of the ``max_languages`` most frequent languages. Null texts and texts without letters teach nothing; without any usable row the model answers ``und``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       usable.alias("usable")).where("usable and lang is not null and text is not null")
    ids = rows.select("doc_id", "lang").distinct().withColumn("at", F.xxhash64("doc_id"))
    sizes = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not sizes:
        return fit([], landmarks)
    # hashes are even over the long range: the lowest ones, four times as many as asked for, hold the sample
    limits = [(r["lang"], min((1 << 64) // r["count"] * 4 * per_language, (1 << 64) - 1) - (1 << 63)) for r in sizes]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, most bigint")
    order = Window.partitionBy("lang").orderBy("at", "doc_id")
    picked = ids.join(F.broadcast(limits), "lang").where(F.col("at") <= F.col("most"))
    picked = picked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    picked = picked.select("doc_id", "lang", "place")
    # at most per_language rows for each of max_languages languages
    sample = rows.join(F.broadcast(picked), ["doc_id", "lang"]).select("lang", "place", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, 2):
            sets = [_grams(t) for t in part.column(2).to_pylist()]
            sets = [[] if g is None else np.unique(g) for g in sets]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int32()))],
                                             ["lang", "place", "grams"])

    got = (map_texts(sample, grams, "lang string, place int, grams array<int>").where(F.size("grams") > 0)
           .dropDuplicates(["lang", "place"]).collect())
    got.sort(key=lambda r: (r["lang"], r["place"]))
    return fit([(r["lang"], np.array(r["grams"], np.int64)) for r in got], landmarks)


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all, if None) with lang_pred and score appended, in one pass over whole texts.

    Null text and text without letters give ``und`` with score 0. Input columns called lang_pred or score are
    replaced. Repeated rows stay; an empty table gives an empty result.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score")]
    kept = docs.select(F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    schema = StructType([kept.schema["row"]]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, 0):
            found, scores = model.score(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found, pa.string()), pa.array(scores)],
                                             ["row", "lang_pred", "score"])

    return map_texts(kept, run, schema).select("row.*", "lang_pred", "score")
