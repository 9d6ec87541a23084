"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is merged on its own; those that end as one token form a proven table. A text is
cut at places that no vocabulary string spans, so that its parts (pre-tokens) encode independently. A pre-token in
the table counts one; only the rest is merged.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, steps

SPACE = "▁"
CACHE_ENTRIES = 400_000
SHORT = 48


class PieceCounter(dict):
    """pre-token → number of tokens, for a sentencepiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, model_file: str):
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
                       if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))}
        if model.encode(SPACE + " \t", out_type=str) != model.encode("  \t", out_type=str):
            raise ValueError("only models with plain space escaping are supported")
        crossing = [p for p in self.scores if re.search(f"[^{SPACE}]{SPACE}", p)]
        newline = [p for p in self.scores if "\n" in p]
        # the cut is exact only where no vocabulary string reaches over it
        self._cut = re.compile(r"(?s).+" if crossing else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if newline else
                               f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.whole = {p: 1 for p in self.scores if self.merge(p) == 1}
        self.update(self.whole)

    def merge(self, text: str) -> int:
        """Tokens of one pre-token: adjacent parts join by best score, leftmost on ties, until none can."""
        scores, n = self.scores, len(text)
        if n <= SHORT:
            return self._merge_short(list(text))
        parts: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            score = scores.get(text[i:i + 2])
            if score is not None:
                heap.append((-score, i, i + 1, 2))
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            left, right = parts[i], parts[j]
            if left is None or right is None or len(left) + len(right) != size:
                continue
            parts[i], parts[j] = left + right, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n:
                    pair = parts[a] + parts[b]
                    score = scores.get(pair)
                    if score is not None:
                        heapq.heappush(heap, (-score, a, b, len(pair)))
        return self._tokens(parts)

    def _merge_short(self, parts: list[str]) -> int:
        score, never = self.scores.get, float("-inf")
        pairs = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == never:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], never)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], never)
        return self._tokens(parts)

    def _tokens(self, parts: list) -> int:
        # what the vocabulary lacks falls back to its bytes, one token each
        scores = self.scores
        return sum(1 if p in scores else len(p.encode("utf-8", "surrogatepass")) for p in parts if p is not None)

    def __missing__(self, part: str) -> int:
        count = self.merge(part)
        if len(part) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.whole)
            self[part] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self._cut.findall(SPACE + text.replace(" ", SPACE))))


@lru_cache(maxsize=2)
def counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, whole texts, in one narrow pass.

    ``model_file`` is readable on every executor. Null text counts as empty (0, 0, false); repeated rows and null
    ids are kept; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file).count
        for part in steps(batches, 1):
            tokens = np.fromiter(map(count, part.column(1).to_pylist()), np.int64, part.num_rows)
            sizes = pa.compute.binary_length(part.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
