"""BPE encoding and decoding by a tokenization automaton.

The automaton accepts exactly the token sequences that the merges would produce. It starts with one state in which
every base symbol loops. Merge number r, of u and v into w, applies a gadget: whatever state follows u loses its
v-arc, and every state with such a u-arc gains a w-arc to where v led. All states reached over one token are equal,
so a state is named by its token: the state of w starts as a copy of the state of v, as that was before merge r.
``MergeAutomaton`` keeps the gadgets as a persistent structure (what was cut, when, and which state was copied) and
answers single arcs from it; the answers fill a transition table. ``explicit_arcs`` builds the same automaton state
by state and is what the tests compare with.

A word is encoded by a walk through the automaton along arcs that spell it, found in a trie of the tokens. Each prefix
of a word has one accepted tokenization, so a position is reached in one state only.

Letter classes and normal forms follow the Unicode versions of the tokenizers library. ``LibraryClasses`` finds the
characters on which they may differ from this Python's: texts with one of them are normalized by the library's
normalizer, and each such character is put to its pre-tokenizer once to learn its class.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, steps

START = -1
CACHE_ENTRIES = 300_000
ARC_ENTRIES = 400_000
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = (".", ",", "!", "?", ";", ":")
# what str.split takes for white space beyond that is left to the pattern
_SEPARATORS = re.compile("[\x1c-\x1f]")


class MergeAutomaton:
    """Automaton over token ids, compiled from merges (left id, right id, joined id) in order of priority."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.cut: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}
        self.left: dict[int, int] = {}
        self.copied: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        self.dead: set[int] = set()
        for r, merge in enumerate(merges):
            self._gadget(r, *merge)

    def _gadget(self, r: int, u: int, v: int, w: int) -> None:
        if w in self.born:
            raise ValueError(f"token {w} is made by two merges")
        if u in self.dead or v in self.dead or not self._arc_before(u, v, r):
            self.dead.add(w)            # no state has the arcs to join: w is never reached
        self.cut.setdefault((u, v), r)
        self.born[w], self.left[w], self.copied[w] = r, u, v

    def _arc_before(self, state: int, token: int, when: int) -> bool:
        """Whether ``state`` has an arc ``token`` once the gadgets before number ``when`` are applied."""
        cut, born = self.cut, self.born
        while True:
            if cut.get((state, token), when) < when:
                return False
            made, joined = born.get(state, -1), born.get(token, -1)
            if made < 0 and joined < 0:
                return True
            if joined >= made:          # the arc came from that of its left part, still there after that gadget's cut
                when, token = joined + 1, self.left[token]
            else:                       # inherited from the copied state
                when, state = made, self.copied[state]

    def arc(self, state: int, token: int) -> bool:
        if state == START:
            return token not in self.dead
        key = state << 32 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= ARC_ENTRIES:
                self.table.clear()
            known = token not in self.dead and self._arc_before(state, token, len(self.born) + 1)
            self.table[key] = known
        return known


def explicit_arcs(base: list[int], merges: list[tuple[int, int, int]]) -> dict[int, set[int]]:
    """The automaton with every state and arc written out (START included); for small vocabularies and tests."""
    states = {s: set(base) for s in [START, *base]}
    for u, v, w in merges:
        if v not in states.get(u, ()):
            states[w] = set()
            continue
        target = set(states[v])                              # copy of v's state before the cut
        states[u].discard(v)
        for arcs in [*states.values(), target]:
            if u in arcs and arcs is not states[u]:
                arcs.add(w)
        if u in states[u]:
            states[u].add(w)
        states[w] = target
    return states


class LibraryClasses:
    """Characters that the tokenizers library and this Python may take differently.

    These are the ones that Python's Unicode version does not assign, marks that the library does not put in order, and
    parts of characters that it does not compose.
    """

    LETTER, NUMBER, OTHER = "\u0436", "1", "\u2026"          # plain characters of each class, to split words by
    LAST_MARK, LAST_CLASS = "\u0345", 240                    # the mark that is ordered behind all others

    def __init__(self, tokenizer_file: str):
        from tokenizers.normalizers import NFC

        self._file = tokenizer_file
        self._stand_ins: dict[int, str] = {}
        composed = NFC().normalize_str
        self._differs = np.zeros(0x110000, bool)
        for first in range(0, 0x110000, 0x10000):
            plane = range(first, first + 0x10000)
            used = unicodedata.category(chr(first)) != "Cn"         # else the library is asked about the whole plane
            self._differs[first:plane.stop] = [unicodedata.category(chr(c)) == "Cn" for c in plane] if used else True
        for c in map(chr, np.flatnonzero(~self._differs[:0xF0000])):        # private use beyond
            if 0 < unicodedata.combining(c) < self.LAST_CLASS and composed(self.LAST_MARK + c)[-1:] != self.LAST_MARK:
                self._differs[ord(c)] = True
            apart = unicodedata.normalize("NFD", c) if unicodedata.decomposition(c)[:1] not in ("", "<") else c
            if apart != c and not (composed(apart) == composed(c) == unicodedata.normalize("NFC", c)):
                self._differs[[ord(c), *map(ord, apart)]] = True

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._file)

    def has_any(self, text: str) -> bool:
        if text.isascii():
            return False
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return bool(self._differs[points].any())

    def normalized(self, text: str) -> str:
        return self._library.normalizer.normalize_str(text)

    def stand_in(self, text: str) -> str:
        """``text`` with a plain character of the same class for each that differs, place by place."""
        for c in set(text):
            if self._differs[ord(c)] and ord(c) not in self._stand_ins:
                words = self._library.pre_tokenizer.pre_tokenize_str
                alike = (self.LETTER if len(words("b" + c)) == 1 else
                         self.OTHER if len(words("!" + c)) == 1 else self.NUMBER)
                self._stand_ins[ord(c)] = alike
        return text.translate(self._stand_ins)


class WordBpe(dict):
    """Text between white space → token ids, for a tokenizers file of kind BPE with word ends, lower case and byte
    symbols."""

    def __init__(self, tokenizer_file: str):
        super().__init__()
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or any(t["normalized"] or t["lstrip"] or t["rstrip"]
                                                          or t["single_word"] for t in added):
            raise ValueError("unsupported tokenizer file")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.automaton = MergeAutomaton(merges)
        spelled = {i: (piece,) for piece, i in vocab.items() if i not in self.automaton.born}
        for u, v, w in merges:
            spelled[w] = spelled[u] + spelled[v]
        self.trie: dict = {}
        for token, symbols in spelled.items():
            if token not in self.automaton.dead:
                node = self.trie
                for s in symbols:
                    node = node.setdefault(s, {})
                node[None] = ((len(symbols), token),)
        self._gather(self.trie, ())
        self.longest = max(map(len, spelled.values()))
        self.special = {t["content"]: t["id"] for t in added}
        self._cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(split.replace(r"[^\s", f"[^{_WHITE}"))
        self._byte_symbols = _byte_symbols()
        self._classes = LibraryClasses(tokenizer_file)

    def _gather(self, node: dict, shorter: tuple) -> None:
        """Let every trie node hold the tokens on the way to it, longest first."""
        node[None] = node.get(None, ()) + shorter
        for symbol, below in node.items():
            if symbol is not None:
                self._gather(below, node[None])

    def _symbols(self, word: str) -> list[str]:
        if word.isascii() and word.isprintable():
            letters = list(word)
        else:
            letters = [self._byte_symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.suffix
        return letters

    def _arcs_from(self, symbols: list[str], at: int) -> tuple[tuple[int, int], ...]:
        """(length, token) of the tokens spelled from ``at`` on, longest first."""
        node = self.trie
        for symbol in symbols[at:at + self.longest]:
            below = node.get(symbol)
            if below is None:
                break
            node = below
        return node[None]

    def walk(self, symbols: list[str]) -> tuple[int, ...]:
        """The tokens of the one accepted path that spells ``symbols``: longest arcs first, back from dead ends.

        A position is reached in one state only, so one that turned out a dead end is not entered again.
        """
        arc, known, n = self.automaton.arc, self.automaton.table.get, len(symbols)
        state, at, path, dead = START, 0, [], None
        arcs = iter(self._arcs_from(symbols, 0))
        while at < n:
            for length, token in arcs:
                if dead and at + length in dead:
                    continue
                fits = known(state << 32 | token)
                if arc(state, token) if fits is None else fits:
                    path.append((state, at, arcs))
                    state, at = token, at + length
                    if at < n:
                        arcs = iter(self._arcs_from(symbols, at))
                    break
            else:
                dead = dead or set()
                dead.add(at)
                state, at, arcs = path.pop()
        return (*[s for s, _, _ in path[1:]], state)

    def __missing__(self, part: str) -> tuple[int, ...]:
        if part[-1:] in _MARKS and part[:-1].isalpha():         # two words; kept apart, the parts stay few
            return self[part[:-1]] + self[part[-1]]
        words = [self.walk(self._symbols(w)) for w in self.words(part)]
        ids = words[0] if len(words) == 1 else tuple(chain.from_iterable(words))
        if len(part) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[part] = ids
        return ids

    def normal(self, text: str) -> str:
        if self._classes.has_any(text):
            return self._classes.normalized(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def words(self, part: str) -> list[str]:
        if not part.isalpha() and self._classes.has_any(part):          # letters of this Python are the library's
            return [part[m.start():m.end()] for m in self._words.finditer(self._classes.stand_in(part))]
        return self._words.findall(part)

    def encode(self, text: str) -> list[tuple[int, ...]]:
        """Token ids of one text, in parts between white space (no word reaches over any)."""
        out: list[tuple[int, ...]] = []
        for part in self._cut_special.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append((self.special[part],))
            else:
                part = self.normal(part)
                out += map(self.__getitem__, (part,) if _SEPARATORS.search(part) else part.split())
        return out


def labels(tokenizer_file: str) -> list[str]:
    """The label of every token id."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    names = {**{i: piece for piece, i in spec["model"]["vocab"].items()},
             **{t["id"]: t["content"] for t in spec["added_tokens"]}}
    return [names[i] for i in range(len(names))]


def _byte_symbols() -> list[str]:
    """One printable character per byte: the printable Latin-1 ones stand for themselves, the rest follow from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=2)
def word_bpe(tokenizer_file: str) -> WordBpe:
    return WordBpe(tokenizer_file)


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer_file: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) → (doc_id, ids)."""
    bpe = word_bpe(tokenizer_file)
    for part in steps(batches, 1):
        words = [bpe.encode(t) for t in part.column(1).to_pylist()]
        sizes = np.fromiter((sum(map(len, w)) for w in words), np.int64, len(words))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.fromiter(chain.from_iterable(chain.from_iterable(words)), np.int32, int(ends[-1]))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])
    bpe.clear()             # workers outlive their tasks


def _decoded(batches: Iterator[pa.RecordBatch], tokenizer_file: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) → (doc_id, ids, decoded)."""
    label = labels(tokenizer_file).__getitem__
    for part in steps(batches, 1):
        ids = part.column(1).flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(part.column(1).value_lengths().to_numpy(zero_copy_only=False)).tolist()
        texts = [" ".join(map(label, ids[start:end])) for start, end in zip([0, *ends[:-1]], ends)]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                         ["doc_id", "ids", "decoded"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row, whole texts, one narrow pass.

    ``tokenizer_file`` is readable on every executor. Null or empty text gives an empty array; repeated rows and
    null ids are kept; other columns are not read.
    """
    rows, id_type = _texts(docs, id_col, text_col)
    return map_texts(rows, lambda batches: _encoded(batches, tokenizer_file), f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_file: str, keep: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): the labels of the arcs taken, joined by one space as this tokenizer's decoder does.

    An empty or null array gives the empty string; an id that labels no arc is an error.
    """
    rows = encoded.select(F.col(keep).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, lambda batches: _decoded(batches, tokenizer_file),
                           f"doc_id {id_type}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: (doc_id, ids, decoded)."""
    rows, id_type = _texts(docs, id_col, text_col)
    return map_texts(rows, lambda batches: _decoded(_encoded(batches, tokenizer_file), tokenizer_file),
                           f"doc_id {id_type}, ids array<int>, decoded string")
