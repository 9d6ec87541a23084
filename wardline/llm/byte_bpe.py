"""Byte-level BPE encoding and decoding by finite-state transducers.

Encoding. A sequence of tokens is what the merges leave of its bytes if and only if that holds for each two tokens in a
row: the first merge over a border between two tokens would also happen in those two alone. So the merges compile to a
nondeterministic transducer whose states are (last token, place in a trie of the tokens): a byte leads on in the trie,
and where a token is spelled that joins the last one, also back to the trie's root. ``State`` is its determinisation,
done lazily byte by byte as texts need it: the set of all live states, each with its tokens not written yet. Tokens that
all of them share are written at once, which a token's greatest length bounds; the rest is written when the word ends.
Each prefix of a word has one tokenization, hence exactly one live state is at the root.

Decoding. The bytes of the tokens run through a state machine for UTF-8 that keeps an unfinished character for the next
call, so texts may be decoded in pieces. For each token the step from the machine's initial state is compiled ahead.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, steps

NONE = -1
MOST_STATES = 400_000
MOST_PAIRS = 500_000
CACHE_ENTRIES = 300_000
CACHED_BYTES = 48
REPLACEMENT = "\ufffd"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank, which is its id, a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """The merges themselves: the adjacent pair of least rank joins, the leftmost on ties, until none can."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


Live = tuple[int, int, tuple[int, ...]]         # place in the trie, last token, tokens not written yet


class State(dict):
    """byte → (next state, tokens written); ``rest`` is written where a word ends here."""

    __slots__ = ("machine", "live", "rest")

    def __init__(self, machine: ByteBpe, live: tuple[Live, ...]):
        super().__init__()
        self.machine, self.live, self.rest = machine, live, live[0][2]

    def __missing__(self, byte: int) -> tuple[State, tuple[int, ...]]:
        step = self[byte] = self.machine.step(self.live, byte)
        return step


class ByteBpe(dict):
    """Word (bytes) → token ids. Rank files give every byte a token; the pattern cuts texts into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a rank file needs a token for every byte")
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.words = re.compile(pin_classes(pattern))
        self.plain_words = regex.compile(pattern)
        self.beyond_plain = re.compile(f"[{chr(_first_difference())}-\U0010ffff]")
        self.below: dict[int, int] = {}         # place in the trie << 8 | byte → place
        self.spelled: list[int] = [NONE]
        inner = {0}
        # tokens that the merges never leave whole take no part in the transducer; a word that is one is looked up
        for token, i in ranks.items():
            if len(token) > 1 and merge(ranks, token) != [i]:
                continue
            at = 0
            for byte in token:
                key = at << 8 | byte
                inner.add(at)
                if key not in self.below:
                    self.below[key] = len(self.spelled)
                    self.spelled.append(NONE)
                at = self.below[key]
            self.spelled[at] = i
        self.inner = [at in inner for at in range(len(self.spelled))]
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple[Live, ...], State] = {}
        self.start = self._state(((0, NONE, ()),))

    def _state(self, live: tuple[Live, ...]) -> State:
        state = self.states.get(live)
        if state is None:
            state = self.states[live] = State(self, live)
        return state

    def follows(self, last: int, token: int) -> bool:
        """Whether the merges leave ``last`` and ``token`` apart when they stand in a row."""
        if last == NONE:
            return True
        key = last << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(self.tokens[last], self.tokens[token])
        return known

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Merges the two until a pair over their border joins (False) or none can (True)."""
        rank = self.ranks.get
        parts = [left[i:i + 1] for i in range(len(left))] + [right[i:i + 1] for i in range(len(right))]
        border = len(left) - 1                  # number of the pair over the border
        none = len(self.ranks) + 1 << 20
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            if i == border:
                return False
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < border:
                border -= 1
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return True

    def step(self, live: tuple[Live, ...], byte: int) -> tuple[State, tuple[int, ...]]:
        """The subset construction for one byte, with the tokens that all live states share written."""
        on, whole = [], None
        for at, last, waiting in live:
            at = self.below.get(at << 8 | byte, NONE)
            if at == NONE:
                continue
            token = self.spelled[at]
            if whole is None and token != NONE and self.follows(last, token):
                whole = (0, token, (*waiting, token))
            if self.inner[at]:
                on.append((at, last, waiting))
        # oldest first, the one at the root (which every word end needs) in front
        reached = [whole, *on]
        first = min(len(w) for _, _, w in reached)
        shared = 0
        while shared < first and len({w[shared] for _, _, w in reached}) == 1:
            shared += 1
        written = whole[2][:shared]
        return self._state(tuple((at, last, w[shared:]) for at, last, w in reached)), written

    def walk(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one word of any length, in one pass over its bytes."""
        alone = self.ranks.get(word)
        if alone is not None:
            return (alone,)
        if len(self.states) > MOST_STATES:
            self.reset()
        state, ids, since = self.start, [], 0
        for byte in word:
            state, written = state[byte]
            if written:
                ids += written
                since += 1
                if since > CACHED_BYTES and len(self.states) > MOST_STATES:     # a long word: go on from the live set
                    live, since = state.live, 0
                    self.reset()
                    state = self._state(live)
        return (*ids, *state.rest)

    def __missing__(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8", "surrogatepass")
        ids = self.walk(data)
        if len(data) <= CACHED_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> Iterable[tuple[int, ...]]:
        """Token ids of one text, word by word."""
        words = self.words if self.beyond_plain.search(text) else self.plain_words
        return map(self.__getitem__, words.findall(text))


@lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    """Letters, numbers and white space as the library's own regular expressions know them, as character ranges.

    Unicode versions differ between libraries; asking for every code point once keeps words alike.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, chain(range(0xd800), range(0xe000, 0x110000))))
    out = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        points = np.array([ord(c) for c in bytes(asked.encode_ordinary(every)).decode()])
        runs = np.split(points, np.flatnonzero(np.diff(points) != 1) + 1)
        out[name] = "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)
    return out


@lru_cache(maxsize=1)
def _first_difference() -> int:
    """The first code point that this process's regular expressions put in other classes than the library's do."""
    found = 0x10ffff
    for name, ranges in _classes().items():
        own, pinned = regex.compile(name), re.compile(f"[{ranges}]")
        found = next((c for c in range(found) if bool(own.match(chr(c))) != bool(pinned.match(chr(c)))), found)
    return found


def pin_classes(pattern: str) -> str:
    r"""``pattern`` with \p{L}, \p{N}, \s and \S written out as ranges."""
    classes = _classes()

    def inside(m: re.Match) -> str:
        return re.sub(r"\\p\{[LN]\}|\\s", lambda c: classes[c.group()], m.group())

    def place(m: re.Match) -> str:
        if m.group().startswith("["):
            return inside(m)
        return f"[^{classes[chr(92) + 's']}]" if m.group() == r"\S" else f"[{classes[m.group()]}]"

    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", place, pattern)


class Utf8Stream:
    """Incremental UTF-8: ``feed`` gives the characters that are whole, ``finish`` ends the text.

    Bytes that cannot go on a character end it: each longest beginning of a character becomes one replacement character,
    as does each byte that begins none.
    """

    def __init__(self):
        self.kept, self.need, self.low, self.high = b"", 0, 0x80, 0xbf

    @property
    def idle(self) -> bool:
        return not self.need

    def _begin(self, byte: int) -> str:
        """The lead byte sets how many follow, and the range of the next one (no overlong forms, no surrogates)."""
        if byte < 0x80:
            return chr(byte)
        if 0xc2 <= byte <= 0xdf:
            self.need = 1
        elif 0xe0 <= byte <= 0xef:
            self.need = 2
            self.low, self.high = (0xa0 if byte == 0xe0 else 0x80), (0x9f if byte == 0xed else 0xbf)
        elif 0xf0 <= byte <= 0xf4:
            self.need = 3
            self.low, self.high = (0x90 if byte == 0xf0 else 0x80), (0x8f if byte == 0xf4 else 0xbf)
        else:
            return REPLACEMENT
        self.kept = bytes([byte])
        return ""

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.kept += bytes([byte])
                    self.need -= 1
                    self.low, self.high = 0x80, 0xbf
                    if not self.need:
                        out.append(self.kept.decode())
                    continue
                out.append(self.finish())
            out.append(self._begin(byte))
        return "".join(out)

    def finish(self) -> str:
        left = REPLACEMENT if self.need else ""
        self.__init__()
        return left


class StreamDecoder:
    """Token ids → text, in pieces of any size. A token of whole characters, met between two, is one table look-up."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: t for t, i in ranks.items()}
        self.text: dict[int, str] = {}
        for i, token in self.tokens.items():
            alone = Utf8Stream()
            text = alone.feed(token)
            if alone.idle and REPLACEMENT not in text:
                self.text[i] = text
        self.stream = Utf8Stream()

    def feed(self, ids: Iterable[int]) -> str:
        whole, stream, out = self.text.get, self.stream, []
        for i in ids:
            text = whole(i) if stream.idle else None
            out.append(stream.feed(self.tokens[i]) if text is None else text)
        return "".join(out)

    def finish(self) -> str:
        return self.stream.finish()

    def decode(self, ids: list[int]) -> str:
        try:                                     # most texts: every token is whole characters
            return "".join(map(self.text.__getitem__, ids))
        except KeyError:
            return self.feed(ids) + self.finish()


@lru_cache(maxsize=2)
def byte_bpe(rank_file: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(rank_file), pattern)


@lru_cache(maxsize=2)
def stream_decoder(rank_file: str) -> StreamDecoder:
    return StreamDecoder(read_ranks(rank_file))


def _encoded(batches: Iterator[pa.RecordBatch], rank_file: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) → (doc_id, n_tokens, ids)."""
    bpe = byte_bpe(rank_file, pattern)
    for part in steps(batches, 1):
        packs, sizes = [], []
        for text in part.column(1).to_pylist():
            ids = np.fromiter(chain.from_iterable(bpe.encode(text)), "<u4")
            packs.append(ids.tobytes())
            sizes.append(len(ids))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(packs, pa.binary())],
                                         ["doc_id", "n_tokens", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], rank_file: str, at: int) -> Iterator[pa.RecordBatch]:
    """Adds the text of the packed ids in column ``at``."""
    decoder = stream_decoder(rank_file)
    for part in steps(batches, at):
        texts = [decoder.decode(np.frombuffer(p, "<u4").tolist()) for p in part.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) for every row, whole texts, one narrow pass; ids are packed little-endian unsigned 32-bit
    integers (``unpack`` gives an array).

    ``rank_file`` is readable on every executor. Null or empty text gives no tokens; repeated rows and null ids are
    kept; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, lambda batches: _encoded(batches, rank_file, pattern),
                     f"doc_id {id_type}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded) for every row of packed ids.

    Null or empty ids give the empty text; an id without a token is an error; bytes that are no UTF-8 become replacement
    characters. Repeated rows and null ids of rows are kept; other columns are not read.
    """
    packed = F.coalesce(F.col(ids_col), F.lit(b""))
    rows = encoded.select(F.col(id_col).alias("doc_id"), packed.alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, lambda batches: _decoded(batches, rank_file, 1), f"doc_id {id_type}, ids binary, decoded string")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: (doc_id, n_tokens, ids, decoded), with the rules of both."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    run: Callable = lambda batches: _decoded(_encoded(batches, rank_file, pattern), rank_file, 2)
    return map_texts(rows, run, f"doc_id {id_type}, n_tokens bigint, ids binary, decoded string")


def unpack(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed or b"", "<u4").tolist()
