"""Phrase mining, byte-level BPE and the prefix trie against plain versions and the public library."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardline.llm import byte_bpe, collocations, prefix_trie
from wardline.llm.queries import BYTE_BPE, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n long, f long, phrase string, ids string"


# phrases

def plain_collocations(rows, threshold, longest, top):
    """The contract word by word: every phrase counted, every cut scored, every longer phrase looked at."""
    fold = {c: c + 32 for c in range(65, 91)}
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= threshold}
        covered = {q[i:i + m] for q in candidates for m in range(2, len(q)) for i in range(len(q) - m + 1)
                   if f[q] >= f[q[i:i + m]]}
        scored = []
        for p in candidates - covered:
            score, _, l, r = min((1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def mined(docs, **parameters):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, collocations.collocations(docs, **parameters).select(*columns).collect()))


def test_collocations_match_plain_counts(spark):
    rnd = random.Random(3)
    words = ["a", "B", "\x00", "ab", "日本", "x\xa0y", "é", "\x1c", "-"]
    rows = [(rnd.choice(["en", None, "und", "fr"]), "".join(rnd.choice(words) + rnd.choice("  \t  .,\n\x0b;") for _ in range(rnd.randint(1, 90))))
            for _ in range(300)]
    rows += [("en", "one two three four five six")] * 30 + [("en", None), ("en", ""), ("xx", " .\t,"), ("fr", "w " * 40_000)]
    docs = spark.createDataFrame([(None, t, lang, 1, 2, "p", "i") for lang, t in rows], DOCS).repartition(7)
    for top in (5, 2000):
        assert mined(docs, threshold=9, longest=5, top=top) == plain_collocations(rows, 9, 5, top)
    assert mined(docs, threshold=40, longest=3, top=100) == plain_collocations(rows, 40, 3, 100)


def test_collocations_of_nothing(spark):
    assert mined(spark.createDataFrame([], DOCS)) == []
    assert mined(spark.createDataFrame([(1, None, None, 1, 1, None, None), (1, "one two", "en", 1, 1, "", "")], DOCS)) == []


def test_full_filter_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(map(tuple, collocations.phrase_counts(docs, 20, 5).collect()))
    assert want == sorted(map(tuple, collocations.phrase_counts(docs, 20, 5, filter_bits=8).collect()))    # all bits set
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert mined(docs, threshold=20, longest=5, top=300) == plain_collocations(rows, 20, 5, 300)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=40), max_size=6), st.integers(1, 60))
def test_merged_summaries_keep_what_is_frequent(parts, threshold):
    truth = Counter()
    for part in parts:
        for key, n in part:
            truth[key] += n
    mass = sum(truth.values())
    capacity = mass // threshold + 1
    keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for part in parts:
        more = np.array([k for k, _ in part], np.uint32), np.array([n for _, n in part], np.int64)
        keys, counts = collocations.merge_summaries(keys, counts, *more, capacity)
        assert len(keys) <= capacity
    lost = (mass - int(counts.sum())) // (capacity + 1)
    held = dict(zip(keys.tolist(), counts.tolist()))
    for key, f in truth.items():
        assert held.get(key, 0) <= f <= held.get(key, 0) + lost
        assert f < threshold or key in held


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, n, l, r = 9_999_999_999_999, 99_999_999_999_999, 10_000_000_000_001, 99_999_999_999_997
    row = spark.range(1).select(*(F.lit(v).cast("long").cast("decimal(17,0)").alias(c) for c, v in
                                  [("w_f", a), ("w_total", n), ("w_l", l), ("w_r", r)]))
    got = row.select(F.expr("cast(1000 * w_f * w_total as decimal(38,0)) div cast(w_l * w_r as decimal(38,0))")).first()[0]
    assert got == 1000 * a * n // (l * r)


# byte-level BPE

@pytest.fixture(scope="module")
def coder():
    from public_tokenizers import PATTERN
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(tokenizer_path(BYTE_BPE)), PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    import tiktoken
    from public_tokenizers import PATTERN
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def ids_of(coder, text):
    return list(chain.from_iterable(coder.encode(text)))


def test_byte_bpe_every_code_point(coder, library):
    points = [chr(c) for c in range(0x110000) if not 0xd800 <= c < 0xe000]
    for at in range(0, len(points), 400):
        for joint in ("", " a"):
            text = joint.join(points[at:at + 400])
            assert ids_of(coder, text) == library.encode_ordinary(text), hex(ord(points[at]))


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("etaoinshrdlu 'stm\n\t019", max_size=200), st.text(" \n\r\t\x85　", max_size=20)))
def test_byte_bpe_as_the_library(coder, library, text):
    ids = ids_of(coder, text)
    assert ids == library.encode_ordinary(text)
    assert byte_bpe.stream_decoder(tokenizer_path(BYTE_BPE)).decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40))
def test_transducer_gives_what_the_merges_leave(coder, data):
    want = [coder.ranks[data]] if data in coder.ranks else byte_bpe.merge(coder.ranks, data)
    assert list(coder.walk(data)) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=4).filter(lambda b: set(b) <= set(b"abc")) | st.text("abc", min_size=2, max_size=4).map(str.encode),
                unique=True, max_size=12), st.text("abc", max_size=14).map(str.encode))
def test_any_ranks(more, data):
    """Ranks that no training made: tokens that cannot be reached, pairs that join in several ways."""
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(more)}
    coder = byte_bpe.ByteBpe(ranks, r"\S+")
    if data:
        assert list(coder.walk(data)) == ([ranks[data]] if data in ranks else byte_bpe.merge(ranks, data))


def test_words_of_any_length(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_STATES", 500)
    rnd = random.Random(2)
    for text in ("x" * 70_000, " " * 30_000, "".join(rnd.choices("etaoinshrdlu", k=30_000)), "日本" * 9_000):
        coder.reset()
        assert ids_of(coder, text) == library.encode_ordinary(text)
        assert len(coder.states) < 1000


def test_lookahead_is_bounded(coder):
    longest = max(map(len, coder.ranks))
    coder.reset()
    for word in ("internationalization" * 30, "a" * 900):
        coder.walk(word.encode())
    assert max(len(state.live) for state in coder.states.values()) <= longest + 1
    assert max(len(w) for state in coder.states.values() for _, _, w in state.live) <= 2 * longest


@settings(max_examples=400, deadline=None)
@given(st.binary(max_size=30) | st.text(max_size=15).map(str.encode), st.lists(st.integers(0, 30)))
def test_utf8_stream_in_any_pieces(data, cuts):
    stream = byte_bpe.Utf8Stream()
    borders = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    out = "".join(stream.feed(data[a:b]) for a, b in zip(borders, borders[1:])) + stream.finish()
    assert out == data.decode("utf-8", "replace")


def test_byte_bpe_odd_rows(spark, library):
    from public_tokenizers import PATTERN
    path = tokenizer_path(BYTE_BPE)
    texts = [None, "", "x" * 50_000, "<|endoftext|> DON'T don't", "ÄÖ 日本 😀\x00", "ab " * 30_000]
    rows = [(i, t, None, 1, 2, "p", "i") for i, t in enumerate(texts)] + [(3, texts[3], "en", 1, 1, None, None)] * 2 + [(None, "a b", None, 1, 1, "", "")]
    done = byte_bpe.round_trip(spark.createDataFrame(rows, DOCS), path, PATTERN).collect()
    assert len(done) == len(rows)
    assert Counter((r["doc_id"], r["decoded"], tuple(byte_bpe.unpack(r["ids"])), r["n_tokens"]) for r in done) == Counter(
        (r[0], r[1] or "", tuple(library.encode_ordinary(r[1] or "")), len(library.encode_ordinary(r[1] or ""))) for r in rows)
    assert byte_bpe.round_trip(spark.createDataFrame([], DOCS), path, PATTERN).count() == 0
    apart = byte_bpe.decode(byte_bpe.encode(spark.createDataFrame(rows, DOCS), path, PATTERN), path)
    assert Counter(r["decoded"] for r in apart.collect()) == Counter(r[1] or "" for r in rows)
    none = spark.createDataFrame([(1, None), (2, bytes([255, 0, 0, 0]))], "doc_id long, ids binary")
    tokens = {i: t for t, i in byte_bpe.read_ranks(path).items()}
    assert {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(none, path).collect()} == {
        1: "", 2: tokens[255].decode("utf-8", "replace")}


def test_byte_bpe_query_digests(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op12_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_rank_file_lines(tmp_path):
    path = tmp_path / "r.tiktoken"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 1\n")
    assert byte_bpe.read_ranks(str(path)) == {b"a": 0, b"b": 1}
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe({b"a": 0}, r"\S+")


# prefix trie

def plain_trie(rows, family=None, most=4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most if family else 0
        built[c] = (own.get(c - c % family, [])[:h] if family else []) + turns[h:]
    members, children = defaultdict(list), Counter()
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    return sorted((min(m), len(node), -1 if not node else min(members[node[:-1]]), len(m), children[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(node)))).encode()).hexdigest())
                  for node, m in members.items())


TURNS = "conv_id long, turn long, role string, text string, depth long, x1 long, words string, slice int"


def trie_of(spark, rows, **parameters):
    table = spark.createDataFrame([(*r, 1, 2, "w", 3) for r in rows], TURNS).repartition(5)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = prefix_trie.conversation_trie(table, **parameters).select(*columns).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def test_trie_matches_plain_version(spark):
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["a", "b", None]), rnd.choice(["x y", "z", None, ""])) for c in [*range(45), 300, -3]
            for t in range(rnd.randint(1, 6))]
    rows += [(c, t, "u", "one  two\n") for c in (100, 101, 119) for t in range(300 + c)]          # far deeper than two bands
    rows += [(139, 0, "a", "b"), (47, None, "a", "first"), (47, 1, "a", "second"), (None, 1, "a", "b"), (60, 5, "x", "y" * 50_000)]
    assert trie_of(spark, rows) == plain_trie(rows)
    assert trie_of(spark, rows, family=20) == plain_trie(rows, family=20)


def test_trie_of_copies_repeats_and_nothing(spark):
    copies = [(c, t, "u", f"turn {t}") for c in range(1000, 400, -1) for t in range(3)]
    assert trie_of(spark, copies) == plain_trie(copies)
    repeats = [(7, 1, "u", "same")] * 40 + [(8, None, None, None)] * 3
    assert trie_of(spark, repeats) == plain_trie(repeats)
    assert trie_of(spark, []) == [] == trie_of(spark, [(None, 1, "a", "b")])


def test_trie_band_heights_agree(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(c, t, "u", rnd.choice(["p", "q r"])) for c in range(30) for t in range(rnd.randint(1, 40))]
    want = plain_trie(rows)
    for band in (2, 5):
        monkeypatch.setattr(prefix_trie, "BAND", band)
        assert trie_of(spark, rows) == want


def test_trie_ends_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 7)
    rows = [(c, 0, "u", "hello") for c in range(500)]
    assert trie_of(spark, rows) == plain_trie(rows)
