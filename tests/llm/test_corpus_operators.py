"""Operators that compare rows with one another, against brute force; archives; the pipeline."""

import base64
import hashlib
import io
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm import ann, components, decontaminate, simhash, span_dedup, warc
from wardline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 300)] + [(500, 500), (None, 3), (7, 900)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = brute_components(range(1000), [e for e in edges if None not in e])
    assert len(got) == len({r["node"] for r in got}) and all(want[r["node"]] == r["root"] for r in got)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links_equal_all_pairs(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(60)] + [0]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for s in seeds for _ in range(25)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    found = brute_components(signed, [(r["a"], r["b"]) for r in links])
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= simhash.DISTANCE]
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 4 * 64 for r in links)
    assert found == brute_components(signed, near)


def test_simhash_ball_reaches_few_even_buckets():
    rng = np.random.default_rng(6)
    fps = rng.integers(0, 1 << 63, 200_000, np.int64).view(np.uint64)
    for bits in (5, 9, 13):
        reach = np.unique(simhash._bucket(simhash._ball(2), bits))
        assert len(reach) == 1 + bits + bits * (bits - 1) // 2
        sizes = np.bincount(simhash._bucket(fps, bits), minlength=1 << bits)
        assert sizes.max() < 2 * len(fps) / (1 << bits) + 60


def test_simhash_query(spark):
    got = QUERIES["op5_simhash"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    lower = {c: c + 32 for c in range(65, 91)}

    def plain(text):
        words = text.translate(lower).encode().split()
        parts = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: plain(t) for i, t in zip(docs["doc_id"], docs["text"])}
    assert all(int(got.loc[i, "fingerprint"], 16) == p and len(got.loc[i, "fingerprint"]) == 16 for i, p in prints.items())
    ids = sorted(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = brute_components(ids, linked)
    assert all(got.loc[i, "component_id"] == want[i] for i in ids)


def test_simhash_odd_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, " \t", 3), (9, " \t", 3), (None, "one two", 4), (4, "w " * 50_000, 5)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp long")).collect()
    assert sorted((r["doc_id"] or -1, r["fp"] == 0, r["component_id"] or -1) for r in got) == [
        (-1, False, -1), (3, True, 3), (4, False, 4), (5, True, 3), (9, True, 3), (9, True, 3)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [500, 3000])
def test_ann_recall_scores_and_ties(spark, size):
    rng = np.random.default_rng(size)
    x = rng.standard_normal((size, 16)).astype(np.float32)
    x[40:80] = x[40]                                                  # copies: ties to the smaller id
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(size, None, 1), (size + 20, [0.0] * 16, 1), (size + 40, [float("nan")] * 16, 1), (None, [1.0] * 16, 1),
           (size + 60, [1.0, 2.0], 1), (size + 80, [None] * 16, 1)]
    table = spark.createDataFrame([*rows, *odd, rows[0]], "vec_id long, embedding array<float>, rank int")
    got = ann.search(table, F.col("vec_id") % 20 == 0, k=20, least_reach=400).toPandas()
    exact, hits = x.astype(np.float64), 0
    for q in range(0, size, 20):
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and q not in set(own["vec_id"])
        scores = exact @ exact[q]
        np.testing.assert_allclose(own["score"], scores[own["vec_id"]], rtol=1e-12)
        assert sorted(zip(-own["score"], own["vec_id"])) == list(zip(-own["score"], own["vec_id"]))
        scores[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(size), -scores))[:20]) & set(own["vec_id"]))
    assert hits / (20 * len(range(0, size, 20))) >= 0.9 and set(got["query_id"]) == set(range(0, size, 20))


@pytest.mark.parametrize("noise", [1e-5, 1e-4])
def test_ann_recall_in_a_jittered_group(spark, noise):
    rng, size = np.random.default_rng(5), 3000
    x = rng.standard_normal((size, 16))
    x[::3] = rng.standard_normal(16) + noise * rng.standard_normal((size // 3, 16))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") % 30 == 0, k=20, least_reach=60).toPandas()
    hits, queries = 0, range(0, size, 30)
    for q in queries:
        near = ((x - x[q]) ** 2).sum(axis=1)                            # unit vectors: nearest first
        near[q] = np.inf
        hits += len(set(np.argsort(near)[:20]) & set(got.loc[got["query_id"] == q, "vec_id"]))
    assert hits / (20 * len(queries)) >= 0.9


def test_ann_empty_and_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])], schema)
    got = ann.search(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]


def plain_span_dedup(docs):
    """All runs of all documents in a dictionary, in order."""
    seen, covered = {}, {}
    for key, text in sorted(docs.items()):
        parts = [text[s:e].lower().split() for s, e in span_dedup.sentences(text)]
        for first, n in span_dedup.runs([len(p) for p in parts]):
            run = tuple(map(tuple, parts[first:first + n]))
            if run in seen:
                covered.setdefault(key, set()).update(range(first, first + n))
            seen.setdefault(run, key)
    return {k: "".join(t[s:e] for i, (s, e) in enumerate(span_dedup.sentences(t)) if i not in covered.get(k, ()))
            for k, t in docs.items()}


def test_span_dedup_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_span_dedup"](spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {i: r["text"] for i, r in got.items()} == plain_span_dedup(docs)


def test_span_dedup_passage_inside_sentences_and_odd_rows(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta. " + "One two three four five six seven eight nine ten. " * 2 + \
        "Kilo lima mike november oscar papa quebec romeo sierra tango uniform. Last words of the passage stand here now."
    rows = [(1, f"Some first text {passage} tail a b.", "x"), (2, f"Other words before {passage} end.", "x"), (3, None, "x"),
            (4, "", "x"), (5, "short", "x"), (None, f"Third of it {passage}", "x"), (6, "unique words only here. " * 1, "x")]
    table = spark.createDataFrame([*rows, rows[1]], "doc_id long, text string, covers string")
    got = {r["doc_id"]: r for r in span_dedup.dedup_spans(table).collect()}
    assert got[None]["n_removed"] <= 1 and "Kilo lima" in got[None]["text"]
    assert "Kilo lima" not in got[1]["text"] and "Kilo lima" not in got[2]["text"] and "Other words" in got[2]["text"]
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["n_removed"] == 0 and got[6]["n_removed"] == 0
    assert span_dedup.dedup_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_sentences(text):
    """The cut as the module words it, border by border: nothing shared with it but the hash."""
    out, start = [], 0
    ends = [m.end() for m in re.finditer(r"[.!?]+[\"')\]]*\s+|\s*\n\s*", text)] + [len(text)]
    for end in ends:
        places = [start + m.start() for m in re.finditer(r"\S+", text[start:end])]
        words = text[start:end].lower().split()
        rank = {i: (words[i - 1][-1] not in ",;:", xxhash.xxh3_64_intdigest(f"{words[i - 1]} {words[i]}".encode()), -i)
                for i in range(1, len(words))}
        cuts = {min(range(i, i + 14), key=rank.__getitem__) for i in range(1, len(words) - 13)} if len(words) > 14 else set()
        borders = [start, *(places[i] for i in sorted(cuts)), end]
        out += [(a, b) for a, b in zip(borders, borders[1:]) if b > a]
        start = end
    return out


def test_span_dedup_against_own_cut_and_all_runs(spark):
    """At the production parameters: every run of 2 sentences and 24 words that occurred before goes, no other sentence."""
    rng = random.Random(23)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(10**5)) + rng.choice(["", "", "", ",", ".", ";"])
    shared = [" ".join(word() for _ in range(n)) for n in (20, 40, 60, 90, 200)]
    texts = []
    for _ in range(80):
        own = [" ".join(word() for _ in range(rng.randint(5, 80))) for _ in range(3)]
        texts.append(rng.choice([" ", "\n"]).join([own[0], rng.choice(shared), own[1], *rng.choices([own[2], shared[1]], k=1)]))
    texts += [shared[3], shared[4] + " end", texts[0], "\n" + texts[1].upper()]
    seen, want = set(), []
    for text in texts:
        spans = plain_sentences(text)
        parts = [tuple(text[s:e].lower().split()) for s, e in spans]
        gone, new = set(), set()
        for first in range(len(parts)):
            for end in range(first + 2, len(parts) + 1):
                if sum(map(len, parts[first:end])) >= 24:
                    run = tuple(parts[first:end])
                    if run in seen or run in new:
                        gone.update(range(first, end))
                    new.add(run)
        seen |= new
        want.append(("".join(text[s:e] for i, (s, e) in enumerate(spans) if i not in gone), len(spans), len(gone)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in span_dedup.dedup_spans(docs).collect()}
    assert got == dict(enumerate(want)) and sum(w[2] > 0 for w in want) > 30


def every_run_dedup(texts):
    """Texts without the sentences of any run, of any length, that occurred before; nothing shared with ``runs``."""
    seen, out = set(), []
    for text in texts:
        spans = span_dedup.sentences(text)
        parts = [tuple(text[s:e].lower().split()) for s, e in spans]
        gone = set()
        for first in range(len(parts)):
            for end in range(first + 2, len(parts) + 1):
                run = tuple(parts[first:end])
                if sum(map(len, run)) >= 12:
                    if run in seen:
                        gone.update(range(first, end))
                    seen.add(run)
        out.append("".join(text[s:e] for i, (s, e) in enumerate(spans) if i not in gone))
    return out


def test_span_dedup_removes_every_repeated_run(spark):
    rng = random.Random(11)

    def sentence(n):
        return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(10**6)) for _ in range(n)) + ". "

    tail = "".join(map(sentence, (10, 12, 2, 2)))                     # the short end is in no run from its start
    texts = [sentence(9) + tail, tail, sentence(7) + tail + sentence(8), tail.upper()]
    for _ in range(60):
        parts = [sentence(rng.choice((1, 2, 3, 5, 10, 12))) for _ in range(rng.randint(1, 9))]
        texts += ["".join(parts), sentence(3) + "".join(parts[rng.randrange(len(parts)):]) + sentence(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in span_dedup.dedup_spans(docs, least_words=12).collect()}
    want = every_run_dedup(texts)
    assert want[1] == want[3] == "" and sum(t != w for t, w in zip(texts, want)) > 20
    short = {i for i, t in enumerate(texts) if len(span_dedup.sentences(t)) < 2 or len(t.split()) < 12}
    assert all(got[i] == want[i] for i in range(len(texts)) if i not in short)


@pytest.mark.parametrize("script", ["spaced", "unspaced"])
def test_span_dedup_passages_across_and_inside_sentences(spark, script):
    rng, glue, texts, passages = random.Random(13), " " if script == "spaced" else "", [], []

    def words(n):
        return [f"w{fresh.pop()}" if glue else chr(fresh.pop()) for _ in range(n)]

    for k in range(60):
        fresh = rng.sample(range(0x4E00, 0x9F00), 400)                  # no word twice in a pair of texts
        passage = words(rng.randint(50, 90))
        shown = list(passage)
        for i in rng.sample(range(len(shown)), (0, 1, 4)[k % 3]):        # no mark; one; several
            shown[i] += (". " if k % 2 else ", ") if glue else ("。" if k % 2 else "、")
        passages.append((passage, ends := [words(rng.randint(0, 40)) for _ in range(4)]))
        texts += [glue.join([*ends[0], *shown, *ends[1]]), glue.join([*ends[2], *shown, *ends[3]]) + "."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in span_dedup.dedup_spans(docs).collect()}
    for k, (passage, ends) in enumerate(passages):
        assert got[2 * k] == texts[2 * k] and all(w in got[2 * k + 1] for w in ends[2] + ends[3])
        left = [i for i, w in enumerate(passage) if w in got[2 * k + 1]]
        assert all(i < span_dedup.PIECE or i >= len(passage) - span_dedup.PIECE for i in left), (k, left)


def plain_leaks(docs, items):
    out = set()
    words = {i: [w.decode() for w in split(t)] for i, t in docs.items() if t}
    for item, text in items.items():
        own = split(text)
        for i, w in words.items():
            w = [x.encode() for x in w]
            for at in range(max(1, len(w) - len(own) + 1)) if own and w else ():
                if decontaminate.similarity(w[at:at + len(own)], own) >= 0.8:
                    out.add((i, item))
                    break
    return out


def split(text):
    raw = decontaminate.normal(text)
    starts, ends = decontaminate.word_bounds(np.frombuffer(raw, np.uint8))
    return [raw[s:e] for s, e in zip(starts, ends)]


def test_decontamination_equals_every_window(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.randint(6, 60))) for i in range(30)}
    docs, odd = {}, [(900, None), (901, ""), (902, "..."), (None, items[3])]
    for d in range(120):
        words, item = rng.choices(vocabulary, k=rng.randint(0, 200)), items[rng.randrange(30)].split()
        for at in rng.sample(range(len(item)), rng.randint(0, 2)):
            item[at] = rng.choice(vocabulary)
        docs[d] = " ".join(words[:50] + (["Start,"] + [w.upper() for w in item] if d % 3 else item[1:-1]) + words[50:])
    table = spark.createDataFrame([*docs.items(), *odd], "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([*items.items(), (77, None), (78, "")], "item_id long, text string")
    want = plain_leaks(docs, items)
    for block in (10**6, 2000):
        got = decontaminate.leaks(table, bench, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got if r["doc_id"] is not None} == want
        assert [r["item_id"] for r in got if r["doc_id"] is None] == [3]
    assert want and decontaminate.leaks(table, bench.limit(0)).count() == 0 and decontaminate.leaks(table.limit(0), bench).count() == 0
    kept = decontaminate.without_leaks(table, bench)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {*docs, 900, 901, 902} - {d for d, _ in want}


def test_decontamination_short_items_and_items_without_id(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)]
    items = {n: " ".join(rng.choices(vocabulary, k=n)) for n in range(1, 9)}
    docs = {d: " ".join(rng.choices(vocabulary, k=d % 40)) + " " + items[1 + d % 8] * (d % 3) for d in range(200)}
    table = spark.createDataFrame([*docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([*items.items()], "item_id long, text string")
    got = decontaminate.leaks(table, bench, block_chars=40).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted(plain_leaks(docs, items))
    for r in got:
        if r["item_id"] < 5:
            assert split(docs[r["doc_id"]])[r["first_word"]:][:r["n_words"]] == split(items[r["item_id"]])
    nameless = bench.where("item_id in (2, 7)").withColumn("item_id", F.lit(None).cast("long"))
    want = sorted(d for d, i in plain_leaks(docs, items) if i in (2, 7))
    got = decontaminate.leaks(table, nameless, block_chars=10).collect()
    assert sorted(r["doc_id"] for r in got) == want and {r["item_id"] for r in got} == {None}


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 200, np.int64).astype(np.uint64)
    queries = np.concatenate([prints ^ np.uint64((1 << k) - 1) for k in (0, 7, 20, 21)])
    q, p, d = decontaminate.HammingIndex(prints, 20).near(queries)
    full = np.bitwise_count(queries[:, None] ^ prints[None, :])
    assert set(zip(q, p)) == set(zip(*np.nonzero(full <= 20))) and (full[q, p] == d).all()


def test_archives_round_trip(spark):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 300_000, "\r\n\r\nWARC/1.1", "<p>a</p>"]
    rows = [(i, None if i == 2 else f"http://x/{i} ü\n", h, "c") for i, h in enumerate(html)]
    table = spark.createDataFrame([*rows, rows[5], (None, None, "<p>a</p>", "c")], "page_id long, url string, html string, path string")
    listed = warc.write_archives(table, warc.archive_folder(spark))
    got = warc.read_archives(listed, with_payload=True).collect()
    first = {"<p>a</p>": 0, "": 1}
    for r in got:
        text = "<p>a</p>" if r["page_id"] is None else html[r["page_id"]] or ""
        revisit = first.get(text, r["page_id"]) != r["page_id"]
        data = text.encode()
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[text]) if revisit else ("response", None))
        assert r["payload_bytes"] == len(data) and r["payload"] == (b"" if revisit else data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert len(got) == len(html) + 2
    sized = warc.read_archives(warc.write_archives(table, warc.archive_folder(spark), least_bytes=8)).collect()
    assert sorted(r["page_id"] or -1 for r in sized if r["record_type"] == "revisit") == [-1, 3, 6]
    assert warc.read_archives(warc.write_archives(table.limit(0), warc.archive_folder(spark))).count() == 0


def test_reader_notices_damage():
    record = warc.record_bytes(1, "http://x", b"payload", warc.sha1_text(b"payload"), None, False)
    good = warc.gzip_member(record)
    assert [r[3] for r in warc.read_records(io.BytesIO(good * 3))] == [b"payload"] * 3
    for bad in (good[:-9], warc.gzip_member(record.replace(b"payload", b"pAyload")), warc.gzip_member(record[:-1]),
                warc.gzip_member(record.replace(b"Content-Length: ", b"Content-Length: 1", 1)), warc.gzip_member(b"x")):
        with pytest.raises(warc.BrokenArchive):
            list(warc.read_records(io.BytesIO(good + bad)))


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF).toPandas().set_index("doc_id")
    one = QUERIES["op5_simhash"](spark, SF).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    kept = {i for i in one["component_id"].unique() if texts[i] and any(map(str.isalpha, texts[i]))}
    leaking = {i for i in kept if any(t in texts[i] for t in items.values())}
    assert leaking and set(got.index) == kept - leaking and got["n_tokens"].gt(0).all()


def test_pipeline_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 456", "en", "s", 7), (4, "the and of that is mail a@b.cd", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (spark.createDataFrame([*rows, rows[3]], schema), spark.createDataFrame([], schema)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == table.columns
        left = docs.collect()
        assert [r["doc_id"] for r in left] == ([4] if table.count() else [])
        assert all("<EMAIL>" in r["text"] and r["n_chars"] == len(r["text"]) for r in left)


def test_pipeline_judges_rows_not_ids(spark):
    rng = random.Random(17)
    prose = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(8)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def table(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema).repartition(3)

    def left(docs):
        return sorted((r["doc_id"] or -1, r["text"]) for r in docs.collect())

    rows = [(None, prose[0]), (None, prose[1]), (None, prose[1]), (None, prose[2]), (1, prose[2]), (7, prose[3]), (9, prose[3]),
            (3, prose[4]), (7, prose[4]), (8, prose[5]), (8, prose[6]), (8, prose[6])]
    got = corpus_pipeline.drop_near_duplicates(spark, table(rows), SF)
    assert got.columns == table(rows).columns and left(got) == sorted([
        (-1, prose[0]), (-1, prose[1]), (1, prose[2]), (7, prose[3]), (3, prose[4]), (8, prose[5]), (8, prose[6])])
    rows = [(None, prose[0]), (None, f"{prose[1]} {item} {prose[2]}"), (7, item), (7, prose[3]), (8, prose[4]), (8, prose[4])]
    assert left(corpus_pipeline.drop_leaks(spark, table(rows), SF)) == sorted(
        [(-1, prose[0]), (7, prose[3]), (8, prose[4]), (8, prose[4])])


def test_pipeline_language_score_follows_the_number_of_languages(spark):
    rng = random.Random(19)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    letters = ["abcdefg", "hijklmn", "opqrstu", "vwxyzäö"]

    def left(languages, labelled):
        rows = [(k * 100 + i, " ".join("".join(rng.choices(letters[k], k=5)) for _ in range(30)), f"l{k}" if labelled else None, "s", 1)
                for k in range(languages) for i in range(20)]
        table = spark.createDataFrame([*rows, (9000, "12 34", None, "s", 1), (9001, None, None, "s", 1)], schema)
        kept = corpus_pipeline.identify_language(spark, table, SF)
        return kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows}

    assert left(1, True) and left(4, True) and left(3, False)
