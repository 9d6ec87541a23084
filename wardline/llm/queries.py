"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (ann, bpe, byte_bpe, collocations, decontaminate, langid, pii, prefix_trie, secrets, simhash,
                          span_dedup, token_count, warc)

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0, k=20)


def _count(spans: str, kind: str | int, name: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    counts = [_count("spans", k, k) for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))


def op3_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.dedup_spans(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE_KINDS))
    counts = [_count("spans", i, name) for i, name in enumerate(secrets.KINDS)]
    return found.select("doc_id", *counts[:3], F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"), counts[3])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(WORD_BPE)
    decoded = bpe.round_trip(_table(spark, sf_dir, "documents"), path)
    ids_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids_text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark), least_bytes=0)
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE), limit=4096)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.train(docs, usable=~held_out)
    return langid.predict(docs.withColumn("held_out", held_out), model, carry=["doc_id", "held_out"])


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), threshold=100, longest=5, top=2000)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    done = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), PATTERN)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), family=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_pii": op2_pii,
    "op3_span_dedup": op3_span_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_warc": op8_warc,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}

# five hexadecimal digits are four base32 ones
ORACLES: dict[str, str] = {
    "op8_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex, body FROM p),
f AS (SELECT body, min(page_id) AS first_id FROM h GROUP BY body)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           (CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM h JOIN f USING (body)""",
    # every split of a phrase is counted as a phrase of its own; HUGEINT holds the products at this size
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2),
                                                lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
          FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(words) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, m, phrase, f AS a, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS words FROM f WHERE m > 1),
scores AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         CAST((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM f WHERE f.lang = b.lang AND f.m > b.m AND 100 * f.f >= 100 * b.a
  AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, score
FROM kept QUALIFY rank <= 2000""",
    # crc32 goes bit by bit over the decimal id; a node is the list of its turns
    "op13_prefix_trie": r"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations
                       WHERE conv_id IS NOT NULL),
crc(c, s, i, v) AS (
  SELECT c, s, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(s[i // 8 + 1])::BIGINT) ELSE v END AS x FROM crc
        WHERE i < 8 * length(s))),
h AS (SELECT c, xor(v, 4294967295::BIGINT) % 4 AS h FROM crc WHERE i = 8 * length(s)),
own AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (SELECT h.c, list_concat(coalesce(b.turns[1:h.h], []), own.turns[h.h + 1:]) AS turns
            FROM h JOIN own USING (c) LEFT JOIN own b ON b.c = h.c - (h.c % 20 + 20) % 20),
members AS (SELECT c, d, turns[1:d] AS node, d = len(turns) AS ends
            FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
                 coalesce((count(*) - 1) * len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')), 0) AS saved
          FROM members GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
subtree AS (SELECT node[1:e] AS node, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
            FROM (SELECT n.node, n.saved, k.n IS NULL AS leaf, unnest(range(0, n.d + 1)) AS e
                  FROM nodes n LEFT JOIN kids k ON k.node = n.node) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtree s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node
LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]""",
}
