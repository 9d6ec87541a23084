"""Corpus cleaning pipeline: language ID, near-dedup, decontamination, personal data, tokenization.

Each stage takes the documents that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, decontaminate, langid, pii, simhash
from wardline.llm.common import new_folder, settle
from wardline.llm.queries import WORD_BPE, tokenizer_path

LEAST_LANGUAGE_GAIN = 1 / 15      # of the way from a score of 1 / languages, which every text reaches, to 1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determinable language: null or letterless text, or a score under the least one.

    The least score follows the number of languages. Where no row is labelled nothing can be told, and all documents
    with letters stay.
    """
    model = langid.train(docs, usable=F.lit(True))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    chance = 1 / len(model.languages)
    least = chance + LEAST_LANGUAGE_GAIN * (1 - chance)
    scored = langid.predict(docs, model)
    kept = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least - 1e-9)
    return scored.where(kept).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash group: that with the smallest doc_id, null ids last.

    Rows are documents of their own, whether their ids are null or repeated: each goes by its id and a 128-bit digest of
    its columns. Of equal ids the smallest digest stays; wholly equal rows are in one group, and one of them stays. Texts
    meet the decisions in one join, of the same kind at every size. Columns may have any names.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    content = [*columns, *(c.isNull() for c in columns)]      # hashes pass over nulls
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(*content).alias("h1"),
                   F.xxhash64(F.lit(1), *content).alias("h2"))
    keyed = docs.select(F.struct(*columns).alias("doc"), key.alias("row"))
    found = simhash.near_duplicates(keyed, words=4, distance=4, id_col="row", text_col="doc.text")
    rows = found.groupBy("doc_id").agg(F.min("component_id").alias("stands_for"), F.count(F.lit(1)).alias("n"))
    rows = rows.select("doc_id.h1", "doc_id.h2", (F.col("doc_id") == F.col("stands_for")).alias("stands"), "n")
    rows = settle(rows.where("not stands or n > 1"), "copies")
    placed = keyed.select("doc", "row.h1", "row.h2").join(rows.hint("merge"), ["h1", "h2"], "left")
    kept = placed.where("stands is null or stands")
    kept = settle(kept.select("doc", "h1", "h2", F.coalesce("n", F.lit(1)).alias("n")), "kept-documents")
    once = kept.where("n > 1").dropDuplicates(["h1", "h2"])   # combined in each task before it is shuffled
    return kept.where("n = 1").unionByName(once).select("doc.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span by its kind; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its tokens, and a digest of what they decode to."""
    path = tokenizer_path(WORD_BPE)
    done = bpe.round_trip(docs, path)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", redact_personal_data),
    ("bpe", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
