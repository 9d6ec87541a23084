"""Landed API documents → typed RAW rows.

The documents arrive as JSON text (one per row, e.g. from
``spark.read.text`` or a landing stream). They are parsed on the JVM with
``from_json`` against explicit schemas; nothing is parsed in Python.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.columns import ts_ntz

S = T.StringType()

PACKAGE = T.StructType([T.StructField("ecosystem", S), T.StructField("name", S)])
# Nested arrays are read as text (a string field keeps the raw JSON of an
# array or object), so the stored lists keep every field they arrived with.
ADVISORY_DOC = T.StructType([
    T.StructField("ghsa_id", S), T.StructField("cve_id", S), T.StructField("summary", S),
    T.StructField("description", S), T.StructField("severity", S),
    T.StructField("cvss", T.StructType([T.StructField("score", T.DoubleType()),
                                        T.StructField("vector_string", S)])),
    T.StructField("cwes", S), T.StructField("vulnerabilities", S), T.StructField("credits", S),
    T.StructField("published_at", S), T.StructField("updated_at", S), T.StructField("withdrawn_at", S),
    T.StructField("html_url", S),
])

GRAPHQL_PAGE = T.StructType([
    T.StructField("pageInfo", T.StructType([T.StructField("hasNextPage", T.BooleanType()),
                                            T.StructField("endCursor", S)])),
    T.StructField("nodes", T.ArrayType(T.StringType())),
])


# RAW.RAW_GITHUB_ADVISORIES, declared: what is stored does not depend on what the first batch holds
RAW_ADVISORY = T.StructType([
    T.StructField("ghsa_id", S), T.StructField("cve_id", S), T.StructField("summary", S), T.StructField("description", S),
    T.StructField("severity", S), T.StructField("cvss_score", T.DoubleType()), T.StructField("cvss_vector_string", S),
    T.StructField("cwes", T.VariantType()), T.StructField("affected_packages", T.VariantType()),
    T.StructField("published_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("withdrawn_at", T.TimestampNTZType()), T.StructField("html_url", S),
    T.StructField("credits_count", T.LongType()), T.StructField("source_api", S),
    T.StructField("ingested_at", T.TimestampNTZType()), T.StructField("raw_json", T.VariantType()),
])


def parse_documents(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """(json, doc, reject_reason): each document parsed once, to VARIANT.

    A document that is no JSON, and JSON that is no object, is a reject with its reason.
    """
    parsed = docs.select(F.col(json_col).alias("json"), F.try_parse_json(json_col).alias("doc"))
    # JSON that starts with a brace and parses is an object
    reason = (F.when(F.col("doc").isNull(), F.lit("invalid JSON in raw_json"))
              .when(~F.col("json").rlike(r"^[ \t\r\n]*\{"), F.lit("no object in raw_json")))
    return parsed.withColumn("reject_reason", reason)


def typed_advisories(parsed: DataFrame, ingested_at: _dt.datetime) -> DataFrame:
    """Parsed documents (``parse_documents``) → RAW advisory rows as declared, with reject_reason and, for rejects, json.

    The same columns as ``type_raw(flatten_advisories(...))`` from one parse: fields come out of the VARIANT. Where
    text is declared any value counts as its text, an object as its JSON; what does not fit another type is NULL.
    """
    doc = F.col("doc")
    text = lambda path: F.try_variant_get(doc, path, "string")
    time = lambda path: F.try_to_timestamp(text(path)).cast("timestamp_ntz")

    def array(path: str):
        found = F.try_variant_get(doc, path, "variant")
        return F.when(found.isNull() | F.is_variant_null(found), F.parse_json(F.lit("[]"))).otherwise(found)

    credits = F.size(F.try_variant_get(doc, "$.credits", "array<variant>")).cast("long")
    return parsed.select(
        text("$.ghsa_id").alias("ghsa_id"), text("$.cve_id").alias("cve_id"),
        F.coalesce(text("$.summary"), F.lit("")).alias("summary"), text("$.description").alias("description"),
        text("$.severity").alias("severity"), F.try_variant_get(doc, "$.cvss.score", "double").alias("cvss_score"),
        text("$.cvss.vector_string").alias("cvss_vector_string"), array("$.cwes").alias("cwes"),
        array("$.vulnerabilities").alias("affected_packages"), time("$.published_at").alias("published_at"),
        time("$.updated_at").alias("updated_at"), time("$.withdrawn_at").alias("withdrawn_at"),
        text("$.html_url").alias("html_url"), F.coalesce(F.greatest(credits, F.lit(0)), F.lit(0)).cast("long").alias("credits_count"),
        F.lit(R.REST_SOURCE).alias("source_api"), ts_ntz(ingested_at).alias("ingested_at"), doc.alias("raw_json"),
        "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("json")).alias("json"))


def flatten_advisories(docs: DataFrame, ingested_at: _dt.datetime, json_col: str = "json") -> DataFrame:
    """REST advisory JSON → the 17-column RAW advisory row.

    Null-safe nested CVSS fields, package and CWE arrays default to empty
    lists, credits counted, summary and raw payload kept whole,
    and source/ingest stamps added. Timestamps stay text here; ``type_raw``
    types them.
    """
    d = F.from_json(F.col(json_col), ADVISORY_DOC)
    credits = F.from_json(F.col("d.credits"), "array<string>")
    return docs.select(d.alias("d"), F.col(json_col).alias("raw_json")).select(
        F.col("d.ghsa_id").alias("ghsa_id"),
        F.col("d.cve_id").alias("cve_id"),
        F.coalesce(F.col("d.summary"), F.lit("")).alias("summary"),
        F.col("d.description").alias("description"),
        F.col("d.severity").alias("severity"),
        F.col("d.cvss.score").alias("cvss_score"),
        F.col("d.cvss.vector_string").alias("cvss_vector_string"),
        F.coalesce(F.col("d.cwes"), F.lit("[]")).alias("cwes"),
        F.coalesce(F.col("d.vulnerabilities"), F.lit("[]")).alias("affected_packages"),
        F.col("d.published_at").alias("published_at"),
        F.col("d.updated_at").alias("updated_at"),
        F.col("d.withdrawn_at").alias("withdrawn_at"),
        F.col("d.html_url").alias("html_url"),
        F.coalesce(F.size(credits), F.lit(0)).cast("long").alias("credits_count"),
        F.lit(R.REST_SOURCE).alias("source_api"),
        ts_ntz(ingested_at).alias("ingested_at"),
        F.col("raw_json"),
    )


def unwrap_cves(pages: DataFrame, fetched_at_col: str = "fetched_at", json_col: str = "json") -> DataFrame:
    """CVE result pages → one row per CVE item: ``item.cve`` if present, else the item.

    Items are kept as JSON text (the record); the page's fetch time is
    stamped on each.
    """
    items = F.from_json(F.col(json_col), "struct<vulnerabilities:array<string>>")
    ex = pages.select(F.explode(items["vulnerabilities"]).alias("item"), F.col(fetched_at_col).alias("fetched_at"))
    cve = F.get_json_object(F.col("item"), "$.cve")
    rec = F.coalesce(cve, F.col("item"))
    return ex.select(F.get_json_object(rec, "$.id").alias("cve_id"), rec.alias("record"), "fetched_at")


def unwrap_nodes(pages: DataFrame, fetched_at_col: str = "fetched_at", json_col: str = "json") -> DataFrame:
    """Paged GraphQL results → one row per node (JSON text), stamped with the fetch time."""
    p = F.from_json(F.col(json_col), GRAPHQL_PAGE)
    ex = pages.select(F.explode(p["nodes"]).alias("node"), F.col(fetched_at_col).alias("fetched_at"))
    return ex.select(F.get_json_object("node", "$.ghsaId").alias("ghsa_id"), F.col("node").alias("record"),
                     "fetched_at")


def type_raw(df: DataFrame, timestamp_cols=("published_at", "updated_at", "withdrawn_at", "ingested_at"),
             json_cols=("cwes", "affected_packages", "raw_json")) -> DataFrame:
    """Text → typed RAW columns.

    Timestamps parse with ``try_to_timestamp`` (ISO with Z, offsets and
    fractions; bad text becomes NULL) and are held zone-less in UTC. JSON
    columns become VARIANT with ``parse_json``, which fails the job on bad
    JSON like the surveyed load does.
    """
    out = df
    for c in timestamp_cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, F.try_to_timestamp(F.col(c)).cast("timestamp_ntz"))
    for c in json_cols:
        if c in df.columns:
            out = out.withColumn(c, F.parse_json(F.col(c)))
    return out


def split_unparsable(df: DataFrame, json_cols=("cwes", "affected_packages", "raw_json")) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON columns all parse, the others with ``reject_reason``), both with the text as it came."""
    bad = F.lit(None).cast("string")
    for c in reversed([c for c in json_cols if c in df.columns]):
        wrong = F.col(c).isNotNull() & F.try_parse_json(F.col(c)).isNull()
        bad = F.when(wrong, F.lit(f"invalid JSON in {c}")).otherwise(bad)
    marked = df.withColumn("reject_reason", bad)
    return marked.where("reject_reason is null").drop("reject_reason"), marked.where("reject_reason is not null")


def type_raw_with_rejects(df: DataFrame,
                          timestamp_cols=("published_at", "updated_at", "withdrawn_at", "ingested_at"),
                          json_cols=("cwes", "affected_packages", "raw_json")) -> tuple[DataFrame, DataFrame]:
    """Like ``type_raw`` but bad JSON does not fail the job: such rows go to a reject frame.

    Returns ``(typed, rejects)``; ``rejects`` keeps the original text columns
    and names the first column that did not parse.
    """
    good, rejects = split_unparsable(df, json_cols)
    return type_raw(good, timestamp_cols, json_cols), rejects


def plan_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of plan outputs, one text file a run → (run_id, environment, exit_code, stdout, checked_at).

    The run id is the file's name without its last ending, the environment its folder, the time that of the file. The
    exit code is read off the output, as a plan with detailed exit codes gives it: 1 if a line starts with an error, 2 if
    there are changes, else 0. Files are read whole and in the tasks; none is opened by the driver.
    """
    path = F.col("_metadata.file_path")
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    text = F.regexp_replace("value", r"\x1b\[[0-9;]*m", "")                      # colours
    code = (F.when(text.rlike(r"(?m)^(\S\s+)?Error:"), 1).when(text.rlike(r"(?m)^Plan: \d+ to add, \d+ to change, \d+ to destroy"), 2)
            .otherwise(0))
    return files.select(F.url_decode(F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)).alias("run_id"),
                        F.url_decode(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)).alias("environment"),
                        code.cast("int").alias("exit_code"), text.alias("stdout"),
                        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("checked_at"))
