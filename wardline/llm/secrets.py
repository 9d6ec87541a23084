"""Secrets, with DataFrame functions only.

Patterns give the base spans (assign, access, hex). Long runs of token characters are put to a randomness test
battery in the encoding they seem to have (hex, base32, lower-case alphanumeric, base64): chi-squared uniformity of
the alphabet, a runs test about the middle of the alphabet, and lag-one serial correlation. The smallest of the
three p-values, times three, tells how badly a token fails to be random. The Benjamini-Hochberg procedure, run over
all tokens of the same encoding and length class, decides which tokens are not random.

A token that passes may still be a name, too short to fail. So each survivor also needs evidence against being one:
its symbols must be less likely than those of names are. The procedure runs a second time, over the survivors of an
encoding and length class with these p-values; only what it rejects as a name is reported as ``random``, so wrong
reports are bounded as a share of the reports, and lengths at which nothing can be told report nothing.

p-values are counted on a grid of hundredths of a decade, so the procedures need small tables of counts and no global
sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import settle

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]
LEAST_TOKEN = 20
FDR = 0.05
GRID = 100
DECADES = 30

# fixed values: the base patterns, with the length each match must have
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}={{0,2}}"

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}

# fixed values: letters of English text per 10,000, most frequent first
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
LETTER_SHARES = (1270, 906, 817, 751, 697, 675, 633, 609, 599, 425, 403, 278, 276, 241, 236, 223, 202, 197, 193, 149, 98,
                 77, 15, 15, 10, 7)
# names: so much of them letters (a tenth of these evenly), digits and signs; words repeat letters, so scores spread more
# than those of independent symbols would
NAME_LETTERS, NAME_DIGITS, NAME_SIGNS, EVEN, OVERSPREAD = 0.82, 0.08, 0.10, 0.1, 1.5
SIGNS = "-_/+"


def _matches(text: Column, pattern: str, kind: str, least_body: int = 0, keep_token: bool = False) -> Column:
    """Array of (kind, i, gap, len, ok, token): the i-th match, what lies between it and the one before, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    body = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least_body else None

    def one(match: Column, i: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(F.get(between, i)).alias("gap"),
            F.length(match).alias("len"),
            (F.length(F.get(body, i)) >= least_body if least_body else F.lit(True)).alias("ok"),
            (match if keep_token else F.lit(None).cast("string")).alias("token"))

    spans = F.transform(found, one)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(
        "array<struct<kind:int,i:int,gap:int,len:int,ok:boolean,token:string>>"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a rational approximation with error below 1e-7."""
    x = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = F.lit(0.0)
    for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = (poly + c) * t
    tail = F.exp(-x * x / 2) / (2 * 3.141592653589793) ** 0.5 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _two_sided(z: Column) -> Column:
    return 2 * _upper_tail(F.abs(z))


def with_battery(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``tokens`` with encoding, symbols (their number) and p, the battery's p-value, for the string column ``token``."""
    bare = F.regexp_replace(F.col(token), "=+$", "")
    coding = (F.when(bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(bare.rlike("^[A-Z2-7]+$"), "base32")
              .when(bare.rlike("^[a-z0-9]+$"), "alnum").otherwise("base64"))
    plain = F.when(F.col("encoding") == "hex", F.lower(bare)).otherwise(F.translate(bare, "-_", "+/"))
    alphabet = F.lit(None).cast("string")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(F.col("encoding") == name, letters).otherwise(alphabet)
    rows = tokens.withColumn("encoding", coding).withColumn("_plain", plain).withColumn("_alphabet", alphabet)
    rows = rows.withColumn("_k", F.length("_alphabet").cast("double")).withColumn("symbols", F.length("_plain"))
    rows = rows.withColumn("_v", F.transform(F.split("_plain", ""), lambda c: F.position(c, F.col("_alphabet")) - 1))
    n = F.col("symbols").cast("double")
    count = F.transform(F.split("_alphabet", ""), lambda c: n - F.length(F.replace(F.col("_plain"), c)))
    squares = F.aggregate(count, F.lit(0.0), lambda a, x: a + x * x)
    df = F.col("_k") - 1
    spread = 2 / (9 * df)
    chi = F.greatest(F.col("_k") / n * squares - n, F.lit(0.0))
    chi_z = (F.pow(chi / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)

    high = F.transform("_v", lambda x: (x * 2 >= F.col("_k")).cast("int"))
    ones = F.aggregate(high, F.lit(0), lambda a, x: a + x).cast("double")
    turns = F.aggregate(F.zip_with(F.slice(high, 1, F.col("symbols") - 1), F.slice(high, 2, F.col("symbols") - 1),
                                   lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, x: a + x)
    expected = 2 * ones * (n - ones) / n
    variance = expected * (expected - 1) / (n - 1)
    runs_z = F.when(variance > 0, (turns - expected) / F.sqrt(variance)).otherwise(37.0)

    # from sums of whole numbers: a mean used inside a lambda would be taken anew for every symbol
    total = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x)
    squared = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)
    products = F.aggregate(F.zip_with(F.slice("_v", 1, F.col("symbols") - 1), F.slice("_v", 2, F.col("symbols") - 1),
                                      lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("_sums", F.struct(total.alias("s"), squared.alias("q"), products.alias("p")))
    mean = F.col("_sums.s") / n
    ends = F.get("_v", F.lit(0)) + F.get("_v", F.col("symbols") - 1)
    power = F.col("_sums.q") - n * mean * mean
    lagged = F.col("_sums.p") - mean * (2 * F.col("_sums.s") - ends) + (n - 1) * mean * mean
    serial_z = F.when(power > 0.5 / n, lagged / power * F.sqrt(n)).otherwise(37.0)

    least = F.least(_upper_tail(chi_z), _two_sided(runs_z), _two_sided(serial_z))
    return rows.withColumn("p", F.least(F.lit(1.0), 3 * least)).drop("_plain", "_alphabet", "_k", "_v", "_sums")


def _name_scores() -> tuple[str, list[float], float, float]:
    """Symbols, the logarithm of each one's share in names, and mean and deviation of these logarithms in names."""
    whole = sum(LETTER_SHARES)
    shares = [NAME_LETTERS * ((1 - EVEN) * x / whole + EVEN / len(LETTERS)) for x in LETTER_SHARES]
    shares += [NAME_DIGITS / 10] * 10 + [NAME_SIGNS / len(SIGNS)] * len(SIGNS)
    logs = [math.log(x) for x in shares]
    mean = sum(x * y for x, y in zip(shares, logs))
    return LETTERS + "0123456789" + SIGNS, logs, mean, math.sqrt(sum(x * (y - mean) ** 2 for x, y in zip(shares, logs)))


def with_name_p(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``tokens`` with name_p, the p-value of the string column ``token`` against being a name: how seldom a name of its
    length is as unlikely."""
    symbols, logs, mean, deviation = _name_scores()
    table = F.array(*map(F.lit, logs))
    rows = tokens.withColumn("_plain", F.regexp_replace(F.lower(token), "=+$", ""))
    score = F.aggregate(F.split("_plain", ""), F.lit(0.0),
                        lambda a, c: a + F.coalesce(F.get(table, F.position(c, F.lit(symbols)) - 1), F.lit(mean)))
    n = F.length("_plain").cast("double")
    rows = rows.withColumn("_z", (mean * n - score) / (OVERSPREAD * deviation * F.sqrt(n)))
    return rows.withColumn("name_p", _upper_tail(F.col("_z"))).drop("_plain", "_z")


def _cell(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(10.0 ** -DECADES))) * GRID), F.lit(DECADES * GRID))


def rejected_from(cells: DataFrame, fdr: float = FDR) -> DataFrame:
    """Benjamini-Hochberg per stratum on counted p-values.

    ``cells`` has (stratum, cell, n): n tokens whose p-value is at most 10^(-cell / GRID). Returns (stratum, least):
    tokens with a cell of at least ``least`` are rejected; strata without a rejection are absent.
    """
    upward = Window.partitionBy("stratum").orderBy(F.col("cell").desc())
    ranked = cells.select("stratum", "cell", F.sum("n").over(upward).alias("at_most"),
                          F.sum("n").over(Window.partitionBy("stratum")).alias("all"))
    held = F.pow(F.lit(10.0), -F.col("cell") / GRID) <= fdr * F.col("at_most") / F.col("all")
    return ranked.where(held).groupBy("stratum").agg(F.min("cell").alias("least"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(doc_id, spans) for every row, whole texts; spans are (start, kind, end), by start, then kind as listed.

    Null text counts as empty. Repeated rows and null ids are kept apart and stay; columns other than the two named
    are not read. An empty table gives an empty result. A span of kind random may lie in a base span: both are given.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    every = F.concat(_matches(text, ASSIGN, "assign", LEAST_ASSIGNED), _matches(text, ACCESS, "access"),
                     _matches(text, HEX, "hex"), _matches(text, CANDIDATE, "random", keep_token=True))
    found = rows.select("row", "doc_id", F.explode_outer(every).alias("m")).select("row", "doc_id", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    tested = with_name_p(with_battery(found))
    stratum = F.concat_ws("/", "encoding", F.floor(F.log2("symbols")))
    random = F.col("kind") == KINDS.index("random")
    spans = tested.select("row", "doc_id", "kind", "ok", (end - F.col("len")).alias("start"), end.alias("end"),
                          F.when(random, stratum).alias("stratum"), F.when(random, _cell(F.col("p"))).alias("cell"),
                          F.when(random, _cell(F.col("name_p"))).alias("name_cell"))
    spans = settle(spans, "secret-spans")

    tokens = spans.where("stratum is not null")
    cells = tokens.groupBy("stratum", "cell").agg(F.count(F.lit(1)).alias("n"))
    unfit = rejected_from(cells, fdr).withColumnRenamed("least", "unfit")   # one row per encoding and power of two at most
    survives = F.col("unfit").isNull() | (F.col("cell") < F.col("unfit"))
    left = tokens.join(F.broadcast(unfit), "stratum", "left").where(survives)
    named = left.groupBy("stratum", F.col("name_cell").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    unnamed = rejected_from(named, fdr).withColumnRenamed("least", "unnamed")
    judged = spans.join(F.broadcast(unfit), "stratum", "left").join(F.broadcast(unnamed), "stratum", "left")
    random = survives & F.coalesce(F.col("name_cell") >= F.col("unnamed"), F.lit(False))
    keep = F.col("ok") & (F.col("stratum").isNull() | random)
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("kind"), F.col("end").cast("int").alias("end"))
    return judged.groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(keep, span))).alias("spans")).select("doc_id", "spans")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in order."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))
