"""Data-quality expectations and contracts.

Every check is one job over the data that returns a small frame of failures
(never the data itself): not-null counts for many columns come from a single
scan; uniqueness is a grouped count (combined map-side); accepted values and
freshness are global aggregates.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.columns import ts_ntz


class ContractError(ValueError):
    """The frame does not satisfy its declared contract."""


def _check_rows(df: DataFrame, model: str, test: str, counts: dict[str, "F.Column"]) -> DataFrame:
    """One scan computing several failure counts, returned as rows (model, column, test, failures)."""
    agg = df.agg(*[c.cast("long").alias(f"_f{i}") for i, c in enumerate(counts.values())])
    rows = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(name).alias("column_name"),
                              F.lit(test).alias("test"),
                              F.coalesce(F.col(f"_f{i}"), F.lit(0).cast("long")).alias("failures"))
                     for i, name in enumerate(counts)])
    return agg.select(F.inline(rows))


def expect_not_null(df: DataFrame, columns: Sequence[str], model: str = "model") -> DataFrame:
    return _check_rows(df, model, "not_null",
                       {c: F.count(F.when(F.col(c).isNull(), 1)) for c in columns})


def expect_unique(df: DataFrame, key: str, model: str = "model") -> DataFrame:
    """Number of key values that occur more than once (NULL keys are ignored)."""
    dup = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1))
    return _check_rows(dup, model, "unique", {key: F.count(F.lit(1))})


def expect_in(df: DataFrame, col: str, values: Sequence[str], model: str = "model") -> DataFrame:
    """Rows whose value is outside the accepted set (NULL passes)."""
    bad = F.col(col).isNotNull() & ~F.col(col).isin(*values)
    return _check_rows(df, model, "accepted_values", {col: F.count(F.when(bad, 1))})


def freshness(df: DataFrame, source: str, ts_col: str, as_of: _dt.datetime,
              warn_hours: int = R.FRESHNESS_WARN_HOURS,
              error_hours: int = R.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Max loaded-at against as_of: pass, warn (older than warn) or error (older than error)."""
    now = ts_ntz(as_of)
    m = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(F.col("age_seconds") > error_hours * 3600, "error")
              .when(F.col("age_seconds") > warn_hours * 3600, "warn")
              .otherwise("pass"))
    return (m.withColumn("age_seconds", age.cast("long"))
            .select(F.lit(source).alias("source_table"), "max_loaded_at", "age_seconds",
                    status.alias("status")))


def declared_tests(models: dict[str, DataFrame]) -> DataFrame:
    """Every declared not-null, unique and accepted-values test over the given models.

    One small frame of (model, column_name, test, failures); each model is
    scanned once per kind of test.
    """
    frames = [expect_not_null(models[m], cols, m) for m, cols in R.NOT_NULL_TESTS.items() if m in models]
    frames += [expect_unique(models[m], key, m) for m, key in R.UNIQUE_TESTS.items() if m in models]
    frames += [expect_in(models[m], col, vals, m) for m, (col, vals) in R.ACCEPTED_TESTS.items() if m in models]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ contracts

CRITICAL_CONTRACT = T.StructType([
    T.StructField("advisory_id", T.StringType(), False),
    T.StructField("cve_id", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("severity", T.StringType(), False),
    T.StructField("cvss_score", T.DoubleType(), False),
    T.StructField("composite_risk_score", T.DoubleType(), False),
    T.StructField("age_bucket", T.StringType(), False),
    T.StructField("days_since_published", T.LongType(), True),
    T.StructField("vulnerability_category", T.StringType(), True),
    T.StructField("published_at", T.TimestampNTZType(), True),
])

HEALTH_CONTRACT = T.StructType([
    T.StructField("source_table", T.StringType(), False),
    T.StructField("last_ingested_at", T.TimestampNTZType(), False),
    T.StructField("hours_since_last_load", T.LongType(), True),
    T.StructField("total_rows", T.LongType(), True),
    T.StructField("rows_last_24h", T.LongType(), True),
    T.StructField("rows_last_7d", T.LongType(), True),
    T.StructField("avg_daily_rows_7d", T.LongType(), True),
    T.StructField("is_fresh", T.BooleanType(), True),
    T.StructField("is_row_count_normal", T.BooleanType(), True),
    T.StructField("pipeline_status", T.StringType(), False),
    T.StructField("checked_at", T.TimestampNTZType(), True),
])


def contract_violations(df: DataFrame, contract: T.StructType) -> list[str]:
    """Schema differences (names, order-insensitive; types) — metadata only."""
    problems = []
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    for name in want:
        if name not in have:
            problems.append(f"missing column {name}")
        elif have[name] != want[name]:
            problems.append(f"column {name}: {have[name].simpleString()} != {want[name].simpleString()}")
    for name in have:
        if name not in want:
            problems.append(f"unexpected column {name}")
    return problems


def check_not_null(df: DataFrame, contract: T.StructType, model: str = "model") -> None:
    """Raise when a NOT NULL column of the contract holds NULLs (one aggregate job)."""
    required = [f.name for f in contract.fields if not f.nullable]
    if required:
        row = expect_not_null(df, required, model).where(F.col("failures") > 0).collect()
        if row:
            raise ContractError(f"{model}: NULL in " + ", ".join(f"{r.column_name} ({r.failures})" for r in row))


def check_schema(df: DataFrame, contract: T.StructType, model: str = "model") -> DataFrame:
    """Raise when names or types differ from the contract (metadata only); return the contract's column order."""
    problems = contract_violations(df, contract)
    if problems:
        raise ContractError(f"{model}: " + "; ".join(problems))
    return df.select(*[f.name for f in contract.fields])


def enforce_contract(df: DataFrame, contract: T.StructType, model: str = "model") -> DataFrame:
    """Fail before writing when the schema differs or a NOT NULL column has NULLs (one aggregate job)."""
    out = check_schema(df, contract, model)
    check_not_null(out, contract, model)
    return out


class ObservedContract:
    """A contract that the write itself checks: NULLs of the required columns are counted in the pass that writes.

    ``watch`` checks names and types and adds the counts to the frame to be written; after the write ``nulls`` has
    them and ``verify`` raises if there are any. The written data is not read for it.
    """

    def __init__(self, contract: T.StructType, model: str):
        self.contract, self.model = contract, model
        self.required = [f.name for f in contract.fields if not f.nullable]
        self._observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        out = check_schema(df, self.contract, self.model)
        counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in self.required]
        return out.observe(self._observation, *counts) if counts else out

    def nulls(self) -> dict[str, int]:
        """Column → NULLs written. Waits for the write."""
        return {c: self._observation.get[c] for c in self.required} if self.required else {}

    def verify(self) -> None:
        found = {c: n for c, n in self.nulls().items() if n}
        if found:
            raise ContractError(f"{self.model}: NULL in " + ", ".join(f"{c} ({n})" for c, n in found.items()))
