"""Column-expression helpers.

Everything here returns a ``Column`` evaluated by Spark (inside whole-stage
codegen); no Python runs per row. When the input is a column name (or SQL
expression text), the rule-list helpers build the whole CASE as one SQL
expression and hand it to ``F.expr`` — a single parse on the JVM instead of
many Python→JVM calls; given a ``Column`` they compose it with functions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import sqltext as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- literals

def ts_ntz(value: str | _dt.datetime | _dt.date) -> Column:
    """A zone-less timestamp literal (the driver tables are TIMESTAMP_NTZ)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: str | _dt.date | _dt.datetime) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def word(n: Column | str, words: Sequence[str]) -> Column:
    """``words[n % len(words)]`` — deterministic pick from a list."""
    if isinstance(n, str):
        return F.expr(S.word(n, words, S.SPARK))
    arr = F.array(*[F.lit(w) for w in words])
    return F.element_at(arr, (_col(n) % len(words) + 1).cast("int"))


# ---------------------------------------------------------------- rule lists

def bucketize(c: Column | str, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """First ``value <= bound`` wins; NULL and everything above → default."""
    if isinstance(c, str):
        return F.expr(S.bucketize(c, bounds, default))
    c = _col(c)
    expr = None
    for bound, label in bounds:
        expr = (F.when(c <= bound, F.lit(label)) if expr is None
                else expr.when(c <= bound, F.lit(label)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def map_values(c: Column | str, mapping: Iterable[tuple[str, object]],
               default: object | None = None) -> Column:
    """Simple CASE: equal key → value; no match → default (NULL by default)."""
    if isinstance(c, str):
        return F.expr(S.map_values(c, list(mapping), default))
    c = _col(c)
    expr = None
    for key, value in mapping:
        expr = (F.when(c == key, F.lit(value)) if expr is None
                else expr.when(c == key, F.lit(value)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def like_any(c: Column | str, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against any pattern (substring matches inside words)."""
    if isinstance(c, str):
        return F.expr(S.like_any(c, patterns))
    low = F.lower(_col(c))
    cond = None
    for p in patterns:
        one = low.like(p.lower())
        cond = one if cond is None else (cond | one)
    return cond


def keyword_class(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]],
                  default: str | None) -> Column:
    """Searched CASE over LIKE rules; first match wins, NULL text → default."""
    if isinstance(c, str):
        return F.expr(S.keyword_class(c, rules, default))
    expr = None
    for label, patterns in rules:
        cond = like_any(c, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def order_rank(c: Column | str, order: Sequence[str]) -> Column:
    """Position of a value in a fixed order (1-based); anything else sorts last."""
    return map_values(c, [(v, i + 1) for i, v in enumerate(order)], len(order) + 1)


# ---------------------------------------------------------------- numerics

def hundredths(c: Column | str) -> Column:
    """Scores carry at most two decimals: hold them as exact integer hundredths."""
    if isinstance(c, str):
        return F.expr(S.hundredths(c))
    return F.round(_col(c) * 100).cast("long")


def avg_round2(sum_hundredths: Column | str, n: Column | str) -> Column:
    """round(avg, 2) with halves rounded up, computed on exact integers.

    ``(2*s + n) div (2*n)`` is round-half-up of s/n; NULL when n is 0.
    """
    if isinstance(sum_hundredths, str) and isinstance(n, str):
        return F.expr(S.avg_round2(sum_hundredths, n, S.SPARK))
    num = (sum_hundredths * 2 + n).cast("decimal(38,0)")
    den = (n * 2).cast("decimal(38,0)")
    return F.when(n > 0, F.floor(num / den).cast("double") / 100.0)


def div_round_half_up(num: Column | str, den: int) -> Column:
    """round(num / den) for non-negative integers, halves up, as bigint."""
    if isinstance(num, str):
        return F.expr(S.div_round_half_up(num, den, S.SPARK))
    q = (num * 2 + den).cast("decimal(38,0)") / F.lit(2 * den).cast("decimal(38,0)")
    return F.floor(q).cast("long")


# ---------------------------------------------------------------- time

def hour_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries crossed from start to end (10:59 → 11:01 is 1).

    Counted on the wall clock of the zone-less timestamps (calendar days × 24
    plus the difference of the hour fields), so the session zone does not
    enter.
    """
    a, b = _col(start), _col(end)
    return (F.datediff(F.to_date(b), F.to_date(a)).cast("long") * 24
            + (F.hour(b) - F.hour(a)).cast("long"))


def day_boundaries(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start))).cast("long")
