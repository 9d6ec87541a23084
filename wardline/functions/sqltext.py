"""SQL expression text built from the fixed rule lists.

Used two ways: by the operators, which hand one expression string to
``F.expr`` (one parse on the JVM instead of dozens of Python→JVM calls to
compose the same CASE), and by the DuckDB oracles. Where the two dialects
differ (array subscripts, integer division) ``dialect`` picks the form.
"""

from __future__ import annotations

from collections.abc import Sequence

SPARK = "spark"
DUCKDB = "duckdb"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def word(expr: str, words: Sequence[str], dialect: str = DUCKDB) -> str:
    """words[expr % len(words)] (1-based pick in both dialects)."""
    items = ", ".join(q(w) for w in words)
    if dialect == SPARK:
        return f"element_at(array({items}), CAST(({expr}) % {len(words)} + 1 AS INT))"
    return f"([{items}])[({expr}) % {len(words)} + 1]"


def like_any(expr: str, patterns: Sequence[str]) -> str:
    return "(" + " OR ".join(f"lower({expr}) LIKE {q(p.lower())}" for p in patterns) + ")"


def keyword_class(expr: str, rules, default: str | None) -> str:
    parts = [f"WHEN {like_any(expr, pats)} THEN {q(label)}" for label, pats in rules]
    tail = f" ELSE {q(default)}" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


def bucketize(expr: str, bounds, default: str) -> str:
    parts = [f"WHEN {expr} <= {b} THEN {q(label)}" for b, label in bounds]
    return "CASE " + " ".join(parts) + f" ELSE {q(default)} END"


def _lit(v) -> str:
    if isinstance(v, str):
        return q(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def map_values(expr: str, mapping, default=None) -> str:
    parts = [f"WHEN {expr} = {q(k)} THEN {_lit(v)}" for k, v in mapping]
    tail = f" ELSE {_lit(default)}" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


def order_rank(expr: str, order: Sequence[str]) -> str:
    return map_values(expr, [(v, i + 1) for i, v in enumerate(order)], len(order) + 1)


def hundredths(expr: str) -> str:
    return f"CAST(round(({expr}) * 100) AS BIGINT)"


def _idiv(a: str, b: str, dialect: str) -> str:
    return f"({a}) div ({b})" if dialect == SPARK else f"({a}) // ({b})"


def avg_round2(sum_h: str, n: str, dialect: str = DUCKDB) -> str:
    """round(sum_h / n / 100, 2), halves up, on exact integers; NULL when n = 0."""
    return (f"CASE WHEN ({n}) > 0 THEN CAST({_idiv(f'2 * ({sum_h}) + ({n})', f'2 * ({n})', dialect)} AS DOUBLE)"
            f" / CAST(100 AS DOUBLE) END")


def div_round_half_up(num: str, den: int, dialect: str = DUCKDB) -> str:
    return f"CAST({_idiv(f'2 * ({num}) + {den}', str(2 * den), dialect)} AS BIGINT)"
