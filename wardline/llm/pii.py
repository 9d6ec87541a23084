"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (email, ip, card, phone) are always reported once their check holds; their score is informative. The
added kinds (iban, ssn) are reported when their score reaches ``THRESHOLD``: an IBAN that passes mod-97 does so
alone, a three-part number only with a context word before or after it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, steps

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
THRESHOLD = 0.6
CONTEXT_CHARS = 48
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT_GAIN = 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_CONTEXT_RE = {k: re.compile(r"(?i)\b(?:" + "|".join(v) + r")") for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # the local part is the whole run before an @, cut by the previous match; found from the @ it stays linear
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    # tried at every place that no letter or digit precedes, but not within a confirmed number
    m = _IBAN.search(text)
    while m:
        after = m.start() + 1
        if not (m.start() and text[m.start() - 1].isalnum()):
            body = m.group()
            # text after the number may have been taken too: the longest prefix that passes counts
            for end in range(len(body), 14, -1):
                code = body[:end].replace(" ", "")
                if body[end - 1] != " " and 15 <= len(code) <= 34 and mod97(code):
                    after = m.start() + end
                    yield m.start(), after
                    break
        m = _IBAN.search(text, after)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        before, after = text[max(0, m.start() - 1):m.start()], text[m.end():m.end() + 1]
        if not (before.isdigit() or after.isdigit()) and m.group()[:3] not in ("000", "666") and m.group()[0] != "9":
            yield m.span()


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of one text as (kind, start, end, score): by kind as listed, then start; code points, end exclusive."""
    finders = []
    if "@" in text:
        finders.append(("email", _emails))
    if _DIGIT.search(text):
        finders += [("ip", _ips), ("card", _cards), ("phone", _phones), ("iban", _ibans), ("ssn", _ssns)]
    found = []
    for kind, finder in finders:
        for start, end in finder(text):
            near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
            score = min(1.0, PRIOR[kind] + (CONTEXT_GAIN if _CONTEXT_RE[kind].search(near) else 0.0))
            if kind in BASE_KINDS or score >= THRESHOLD:
                found.append((kind, start, end, score))
    return found


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("score", pa.float64())]))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every row: one narrow pass, whole texts.

    Null text counts as empty (no spans). Null ids and repeated rows are kept as they are; columns other than the
    two named ones are not read, so clashing names do no harm. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, 1):
            spans = [[{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(t)]
                     for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _ARROW_SPANS)], ["doc_id", "spans"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, scan, f"doc_id {id_type}, spans {_SPAN}")


def redact(docs: DataFrame, text_col: str = "text", placeholder: str = "<{}>") -> DataFrame:
    """``docs`` with every reported span of ``text_col`` replaced by ``<KIND>``; null stays null.

    Overlapping spans of different kinds are merged first; the placeholder names the one that starts first (the
    longer one, then the one listed first, on ties). All other columns pass through unchanged.
    """
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        spans = find_spans(text) if text else []
        if not spans:
            return text
        out, done, i = [], 0, 0
        spans.sort(key=lambda s: (s[1], -s[2]))
        while i < len(spans):
            kind, start, end, _ = spans[i]
            while i + 1 < len(spans) and spans[i + 1][1] < end:
                i += 1
                end = max(end, spans[i][2])
            out += [text[done:start], placeholder.format(kind.upper())]
            done, i = end, i + 1
        return "".join(out) + text[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, at):
            columns = list(part.columns)
            columns[at] = pa.array([clean(t) for t in part.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return map_texts(docs, run, docs.schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in order."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
