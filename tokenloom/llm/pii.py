"""Personal data, also where it is disguised, with offsets into the original text.

``base_spans`` finds what stands in the text as it is.  Three transducers then rewrite a copy of
the text, each keeping where every character came from: look-alike characters (other scripts, full
width, invisible ones), digits spelled as words, and "at"/"dot" in place of the signs.  The same
detectors read the rewritten copy; what they find there is mapped back to source characters and
added if it holds a rewritten place and touches no base span of its kind.

Offsets are code points, ends exclusive.  All scans are linear in the text's length.

Edge cases: null counts as empty and has no spans; rows are judged one by one (repeated rows,
null ids, empty tables need no rule); other columns pass through ``redact`` untouched.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import ROW, column, map_arrow, nested

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_ANY_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    found, end, m = [], 0, _DOMAIN.search(text)
    while m:
        start = at = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            found.append((start, end))
        m = _DOMAIN.search(text, end if start < at else at + 1)
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _is_card(match: str) -> bool:
    digits = _NOT_DIGIT.sub("", match)
    return 12 <= len(digits) <= 19 and _luhn(digits)


def _is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def _is_phone(match: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", match)) <= 15


def base_spans(text: str) -> list[Span]:
    """All spans of the text as it stands, by start, then kind."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):
        for kind, pattern, valid in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
            if kind == "phone" and "+" not in text:
                continue
            found += [(kind, *m.span()) for m in pattern.finditer(text) if valid(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# --- transducers ------------------------------------------------------------

#: Look-alikes of Latin letters, by code point name order; full width and other digits follow by rule.
_LOOK_ALIKES = str.maketrans(
    "АВЕЗІЈКМНОРЅСТУХаеіјоѕрсухΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορ",
    "ABE3IJKMHOPSCTYXaeijospcyxABEZHIKMNOPTYXaivop",
)
_INVISIBLE = "­​‌‍⁠﻿"
_OTHER_SIGNS = {"․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-"}
_CHARACTER = re.compile(
    "[" + _INVISIBLE + "".join(map(chr, _LOOK_ALIKES)) + "".join(_OTHER_SIGNS) + "！-～]|(?![0-9])\\d"
)
_DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_DIGIT = "(?:" + "|".join(_DIGITS) + ")"
_SPELLED = re.compile(rf"\b{_DIGIT}\b(?:(?:[\x20]++|[\x20,-]{{1,2}}){_DIGIT}\b)*+", re.I)
_SPELLED_ONE = re.compile(_DIGIT, re.I)
#: A run of spaces is tried from its start only, or long runs would take quadratic time.
_OPEN, _CLOSE = r"(?:(?<!\x20)[\x20]++)?[\[({<][\x20]*+", r"[\x20]*+[\])}>][\x20]*+"
_SIGN = re.compile(
    rf"{_OPEN}(?:at|@){_CLOSE}|{_OPEN}(?:dot|\.){_CLOSE}"
    r"|(?<=[A-Za-z0-9])[\x20]++(?:at)[\x20]++"
    r"(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?:[\x20]++dot[\x20]++|[\x20]*+[\[({<][\x20]*+dot)[A-Za-z0-9\])}>\x20])"
    r"|(?<=[A-Za-z0-9])[\x20]++dot[\x20]++(?=[A-Za-z0-9])"
    r"|\bplus[\x20]++(?=[0-9])",
    re.I,
)


def _character(m: re.Match) -> str:
    c = m[0]
    if c in _INVISIBLE:
        return ""
    if c in _OTHER_SIGNS:
        return _OTHER_SIGNS[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    return str(int(c)) if c.isdecimal() else c.translate(_LOOK_ALIKES)


def _spelled(m: re.Match) -> str:
    return "".join(_DIGITS[d.lower()] for d in _SPELLED_ONE.findall(m[0]))


def _sign(m: re.Match) -> str:
    words = m[0].lower()
    return "@" if "at" in words or "@" in words else "+" if "plus" in words else "."


TRANSDUCERS: tuple[tuple[re.Pattern, Callable[[re.Match], str]], ...] = (
    (_CHARACTER, _character),
    (_SPELLED, _spelled),
    (_SIGN, _sign),
)


class Rewritten:
    """A rewritten text that knows where its characters came from, one transducer at a time."""

    def __init__(self, text: str):
        self.text = text
        self.steps: list[tuple[list[int], list[tuple[int, int, int, int]]]] = []

    def apply(self, pattern: re.Pattern, replace: Callable[[re.Match], str]) -> None:
        out, edits, pos, n = [], [], 0, 0
        for m in pattern.finditer(self.text):
            start, end = m.span()
            new = replace(m)
            n += start - pos
            out += [self.text[pos:start], new]
            edits.append((n, n + len(new), start, end))
            n, pos = n + len(new), end
        if edits:
            out.append(self.text[pos:])
            self.text = "".join(out)
            self.steps.append(([e[0] for e in edits], edits))

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of a span, and whether a rewritten place lies in it."""
        touched = False
        for starts, edits in reversed(self.steps):
            i = bisect_right(starts, start) - 1
            while i >= 0 and edits[i][0] == start and edits[i][1] == start:
                i -= 1  # an invisible character just before the span does not belong to it
            j = bisect_right(starts, end - 1) - 1
            touched |= any(edits[k][1] > start for k in range(max(i, 0), j + 1))
            start, end = self._old(edits, i, start, 0), self._old(edits, j, end - 1, 1)
        return start, end, touched

    @staticmethod
    def _old(edits: list[tuple[int, int, int, int]], i: int, at: int, last: int) -> int:
        if i < 0:
            return at + last
        _, new_end, old_start, old_end = edits[i]
        if at < new_end:
            return old_end if last else old_start
        return old_end + at - new_end + last


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and base spans with those found behind disguises."""
    base = base_spans(text)
    copy = Rewritten(text)
    for pattern, replace in TRANSDUCERS:
        copy.apply(pattern, replace)
    if not copy.steps:
        return base, base
    added = []
    for kind, start, end in base_spans(copy.text):
        start, end, touched = copy.source(start, end)
        if touched and not any(k == kind and s < end and start < e for k, s, e in base):
            added.append((kind, start, end))
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_<kind> of base spans, base_sha256, spans, n_added)`` of each row."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        both = [all_spans(t or "") for t in b.column("text").to_pylist()]
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in both], pa.int64()) for k in KINDS]
        digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in both], pa.string())
        spans = pa.array([joined(every) for _, every in both], pa.string())
        added = pa.array([len(every) - len(base) for base, every in both], pa.int64())
        return pa.RecordBatch.from_arrays([b.column("id"), *counts, digests, spans, added], names)

    light = docs.select(column(key).alias("id"), column(text).alias("text"))
    out = "id {}, {}, base_sha256 string, spans string, n_added long"
    out = out.format(kind, ", ".join(f"n_{k} long" for k in KINDS))
    return map_arrow(light, batch, out).withColumnRenamed("id", key)


def redacted(text: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    _, spans = all_spans(text)
    out, pos = [], 0
    for kind, start, end in spans:
        if start >= pos:
            out += [text[pos:start], f"[{kind.upper()}]"]
        pos = max(pos, end)
    return "".join([*out, text[pos:]])


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns; personal data in ``text`` replaced, ``length`` (if there) renewed.  Null stays null."""
    rows = docs.select(nested(docs), column(text).alias("text"))
    kind = rows.schema[ROW].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        clean = [None if t is None else redacted(t) for t in b.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(ROW), pa.array(clean, pa.string())], [ROW, "clean"])

    done = map_arrow(rows, batch, f"{ROW} {kind}, clean string")
    renewed = {text: F.col("clean")}
    if length in docs.columns:
        renewed[length] = F.length("clean").cast(docs.schema[length].dataType)
    return done.select(*[renewed.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])
