"""Quality rules, line first: drop lines that fail, then documents that lost too much.

Rules of a line (a line without a word is neither judged nor counted):

* punctuation: more marks than words; or a short line (``SHORT_LINE`` words at most) of four words and more without any sentence
  mark, of whatever script, that no later line of its paragraph ends for it (so hard-wrapped prose stays);
* navigation: two bare separators or more, at least one for every five words;
* boilerplate: a stock phrase in a short line; or more than half of the words in runs of ``RUN`` words (eight and more at the end) of
  which at most a quarter differ.  The runs are of one length, so a long line is judged like a short one.

A document is kept unless its base measures fail or its failed lines hold more than
``MOST_LOST`` of its words.

Edge cases: a null or empty text has no words and is rejected; a null id stays null; rows
are judged one by one, so repeated rows get equal results; an empty table gives an empty one;
other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import ROW, column, map_arrow, nested

FEWEST_WORDS = 50
MOST_LOST = 0.4
SHORT_LINE, RUN, SHORTEST_RUN = 12, 32, 8
WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?#*$%&|<>{}=_~^"
# What ends a sentence or part of one, by script.
SENTENCE_MARKS = (
    ".", "!", "?", ":", ";", "\u2026", "\u203c", "\u2047", "\u2048", "\u2049",
    "\u3002", "\uff0e", "\uff61", "\uff01", "\uff1f", "\uff1a", "\uff1b",
    "\u0964", "\u0965", "\u061f", "\u061b", "\u06d4", "\u0589", "\u1362", "\u1367", "\u104a", "\u104b", "\u17d4", "\u1803", "\u0df4",
)
BARS = ("|", ">", "/", "\u00bb", "\u2022", "\u00b7")
PHRASES = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "enable javascript", "lorem ipsum", "sign up for our newsletter", "click here to",
    "powered by wordpress", "skip to content", "add to cart",
)


_SENTENCE = re.compile(b"|".join(re.escape(m.encode()) for m in SENTENCE_MARKS))
_BARS = frozenset(m.encode() for m in BARS)
_PHRASES = re.compile("|".join(PHRASES).encode())

MEASURES = pa.schema(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lost", pa.int64()), ("cleaned", pa.string())]
)


class _Numbers(dict):
    """Dense numbers of words, forgotten between texts once there are many."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def _count(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def has_mark(line: bytes) -> bool:
    return bool(_SENTENCE.search(line))


def line_fails(line: bytes, words: list[bytes], ended: bool = False) -> bool:
    """Whether one line (UTF-8), given with its words, breaks a rule; ``ended`` if a later line of its paragraph has a sentence mark."""
    n = len(words)
    if _count(line, MARKS) > n:
        return True
    if (bars := sum(map(words.count, _BARS))) >= 2 and 5 * bars >= n:
        return True
    if n <= SHORT_LINE and (n >= 4 and not ended and not has_mark(line) or _PHRASES.search(line.lower())):
        return True
    if n < SHORTEST_RUN:
        return False
    runs = (words[i : i + RUN] for i in range(0, n, RUN))
    return 2 * sum(len(r) for r in runs if len(r) >= SHORTEST_RUN and 4 * len(set(r)) <= len(r)) > n


def ended_later(lines: list[bytes], split: list[list[bytes]]) -> list[bool]:
    """For each line, whether a later one of the same paragraph (up to a line without words) has a sentence mark.

    A line without words is of no paragraph.
    """
    out, later = [False] * len(lines), False
    for i in reversed(range(len(lines))):
        out[i] = later and bool(split[i])
        later = bool(split[i]) and (later or has_mark(lines[i]))
    return out


def repeated_words(words: list[bytes], numbers: dict[bytes, int] | None = None) -> int:
    """How many words lie in a window of three words that occurs twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers = _Numbers() if numbers is None else numbers
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    key = ids[:n] * len(numbers) + ids[1 : n + 1]
    if len(numbers) >= 1 << 21:  # three numbers would not fit 63 bits
        key = np.unique(key, return_inverse=True)[1]
    key = key * len(numbers) + ids[2:]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    starts = order[np.append(same, False) | np.append(False, same)]
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[starts + j] = True
    return int(np.count_nonzero(covered))


def judge(text: str | None, numbers: dict[bytes, int] | None = None) -> tuple:
    """The measures of one text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    lines = raw.split(b"\n")
    split = [line.split() for line in lines]
    n = sum(map(len, split))
    kept, filled, lost = [], [], 0
    for line, words, ended in zip(lines, split, ended_later(lines, split), strict=True):
        if words:
            filled.append(line)
            if line_fails(line, words, ended):
                lost += len(words)
                continue
        kept.append(line)
    repeats = repeated_words([w for words in split for w in words], numbers)
    failed = n < FEWEST_WORDS or 100 * repeats > 50 * n
    return (
        n,
        len(text or "") - _count(raw, WHITE),
        _count(raw, SYMBOLS),
        len(filled) - len(set(filled)),
        repeats,
        failed,
        not failed and lost <= MOST_LOST * n,
        lost,
        b"\n".join(kept).decode(),
    )


_SEEN = _Numbers()


def _judged(batch: pa.RecordBatch, with_text: bool) -> list[pa.Array]:
    if len(_SEEN) > 1 << 18:
        _SEEN.clear()
    rows = [judge(t, _SEEN) for t in batch.column("text").to_pylist()]
    fields = MEASURES if with_text else list(MEASURES)[:-1]
    return [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost)``."""
    kind = docs.schema[key].dataType.simpleString()
    out = (
        f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_lost long"
    )
    names = [c.split()[0] for c in out.split(", ")]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column("id"), *_judged(b, False)], names)

    light = docs.select(column(key).alias("id"), column(text).alias("text"))
    return map_arrow(light, batch, out).withColumnRenamed("id", key)


def clean(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The kept rows with all their columns; ``text`` without its failed lines, ``length`` (if there) renewed."""
    rows = docs.select(nested(docs), column(text).alias("text"))
    kind = rows.schema[ROW].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        *_, kept, _, cleaned = _judged(b, True)
        out = pa.RecordBatch.from_arrays([b.column(ROW), cleaned], [ROW, "cleaned"])
        return out.filter(kept)

    done = map_arrow(rows, batch, f"{ROW} {kind}, cleaned string")
    renewed = {text: F.col("cleaned")}
    if length in docs.columns:
        renewed[length] = F.length("cleaned").cast(docs.schema[length].dataType)
    return done.select(*[renewed.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])
