"""Splitting text into tokens, without loss: joining the tokens gives the text back."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word with the white space before it, or trailing white space.
# (Possessive repeats: nothing can be gained by giving characters back.)
WORD = r"[ \n\t\r]*+[^ \n\t\r]++|[ \n\t\r]++"

SPACE = np.isin(np.arange(256), list(b" \n\t\r"))


def any_of(literals: Sequence[str]) -> str:
    """A pattern for the literals; longer ones first, so that none hides behind its prefix."""
    return "|".join(_escape(s) for s in sorted(literals, key=lambda s: (-len(s), s)))


def split_tokens(text: Column | str, specials: Sequence[str] = ()) -> Column:
    """Tokens of a text as ``array<string>``.  Special tokens are never split or joined to a word."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    if not specials:
        return _words(text)
    pattern = any_of(specials)
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, special: F.when(special.isNull(), _words(gap)).otherwise(
            F.concat(_words(gap), F.array(special))
        ),
    )
    has_special = reduce(or_, [text.contains(s) for s in specials])
    return F.when(has_special, F.flatten(pieces)).otherwise(_words(text))


def splitter(specials: Sequence[str] = ()) -> Callable[[str], list[str]]:
    """What :func:`split_tokens` does, as a function of a Python text."""
    words = re.compile(WORD).findall
    if not specials:
        return words
    marks = re.compile("(" + "|".join(re.escape(s) for s in sorted(specials, key=lambda s: (-len(s), s))) + ")")

    def split(text: str) -> list[str]:
        if not marks.search(text):
            return words(text)
        return [t for i, piece in enumerate(marks.split(text)) for t in ([piece] if i % 2 else words(piece))]

    return split


def token_arrays(texts: pa.Array, specials: Sequence[str] = ()) -> tuple[pa.Array, np.ndarray]:
    """The tokens of an Arrow array of texts (null: empty) one after the other, and how many each text has.

    Tokens joined give the text back, so they are the same bytes with more offsets: a token starts where a text does
    and at white space after a word.  Only texts with special tokens are split as Python texts.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if len(texts) else np.zeros(1, np.int32)
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    data = texts.buffers()[2]
    space = SPACE[np.frombuffer(data, np.uint8)[low:high]]
    starts = np.zeros(high - low, bool)
    starts[1:] = space[1:] & ~space[:-1]
    at = offsets - low
    starts[at[:-1][np.diff(at) > 0]] = True
    if specials:
        marked = reduce(or_, [pc.match_substring(texts, s).to_numpy(zero_copy_only=False) for s in specials])
        split = splitter(specials)
        for i in np.flatnonzero(marked).tolist():
            starts[at[i] : at[i + 1]] = False
            sizes = [len(t.encode()) for t in split(texts[i].as_py())]
            starts[at[i] + np.cumsum([0, *sizes[:-1]])] = True
    found = np.flatnonzero(starts)
    bounds = np.append(found, high - low).astype(np.int32) + np.int32(low)
    tokens = pa.StringArray.from_buffers(len(found), pa.py_buffer(bounds), data)
    return tokens, np.diff(np.searchsorted(found, at)).astype(np.int64)


def text_lengths(text: Column | str, specials: Sequence[str] = ()) -> Column:
    """Number of tokens of each text, as an Arrow function."""
    specials = tuple(specials)

    @F.arrow_udf("int")
    def lengths(texts: pa.Array) -> pa.Array:
        return pa.array(token_arrays(texts, specials)[1], pa.int32())

    return lengths(F.col(text) if isinstance(text, str) else text)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _escape(literal: str) -> str:
    return re.sub(r"([^0-9A-Za-z_<>/ ])", r"\\\1", literal)
