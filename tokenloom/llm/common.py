"""What several operators of this package share: nested rows, words as arrays, Arrow helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
JAVA_WORD = r"[^\x20\x09-\x0D]+"
ROW = "row"
#: Bytes of texts that ``map_arrow`` hands on at once.
SLICE_BYTES = 4 << 20


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def nested(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that helper columns cannot clash with them."""
    return F.struct(*[column(c) for c in df.columns]).alias(ROW)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(JAVA_WORD)), F.lit(0)).cast("long")


def as_bytes(array: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null as empty.  ``bytes.split()`` of one gives its words."""
    return [b or b"" for b in array.cast(pa.binary()).to_pylist()]


class WordIds(dict):
    """Dense numbers of words, with a 128-bit hash of each as two 64-bit arrays.

    Bounded: ``trim`` forgets everything beyond ``most`` words, between two batches.
    """

    def __init__(self, most: int = 1 << 18):
        super().__init__()
        self.most = most
        self.low = np.empty(1 << 12, np.uint64)
        self.high = np.empty(1 << 12, np.uint64)

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        if i == len(self.low):
            self.low = np.concatenate([self.low, np.empty_like(self.low)])
            self.high = np.concatenate([self.high, np.empty_like(self.high)])
        h = xxhash.xxh3_128_intdigest(word)
        self.low[i] = h & 0xFFFFFFFFFFFFFFFF
        self.high[i] = h >> 64
        self[word] = i
        return i

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    start = np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mix(np.arange(1, n + 1, dtype=np.uint64) + start) | np.uint64(1)


def window_hashes(words: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """A hash of each run of ``len(multipliers)`` consecutive word hashes."""
    n = len(words) - len(multipliers) + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j, m in enumerate(multipliers):
        if n > 0:
            out += words[j : j + n] * m
    return mix(out)


def map_arrow(df: DataFrame, batch: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema) -> DataFrame:
    """Map each Arrow batch, in slices of about ``SLICE_BYTES`` of text, so that few rows are Python objects at a time.

    A row's result depends on the row alone.  At its end a task gives unused memory back, as its worker goes on to other tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                out = batch(part)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(b: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``most`` bytes in its text and binary columns, or one row."""
    texts = [c for c in b.columns if pa.types.is_string(c.type) or pa.types.is_binary(c.type)]
    sizes = [pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts]
    ends = np.cumsum(np.sum(sizes, axis=0)) if sizes else np.zeros(b.num_rows, np.int64)
    start = 0
    while start < b.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield b.slice(start, end - start)
        start = end


def byte_parts(array: pa.Array, most: int = 4 << 20) -> Iterator[list[bytes]]:
    """The texts of a column as UTF-8, in consecutive parts of about ``most`` bytes, or of one text.

    Only one part is held as Python objects at a time, however many rows an Arrow batch has.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(array):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield as_bytes(array.slice(start, end - start))
        start = end


def in_parts(texts: list, most: int) -> Iterator[list]:
    """Consecutive parts of a batch, each of at most ``most`` characters or of one text."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part
