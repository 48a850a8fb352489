"""Substring dedup: remove words in 13-word windows that an earlier document has, too.

1. Every partition sketches its windows in a count-min table (``ROWS`` hash rows, counts that stop
   at two) and sends the touched cells, block by block; blocks are merged by key.  Merged counts never
   fall below the true number of documents with a window, so no repeated window is lost.
2. The cells counted twice, as compressed bit blocks of bounded size, go to all tasks.  A second
   pass over the texts takes only windows whose every cell was counted twice, as 96-bit
   fingerprints.  Within a part of texts all but the smallest id of a window are settled at once; the
   rest, one row for each window and part at most (if ids are unique), are grouped exactly, and windows
   whose smallest document id is smaller than the row's own mark the places to remove.

The table has about ``CELLS_PER_WINDOW`` cells for each window, at most ``2 ** MOST_BITS`` cells in all: that
bounds what is broadcast.  Beyond it more windows pass the prefilter, and the result stays the same.

Edge cases: null and empty texts have no words and keep none; windows do not cross documents; rows
of one id are one document with several texts, judged by that id; a null id is no smaller and no larger
than any other, so such rows keep everything; repeated rows get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import WordIds, byte_parts, column, map_arrow, mix, odd_numbers, window_hashes
from tokenloom.staging import stage

WINDOW = 13
ROWS = 2
CELLS_PER_WINDOW = 3
MOST_BITS = 30
BLOCK_BITS = 20
#: Bytes of texts sketched at once, and bytes among which repeated windows are settled before the shuffle.
PART_BYTES, SETTLED_BYTES = 6 << 20, 32 << 20
#: About how many bytes a word takes; it steers the size of the table only.
WORD_BYTES = 6

_LOW, _HIGH = odd_numbers(WINDOW, 11), odd_numbers(WINDOW, 13)
_WORDS = WordIds()


def fingerprints(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run of ``window`` words, by its first word."""
    ids = _WORDS.of(text.split())
    return window_hashes(_WORDS.low[ids], _LOW[:window]), window_hashes(_WORDS.high[ids], _HIGH[:window])


def _parts(texts: pa.Array, most: int = PART_BYTES) -> Iterator[list[bytes]]:
    # A function of the module: what is nested in another one would trim a copy of the store.
    for part in byte_parts(texts, most):
        _WORDS.trim()
        yield part


def _each(texts: pa.Array) -> Iterator[bytes]:
    for part in _parts(texts):
        yield from part


def cells(low: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each window in every row of the table; the rows share the ``2 ** bits`` cells."""
    width = bits - (ROWS - 1).bit_length()
    return [((mix(low + np.uint64(i)) >> np.uint64(64 - width)) + np.uint64(i << width)).astype(np.uint32) for i in range(ROWS)]


def table_bits(windows: int) -> int:
    """log2 of the number of cells for so many windows."""
    return min(MOST_BITS, max(BLOCK_BITS + 1, (CELLS_PER_WINDOW * max(windows, 1) - 1).bit_length()))


# --- the table ----------------------------------------------------------------


def _packed(touched: np.ndarray, twice: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """``(block, cells)``: the sorted distinct cells of each block as gaps; those counted twice are flagged."""
    block = touched >> np.uint32(BLOCK_BITS)
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(starts[1:], len(block))
    inner = (touched & np.uint32((1 << BLOCK_BITS) - 1)).astype(np.int64)
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        yield int(block[s]), _gaps(inner[s:e], twice[s:e])


def _gaps(at: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted distinct cells of a block: gaps as 16-bit numbers, longer ones split by marks, then flags; deflated."""
    gap = np.diff(at, prepend=-1) - 1
    long = gap // 0xFFFF
    out = np.full(int(long.sum()) + len(gap), 0xFFFF, np.uint16)
    out[np.cumsum(long + 1) - 1] = gap % 0xFFFF
    head = np.array([len(out), len(gap)], "<u4").tobytes()
    low, high = (out & 0xFF).astype(np.uint8), (out >> 8).astype(np.uint8)
    return head + zlib.compress(low.tobytes() + high.tobytes() + np.packbits(twice).tobytes(), 1)


def _cells_of(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(packed[:8], "<u4").tolist()
    raw = np.frombuffer(zlib.decompress(packed[8:]), np.uint8)
    gaps = raw[:n].astype(np.int64) | raw[n : 2 * n].astype(np.int64) << 8
    mark = gaps == 0xFFFF
    at = np.cumsum(np.where(mark, 0xFFFF, gaps + 1))[~mark] - 1
    return at, np.unpackbits(raw[2 * n :], count=m).astype(bool)


def _sketch(docs: DataFrame, bits: int) -> DataFrame:
    """``(block, cells)`` of each part of texts; a document counts a window once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts in _parts(b.column("text")):
                found = [c for t in texts for c in cells(np.unique(fingerprints(t)[0]), bits)]
                touched, counts = np.unique(np.concatenate(found), return_counts=True)
                rows = list(_packed(touched, counts > 1)) if len(touched) else []
                arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "cells"])

    return docs.select("text").mapInArrow(run, "block int, cells binary")


def _merged(sketches: DataFrame) -> DataFrame:
    """``(block, bits)``: the cells of each block counted twice over all batches, as a deflated bitmap.

    A block is read batch by batch into two bitmaps, so memory does not grow with the input.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, once, twice = None, np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
        for b in batches:
            block = b.column("block")[0].as_py()
            for packed in b.column("cells").to_pylist():
                at, again = _cells_of(packed)
                twice[at[again | once[at]]] = True
                once[at] = True
        bits = zlib.compress(np.packbits(twice).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

    return sketches.groupBy("block").applyInArrow(merge, "block int, bits binary")


#: The table a worker has unpacked last.
_OPEN: dict = {}


def _bitmap(shared, bits: int) -> np.ndarray:
    blocks = shared.value
    if _OPEN.get("of") is not blocks:
        table = np.zeros(1 << (bits - 3), np.uint8)
        size = 1 << (BLOCK_BITS - 3)
        for block, packed in blocks:
            table[block * size : (block + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
        _OPEN.update(of=blocks, table=table)
    return _OPEN["table"]


def _maybe_repeated(low: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(low), bool)
    for at in cells(low, bits):
        ok &= (table[at >> np.uint32(3)] >> (7 - (at & np.uint32(7))).astype(np.uint8)) & 1 == 1
    return ok


# --- the exact pass -----------------------------------------------------------


def _settled(low: np.ndarray, high: np.ndarray, ids: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which windows of a part also stand in a text of the part with a smaller id; ``row`` is the text of each."""
    order = np.lexsort((high, low))
    low, high, ordered = low[order], high[order], ids[row[order]]
    new = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(low)]
    starts = np.flatnonzero(new)
    late = np.empty(len(row), bool)
    if len(starts):
        late[order] = ordered > np.repeat(np.minimum.reduceat(ordered, starts), np.diff(np.append(starts, len(low))))
    return late


def _candidates(docs: DataFrame, shared, bits: int) -> DataFrame:
    """``(low, high, id, tag, at, late)``: each estimated-repeated window of a text once, at its first place.

    Windows that are settled within a part of ``SETTLED_BYTES`` come as one row for each text, with their places in ``late``;
    these rows are dealt by id.
    """

    def part(texts: list[bytes], ids: pa.Array, tags: pa.Array) -> pa.RecordBatch:
        table = _bitmap(shared, bits)
        lows, highs, places, rows = [], [], [], []
        for i, text in enumerate(texts):
            low, high = fingerprints(text)
            at = np.flatnonzero(_maybe_repeated(low, table, bits))
            at = at[np.sort(np.unique(low[at], return_index=True)[1])]
            lows.append(low[at])
            highs.append((high[at] >> np.uint64(32)).astype(np.uint32))
            places.append(at.astype(np.int32))
            rows.append(np.full(len(at), i, np.int32))
        low, high, at, row = map(np.concatenate, (lows, highs, places, rows))
        late = _settled(low, high, ids.to_numpy(zero_copy_only=False), row)
        open_, done = row[~late], row[late]
        whole, sizes = np.unique(done, return_counts=True)
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        take = pa.array(np.concatenate([open_, whole]))
        n = len(whole)
        arrays = [
            pa.array(np.concatenate([low[~late].view(np.int64), mix(whole.astype(np.uint64)).view(np.int64)])),
            pa.array(np.concatenate([(high[~late].astype(np.int64) - (1 << 31)).astype(np.int32), np.zeros(n, np.int32)])),
            ids.take(take),
            tags.take(take),
            pa.concat_arrays([pa.array(at[~late]), pa.nulls(n, pa.int32())]),
            pa.concat_arrays([pa.nulls(len(open_), pa.list_(pa.int32())), pa.ListArray.from_arrays(ends, at[late])]),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["low", "high", "id", "tag", "at", "late"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = 0
            for texts in _parts(b.column("text"), SETTLED_BYTES):
                ids, tags = (b.column(c).slice(start, len(texts)) for c in ("id", "tag"))
                yield part(texts, ids, tags)
                start += len(texts)

    schema = "low long, high int, id long, tag int, at int, late array<int>"
    return docs.select("id", "tag", "text").mapInArrow(run, schema)


def kept_words(text: bytes, places: np.ndarray, window: int = WINDOW) -> tuple[int, list[bytes]]:
    """Number of words and the words left when all windows equal to those at ``places`` are removed."""
    words = text.split()
    if not len(places):
        return len(words), words
    low, _ = fingerprints(text, window)
    starts = np.flatnonzero(np.isin(low, low[places]))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    gone = np.cumsum(edge)[: len(words)] > 0
    return len(words), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(column(key).alias("id"), F.hash(column(text)).alias("tag"), column(text).alias("text"))


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, tag, places)``: of each text that loses words, first places of the windows to remove.

    ``tag`` is a hash of the text, so that rows of one id with different texts stay apart.  Ids are long.  Runs
    jobs: the bytes of all texts, and the merged table.
    """
    spark = docs.sparkSession
    rows = _rows(docs, key, text).filter("id IS NOT NULL")
    bits = table_bits((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // WORD_BYTES)
    merged = stage(_merged(_sketch(rows, bits)), "windows")
    # At most 2 ** (MOST_BITS - 3) bytes before compression, whatever the input's size.
    shared = spark.sparkContext.broadcast([(r.block, bytes(r.bits)) for r in merged.collect()])
    found = _candidates(rows, shared, bits)
    # A window has at most a row from each part of texts (if ids are unique), so no group is large.
    first = F.min(F.when(F.col("late").isNull(), F.col("id"))).over(Window.partitionBy("low", "high"))
    late = found.withColumn("first", first).filter("late IS NOT NULL OR id > first")
    places = F.concat(F.collect_list("at"), F.flatten(F.collect_list("late")))
    return late.groupBy("id", "tag").agg(F.array_distinct(places).alias("places"))


def _with_places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, text, places)`` of each row; ``places`` is null where nothing is removed."""
    rows = _rows(docs, key, text)
    named = rows.filter("id IS NOT NULL").join(removals(docs, key, text), ["id", "tag"], "left")
    unnamed = rows.filter("id IS NULL").withColumn("places", F.lit(None).cast("array<int>"))
    return named.select("id", "text", "places").unionByName(unnamed.select("id", "text", "places"))


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` of each row; the digest is of the kept words joined by a space."""
    kind = docs.schema[key].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        n, left, digest = [], [], []
        for t, at in zip(_each(b.column("text")), b.column("places"), strict=True):
            total, words = kept_words(t, np.asarray(at.as_py() or [], np.int64))
            n.append(total)
            left.append(total - len(words))
            digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
        arrays = [b.column("id"), pa.array(n, pa.int64()), pa.array(left, pa.int64()), pa.array(digest, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_removed", "kept_sha256"])

    out = map_arrow(_with_places(docs, key, text), batch, f"id {kind}, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("id", key)
