"""Lookup of the many keys of wide rows with one table row for each distinct key of a block of rows.

A task numbers the distinct keys (tokens, ids) of a block, a run of its rows with about ``BLOCK_KEYS`` keys, and writes
the rows with these numbers.  Only the distinct keys of each block meet the table.  What they find travels to
the partition of the block, where the rows follow it and exchange numbers for values as Arrow arrays.
No key of a row is ever a row of its own, and nothing is sorted but whole rows by their block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.tokens import token_arrays
from tokenloom.staging import spread, stage

BLOCK, CODES, FIRST, KEYS, CODE, VALUE = "_block", "_codes", "_first", "_keys", "_code", "_value"
BLOCK_KEYS = 1 << 22
KEYS_IN_ROW = 1 << 13
# Values handed on at once.
SLICE = 1 << 20
# Rows handed on at once.
ROWS = 1 << 16


def numbered_tokens(specials: Sequence[str]) -> Callable[[list[pa.Array]], tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Numbers a block's tokens: ``(codes, sizes, distinct tokens)``, as many sizes as rows."""
    specials = tuple(specials)

    def number(arrays: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        tokens, sizes = token_arrays(pa.concat_arrays(arrays), specials)
        coded = tokens.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), sizes, coded.dictionary

    return number


def numbered_ids(arrays: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As :func:`numbered_tokens`, of lists of ids; a null id has the number -1, a null list has no ids."""
    sizes = np.concatenate([pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False) for a in arrays])
    coded = pa.concat_arrays([a.flatten() for a in arrays]).dictionary_encode()
    return pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False), sizes.astype(np.int64), coded.dictionary


def keys_of_texts(array: pa.Array) -> np.ndarray:
    """About how many tokens each text has."""
    return pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 6 + 1


def keys_of_lists(array: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def as_binary(codes: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of numbers as bytes.  (Spark measures a batch after each row, which takes a pass over all rows of a list column.)"""
    data = pa.py_buffer(np.ascontiguousarray(codes, np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), data])


def from_binary(array: pa.Array) -> np.ndarray:
    """The numbers of all lists of :func:`as_binary`."""
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int32, len(array) + 1, array.offset * 4)
    return np.frombuffer(data, np.int32, (ends[-1] - ends[0]) // 4, ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.int32)


def numbered(df: DataFrame, columns: Sequence[str], source: str, number: Callable, guess: Callable, kind: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Stage the rows with numbers for keys: ``(columns, block, codes)`` and ``(block, code, key)``."""
    staged = numbered_rows(df, columns, source, number, guess, kind)
    keys = staged.filter(F.col(KEYS).isNotNull()).select(BLOCK, FIRST, F.posexplode(KEYS).alias("pos", "key"))
    return (
        staged.filter(F.col(CODES).isNotNull()).select(*columns, BLOCK, CODES),
        keys.select(BLOCK, (F.col(FIRST) + F.col("pos")).alias(CODE), "key"),
    )


def each_key(name: str) -> Callable[[DataFrame], DataFrame]:
    """Turns :func:`numbered_rows` into one row for each key, with its number; rows with numbers stay one row, with a null key."""

    def spread(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in (FIRST, KEYS)]
        each = rows.select(*others, FIRST, F.posexplode_outer(KEYS).alias("pos", name))
        return each.select(*others, (F.col(FIRST) + F.col("pos")).alias(CODE), name)

    return spread


def numbered_rows(df: DataFrame, columns: Sequence[str], source: str, number: Callable, guess: Callable, kind: T.DataType) -> DataFrame:
    """Stage both kinds of rows as one table: rows with numbers for keys, and runs of a block's keys with the number of the first."""
    columns = list(columns)
    rows = spread(df.select(*columns, F.col(source).alias(VALUE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, weight = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ends, start = np.cumsum(guess(batch.column(VALUE))), 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_KEYS - weight, "right")))
                held.append(batch.slice(start, stop - start))
                weight += int(ends[stop - 1] - before)
                if weight >= BLOCK_KEYS or stop < batch.num_rows:
                    yield from emitted(held, block)
                    block, held, weight = block + 1, [], 0
                start = stop
        if held:
            yield from emitted(held, block)

    def emitted(held: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        codes, sizes, keys = number([b.column(VALUE) for b in held])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        names, at = [*columns, BLOCK, CODES, FIRST, KEYS], 0
        for b in held:
            n = b.num_rows
            inside = ends[at : at + n + 1]
            lists = as_binary(codes[inside[0] : inside[-1]], inside - inside[0])
            none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(keys.type))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(np.full(n, block)), lists, *none], names)
            at += n
        starts = np.arange(0, len(keys), KEYS_IN_ROW)
        offsets = pa.array(np.append(starts, len(keys)), pa.int32())
        n, blank = len(starts), held[0]
        nulls = [pa.nulls(n, blank.column(c).type) for c in columns]
        more = [pa.array(starts, pa.int32()), pa.ListArray.from_arrays(offsets, keys)]
        yield pa.RecordBatch.from_arrays([*nulls, pa.array(np.full(n, block)), pa.nulls(n, pa.binary()), *more], names)

    kinds = [T.StructField(c, rows.schema[c].dataType) for c in columns]
    more = [(BLOCK, T.LongType()), (CODES, T.BinaryType()), (FIRST, T.IntegerType()), (KEYS, T.ArrayType(kind))]
    schema = T.StructType([*kinds, *(T.StructField(*field) for field in more)])
    return stage(rows.mapInArrow(run, schema), "blocks")


def exchanged(rows: DataFrame, known: DataFrame, columns: Sequence[str], out: str, together: bool = False) -> DataFrame:
    """``(columns, out)``: the values of the rows' numbers as a list, or as one text of those that are not null if ``together``.

    ``known`` is ``(block, code, value)`` with every number of every block.
    """
    both = rows.unionByName(known, allowMissingColumns=True).repartition(BLOCK)
    return exchanged_in_place(both, columns, out, together)


def exchanged_in_place(both: DataFrame, columns: Sequence[str], out: str, together: bool = False) -> DataFrame:
    """As :func:`exchanged`, of one table of rows and ``(block, code, value)`` that has each block in one partition."""
    columns, value = list(columns), both.schema[VALUE].dataType

    def listed(rows: pa.RecordBatch, got: pa.Array, ends: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.fill_null(got, "") if together else got)
        result = pc.binary_join(lists, "") if together else lists
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), result], [*columns, out])

    kinds = T.StructType([T.StructField(c, both.schema[c].dataType) for c in columns])
    dealt = both.select(*columns, BLOCK, CODES, CODE, VALUE)
    return _exchange(dealt, listed, kinds.add(out, value if together else T.ArrayType(value)), SLICE)


def adjacent(rows: DataFrame, known: DataFrame, end: int | None = None) -> DataFrame:
    """``(prev, next, n)``: how often two values are next to each other in a row, ``end`` being one after every row.

    ``known`` is as for :func:`exchanged`, its values ids.  Counts are summed within about ``SLICE`` values; pairs may repeat.
    """

    def counted(rows: pa.RecordBatch, got: pa.Array, ends: np.ndarray) -> pa.RecordBatch:
        ids = got.to_numpy(zero_copy_only=False).astype(np.int64)
        inside = np.ones(max(len(ids) - 1, 0), bool)
        last = ends[1:][np.diff(ends) > 0] - 1  # of each row that has values
        inside[last[:-1]] = False
        pairs = (ids[:-1] << 32 | ids[1:])[inside]
        if end is not None:
            pairs = np.concatenate([pairs, ids[last] << 32 | end])
        both, n = counts_of(pairs)
        return pa.RecordBatch.from_arrays([pa.array((both >> 32).astype(np.int32)), pa.array(both.astype(np.int32)), pa.array(n)], ["prev", "next", "n"])

    both = rows.select(BLOCK, CODES).unionByName(known, allowMissingColumns=True)
    return _exchange(both.repartition(BLOCK), counted, "prev int, next int, n long", SLICE)


def counts_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers and how often each occurs, by sorting ``numbers`` in place, which takes a fraction of a hash table's memory."""
    numbers.sort()
    starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)])
    return numbers[starts], np.diff(np.append(starts, len(numbers)))


def _exchange(both: DataFrame, finish: Callable, schema: T.StructType | str, most: int) -> DataFrame:
    """``finish(rows, their values, ends of each row's)`` of about ``most`` values of a block at a time."""
    # One number to sort by: the rows of a block come after what is known of it.
    order = F.col(BLOCK) * 2 + F.col(CODES).isNotNull().cast("long")
    dealt = both.withColumn("_order", order).sortWithinPartitions("_order").drop("_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found, values = None, [], None
        for batch in batches:
            blocks = batch.column(BLOCK).to_numpy()
            wide = batch.column(CODES).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(wide.astype(np.int8)) != 0)) + 1
            for low, high in pairwise([0, *cuts.tolist(), len(blocks)]):
                part = batch.slice(low, high - low)
                if blocks[low] != block:
                    block, found, values = blocks[low], [], None
                if not wide[low]:
                    found.append((part.column(CODE), part.column(VALUE)))
                    continue
                if values is None:
                    values, found = in_order(found, part.column(VALUE).type), []
                yield from filled(part, values)

    def in_order(found: list, kind: pa.DataType) -> pa.Array:
        if not found:
            return pa.nulls(0, kind)
        _, at = np.unique(np.concatenate([c.to_numpy() for c, _ in found]), return_index=True)
        return pa.concat_arrays([v for _, v in found]).take(pa.array(at))

    def filled(part: pa.RecordBatch, values: pa.Array) -> Iterator[pa.RecordBatch]:
        ends, start = np.cumsum(pc.binary_length(part.column(CODES)).to_numpy(zero_copy_only=False).astype(np.int64) // 4), 0
        while start < part.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            rows = part.slice(start, stop - start)
            codes = from_binary(rows.column(CODES))
            got = values.take(pa.array(codes, pa.int32(), mask=codes < 0))
            done = finish(rows, got, np.concatenate([[0], ends[start:stop] - before]))
            for at in range(0, done.num_rows, ROWS):  # the JVM holds a batch beside its heap
                yield done.slice(at, ROWS)
            start = stop

    return dealt.mapInArrow(run, schema)


def keys_repeat(rows: DataFrame, columns: Sequence[str]) -> bool:
    """Whether two rows have one key (an action that reads the key columns)."""
    return not rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def merged(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """The lists of rows of one key as one list, by position and then value."""
    def placed(values: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(i.alias("pos"), v.alias("v")))

    lists = F.transform(F.collect_list(out), placed)
    return df.groupBy(*columns).agg(F.sort_array(F.flatten(lists))["v"].alias(out))
