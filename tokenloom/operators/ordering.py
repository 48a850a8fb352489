"""Positions in a global order without sorting the data into one partition.

Rows have no position in a DataFrame, yet packing, batching and ranking depend
on it.  The order key space is cut into ranges ("buckets") of about equal
weight; each bucket is sorted on its own and a table with one row per bucket
carries the running base.  The cut points are literals computed from a bounded
sample, so the bucket of a row is a pure function of the row: a task that is run
again after an executor loss puts it in the same place.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, KEY = "bucket", "_order_key"
SAMPLES_PER_BUCKET = 24
SMALLEST_BUCKET = 50_000
LARGEST_BUCKET = 1 << 26
MOST_BUCKETS = 100_000
TREE = 1_000


@dataclass(frozen=True)
class KeyRanges:
    """Cut points of an ascending, unique, non-null order key.

    Cut points are kept as :func:`comparable` makes them, ``kinds`` are the types of the
    order columns, and ``total`` is the weight of all rows the cut points were chosen for.
    """

    order_by: tuple[str, ...]
    kinds: tuple[T.DataType, ...]
    bounds: tuple[tuple, ...]
    total: int

    @property
    def buckets(self) -> int:
        return len(self.bounds) + 1

    def with_bounds(self, bounds: Sequence[tuple]) -> KeyRanges:
        return replace(self, bounds=tuple(bounds))

    def key(self) -> Column:
        """What cut points are compared with: one column, or a struct of several."""
        columns = self.columns()
        return columns[0] if len(columns) == 1 else F.struct(*columns)

    def columns(self) -> list[Column]:
        return [comparable(c, kind).alias(c) for c, kind in zip(self.order_by, self.kinds, strict=True)]

    def column(self) -> Column:
        """Bucket number of a row: how many cut points are <= its key.

        The first column is compared along a tree of plain numbers.  Only rows that equal a cut point in it, or all
        where it is no plain number, are compared with whole keys.
        """
        if not self.bounds:
            return F.lit(0)
        first = sorted({b[0] for b in self.bounds})
        if len(first) > TREE or not isinstance(self.kinds[0], _PLAIN):
            return self._searched()
        c, kind, heads = self.columns()[0], _comparable_type(self.kinds[0]), sorted(b[0] for b in self.bounds)

        def tree(low: int, high: int) -> Column:
            """For a first column between the cut points ``low - 1`` and ``high`` (those excluded); -1 if it equals one."""
            if low == high:
                return F.lit(bisect_left(heads, first[low]) if low < len(first) else len(heads))
            mid = (low + high) // 2
            at = F.lit(first[mid]).cast(kind)
            return F.when(c < at, tree(low, mid)).when(c > at, tree(mid + 1, high)).otherwise(-1)

        found = tree(0, len(first))
        return F.when(c.isNotNull() & (found >= 0), found).otherwise(self._searched())

    def _searched(self) -> Column:
        """The cut points are searched in two levels, so a row costs about ``2 * sqrt(buckets)`` comparisons."""
        block = math.isqrt(len(self.bounds)) + 1
        key = self.key()
        every = self.literal(self.bounds)
        heads = self.literal(self.bounds[block - 1 :: block])
        full_blocks = F.size(F.filter(heads, lambda b: b <= key))
        rest = F.slice(every, full_blocks * block + 1, F.lit(block))
        return full_blocks * block + F.size(F.filter(rest, lambda b: b <= key))

    def place(self, df: DataFrame) -> DataFrame:
        """Add the bucket column, as :meth:`column` gives it, by about ``log2(buckets)`` comparisons of whole keys a row.

        Each halving is a projection of its own: one expression of them all would compute each step twice for the next.
        """
        if not self.bounds:
            return df.withColumn(BUCKET, F.lit(0))
        # A struct even of one column, so that a null has a place in the order.
        key, every = F.struct(*self.columns()), self._structs(self.bounds)
        placed, step = df.withColumns({KEY: key, BUCKET: F.lit(0)}), 1 << (len(self.bounds).bit_length() - 1)
        while step:
            reached = F.get(every, F.col(BUCKET) + (step - 1)) <= F.col(KEY)
            placed = placed.withColumn(BUCKET, F.col(BUCKET) + F.when(reached, step).otherwise(0))
            step //= 2
        return placed.drop(KEY)

    def partition(self, df: DataFrame) -> DataFrame:
        """Add the bucket column and give each bucket a partition of its own (one shuffle)."""
        return self.place(df).repartitionById(self.buckets, F.col(BUCKET))

    def bases(self, df: DataFrame, weight: str | None = None) -> DataFrame:
        """``(bucket, base)``: the weight before each bucket.

        At most ``self.buckets`` rows whatever the size of ``df``; the window over
        them is the only unpartitioned one.
        """
        before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        return (
            self.place(df.select(*self.order_by, _weight(weight).alias("w")))
            .groupBy(BUCKET)
            .agg(F.sum("w").alias("total"))
            .select(BUCKET, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
        )

    def literal(self, bounds: Sequence[tuple]) -> Column:
        """Keys as a literal array, parsed once when the query is planned."""
        if len(self.order_by) > 1:
            return self._structs(bounds)
        return _parsed([b[0] for b in bounds], _comparable_type(self.kinds[0]))

    def _structs(self, bounds: Sequence[tuple]) -> Column:
        names = [f"k{i}" for i in range(len(self.order_by))]
        kinds = [_comparable_type(k) for k in self.kinds]
        keys = [dict(zip(names, b, strict=True)) for b in bounds]
        return _parsed(keys, "struct<" + ",".join(f"{n}:{k}" for n, k in zip(names, kinds, strict=True)) + ">")


# Types whose comparison is one of Java numbers (floats are left out, for NaN).
_PLAIN = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)
_AS_THEY_ARE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.DecimalType,
)


def comparable(name: str, kind: T.DataType) -> Column:
    """An order column as a number or string in the same order, which can be written as a literal.

    Types without such a form are refused, whatever the size of the table.
    """
    c = F.col(name)
    if isinstance(kind, _AS_THEY_ARE):
        return c
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    raise TypeError(f"cannot order by {name}: {kind.simpleString()} has no order that can be written down")


def _parsed(values: list, kind: str) -> Column:
    # A decimal is written as a string, which is parsed without loss.
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False, default=str)), f"array<{kind}>")


def _comparable_type(kind: T.DataType) -> str:
    if isinstance(kind, _AS_THEY_ARE):
        return kind.simpleString()
    return "int" if isinstance(kind, (T.BooleanType, T.DateType)) else "bigint"


def key_ranges(
    df: DataFrame, order_by: Sequence[str], weight: str | None = None, buckets: int | None = None
) -> KeyRanges:
    """Choose cut points so that buckets carry about equal weight.

    Runs two actions that read only the key and weight columns, so a costly input should be
    staged first: the total, and a sample with about ``SAMPLES_PER_BUCKET`` rows per bucket, drawn with
    probability proportional to weight.  The sample steers balance only; any cut
    points give the same positions.
    """
    order_by = tuple(order_by)
    keys = df.select(*order_by, _weight(weight).alias("w"))
    kinds = tuple(keys.schema[c].dataType for c in order_by)
    ranges = KeyRanges(order_by, kinds, (), 0)
    columns = ranges.columns()
    total = keys.agg(F.sum("w")).first()[0] or 0
    if buckets is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(partitions, total // LARGEST_BUCKET)
        buckets = min(wanted, total // SMALLEST_BUCKET + 1, MOST_BUCKETS)
    if buckets <= 1 or total == 0:
        return replace(ranges, total=total)
    share = F.col("w") * (buckets * SAMPLES_PER_BUCKET / total)
    sample = (
        keys.withColumn("share", share)
        .filter(F.rand(17) < F.col("share"))
        .select(F.struct(*columns).alias("key"), F.greatest(F.lit(1.0), "share").alias("share"))
        .orderBy("key")
        .collect()
    )
    bounds = _cut([(tuple(r.key), r.share) for r in sample], buckets)
    return replace(ranges, bounds=bounds, total=total)


def _cut(sample: list[tuple[tuple, float]], buckets: int) -> tuple[tuple, ...]:
    """Cut points of a sample in key order."""
    step = sum(share for _, share in sample) / buckets
    bounds: list[tuple] = []
    reached = 0.0
    for key, share in sample:
        if reached >= step * (len(bounds) + 1) and len(bounds) < buckets - 1:
            bounds.append(key)
        reached += share
    return tuple(dict.fromkeys(bounds))


def _weight(weight: str | None) -> Column:
    return (F.lit(1) if weight is None else F.col(weight)).cast("long")


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    weight: str | None = None,
    out: str = "start",
    sizes: DataFrame | None = None,
    ranges: KeyRanges | None = None,
) -> DataFrame:
    """Add the total weight of all earlier rows (without ``weight``: the row's ordinal from 0).

    ``sizes`` may give the key and weight columns from a cheaper plan than ``df``;
    otherwise ``df`` itself is read for them, about three times: stage it if it is costly.
    Running :func:`key_ranges` makes this eager.
    """
    light = df if sizes is None else sizes
    ranges = ranges or key_ranges(light, order_by, weight)
    before = Window.partitionBy(BUCKET).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(_weight(weight)).over(before), F.lit(0))
    return (
        ranges.partition(df)
        .withColumn("inside", inside)
        .join(F.broadcast(ranges.bases(light, weight)), BUCKET)
        .withColumn(out, F.col("base") + F.col("inside"))
        .drop(BUCKET, "inside", "base")
    )


def div(a: Column, b: Column | int) -> Column:
    """Integer division of longs."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b).cast("long")
