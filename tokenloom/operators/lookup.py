"""Lookup of values by key that neither broadcasts blindly nor trips over hot keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.staging import stage

BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 48
HOT_SHARE = 2_000
FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def row_width(table: DataFrame) -> Column:
    """About how many bytes a row takes in a broadcast."""
    width: Column = F.lit(ROW_OVERHEAD)
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array") and kind[6:-1] in FIXED_WIDTH:
            width = width + 8 * F.greatest(F.size(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + 4 * F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
        else:
            width = width + 16
    return width


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``table`` (one column-wise aggregate) and say whether it may be broadcast."""
    return (table.agg(F.sum(row_width(table).cast("long"))).first()[0] or 0) <= limit


def lookup(df: DataFrame, table: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Left join ``df`` with ``table``, whose ``key`` is unique.

    A table measured to fit is broadcast (``small`` hands in an earlier measurement).  Beyond it, keys that hold
    more than 1/2000 of the rows of ``df`` - at most 2000 of them, by counting - are
    joined by broadcasting just their table rows; the others are shuffled, where no
    key can be heavy any more.
    """
    if fits_broadcast(table) if small is None else small:
        return df.join(F.broadcast(table), key, "left")
    return split_lookup(df, table, key)


def split_lookup(df: DataFrame, table: DataFrame, key: str, hot_share: int = HOT_SHARE) -> DataFrame:
    """The large-table path of :func:`lookup` (stages the key counts of ``df``).

    Should the table rows of the heavy keys not fit a broadcast, they are shuffled like the others and
    left to adaptive splitting of skewed joins.
    """
    counts = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter((F.col("n") * hot_share > total) & F.col(key).isNotNull()).select(key).collect()
    named = [r[key] for r in found]
    if named and not fits_broadcast(table.filter(F.col(key).isin(named))):
        return df.join(table, key, "left")
    is_hot = F.col(key).isNull() | F.col(key).isin(named)
    hot = df.filter(is_hot).join(F.broadcast(table.filter(F.col(key).isin(named))), key, "left")
    return hot.unionByName(df.filter(~is_hot).join(table, key, "left"))


def head_of(table: DataFrame, rank: str, limit: int) -> DataFrame | None:
    """The rows of lowest ``rank`` (a number from 0 on) that fit ``limit`` bytes; None if there are none.

    Measured by the mean width of the table's rows; what it returns may be broadcast.
    """
    total, rows = table.agg(F.sum(row_width(table).cast("long")), F.count(F.lit(1))).first()
    if not rows or limit < total // rows:
        return None
    head = table.filter(F.col(rank) < limit * rows // total)
    return head if fits_broadcast(head, limit) else None


def range_lookup(
    rows: DataFrame,
    spread: Callable[[DataFrame], DataFrame],
    table: DataFrame,
    key: str,
    value: str,
    by: str,
    deal: Callable[[DataFrame], DataFrame],
    head: DataFrame | None = None,
) -> DataFrame:
    """Look up the many keys of wide rows in a table too large for a broadcast, without shuffling the keys.

    ``by`` numbers the range of a row, ``deal`` partitions rows by it, and ``spread`` turns rows into one row for
    each of their keys (and leaves one, with a null key, of a row that has none).  Only the distinct (range, key)
    pairs meet the ``table`` of ``key`` and ``value``; what they find travels to the range as rows
    beside the data, and every key is looked up where it is.  Keys in ``head`` (a part of the table, to be
    broadcast) take no part in that.
    """
    found, keys = f"{value}_found", f"{key}_found"
    pairs = spread(rows).select(by, key).filter(F.col(key).isNotNull())
    if head is not None:
        pairs = pairs.join(F.broadcast(head.select(key)), key, "left_anti")
    known = pairs.distinct().join(table.select(key, value), key)
    known = known.select(by, F.col(key).alias(keys), F.col(value).alias(found))
    both = deal(rows.unionByName(known, allowMissingColumns=True))
    each = spread(both).withColumn(key, F.coalesce(key, keys))
    # The hash comes first, because the sort tells most rows apart by a number in its first column.
    within = Window.partitionBy(F.xxhash64(by, key), by, key)
    named = each.withColumn(value, F.max(found).over(within)).filter(F.col(keys).isNull()).drop(keys, found)
    if head is None:
        return named
    common = head.select(key, F.col(value).alias(found))
    return named.join(F.broadcast(common), key, "left").withColumn(value, F.coalesce(value, found)).drop(found)
