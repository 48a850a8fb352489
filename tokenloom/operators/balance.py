"""Contiguous shares whose largest weight is the least possible."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.ordering import running_total
from tokenloom.staging import stage

#: Row ends brought to the driver at most; more are narrowed down by searches in Spark first.
MOST_ENDS = 1 << 20

Seek = Callable[[int], int]


@dataclass(frozen=True)
class Cuts:
    """Ends of the shares filled one after the other under a bound, and whether all rows found a place."""

    bound: int
    ends: tuple[int, ...]
    enough: bool


def fill(seek: Seek, total: int, shards: int, bound: int) -> Cuts:
    """Fill shares in order; ``seek(x)`` is the largest end of a row that is at most ``x``."""
    ends, at = [], 0
    for _ in range(shards):
        at = seek(at + bound)
        ends.append(at)
    return Cuts(bound, tuple(ends), at >= total)


def least_bound(placed: DataFrame, total: int, heaviest: int, shards: int, most: int = MOST_ENDS) -> Cuts:
    """The least bound under which ``shards`` shares hold everything, by bisection.

    ``placed`` has the ``end`` of each row.  The ends of the shares grow with the bound, so those of a bound too small and of one that is
    enough enclose all others between them; once few rows lie in between, only these come to the driver and the search ends there.
    """

    def seek_in_spark(x: int) -> int:
        return placed.filter(F.col("end") <= x).agg(F.max("end")).first()[0] or 0

    low = max(heaviest, -(-total // shards))
    high = max(low, total // shards + heaviest)  # a share within reach of its part of the total plus one row
    enough = fill(seek_in_spark, total, shards, high)
    least = fill(seek_in_spark, total, shards, low)
    if least.enough:
        return least
    while True:
        between = placed.filter(_any_of(list(zip(least.ends, enough.ends, strict=True)))).select("end").distinct()
        if between.count() <= most or high - low <= 1:
            break
        middle = fill(seek_in_spark, total, shards, (low + high) // 2)
        low, high = (low, middle.bound) if middle.enough else (middle.bound, high)
        least, enough = (least, middle) if middle.enough else (middle, enough)
    ends = np.unique(np.array([r.end for r in between.collect()] + [0, *least.ends, *enough.ends], np.int64)) if high - low > 1 else None
    while high - low > 1:
        bound = (low + high) // 2
        found = fill(lambda x: int(ends[np.searchsorted(ends, x, "right") - 1]), total, shards, bound)
        low, high = (low, bound) if found.enough else (bound, high)
        enough = found if found.enough else enough
    return enough


def _any_of(spans: Sequence[tuple[int, int]]):
    inside = F.lit(False)
    for a, b in spans:
        inside = inside | F.col("end").between(a, b)
    return inside


def shard_by_least_weight(df: DataFrame, order_by: Sequence[str], weight: str, shards: int, most: int = MOST_ENDS) -> DataFrame:
    """Add ``shard``: contiguous shares in order, the heaviest as light as it can be; earlier shares are filled first.

    Weights are whole numbers from 0 on; a null counts as 0.  Runs jobs: running totals (staged, keys and weights only) and a few searches.
    """
    light = df.select(*order_by, F.coalesce(F.col(weight).cast("long"), F.lit(0)).alias("w"))
    placed = running_total(light, order_by, "w", out="before")
    placed = stage(placed.select(*order_by, "w", (F.col("before") + F.col("w")).alias("end")), "ends")
    total, heaviest = placed.agg(F.max("end"), F.max("w")).first()
    ends = list(least_bound(placed, total, heaviest, shards, most).ends) if total else [0] * shards
    # A row belongs to the first share that ends at or after it.
    shard = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e < F.col("end")))
    return df.join(placed.select(*order_by, shard.alias("shard")), list(order_by))
