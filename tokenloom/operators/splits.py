"""Seeded shuffles, hold-outs and samples.

A split is a comparison of each row's own key with one cut key, so neither side
of it is joined or shuffled.  Finding the cut is one bounded action.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.hashing import KEY_DIGITS, shuffle_key
from tokenloom.functions.permute import Permutation
from tokenloom.operators.batches import with_ordinal
from tokenloom.staging import stage

SHUFFLE_KEY = "shuffle_key"
CELL_BITS = 12


def with_shuffle_key(df: DataFrame, key: str, seed: int, epoch: int | None = None) -> DataFrame:
    return df.withColumn(SHUFFLE_KEY, shuffle_key(key, seed, epoch))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in seeded random order."""
    return with_shuffle_key(df, key, seed).orderBy(SHUFFLE_KEY, key)


def epoch_order(df: DataFrame, key: str, seed: int, epochs: int) -> DataFrame:
    """Every row once per epoch, with that epoch's shuffle key."""
    numbered = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return numbered.withColumn(SHUFFLE_KEY, shuffle_key(key, seed, F.col("epoch")))


def epoch_places(df: DataFrame, order_by: Sequence[str], seed: int, epochs: int) -> DataFrame:
    """Every row once per epoch with its ``ordinal`` in the order and its ``place`` (both from 0) in that epoch.

    Places are a formula of ordinals (see :class:`~tokenloom.functions.permute.Permutation`), so epochs cost no sort each.
    """
    placed = stage(with_ordinal(df, order_by), "ordinals")
    n = placed.count()
    each = [
        placed.withColumns({"epoch": F.lit(e), "place": Permutation(n, seed, e).place(F.col("ordinal"))}) for e in range(epochs)
    ]
    return reduce(DataFrame.unionByName, each)


def rows_at_places(placed: DataFrame, n: int, seed: int, epoch: int, start: int, end: int) -> DataFrame:
    """The rows of places ``start`` to ``end - 1`` of an epoch, with their ``place``.

    ``placed`` has the ``ordinal`` of its ``n`` rows, for instance as stored.  The ordinals are found by the inverse formula from
    the places alone, so resuming inside an epoch orders nothing; the few that are wanted meet the rows by a join.
    """
    places = placed.sparkSession.range(max(0, start), max(0, start, min(end, n))).withColumnRenamed("id", "place")
    wanted = places.withColumn("ordinal", Permutation(n, seed, epoch).position(F.col("place")))
    return placed.join(wanted, "ordinal")


def assign_split(df: DataFrame, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """Add ``split``: the last ``n`` rows of the shuffled order are 'eval', the rest 'train'.

    With ``n`` at or above the row count everything is 'eval'.
    """
    keyed = with_shuffle_key(df, key, seed)
    cut = _cut(keyed, key, n, last=True)
    if cut is None:
        return keyed.withColumn("split", F.lit("eval"))
    in_eval = F.struct(SHUFFLE_KEY, key) >= _literal(keyed, key, cut)
    return keyed.withColumn("split", F.when(in_eval, "eval").otherwise("train"))


def holdout(
    df: DataFrame, key: str, n: int = 1000, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``(train, eval)`` of :func:`assign_split`."""
    both = assign_split(df, key, n, seed)
    train, held = (both.filter(F.col("split") == s).drop("split") for s in ("train", "eval"))
    return train, held


def sample_n(df: DataFrame, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of the shuffled order."""
    keyed = with_shuffle_key(df, key, seed)
    cut = _cut(keyed, key, n, last=False)
    if cut is None:
        return keyed
    return keyed.filter(F.struct(SHUFFLE_KEY, key) <= _literal(keyed, key, cut))


def _literal(keyed: DataFrame, key: str, cut: tuple) -> Column:
    kinds = dict(keyed.dtypes)
    return F.struct(*[F.lit(v).cast(kinds[c]) for c, v in zip((SHUFFLE_KEY, key), cut, strict=True)])


def _cut(keyed: DataFrame, key: str, n: int, last: bool) -> tuple | None:
    """The ``n``-th key from one end, or None if there are no more than ``n`` rows.

    Keys are uniform: rows are counted in ``2 ** CELL_BITS`` ranges of equal width, and only the range
    that holds the cut is ranked - one row in ``2 ** CELL_BITS``, whatever ``n`` is.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = keyed.select(SHUFFLE_KEY, key)
    cell = F.shiftright(SHUFFLE_KEY, 4 * KEY_DIGITS - CELL_BITS)
    counts = {r.cell: r.n for r in keys.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if n >= sum(counts.values()):
        return None
    left = n
    for at in sorted(counts, reverse=last):
        if counts[at] >= left:
            break
        left -= counts[at]
    order = [F.desc(SHUFFLE_KEY), F.desc(key)] if last else [F.asc(SHUFFLE_KEY), F.asc(key)]
    edge = F.min if last else F.max
    found = keys.filter(cell == at).orderBy(*order).limit(left).agg(edge(F.struct(SHUFFLE_KEY, key)).alias("cut"))
    return tuple(found.first()["cut"])
