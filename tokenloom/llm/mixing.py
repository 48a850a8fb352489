"""Mix sources to target weights, exactly to the word.

Every row gets a hash-random key; the rows of a source in key order are its shuffled stream.  The
stream is cut into cells of equal key width (about ``CELL_ROWS`` rows each, so that a hot source
is many cells), each cell is sorted on its own, and prefix sums over the cells' totals give every
row the words before it in its source.  A source with budget B and S words gives every row
``B div S`` times, and once more the rows of the stream's first ``B mod S`` words; the one row on
which that border falls gives its first words only.

Edge cases: a null text has size 0 and gives nothing; null is a source of its own, last in code
point order; sources without words have target 0; if no source has words all targets are 0; repeated
rows share a key, so which of them stands first makes no difference; an empty table gives an empty
one; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import ROW, column, n_words, nested
from tokenloom.operators.lookup import lookup
from tokenloom.operators.ordering import div, running_total
from tokenloom.staging import stage

CELL_ROWS = 1_000
MOST_CELLS = 1 << 16
KEY_DIGITS = 11
KEY_BITS = 4 * KEY_DIGITS
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2


def _sized(docs: DataFrame, key: str, source: str, text: str, seed: int, row: Column) -> DataFrame:
    """``(row, src, id, size, place)``; ``src`` is never null and ``place`` is the hash-random key."""
    named = F.concat_ws("-", F.lit(str(seed)), F.coalesce(column(key).cast("string"), F.lit("")), F.md5(F.coalesce(column(text), F.lit(""))))
    place = F.conv(F.substring(F.md5(named), 1, KEY_DIGITS), 16, 10).cast("long")
    return docs.select(
        row,
        F.coalesce(F.concat(F.lit("s"), column(source)), F.lit("null")).alias("src"),
        column(key).alias("id"),
        n_words(column(text)).alias("size"),
        place.alias("place"),
    )


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS
) -> DataFrame:
    """Add ``target`` to ``(src, source_size, n)``: weighted shares of ``share`` times all words.

    A target above ``most`` times its source's size stops there and the excess is shared out again
    by weight, until none is above; each turn is one aggregate over the sources.
    """
    named = sources.withColumn("last", (F.col("src") == "null").cast("int"))
    ranked = running_total(named, ["last", "src"], out="rank").drop("last")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = stage(ranked.withColumn("w", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))), "sources")
    cap = F.col("source_size") * float(most)
    total = (weighted.agg(F.sum("source_size")).first()[0] or 0) * share
    level, before = 0.0, -1
    while True:
        full = F.col("w") * level > cap if level else F.lit(False)
        used, weight, n = weighted.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("w"))), F.count(F.when(full, 1))
        ).first()
        if n == before or not weight:
            break
        before, level = n, (total - (used or 0.0)) / weight
    return weighted.withColumn("target", F.least(cap, F.col("w") * level)).drop("w", "rank")


def allot(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    seed: int = 42,
    row: Column | None = None,
) -> DataFrame:
    """``(row, id, size, source_size, target, copies, part)`` of each row of ``docs``.

    ``copies`` whole texts and the first ``part`` words of one more.  ``row`` (default: all columns,
    as a struct) is what travels with the rows through the one shuffle.  Runs jobs: the sources'
    totals, their targets, and the cells' totals, from a staged table without texts.
    """
    light = _sized(docs, key, source, text, seed, F.lit(None).cast("int").alias(ROW)).drop(ROW)
    light = stage(light, "sizes")
    totals = light.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    budget = F.round("target").cast("long")
    cells = F.least(F.lit(MOST_CELLS), F.ceil(F.col("n") / CELL_ROWS)).cast("long")
    copies = F.when(F.col("source_size") > 0, div(budget, F.col("source_size"))).otherwise(F.lit(0))
    plan = targets(totals, weights, share).withColumns({"cells": cells, "copies": copies})
    plan = plan.withColumn("rest", budget - F.col("copies") * F.col("source_size")).drop("n")
    plan = stage(plan, "targets")
    cell = F.shiftright(F.col("place") * F.col("cells"), KEY_BITS).alias("cell")
    narrow = plan.select("src", "cells")
    sums = lookup(light.select("src", "place", "size"), narrow, "src").groupBy("src", cell).agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("src", "cell", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    rows = _sized(docs, key, source, text, seed, nested(docs) if row is None else row)
    rows = lookup(rows, plan, "src").withColumn("cell", cell)
    inside = Window.partitionBy("src", "cell").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(bases, ["src", "cell"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("base") - F.col("inside")))
    return placed.select(ROW, "id", "size", "source_size", "target", "copies", part.cast("long").alias("part"))


def shares(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``(key, size, source_size, target, taken)``: the words the mix takes of each row."""
    rows = allot(docs, key, row=F.lit(None).cast("int").alias(ROW), **options)
    taken = (F.col("copies") * F.col("size") + F.col("part")).cast("long")
    return rows.select(F.col("id").alias(key), "size", "source_size", "target", taken.alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, white space unchanged."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    blank = F.when(F.regexp_like(text, F.lit(r"^[\x20\x09-\x0D]")), 1).otherwise(0)
    return F.array_join(F.slice(pieces, F.lit(1), (n + blank).cast("int")), "")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", **options) -> DataFrame:
    """The mixed rows with all columns of ``docs``: repeated, dropped, or cut at the budget's border."""
    rows = allot(docs, key, text=text, **options)
    times = F.col("copies") + (F.col("part") > 0).cast("long")
    each = rows.filter((times > 0) & (F.col("size") > 0)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    old = F.col(ROW).getField(text)
    cut = (F.col("copy") > F.col("copies")) & (F.col("part") < F.col("size"))
    each = each.withColumn("new", F.when(cut, first_words(old, F.col("part"))).otherwise(old))
    renewed = {text: F.col("new")}
    if length in docs.columns:
        was = F.col(ROW).getField(length)
        renewed[length] = F.when(cut, F.length("new").cast(docs.schema[length].dataType)).otherwise(was)
    return each.select(*[renewed.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])
