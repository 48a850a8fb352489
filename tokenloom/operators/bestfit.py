"""Packing that keeps samples whole: best fit, longest samples first.

Where a sample goes depends on its length alone and on how many samples of each length there are.  So the plan is made from the
histogram of lengths, at most one number for each length up to the sequence's, and gives the samples of a length their bins by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.sequences import pad, truncate
from tokenloom.operators.ordering import running_total
from tokenloom.staging import stage

#: ``(n, low, high, each, bin)``: samples of length ``n`` with rank ``low`` to ``high - 1`` go ``each`` to a bin, from ``bin`` on.
PLAN_SCHEMA = "n INT, low LONG, high LONG, each LONG, bin LONG"


def best_fit_plan(histogram: Mapping[int, int], length: int) -> list[tuple[int, int, int, int, int]]:
    """Each sample into the fullest bin that has room for it (the one opened first among equals), or into a new one.

    Bins with the same room are kept as runs of bin numbers, so that the work depends on the lengths and not on the number of samples.
    """
    room: dict[int, list[list[int]]] = {}  # by what is left: a heap of [first bin, bins]
    plan, opened = [], 0
    for n in sorted((n for n in histogram if n > 0), reverse=True):
        if n > length:
            raise ValueError(f"a sample of {n} does not fit {length}")
        rank, left = 0, histogram[n]
        while left:
            fits = min((r for r, runs in room.items() if r >= n and runs), default=None)
            if fits is None:
                bins = -(-left // (length // n))
                first, fits = opened, length
                opened += bins
            else:
                first, bins = heapq.heappop(room[fits])
            # A bin that takes one is the fullest with room after it, so it takes as many as fit.
            each = fits // n
            full = min(bins, left // each)
            if full:
                plan.append((n, rank, rank + full * each, each, first))
                heapq.heappush(room.setdefault(fits - each * n, []), [first, full])
                rank, left, first, bins = rank + full * each, left - full * each, first + full, bins - full
            if left and bins:
                plan.append((n, rank, rank + left, left, first))
                heapq.heappush(room.setdefault(fits - left * n, []), [first, 1])
                first, bins, left = first + 1, bins - 1, 0
            if bins:
                heapq.heappush(room.setdefault(fits, []), [first, bins])
    return plan


def assign_bins(sizes: DataFrame, key: str, length: int) -> DataFrame:
    """``(key, n, bin, place)`` of the samples of ``(key, n)`` that are not empty; longer ones count as ``length``.

    ``place`` orders the samples of a bin, longest first.  Samples of one length take their bins in the order of the key.
    """
    sizes = stage(sizes.select(key, F.least("n", F.lit(length)).cast("int").alias("n")).filter("n > 0"), "sizes")
    counts = {r.n: r.c for r in sizes.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}  # at most ``length`` rows
    spark = sizes.sparkSession
    plan = spark.createDataFrame(best_fit_plan(counts, length), PLAN_SCHEMA)
    firsts, before = [], 0
    for n in sorted(counts, reverse=True):
        firsts.append((n, before))
        before += counts[n]
    starts = spark.createDataFrame(firsts, "n INT, first LONG")
    # The longest first: a common length is spread over many ranges of the key.
    ranked = running_total(sizes.withColumn("shorter", -F.col("n")), ["shorter", key], out="ordinal").drop("shorter")
    ranked = ranked.join(F.broadcast(starts), "n").withColumn("rank", F.col("ordinal") - F.col("first"))
    # A few rows for each length: both tables are bounded by the sequence length.
    placed = ranked.join(F.broadcast(plan), "n").filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    slot = F.call_function("div", F.col("rank") - F.col("low"), F.col("each"))
    return placed.select(key, "n", (F.col("bin") + slot).alias("bin"), F.col("ordinal").alias("place"))


def pack_best_fit(df: DataFrame, key: str, length: int, pad_id: int, ids: str = "input_ids") -> DataFrame:
    """``(seq_id, input_ids, lengths, keys, real)``: whole samples laid end to end and filled up to ``length``.

    ``lengths`` and ``keys`` name the samples in a sequence in order, so that attention may be kept within one.  Samples longer than
    ``length`` are cut to it; empty ones are left out.
    """
    bins = assign_bins(df.select(key, F.size(ids).alias("n")), key, length)
    rows = df.select(key, truncate(ids, length).alias("ids")).join(bins, key)
    parts = F.sort_array(F.collect_list(F.struct("place", F.col(key).alias("key"), "n", "ids"))).alias("parts")
    made = rows.groupBy(F.col("bin").alias("seq_id")).agg(parts)  # at most ``length`` samples
    whole = F.flatten("parts.ids")
    return made.select(
        "seq_id", pad(whole, length, pad_id).alias("input_ids"), F.col("parts.n").alias("lengths"),
        F.col("parts.key").alias("keys"), F.size(whole).alias("real"),
    )


def bin_report(bins: DataFrame, length: int) -> DataFrame:
    """One row ``(sequences, tokens, pad_tokens, pad_percent)`` of assigned bins."""
    totals = bins.agg(F.coalesce(F.max("bin") + 1, F.lit(0)).alias("sequences"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))
    wide = F.col("sequences") * length
    return totals.withColumn("pad_tokens", wide - F.col("tokens")).withColumn("pad_percent", F.try_divide(F.col("pad_tokens") * 100.0, wide))
