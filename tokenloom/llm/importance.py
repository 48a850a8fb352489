"""Quality by importance resampling: keep the documents most like the good ones.

Words and word pairs are hashed into ``BUCKETS`` buckets.  One pass over all documents counts the buckets
of the labelled good documents (the target) and of all documents (the raw text).  A document's log weight is
the sum of ``log p_target - log p_raw`` over its words and pairs; the weight plus Gumbel noise, seeded by the row, is its key,
and the rows with the largest keys are the sample without replacement.  The size of the sample is a share of all rows:
that of good documents among the labelled ones, unless it is given.

The border key is found by counting key ranges, at most ``BINS`` counts a job; no keys are collected or sorted.

Edge cases: a null or empty text has no words, weight null, and is never selected; documents with
several labels are good if any label says so, null labels and ids are no labels; without good labels
all weights are 0; equal rows have equal keys and are selected together, so copies of the last row
may exceed the size; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.hashing import unit_hash
from tokenloom.llm.common import WordIds, byte_parts, column, map_arrow, mix, odd_numbers
from tokenloom.operators.lookup import lookup
from tokenloom.staging import stage

BUCKETS = 10_000
BINS = 4_096
#: Keys are compared in steps of 2 ** -KEY_BITS.
KEY_BITS = 20

_WORDS = WordIds()
_PAIR = odd_numbers(2, 17)


def grams(text: bytes) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbouring words."""
    words = text.split()
    ids = _WORDS.of(words)
    h = _WORDS.low[ids]
    pairs = mix(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])
    return (np.concatenate([mix(h), pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def _each(texts: pa.Array) -> Iterator[bytes]:
    for part in byte_parts(texts):
        _WORDS.trim()
        yield from part


def good_ids(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """``(id, good)`` of the labelled documents; ``good`` is 0 or 1."""
    rows = labels.select(column(key).alias("id"), (column(label) == 1).cast("int").alias("good"))
    return rows.filter("id IS NOT NULL AND good IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"))


def models(docs: DataFrame, good: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratio of target to raw probability of each bucket, add-one smoothed."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for t, target in zip(_each(b.column("text")), b.column("good").to_pylist(), strict=True):
                n = np.bincount(grams(t), minlength=BUCKETS)
                counts[1] += n
                if target:
                    counts[0] += n
        at = np.flatnonzero(counts[1])
        arrays = [pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "target", "raw"])

    rows = docs.select(column(key).alias("id"), column(text).alias("text"))
    flagged = lookup(rows, good.filter("good = 1"), "id").select("text", "good")
    sums = flagged.mapInArrow(run, "bucket long, target long, raw long").groupBy("bucket")
    both = np.zeros((2, BUCKETS))
    for r in sums.agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect():  # at most BUCKETS rows
        both[:, r.bucket] = r.target, r.raw
    if not both[0].any():
        return np.zeros(BUCKETS)
    p = (both + 1) / (both.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(p[0]) - np.log(p[1])


def weights(docs: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, tag, n_grams, log_weight)`` of each row; ``tag`` is a hash of the text."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sizes, sums = [], []
        for t in _each(b.column("text")):
            g = grams(t)
            sizes.append(len(g))
            sums.append(float(shared.value[g].sum()) if len(g) else None)
        arrays = [b.column("id"), b.column("tag"), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, ["id", "tag", "n_grams", "log_weight"])

    rows = docs.select(column(key).alias("id"), F.xxhash64(column(text)).alias("tag"), column(text).alias("text"))
    return map_arrow(rows, batch, f"id {kind}, tag long, n_grams long, log_weight double")


def border(rows: DataFrame, n: int) -> tuple[int, int] | None:
    """The ``n``-th largest ``(k, tie)`` of two long columns (null if there are fewer rows), by counting ranges."""
    if n <= 0:
        return (1 << 63) - 1, (1 << 63) - 1
    found: list[int] = []
    for name in ("k", "tie"):
        low, high, total = rows.agg(F.min(name), F.max(name), F.count(F.lit(1))).first()
        if total is None or total < n or low is None:
            return None
        while low < high:
            width = -(-(high - low + 1) // BINS)
            # Decimals, as the difference of two longs may not fit a long.
            above = F.col(name).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
            bin_ = F.call_function("div", above, F.lit(width).cast("decimal(20,0)"))
            inside = rows.filter(F.col(name).between(low, high))
            counts = inside.groupBy(bin_.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
            for r in sorted(counts, key=lambda r: -r.bin):
                if r.n >= n:
                    low, high = low + r.bin * width, min(high, low + (r.bin + 1) * width - 1)
                    break
                n -= r.n
        found.append(low)
        rows = rows.filter(F.col(name) == low)
    return found[0], found[1]


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    seed: int = 42,
) -> DataFrame:
    """``(key, n_grams, log_weight, sample_key, selected)`` of each row."""
    good = stage(good_ids(labels, key, label), "labels")
    if share is None:
        share = good.agg(F.avg("good")).first()[0] or 0.0
    scored = weights(docs, models(docs, good, key, text), key, text)
    gumbel = -F.log(-F.log(unit_hash(F.lit(seed), F.col("id"), F.col("tag"))))
    scored = scored.withColumn("k", F.round((F.col("log_weight") + gumbel) * (1 << KEY_BITS)).cast("long"))
    scored = stage(scored.withColumn("tie", F.xxhash64(F.lit(seed + 1), "id", "tag")), "keys")
    total = scored.count()
    last = border(scored.filter("k IS NOT NULL").select("k", "tie"), round(share * total))
    if last is None:
        chosen = F.col("k").isNotNull()
    else:
        chosen = (F.col("k") > last[0]) | ((F.col("k") == last[0]) & (F.col("tie") >= last[1]))
    return scored.select(
        F.col("id").alias(key),
        "n_grams",
        "log_weight",
        (F.col("k") / (1 << KEY_BITS)).alias("sample_key"),
        F.coalesce(chosen, F.lit(False)).alias("selected"),
    )
