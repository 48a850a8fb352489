"""Packing of token sequences into fixed-length ones.

All packers cut one long stream (the sequences laid end to end in key order) into
chunks.  A light pass over keys and lengths finds where each key range starts in
the stream.  Then the data is shuffled once: a row goes to its own range, and the
few rows at the head of a range also to the range before, which needs them to
finish its last chunks.  After that every chunk is put together where its first
token is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.sequences import pad
from tokenloom.operators.ordering import BUCKET, KeyRanges, div, key_ranges, running_total


@dataclass(frozen=True)
class StreamLayout:
    """Key ranges with the stream offset at which each starts.

    ``heads`` holds, per range, the last key the range before needs as well.
    """

    ranges: KeyRanges
    starts: tuple[int, ...]
    heads: tuple[tuple, ...]

    def partition(self, df: DataFrame) -> DataFrame:
        """Rows by key range, head rows twice (one shuffle)."""
        return self.deal(self.place(df))

    def place(self, df: DataFrame) -> DataFrame:
        """Rows with their key range, head rows twice."""
        placed = self.ranges.place(df)
        if self.ranges.buckets > 1:
            head = F.get(self.ranges.literal(self.heads), F.col(BUCKET))
            shared = (F.col(BUCKET) > 0) & (self.ranges.key() <= head)
            homes = F.when(shared, F.array(F.col(BUCKET), F.col(BUCKET) - 1)).otherwise(F.array(BUCKET))
            placed = placed.withColumn(BUCKET, F.explode(homes))
        return placed

    def deal(self, placed: DataFrame) -> DataFrame:
        """Each key range in a partition of its own (one shuffle)."""
        return placed.repartitionById(self.ranges.buckets, F.col(BUCKET))

    def start(self) -> Column:
        """Offset of the first token of a row's range."""
        return F.get(_longs(self.starts), F.col(BUCKET))

    def end(self) -> Column:
        """Offset after its last token (open for the last range)."""
        return F.get(_longs([*self.starts[1:], 2**62]), F.col(BUCKET))


def stream_layout(
    sizes: DataFrame, order_by: Sequence[str], chunk: int, buckets: int | None = None
) -> StreamLayout:
    """Lay out a stream from ``sizes`` (order columns and the length ``n`` of each sequence).

    Collects one row per key range.  Ranges shorter than a chunk are joined to the
    next, so a chunk never reaches further than one range.
    """
    sizes = sizes.filter("n > 0")
    ranges = key_ranges(sizes, order_by, "n", buckets)
    before = Window.partitionBy(BUCKET).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0))
    measured = (
        ranges.partition(sizes)
        .withColumn("inside", inside)
        .groupBy(BUCKET)
        .agg(
            F.sum("n").alias("total"),
            F.max(F.when(F.col("inside") < max(chunk - 1, 1), F.struct(*ranges.columns()))).alias("head"),
        )
        .orderBy(BUCKET)
        .collect()
    )
    starts, heads, first, offset, closed = [], [], [], 0, True
    for row in measured:
        if closed:
            starts.append(offset)
            heads.append(())
            first.append(row[BUCKET])
        heads[-1] = tuple(row["head"])
        offset += row["total"]
        closed = offset - starts[-1] >= chunk - 1
    bounds = tuple(ranges.bounds[b - 1] for b in first[1:])
    return StreamLayout(ranges.with_bounds(bounds), tuple(starts or [0]), tuple(heads))


def chunk_stream(
    df: DataFrame,
    order_by: Sequence[str],
    chunk: int,
    stride: int,
    ids: str = "input_ids",
    sizes: DataFrame | None = None,
    encoder: Callable[[DataFrame, Callable], DataFrame] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``(seq_id, tokens)``: every chunk of the stream, the last ones possibly short.

    Chunk ``k`` covers offsets ``[k*stride, k*stride + chunk)``.  ``sizes`` may name a
    cheaper plan with the order columns and ``n``, the length of each sequence.  With
    ``encoder``, ``df`` need not have the ids yet: ``encoder`` is given the rows with their bucket and the function
    that partitions by it; it returns partitioned rows with ``ids``, the order columns and the bucket.
    """
    if sizes is None:
        sizes = df.select(*order_by, F.size(ids).alias("n"))
    layout = stream_layout(sizes, order_by, chunk, buckets)
    if encoder is None:
        rows = layout.partition(df.select(*order_by, F.col(ids).alias("ids")))
    else:
        rows = encoder(layout.place(df), layout.deal)
    before = Window.partitionBy(BUCKET).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("n", F.size("ids").cast("long"))
        .filter("n > 0")
        .withColumn("start", layout.start() + F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    first = F.greatest(F.col("start") - chunk, layout.start() - 1, F.lit(-stride)) + stride
    last = F.least(F.col("start") + F.col("n"), layout.end()) - 1
    chunks = _assemble(placed, div(first, stride), div(last, stride), chunk, stride, [BUCKET])
    return chunks.select(F.col("k").alias("seq_id"), "tokens")


def _assemble(
    placed: DataFrame, first: Column, last: Column, chunk: int, stride: int, group: Sequence[str]
) -> DataFrame:
    """``(group, k, tokens)``: each row hands chunks ``first`` to ``last`` its slice of ``ids``."""
    reach = placed.select(*group, "start", "n", "ids", first.alias("first"), last.alias("last"))
    spread = reach.filter("first <= last").select(
        *group, "start", "n", "ids", F.explode(F.sequence("first", "last")).alias("k")
    )
    low = F.greatest(F.col("start"), F.col("k") * stride)
    high = F.least(F.col("start") + F.col("n"), F.col("k") * stride + chunk)
    piece = F.slice("ids", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    slices = spread.select(*group, "k", low.alias("low"), piece.alias("piece"))
    parts = F.sort_array(F.collect_list(F.struct("low", "piece")))
    return slices.groupBy(*group, "k").agg(F.flatten(parts["piece"]).alias("tokens"))


def _shifted(chunks: DataFrame, length: int) -> DataFrame:
    full = chunks.filter(F.size("tokens") == length + 1)
    return full.select(
        "seq_id",
        F.slice("tokens", 1, length).alias("input_ids"),
        F.slice("tokens", 2, length).alias("labels"),
        F.lit(1).alias("label_shift"),
    )


def pack_disjoint(df: DataFrame, order_by: Sequence[str], length: int = 1024, **args) -> DataFrame:
    """Chunks of ``length + 1`` that share nothing; labels are the inputs moved by one.

    ``(seq_id, input_ids, labels, label_shift)``; a short last chunk is dropped.
    """
    return _shifted(chunk_stream(df, order_by, length + 1, length + 1, **args), length)


def pack_overlap(df: DataFrame, order_by: Sequence[str], length: int = 1024, **args) -> DataFrame:
    """Chunks of ``length + 1`` every ``length`` tokens, so each token but the first is a label once."""
    return _shifted(chunk_stream(df, order_by, length + 1, length, **args), length)


pack_constant_length = pack_overlap
"""Packing as asked for by a ``packing=True, max_length=...`` setting: the overlap packer."""


def pack_padded(df: DataFrame, order_by: Sequence[str], length: int, pad_id: int, **args) -> DataFrame:
    """Chunks of ``length``, the last one filled up: ``(seq_id, input_ids, real)``."""
    chunks = chunk_stream(df, order_by, length, length, **args)
    return chunks.select(
        "seq_id",
        pad("tokens", length, pad_id).alias("input_ids"),
        F.size("tokens").alias("real"),
    )


def group_texts(
    df: DataFrame,
    order_by: Sequence[str],
    block: int = 128,
    batch: int = 1000,
    workers: int = 4,
    ids: str = "input_ids",
    mask: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Blocks cut batch by batch: ``(worker, batch, block, input_ids, attention_mask, labels, label_shift)``.

    The rows are dealt to ``workers`` in contiguous shares and each share to batches
    of ``batch`` rows; the stream starts anew in each batch and the remainder of each
    batch is dropped.  Labels equal the inputs.  ``mask`` names the attention mask
    column that is cut alongside; without one, all positions count as real.

    A light pass over the keys picks key ranges that begin with a batch, so the data
    itself is shuffled once and no batch is divided.
    """
    keys = df.select(*order_by)
    even = key_ranges(keys, order_by, buckets=buckets)
    rows, share, extra = even.total, *divmod(even.total, workers)

    def batch_start(ordinal: int) -> int:
        """First row of the batch that holds a row."""
        shard = max(s for w in range(workers) if (s := w * share + min(w, extra)) <= ordinal)
        return ordinal - (ordinal - shard) % batch

    firsts = sorted({batch_start(rows * b // even.buckets) for b in range(even.buckets)}) if rows else [0]
    ranges = even.with_bounds(_keys_at(keys, order_by, even, firsts[1:]))
    columns = [*order_by, F.col(ids).alias("i")]
    columns.append((F.col(mask) if mask else F.array_repeat(F.lit(1), F.size(ids))).alias("m"))
    in_bucket = Window.partitionBy(BUCKET).orderBy(*order_by)
    ordinal = F.get(_longs(firsts), F.col(BUCKET)) + F.row_number().over(in_bucket) - 1
    o, wide = F.col("ordinal"), extra * (share + 1)
    worker = F.when(o < wide, div(o, share + 1)).otherwise(extra + div(o - wide, max(share, 1)))
    shard = F.col("worker") * share + F.least("worker", F.lit(extra))
    group = [BUCKET, "worker", "batch"]
    before = Window.partitionBy(*group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranges.partition(df.select(*columns))
        .withColumn("ordinal", ordinal)
        .withColumn("worker", worker)
        .withColumn("batch", div(o - shard, batch))
        .withColumn("n", F.size("i").cast("long"))
        .filter("n > 0")
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("ids", F.arrays_zip("i", "m"))
    )
    first, last = div(F.col("start"), block), div(F.col("start") + F.col("n") - 1, block)
    blocks = _assemble(placed, first, last, block, block, group).filter(F.size("tokens") == block)
    return blocks.select(
        "worker",
        "batch",
        F.col("k").alias("block"),
        F.col("tokens.i").alias("input_ids"),
        F.col("tokens.m").alias("attention_mask"),
        F.col("tokens.i").alias("labels"),
        F.lit(0).alias("label_shift"),
    )


def _keys_at(
    keys: DataFrame, order_by: Sequence[str], ranges: KeyRanges, positions: list[int]
) -> tuple[tuple, ...]:
    """The keys at the given positions of the order (as many as there are key ranges)."""
    if not positions:
        return ()
    numbered = running_total(keys, order_by, out="ordinal", ranges=ranges)
    found = numbered.filter(F.col("ordinal").isin(positions)).orderBy("ordinal").select(*ranges.columns()).collect()
    return tuple(tuple(r) for r in found)


def _longs(values: Sequence[int]) -> Column:
    """A literal array, parsed once when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def padding_waste(df: DataFrame, length: int, ids: str = "input_ids") -> DataFrame:
    """One row ``(rows, total_tokens, pad_tokens, pad_percent)``: samples padded one by one.

    A sample longer than ``length`` counts as negative padding.
    """
    total = F.count(F.lit(1)) * length
    filler = F.sum(F.lit(length) - F.size(ids))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        total.alias("total_tokens"),
        F.coalesce(filler, F.lit(0)).alias("pad_tokens"),
        (filler * 100.0 / total).alias("pad_percent"),
    )


def packing_report(df: DataFrame, length: int, ids: str = "input_ids") -> DataFrame:
    """Padding before and after padded packing with an end token per sample.

    The number of packed sequences follows from the stream length, so nothing is packed.
    """
    n = F.size(ids)
    totals = df.agg(
        (F.count(F.lit(1)) * length).alias("total_before"),
        F.coalesce(F.sum(length - n), F.lit(0)).alias("pad_before"),
        F.coalesce(F.sum(n + 1), F.lit(0)).alias("real_tokens"),
    )
    sized = totals.withColumn("sequences", F.ceil(F.col("real_tokens") / length)).withColumn(
        "total_after", F.col("sequences") * length
    )
    filled = sized.withColumn("pad_after", F.greatest(F.col("total_after") - F.col("real_tokens"), F.lit(0)))
    return filled.withColumns(
        {f"percent_{t}": F.col(f"pad_{t}") * 100.0 / F.col(f"total_{t}") for t in ("before", "after")}
    )
