"""Element-wise combination of vectors held by shards.

``vector_sum`` folds any number of vectors per shard; the operators that hand
whole vectors from shard to shard expect one vector per shard, as it leaves them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.batches import with_ordinal
from tokenloom.operators.lookup import lookup
from tokenloom.operators.ordering import div
from tokenloom.staging import stage

MOST_SHARDS = 10_000


def vector_sum(df: DataFrame, vec: str = "vec", by: str | None = None) -> DataFrame:
    """Element-wise sum of all vectors, or of those of each ``by``.

    Summed per element before the shuffle, so a shard may hold any share of the rows.
    """
    group = [by] if by else []
    elements = df.select(*group, F.posexplode(vec).alias("pos", "x"))
    sums = elements.groupBy(*group, "pos").agg(F.sum(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return sums.groupBy(*group).agg(ordered["x"].alias(vec))


def vector_sum_all(df: DataFrame, vec: str = "vec", shard: str = "shard") -> DataFrame:
    """The sum of all vectors, on every shard."""
    return df.select(shard).distinct().withColumn(vec, vector_sum(df, vec).scalar())


def broadcast_vector(df: DataFrame, source: int = 0, vec: str = "vec", shard: str = "shard") -> DataFrame:
    """The source shard's vector in place of every other one."""
    one = df.filter(F.col(shard) == source).select(vec)
    return df.select(shard, one.scalar().alias(vec))


def gather_vectors(df: DataFrame, vec: str = "vec", shard: str = "shard") -> DataFrame:
    """One row ``vecs``: the list of vectors in shard order (one vector per shard).

    Everything lands in one row, so more than ``MOST_SHARDS`` rows are refused.
    """
    if df.limit(MOST_SHARDS + 1).count() > MOST_SHARDS:
        raise ValueError("gather_vectors takes one vector per shard; fold them with vector_sum first")
    return df.agg(F.sort_array(F.collect_list(F.struct(shard, vec)))[vec].alias("vecs"))


def gather_vectors_all(df: DataFrame, vec: str = "vec", shard: str = "shard") -> DataFrame:
    """The list of :func:`gather_vectors` on every shard."""
    return df.select(shard, gather_vectors(df, vec, shard).scalar().alias("vecs"))


def scatter_vectors(gathered: DataFrame, vecs: str = "vecs") -> DataFrame:
    """``(shard, vec)``: item r of the list goes to shard r."""
    return gathered.select(F.posexplode(vecs).alias("shard", "vec"))


def segment_sum(df: DataFrame, segments: int, vec: str = "vec") -> DataFrame:
    """``(shard, vec)``: vectors cut into equal segments; shard j gets the sum of the j-th ones."""
    elements = df.select(F.size(vec).alias("width"), F.posexplode(vec).alias("pos", "x"))
    width = F.ceil(F.col("width") / segments).cast("int")
    placed = elements.select(
        F.floor(F.col("pos") / width).cast("int").alias("shard"), (F.col("pos") % width).alias("pos"), "x"
    )
    sums = placed.groupBy("shard", "pos").agg(F.sum(F.col("x").cast("double")).alias("x"))
    return sums.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("pos", "x")))["x"].alias(vec))


# The 16 levels of the 4-bit NormalFloat type, from the QLoRA paper.
NF4_LEVELS = (
    -1.0,
    -0.6961928009986877,
    -0.5250730514526367,
    -0.39491748809814453,
    -0.28444138169288635,
    -0.18477343022823334,
    -0.09105003625154495,
    0.0,
    0.07958029955625534,
    0.16093020141124725,
    0.24611230194568634,
    0.33791524171829224,
    0.44070982933044434,
    0.5626170039176941,
    0.7229568362236023,
    1.0,
)


def quantize_vectors(df: DataFrame, block: int = 64, vec: str = "embedding") -> DataFrame:
    """Replace a vector by ``codes`` (0..15 per element) and ``scales`` (largest absolute value per block)."""
    x = F.col(vec).cast("array<double>")
    starts = F.sequence(F.lit(1), F.size(vec), F.lit(block))
    scales = F.transform(
        starts, lambda s: F.array_max(F.transform(F.slice(x, s, F.lit(block)), lambda v: F.abs(v)))
    )
    codes = F.transform(
        x, lambda v, i: _nearest(F.try_divide(v, F.get(F.col("scales"), F.floor(i / block).cast("int"))))
    )
    return df.withColumn("scales", scales).withColumn("codes", codes).drop(vec)


def dequantize_vectors(df: DataFrame, block: int = 64, out: str = "embedding") -> DataFrame:
    levels = F.array(*[F.lit(v) for v in NF4_LEVELS])
    back = F.transform(
        "codes",
        lambda c, i: (F.get(levels, c) * F.get(F.col("scales"), F.floor(i / block).cast("int"))).cast("float"),
    )
    return df.withColumn(out, back).drop("codes", "scales")


def quantize_scales(
    coded: DataFrame, order_by: Sequence[str], per_vector: int, group: int = 256
) -> tuple[DataFrame, DataFrame, float]:
    """The second level: ``(coded, tops, mean)``, the scales as whole numbers from -127 to 127 in ``scale_codes``.

    Scales are centred on their ``mean``.  ``per_vector`` of them belong to each vector, all are numbered in order (``ordinal`` is that of
    the vector), and each run of ``group`` shares its largest distance from the mean, a row ``(group, far)`` of ``tops``.
    Runs jobs: the mean, the numbering, and the staged tops.
    """
    mean = coded.select(F.explode("scales").alias("s")).agg(F.round(F.avg("s"), 6)).first()[0] or 0.0
    placed = with_ordinal(coded, order_by)
    groups = _groups("ordinal", per_vector, group)
    far = F.arrays_zip(groups.alias("group"), F.transform("scales", lambda s: F.abs(s - mean)).alias("far"))
    tops = stage(placed.select(F.explode(far).alias("x")).groupBy("x.group").agg(F.max("x.far").alias("far")), "tops")
    named = _with_tops(placed, order_by, tops, per_vector, group)
    codes = F.zip_with("scales", "far", lambda s, t: F.round(F.coalesce(F.try_divide(s - mean, t), F.lit(0.0)) * 127).cast("int"))
    return named.withColumn("scale_codes", codes).drop("scales", "far"), tops, mean


def dequantize_scales(
    coded: DataFrame, order_by: Sequence[str], tops: DataFrame, mean: float, per_vector: int, group: int = 256
) -> DataFrame:
    """The way back: ``scales`` from their codes."""
    named = _with_tops(coded, order_by, tops, per_vector, group)
    back = F.zip_with("scale_codes", "far", lambda c, t: c / F.lit(127.0) * t + F.lit(mean))
    return named.withColumn("scales", back).drop("scale_codes", "far", "ordinal")


def _groups(ordinal: str, per_vector: int, group: int) -> Column:
    """The group of each scale of a vector."""
    first = F.col(ordinal) * per_vector
    return F.transform(F.sequence(F.lit(0), F.lit(per_vector - 1)), lambda i: div(first + i, group))


def _with_tops(placed: DataFrame, order_by: Sequence[str], tops: DataFrame, per_vector: int, group: int) -> DataFrame:
    """Add ``far``, the top of each scale's group; a vector asks for the few groups it is in."""
    groups = _groups("ordinal", per_vector, group)
    asked = placed.select(*order_by, F.explode(F.array_distinct(groups)).alias("group"))
    found = lookup(asked, tops, "group").groupBy(*order_by)
    found = found.agg(F.map_from_entries(F.collect_list(F.struct("group", "far"))).alias("by_group"))
    named = placed.join(found, list(order_by))
    return named.withColumn("far", F.transform(groups, lambda g: F.element_at("by_group", g))).drop("by_group")


def _nearest(v):
    """Code of the nearest level: how many midpoints between levels lie below the value.

    The value is null in a block of zeros.
    """
    middles = [(a + b) / 2 for a, b in zip(NF4_LEVELS, NF4_LEVELS[1:])]
    zero = F.lit(NF4_LEVELS.index(0.0))
    steps = F.array(*[F.lit(m) for m in middles])
    return F.when(v.isNull(), zero).otherwise(F.size(F.filter(steps, lambda m: m < v)))
