"""Batches, shards and optimizer updates as columns of a plan table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.ordering import BUCKET, div, key_ranges, running_total

MODES = ("vanilla", "accelerate", "pipeline")


def with_ordinal(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add ``ordinal``, the position from 0 in key order."""
    return running_total(df, order_by, out="ordinal", sizes=df.select(*order_by))


def row_at(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    """The row at position ``k``: only the key range that holds it is sorted.

    Runs jobs that read the order columns: the cut points and the rows of each range.
    """
    ranges = key_ranges(df.select(*order_by), order_by)
    bases = ranges.bases(df.select(*order_by)).collect()  # one row for each range
    home = max((r for r in bases if r.base <= k), key=lambda r: (r.base, r[BUCKET]), default=None)
    bucket, base = (home[BUCKET], home.base) if home else (0, 0)
    inside = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*order_by)) - 1
    rows = df.withColumn(BUCKET, ranges.column()).filter(F.col(BUCKET) == bucket)
    rows = rows.withColumn("ordinal", inside + F.lit(base).cast("long")).drop(BUCKET)
    return rows.filter(F.col("ordinal") == k)


def assign_batches(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """Add ``ordinal`` and ``batch``; the last batch may be short."""
    return with_ordinal(df, order_by).withColumn("batch", div(F.col("ordinal"), size))


def collate(
    df: DataFrame,
    columns: Sequence[str],
    batch: str = "batch",
    order: str = "ordinal",
    hook: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per batch: ``(batch, rows)`` with its rows as structs in order (at most a batch each).

    ``hook`` turns that array of structs into what a batch is to be, e.g. padded lists.
    """
    rows = F.sort_array(F.collect_list(F.struct(order, *columns)))
    made = df.groupBy(batch).agg(rows.alias("rows"))
    return made if hook is None else made.withColumn("rows", hook(F.col("rows")))


def shard_by_rank(df: DataFrame, ranks: int, batch: str = "batch") -> DataFrame:
    """Add ``rank``: batches dealt in turn."""
    return df.withColumn("rank", (F.col(batch) % ranks).cast("int"))


def assign_updates(
    steps: DataFrame, epochs: int, per_epoch: int, accum: int, mode: str = "accelerate"
) -> DataFrame:
    """Each micro-batch of each epoch with the optimizer update it feeds: ``(.., epoch, update, applied)``.

    ``steps`` has one row per micro-batch ``step`` (0 .. ``per_epoch``-1).  Modes:

    * vanilla: an update happens whenever ``step % accum == 0``, so the first holds one
      micro-batch and what is left over at the end of an epoch joins the first of the
      next; after the last epoch it is never applied.
    * accelerate: after every ``accum`` micro-batches and at the end of the epoch.
    * pipeline: full groups of ``accum`` only; the surplus of an epoch is not used.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    plan = steps.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))
    step, epoch = F.col("step"), F.col("epoch")
    ceil_updates = -(-per_epoch // accum)
    if mode == "vanilla":
        update = epoch * ceil_updates + div(step + accum - 1, accum)
        applied = update < epochs * ceil_updates
    elif mode == "accelerate":
        update = epoch * ceil_updates + div(step, accum)
        applied = F.lit(True)
    else:
        full = per_epoch // accum
        applied = div(step, accum) < full
        update = F.when(applied, epoch * full + div(step, accum))
    return plan.withColumn("update", update).withColumn("applied", applied)


def plan_summary(
    df: DataFrame, batch_size: int, ranks: int, accum: int, epochs: int, mode: str = "accelerate"
) -> DataFrame:
    """One row: examples, batches per epoch, total and warm-up steps, effective batch size.

    Modes as in :func:`assign_updates`, and ``raw`` for one step per batch.  Warm-up is a
    tenth of the total, rounded down.
    """
    n = F.col("examples")
    batches = div(n + batch_size - 1, batch_size)
    total = {
        "vanilla": div(batches * epochs, accum),
        "accelerate": div(batches, accum) * epochs,
        "pipeline": div(n, batch_size * accum) * epochs,
        "raw": batches * epochs,
    }[mode]
    return (
        df.agg(F.count(F.lit(1)).alias("examples"))
        .withColumn("batches", batches)
        .withColumn("total_steps", total)
        .withColumn("warmup_steps", div(F.col("total_steps"), 10) if mode != "raw" else F.lit(0).cast("long"))
        .withColumn("effective_batch", F.lit(batch_size * ranks * accum).cast("long"))
    )


def shard_by_weight(df: DataFrame, order_by: Sequence[str], weight: str, shards: int) -> DataFrame:
    """Add ``shard``: contiguous shares of about equal total weight."""
    light = df.select(*order_by, weight)
    placed = running_total(df, order_by, weight, out="before", sizes=light)
    total = light.agg(F.sum(F.col(weight).cast("long")).alias("t")).scalar()
    before = F.col("before").cast("decimal(20,0)") * F.lit(shards).cast("decimal(10,0)")  # may not fit a long
    share = F.call_function("div", before, F.lit(total).cast("decimal(20,0)"))
    return placed.withColumn("shard", F.least(F.lit(shards - 1).cast("long"), share).cast("int"))

