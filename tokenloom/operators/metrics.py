"""Evaluation losses and scores over tables of scored rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.losses import argmax, cross_entropy

Loss = Callable[[Column, Column], Column]


def score(df: DataFrame, logits: str, label: str, loss: Loss = cross_entropy) -> DataFrame:
    """Add ``loss`` and ``prediction``; ``loss`` may be any function of two Columns."""
    return df.withColumn("loss", loss(F.col(logits), F.col(label))).withColumn("prediction", argmax(logits))


def eval_loss_by_batch(scored: DataFrame, batch: str = "batch", loss: str = "loss") -> DataFrame:
    """One row ``eval_loss``: the plain mean of the batch means, however short the last batch."""
    means = scored.groupBy(batch).agg(F.avg(loss).alias("m"))
    return means.agg(F.avg("m").alias("eval_loss"))


def eval_loss_reduced(
    scored: DataFrame, rank: str = "rank", batch: str = "batch", loss: str = "loss"
) -> DataFrame:
    """One row ``(total_loss, total_steps, eval_loss)``: sums per rank, then over the ranks."""
    means = scored.groupBy(rank, batch).agg(F.avg(loss).alias("m"))
    per_rank = means.groupBy(rank).agg(F.sum("m").alias("l"), F.count("m").alias("s"))
    return per_rank.agg(
        F.sum("l").alias("total_loss"), F.sum("s").alias("total_steps")
    ).withColumn("eval_loss", F.col("total_loss") / F.col("total_steps"))


def eval_loss_by_position(df: DataFrame, loss: str = "loss") -> DataFrame:
    """One row ``(positions, eval_loss)`` of :func:`~tokenloom.functions.losses.sequence_loss` structs, however long their rows."""
    sums = df.agg(F.coalesce(F.sum(f"{loss}.count"), F.lit(0)).alias("positions"), F.sum(f"{loss}.loss").alias("total"))
    return sums.select("positions", F.try_divide("total", "positions").alias("eval_loss"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row ``(correct, total, accuracy)``."""
    hit = (F.col(prediction) == F.col(label)).cast("long")
    return df.agg(F.sum(hit).alias("correct"), F.count(hit).alias("total")).withColumn(
        "accuracy", F.col("correct") / F.col("total")
    )


def log_every(metrics: DataFrame, n: int, first: bool = False, step: str = "step") -> DataFrame:
    """The steps to log: every ``n``-th, and with ``first`` step 1 too."""
    due = F.col(step) % n == 0
    return metrics.filter(due | (F.col(step) == 1) if first else due)
