"""Losses and predictions from one row of class scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label of a position that is left out of the loss.
IGNORED_LABEL = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cross_entropy(logits: Column | str, label: Column | str, ignore: int | None = None) -> Column:
    """``ln(sum(exp(x))) - x[label]``, with the maximum taken out first.

    Null for a row whose label is ``ignore``, so that averages leave it out.  Any other label
    without a score is an error when the row is computed.
    """
    x = _col(logits).cast("array<double>")
    label = _col(label)
    top = F.array_max(x)
    total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
    stray = F.raise_error(F.concat(F.lit("cross_entropy: no score for label "), label.cast("string")))
    known = (label >= 0) & (label < F.size(x))
    loss = top + F.log(total) - F.when(known, F.get(x, label)).when(label.isNotNull(), stray.cast("double"))
    return loss if ignore is None else F.when(label != ignore, loss)


def sequence_loss(logits: Column | str, labels: Column | str, ignore: int = IGNORED_LABEL) -> Column:
    """``struct<loss, count>`` of a sequence: the losses of its positions added up, and how many count.

    ``logits`` has an array of scores for each position and ``labels`` a class; positions labelled ``ignore`` or null are left out.
    Sums of both over rows of any length give the mean over positions.
    """
    both = F.zip_with(_col(logits), _col(labels), lambda x, y: cross_entropy(x, y, ignore))
    known = F.filter(both, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v)
    return F.struct(total.alias("loss"), F.size(known).cast("long").alias("count"))


def argmax(logits: Column | str) -> Column:
    """Index of the largest score, the first one on ties."""
    x = _col(logits)
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def perplexity(mean_loss: Column | str) -> Column:
    return F.exp(_col(mean_loss))
