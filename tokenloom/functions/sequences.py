"""Shaping of one token sequence: padding, truncation, masks, shifted pairs, layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate(ids: Column | str, length: int) -> Column:
    return F.slice(_col(ids), 1, length)


def pad(ids: Column | str, length: int, pad_id: int, side: str = "right") -> Column:
    """Fill up to ``length``; a longer sequence is left whole."""
    ids = _col(ids)
    fill = F.array_repeat(F.lit(pad_id), _missing(ids, length))
    return F.concat(ids, fill) if side == "right" else F.concat(fill, ids)


def fit(ids: Column | str, length: int, pad_id: int, side: str = "right") -> Column:
    """Truncate and pad: exactly ``length`` ids."""
    return pad(truncate(ids, length), length, pad_id, side)


def attention_mask(ids: Column | str, length: int, side: str = "right") -> Column:
    """Ones for ids and zeros for the padding :func:`pad` would add.

    Comes from the length of the unpadded sequence: where padding and end share one
    id, the padded ids cannot tell them apart.
    """
    ids = _col(ids)
    ones = F.array_repeat(F.lit(1), F.size(ids))
    zeros = F.array_repeat(F.lit(0), _missing(ids, length))
    return F.concat(ones, zeros) if side == "right" else F.concat(zeros, ones)


def with_bos(ids: Column | str, bos_id: int) -> Column:
    return F.concat(F.array(F.lit(bos_id)), _col(ids))


def with_eos(ids: Column | str, eos_id: int) -> Column:
    return F.array_append(_col(ids), F.lit(eos_id))


def next_token_pairs(ids: Column | str) -> Column:
    """``array<struct<input, label>>``: each id with the one after it."""
    ids = _col(ids)
    last = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(ids, F.lit(1), last).alias("input"), F.slice(ids, F.lit(2), last).alias("label")
    )


# Fixed values below: the characters of a layout (end, padding, token).
def layout_string(ids: Column | str, pad_id: int, eos_id: int) -> Column:
    """One character per id: ``|`` end, ``_`` padding, ``T`` other.

    The end wins where padding uses the same id.
    """
    return F.array_join(
        F.transform(
            _col(ids),
            lambda t: F.when(t == eos_id, "|").when(t == pad_id, "_").otherwise("T"),
        ),
        "",
    )


def sample_layout(ids: Column | str, length: int) -> Column:
    """Layout of one unpacked sample: ``T`` per id, then ``_`` up to ``length``."""
    n = F.size(_col(ids))
    return F.concat(F.repeat(F.lit("T"), n), F.repeat(F.lit("_"), F.greatest(length - n, F.lit(0))))


def strip_generated(
    ids: Column | str, prompt_length: Column | int, special_ids: list[int]
) -> Column:
    """The ids after the prompt, without special ids."""
    n = F.lit(prompt_length) if isinstance(prompt_length, int) else prompt_length
    tail = F.slice(_col(ids), n + 1, F.greatest(F.size(_col(ids)) - n, F.lit(0)))
    return F.filter(tail, lambda t: ~t.isin(special_ids))


def _missing(ids: Column, length: int) -> Column:
    return F.greatest(F.lit(length) - F.size(ids), F.lit(0))
