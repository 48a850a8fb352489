"""Seeded pseudo-random numbers as a pure function of a row's key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_DIGITS = 15
KEY_SPACE = 16**KEY_DIGITS


def shuffle_key(key: Column | str, seed: int, epoch: int | Column | None = None) -> Column:
    """A BIGINT, uniform in ``[0, 16**15)``; ordering by ``(it, key)`` is a seeded shuffle."""
    parts = [F.lit(str(seed))]
    if epoch is not None:
        parts.append((epoch if isinstance(epoch, Column) else F.lit(epoch)).cast("string"))
    parts.append((F.col(key) if isinstance(key, str) else key).cast("string"))
    digits = F.substring(F.md5(F.concat_ws("-", *parts)), 1, KEY_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A DOUBLE in (0, 1) from the parts."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def normal_hash(*parts: Column) -> Column:
    """A standard normal DOUBLE from the parts (Box-Muller)."""
    u, v = unit_hash(*parts, F.lit("u")), unit_hash(*parts, F.lit("v"))
    return F.sqrt(-2 * F.log(u)) * F.cos(v * 6.283185307179586)
