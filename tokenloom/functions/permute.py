"""A keyed permutation of the numbers 0 to n - 1 as a formula, and its inverse.

A number is written as a pair (left, right) of a grid of about sqrt(n) by sqrt(n) cells.  Each round adds to one of the two a hash of
the other, which can be undone; ``ROUNDS`` rounds mix them.  The grid may have a few cells more than n: a number that lands on one of
these goes through the rounds again.  How often is known beforehand, because there are fewer than sqrt(n) such cells to try.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 4
DIGITS = 12


@dataclass(frozen=True)
class Permutation:
    n: int
    seed: int
    epoch: int

    @property
    def wide(self) -> int:
        return max(1, math.isqrt(max(self.n - 1, 0)) + 1)

    @property
    def high(self) -> int:
        return max(1, -(-self.n // self.wide))

    def place(self, position: Column) -> Column:
        """Where the row at ``position`` comes in this epoch."""
        return self._again(position, self._forth, self._walk(self._forth_number))

    def position(self, place: Column) -> Column:
        """The row that comes at ``place``."""
        return self._again(place, self._back, self._walk(self._back_number))

    def _label(self, turn: int) -> str:
        return f"{self.seed}-{self.epoch}-{turn}-"

    def _again(self, x: Column, step, times: int) -> Column:
        # Folds name the number in between, which as nested expressions would be repeated at every use.
        walk = F.sequence(F.lit(0), F.lit(times))
        return F.aggregate(walk, x.cast("long"), lambda at, i: F.when((i > 0) & (at < self.n), at).otherwise(step(at)))

    def _walk(self, step) -> int:
        """The most steps any number takes outside 0 to n - 1."""
        longest = 0
        for start in range(self.n, self.wide * self.high):
            # Follow each walk until it is back inside.  One that returns to its start is never entered from inside.
            x, steps = step(start), 1
            while x >= self.n and x != start:
                x, steps = step(x), steps + 1
            if x < self.n:
                longest = max(longest, steps)
        return longest

    def _hash(self, half: Column, turn: Column) -> Column:
        label = F.concat(F.lit(f"{self.seed}-{self.epoch}-"), turn.cast("string"), F.lit("-"), half.cast("string"))
        return F.conv(F.substring(F.md5(label), 1, DIGITS), 16, 10).cast("long")

    def _rounds(self, x: Column, turns: Column, sign: int) -> Column:
        start = F.struct(F.call_function("div", x, F.lit(self.wide)).alias("left"), (x % self.wide).cast("long").alias("right"))

        def turned(at: Column, turn: Column) -> Column:
            left = F.pmod(at["left"] + sign * self._hash(at["right"], turn), F.lit(self.high).cast("long"))
            right = F.pmod(at["right"] + sign * self._hash(at["left"], turn), F.lit(self.wide).cast("long"))
            odd = F.struct(left.alias("left"), at["right"].alias("right"))
            return F.when(turn % 2 == 1, odd).otherwise(F.struct(at["left"].alias("left"), right.alias("right")))

        return F.aggregate(turns, start, turned, lambda at: at["left"] * self.wide + at["right"])

    def _forth(self, x: Column) -> Column:
        return self._rounds(x, F.sequence(F.lit(0), F.lit(ROUNDS - 1)), 1)

    def _back(self, x: Column) -> Column:
        return self._rounds(x, F.sequence(F.lit(ROUNDS - 1), F.lit(0)), -1)

    def _number(self, half: int, turn: int) -> int:
        return int(hashlib.md5(f"{self._label(turn)}{half}".encode()).hexdigest()[:DIGITS], 16)

    def _forth_number(self, x: int) -> int:
        left, right = divmod(x, self.wide)
        for turn in range(ROUNDS):
            if turn % 2:
                left = (left + self._number(right, turn)) % self.high
            else:
                right = (right + self._number(left, turn)) % self.wide
        return left * self.wide + right

    def _back_number(self, x: int) -> int:
        left, right = divmod(x, self.wide)
        for turn in reversed(range(ROUNDS)):
            if turn % 2:
                left = (left - self._number(right, turn)) % self.high
            else:
                right = (right - self._number(left, turn)) % self.wide
        return left * self.wide + right
