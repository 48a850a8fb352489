"""Whitening of embeddings: leading components of their covariance by FEAST contour integration.

1. One job counts the vectors and sums ``x = floor(1024 * component) + 100000`` per dimension, a second one sums the
   products of centred entries.  The centre is the integer below the mean and products are taken in limbs, so
   both sums are exact and do not depend on how rows are dealt; sums are merged by Spark, entry by entry.
2. The covariance (``d x d``, whatever the number of rows) is decomposed on the driver.  Inertia counts - the signs of the pivots of
   ``V - s I = L D L'`` - bisect for cuts that leave a few eigenvalues in each interval.  In each interval the quadrature of complex
   shifted solves ``(z I - V)^-1 Y`` along a circle projects onto its eigenvectors, Rayleigh-Ritz extracts them, and turns repeat until the
   residuals are at rounding.  The interval's inertia count says how many there have to be, so that none is missed.
3. A third job sums the products of the whitened values, from which ``identity_error`` is measured; the result itself is one scan.

Edge cases: null vectors and vectors with null or non-finite components take no part; neither do vectors whose length is not the
commonest one (the longest of several), among them empty ones if others are commoner; ids may be null or repeated, each row counts; components of
no variance have no whitened value and are left out, so equal vectors, a single one or none give no rows; components beyond
9e15 do not fit a long and raise; a ``deviation`` beyond a long is kept by :func:`whiten` as decimal(38,0); only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import column, map_arrow

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Most eigenvalues in one contour, quadrature nodes on its upper half, and turns of subspace iteration at most.
PER_CONTOUR, NODES, TURNS = 4, 8, 40
LIMB = 20
PART_ROWS = 4_096


# --- the eigenproblem -----------------------------------------------------------


def inertia(a: np.ndarray) -> tuple[int, int]:
    """``(positive, negative)`` eigenvalues of a symmetric matrix, from ``L D L'`` with complete pivoting (blocks of 1 or 2)."""
    a = a.copy()
    n, at, positive, negative = len(a), 0, 0, 0
    tiny = np.finfo(float).tiny
    while at < n:
        s = a[at:, at:]
        diagonal = np.abs(np.diagonal(s))
        i = int(np.argmax(diagonal))
        p, q = np.unravel_index(np.argmax(np.abs(np.tril(s, -1))), s.shape) if len(s) > 1 else (0, 0)
        off = abs(s[p, q]) if len(s) > 1 else 0.0
        if max(diagonal[i], off) <= tiny:
            break  # the rest is zero
        if diagonal[i] >= 0.6404 * off:  # (1 + sqrt 17) / 8 bounds the growth of entries
            _swap(a, at, at + i)
            d = a[at, at]
            positive, negative = positive + (d > 0), negative + (d < 0)
            column_ = a[at + 1 :, at].copy()
            a[at + 1 :, at + 1 :] -= np.outer(column_, column_) / d
            at += 1
        else:
            _swap(a, at, at + min(p, q))
            _swap(a, at + 1, at + max(p, q))
            block = a[at : at + 2, at : at + 2].copy()  # its determinant is negative: one eigenvalue of either sign
            positive, negative = positive + 1, negative + 1
            columns = a[at + 2 :, at : at + 2].copy()
            a[at + 2 :, at + 2 :] -= columns @ np.linalg.solve(block, columns.T)
            at += 2
    return int(positive), int(negative)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def count_above(v: np.ndarray, cut: float) -> int:
    return inertia(v - cut * np.eye(len(v)))[0]


def _cuts(v: np.ndarray, wanted: int, width: float) -> list[float]:
    """Falling cuts from above the spectrum to below the eigenvalue of number ``wanted``.

    Between two of them are at most ``PER_CONTOUR`` eigenvalues, unless more of them lie within ``width``.
    """
    bound = float(np.abs(v).sum(axis=1).max())
    bottom, top = -bound * 1.01 - width, bound * 1.01 + width
    cuts, done = [top], 0
    while done < wanted:
        low, high = bottom, cuts[-1]  # more than enough lies above low, too few above high
        best = None
        while high - low > width:
            middle = (low + high) / 2
            n = count_above(v, middle)
            if n <= done:
                high = middle
            elif n - done > PER_CONTOUR:
                low = middle
            else:
                best, low_n = middle, n
                break
        if best is None:
            best, low_n = low, count_above(v, low)
        # Into the middle of the gap below, where a contour is well separated.
        best = _centre_of_gap(v, best, low_n, bottom, width)
        cuts.append(best)
        done = count_above(v, best)
    return cuts


def _centre_of_gap(v: np.ndarray, cut: float, n: int, bottom: float, width: float) -> float:
    """A cut with as many eigenvalues above it, in the middle between the neighbours on both sides."""
    ends = []
    for outer in (bottom, cut + max(cut - bottom, width)):
        inner, far = cut, outer
        while abs(far - inner) > max(width, 1e-3 * abs(cut - bottom)):
            middle = (inner + far) / 2
            inner, far = (middle, far) if count_above(v, middle) == n else (inner, middle)
        ends.append(inner)
    middle = sum(ends) / 2
    return middle if count_above(v, middle) == n else cut


def contour(v: np.ndarray, low: float, high: float, number: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` eigenpairs in ``(low, high)``: ``(values, vectors)`` by falling value."""
    d = len(v)
    size = min(d, number + max(4, number // 2))
    middle, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (points + 1)  # the upper half; the lower one is its conjugate
    shifts = middle + radius * np.exp(1j * angles)
    block = np.random.default_rng(seed).normal(size=(d, size))
    scale = max(np.abs(v).max(), np.finfo(float).tiny)
    best = None
    for _ in range(TURNS):
        projected = np.zeros((d, size))
        for z, angle, w in zip(shifts, angles, weights, strict=True):
            solved = np.linalg.solve(z * np.eye(d) - v, block.astype(complex))
            projected += (w / 2 * radius * np.exp(1j * angle) * solved).real
        basis, _ = np.linalg.qr(projected)
        small = basis.T @ v @ basis
        values, inner = np.linalg.eigh((small + small.T) / 2)  # Rayleigh-Ritz
        block = basis @ inner
        inside = np.argsort(-values)[np.isin(np.argsort(-values), np.flatnonzero((values > low) & (values < high)))]
        if len(inside) >= number:
            residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            inside = inside[np.argsort(residual, kind="stable")[:number]]
            inside = inside[np.argsort(-values[inside], kind="stable")]
            worst = float(np.sort(residual)[:number].max())
            if best is None or worst < best[0]:
                best = (worst, values[inside], block[:, inside])
            elif best[0] <= 1e-9 * scale:
                break  # no better any more: rounding
            if worst <= 1e-15 * scale:
                break
    if best is None or best[0] > 1e-9 * scale:
        raise ArithmeticError(f"{number} eigenvalues lie in ({low}, {high}) by inertia, but not all were found")
    return best[1], best[2]


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, with unit eigenvectors as columns."""
    wanted = min(wanted, len(v))
    scale = float(np.abs(v).max()) if len(v) else 0.0
    if not wanted or not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / scale
    cuts = _cuts(unit, wanted, 1e-9)
    values, vectors, above = [], [], 0
    for high, low in zip(cuts, cuts[1:]):
        n = count_above(unit, low) - above
        found, them = contour(unit, low, high, n)
        values.append(found)
        vectors.append(them)
        above += n
    values, vectors = np.concatenate(values), np.hstack(vectors)
    vectors, _ = np.linalg.qr(vectors)  # of intervals side by side; Ritz once more over all of them
    small = vectors.T @ unit @ vectors
    values, inner = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * scale, (vectors @ inner)[:, order]


# --- exact sums -------------------------------------------------------------------


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as signed limbs of ``LIMB`` bits, lowest first, in floating point."""
    out, sign, rest = [], np.sign(y), np.abs(y)
    while True:
        out.append((sign * (rest & ((1 << LIMB) - 1))).astype(float))
        rest = rest >> LIMB
        if not rest.any():
            return out


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` of whole numbers, exactly, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), PART_ROWS):  # so many products of two limbs stay below 2 ** 53
        parts = limbs(y[at : at + PART_ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """``sum((n x - S) ** 2)`` of each row, exactly."""
    far = n * np.abs(x).max(initial=0).item() + max(map(abs, sums), default=0)
    if far * far * max(x.shape[1], 1) < 1 << 62:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    return (off * off).sum(axis=1).tolist()


# --- distributed part ---------------------------------------------------------------


def _matrix(rows: pa.Array, d: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)


def fit_list(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``(id, x)`` of the vectors that take part, and their length."""
    vec = column(vector).cast("array<double>")
    rows = df.select(column(key).alias("id"), vec.alias("vec")).filter("vec IS NOT NULL")
    rows = rows.filter(F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    d = lengths.agg(F.max_by("d", F.struct("n", "d"))).first()[0] or 0
    x = F.transform("vec", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long"))
    return rows.filter(F.size("vec") == d).select("id", x.alias("x")), d


def _summed(rows: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all batches of ``size`` numbers; partial sums meet entry by entry in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                found = part(b).ravel()
                total = found if total is None else total + found
        if total is not None:
            values = [Decimal(v) for v in total] if kind.startswith("decimal") else total
            arrow = pa.decimal128(38, 0) if kind.startswith("decimal") else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(values, arrow)], ["i", "v"])

    sums = rows.mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").cast(kind).alias("v"))
    out = np.zeros(size, object)
    for r in sums.collect():  # d * d numbers at most, whatever the number of rows
        out[r.i] = int(r.v) if kind.startswith("decimal") else r.v
    return out


@dataclass(frozen=True)
class Whitening:
    """All that a vector needs to be whitened; its size depends on the dimension alone."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], float) / self.n
        return (((x - base) - rest) @ self.vectors) / np.sqrt(self.values)


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Sums, covariance and components of the fit list ``(id, x)``.  Runs three jobs."""
    whole = "decimal(38,0)"

    def sums_of(b: pa.RecordBatch) -> np.ndarray:
        x = _matrix(b.column("x"), d)
        return np.append(x.astype(object).sum(axis=0), len(x))

    totals = _summed(rows, d + 1, sums_of, whole)
    n, sums = int(totals[d]), [int(s) for s in totals[:d]]
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)
    base = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    products = _summed(rows, d * d, lambda b: exact_gram(_matrix(b.column("x"), d) - base), whole)
    # n * n * V, exactly, as the centre is off the mean by rest / n.
    exact = products.reshape(d, d) * n - np.outer(np.array(rest, object), np.array(rest, object))
    v = np.array([[int(e) / (n * n) for e in row] for row in exact], float).reshape(d, d)
    values, vectors = leading(v, components)
    trace = float(np.trace(v))
    real = values > 1e-12 * max(trace, 0.0)
    values, vectors = values[real], vectors[:, real]
    made = Whitening(n, sums, values, vectors, values / trace if trace else values, 0.0)
    k = len(values)
    if not k:
        return made

    def moments(b: pa.RecordBatch) -> np.ndarray:
        w = made.whitened(_matrix(b.column("x"), d))
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    found = _summed(rows, k * k + k, moments, "double").astype(float) / n
    mean = found[k * k :]
    error = np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(n, sums, values, vectors, made.explained, float(error))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)`` of each vector and component."""
    kind = df.schema[key].dataType.simpleString()
    rows, d = fit_list(df, key, vector)
    model = fit(rows, d, components)
    k = len(model.values)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(b.column("x"), d)
        who = np.repeat(np.arange(len(x)), k)
        deviations = pa.array([Decimal(v) for v in squared_deviations(x, model.n, model.sums)], pa.decimal128(38, 0))
        size = len(who)
        arrays = [
            b.column("id").take(pa.array(who)),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            pa.array(np.full(size, model.n)),
            deviations.take(pa.array(who)),
            pa.array(model.whitened(x).ravel()),
            pa.array(np.tile(model.explained, len(x))),
            pa.array(np.full(size, model.identity_error)),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return map_arrow(rows, batch, schema).withColumnRenamed("id", key)
