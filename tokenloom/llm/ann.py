"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors are dealt to shells by the power of two of their norm, divided by the largest norm of their shell, and lifted to one more
dimension, so that within a shell the largest inner product is the smallest distance to the query's direction; a vector
of 100 times the usual norm is a shell of its own and makes no other bucket coarser.  Each table hashes a vector by
``floor((a x + b) / w)`` with Gaussian ``a``.  A query visits its own bucket and perturbed ones (hashes moved by -1 or 1), in
every shell, in the order of their estimated success: the sum of squared distances to the bucket borders crossed.  Candidates of all tables
are ranked by the exact inner product in double precision, then by their smallest id, and merged; whatever ties with the last
kept score of a block takes part in that ranking.

The number of hashes, their width, the tables and the probes are fitted together: of the settings in ``GRID`` that find ``RECALL`` of the
true neighbours of ``ASKED_IN_FIT`` queries, the one with the least cost: the share of a bounded sample (``SAMPLE`` vectors) that is
scored, and a little for each table and visit.  The true neighbours
come from one pass over all vectors, so with more rows, whose nearest are nearer, finer buckets are chosen.  Every vector is indexed.
Queries for which the visited buckets hold too few vectors, and all queries if no setting reaches ``FEWEST_FOUND``, are
compared with all vectors, in blocks.

Buckets are dealt to cells by hash, and those of more than ``BLOCK`` vectors are split over the next cells, so a hot bucket
is many blocks.  A query is one row for each cell it visits, with the list of its blocks there, however many buckets it
visits: at most one for each cell.  A cell that more than ``CELL_QUERIES`` queries visit is repeated for parts of them.  A task holds the
vectors of one cell; queries pass by, at most ``PASSING`` at a time, and no more than about ``PENDING`` candidates are kept unsorted, so its memory
does not grow with the queries or with the blocks they visit.  Equal vectors are indexed once,
with their smallest ids: more than ``nearest + 1`` of them can never be in a result.

Edge cases: null ids, null, empty or zero vectors, vectors with null or non-finite components, and vectors of another length
than the commonest (the shorter of two equally common) take no part; a query has as many rows as there are candidates, if fewer
than ``nearest``; ties go to the smaller id; a repeated row counts once, and rows of the query's own id are no candidates;
an empty table gives an empty one; only the two named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import column, map_arrow
from tokenloom.operators.lookup import fits_broadcast, lookup
from tokenloom.staging import stage

#: Hashes of a table with widths in units of a shell's largest norm; numbers of tables and of probes.
GRID = ((6, 1.8), (8, 0.9), (8, 1.8), (10, 1.8), (12, 0.9), (12, 2.2), (12, 2.6), (16, 1.0))
TABLES, PROBES = (4, 8), (16, 64, 256, 1024)
#: What a table and a visit cost, in shares of the vectors that a query scores.
TABLE_COST, VISIT_COST = 0.002, 1 / 200_000
NEAREST = 20
SAMPLE = 4_096
ASKED_IN_FIT = 64
RECALL = 0.94
FEWEST_FOUND = 0.92
BLOCK = 2_048
CELLS, CELL_ROWS, CELL_QUERIES = 64, 65_536, 65_536
#: Buckets that may be split, and bits that tell which buckets hold vectors (a power of two).
SPLITS, MARKS = 65_536, 1 << 23
#: Queries scored at once against a block, pairs multiplied out exactly at once, and queries probed at once.
ASKED, PAIRS, PROBED = 256, 65_536, 32
#: Vectors multiplied at once; queries that pass a cell at once and the blocks they visit there; candidates kept before they are sorted.
ROWS, PASSING, PASSING_VISITS, PENDING = 4_096, 16_384, 1 << 20, 1 << 19


@dataclass(frozen=True)
class Index:
    """Everything that hashing a vector needs; a few kilobytes."""

    directions: np.ndarray  # (tables, hashes, dimension + 1)
    offsets: np.ndarray  # (tables, hashes)
    width: float
    moves: np.ndarray  # (probes, 2 * hashes): which of the ranked borders each probe crosses
    shells: dict[int, float]  # largest norm of each shell

    @property
    def tables(self) -> int:
        return len(self.directions)

    def places(self, unit: np.ndarray, query: bool) -> np.ndarray:
        """Position of each vector of the unit ball, lifted, in units of the bucket width: (vectors, tables, hashes)."""
        rest = np.zeros(len(unit)) if query else np.sqrt(np.maximum(1 - (unit * unit).sum(axis=1), 0))
        lifted = np.column_stack([unit, rest])
        return (np.einsum("nd,thd->nth", lifted, self.directions, optimize=True) + self.offsets) / self.width

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        norm = norms(x)
        shell = shell_of(norm)
        top = np.array([self.shells[k] for k in shell.tolist()])
        return bucket_numbers(np.floor(self.places(x / top[:, None], False)).astype(np.int64), shell)

    def crossed(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moves of the hashes, likeliest probe first, and their costs: (queries, tables, probes[, hashes])."""
        low = place - np.floor(place)
        near = np.minimum(low, 1 - low)
        order = np.argsort(near, axis=2, kind="stable")
        ranked = np.take_along_axis(near, order, 2)
        borders = np.concatenate([ranked, 1 - ranked[:, :, ::-1]], axis=2) ** 2
        cost = borders @ self.moves.T
        best = np.argsort(cost, axis=2, kind="stable")
        h = place.shape[2]
        nearer = np.where(low <= 0.5, -1, 1)
        way = np.take_along_axis(nearer, order, 2)
        # By rank of the hash: 1 to the nearer border, -1 to the other.
        by_rank = self.moves[:, :h].astype(np.int64) - self.moves[:, : h - 1 : -1].astype(np.int64)
        step = by_rank[best] * way[:, :, None, :]
        moved = np.zeros_like(step)
        np.put_along_axis(moved, np.broadcast_to(order[:, :, None, :], step.shape), step, 3)
        return moved, np.take_along_axis(cost, best, 2)

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The buckets each query visits in one shell after the other: (queries, tables, shells x probes)."""
        place = self.places(x / norms(x)[:, None], True)
        cells = np.floor(place).astype(np.int64)[:, :, None, :] + self.crossed(place)[0]
        each = [bucket_numbers(cells, np.full(len(x), k)) for k in sorted(self.shells)]
        return np.concatenate(each, axis=2)


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths, also of components whose squares a double cannot hold."""
    largest = np.abs(x).max(axis=1)
    return largest * np.sqrt(((x / largest[:, None]) ** 2).sum(axis=1))


def shell_of(norm: np.ndarray) -> np.ndarray:
    """The power of two nearest to a norm; unit vectors, rounded or not, share a shell."""
    return np.rint(np.log2(norm)).astype(np.int64)


def bucket_numbers(cells: np.ndarray, shell: np.ndarray) -> np.ndarray:
    """One number for shell, table and hash values; ``cells`` has the table on its second axis and hashes on its last.

    Numbers that happen to be equal only join two buckets.
    """
    tables = np.arange(cells.shape[1]).reshape([1, -1] + [1] * (cells.ndim - 3))
    n = np.broadcast_to(shell.reshape([-1] + [1] * (cells.ndim - 2)) * 64 + tables, cells.shape[:-1]).astype(np.uint64)
    for j in range(cells.shape[-1]):
        n = (n ^ cells[..., j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        n ^= n >> np.uint64(29)
    return n.view(np.int64)


def probe_moves(hashes: int, probes: int) -> np.ndarray:
    """Sets of ranked borders by rising expected cost, the empty one first; none has both borders of a hash.

    Ranks 0 to ``hashes - 1`` are the nearer borders, nearest first; the border across from rank ``j`` is ``2 * hashes - 1 - j``.
    The expected squares are those of uniform places.
    """
    m = hashes
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = (1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2)))[::-1]
    z = np.concatenate([near, far])
    out = [()]
    heap = [(z[0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if not {2 * m - 1 - r for r in chosen} & set(chosen):
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - z[last] + z[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + z[last + 1], (*chosen, last + 1)))
    moves = np.zeros((len(out), 2 * m))
    for i, chosen in enumerate(out):
        moves[i, list(chosen)] = 1
    return moves


def best_of(scores: np.ndarray, n: int) -> np.ndarray:
    """Per row the places of the ``n`` largest values, unordered."""
    return np.argpartition(-scores, n - 1, axis=1)[:, :n] if scores.shape[1] > n else np.tile(np.arange(scores.shape[1]), (len(scores), 1))


def _ranks(index: Index, asked: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The probe that meets each vector, for each query and table; the number of probes if none does."""
    home, visited = index.buckets(x), index.visited(asked)
    probes = len(index.moves)
    out = np.full((len(asked), index.tables, len(x)), probes, np.int32)
    for q in range(len(asked)):
        for t in range(index.tables):
            order = np.argsort(visited[q, t], kind="stable")
            numbers = visited[q, t][order]
            at = np.minimum(np.searchsorted(numbers, home[:, t]), len(numbers) - 1)
            hit = numbers[at] == home[:, t]
            out[q, t, hit] = order[at[hit]] % probes
    return out


@dataclass(frozen=True)
class Fit:
    index: Index
    recall: float  # of the true neighbours of the queries asked in the fit
    share: float  # of the sample that a query scores


def fit(sample: np.ndarray, asked: np.ndarray, near: list[np.ndarray], shells: dict[int, float], seed: int = 7) -> Fit:
    """The least cost that reaches ``RECALL``, or else the most recall; ``near`` has each query's true neighbours."""
    best = None
    sizes = np.array([len(v) for v in near])
    true = np.concatenate([v for v in near if len(v)]) if sizes.sum() else sample[:0]
    owner = np.repeat(np.arange(len(asked)), sizes)
    for hashes, width in GRID:
        rng = np.random.default_rng([seed, hashes])
        directions = rng.normal(size=(max(TABLES), hashes, sample.shape[1] + 1))
        moves = probe_moves(hashes, max(PROBES))
        index = Index(directions, rng.uniform(0, width, (max(TABLES), hashes)), width, moves, shells)
        scored = _ranks(index, asked, sample)
        found = _ranks(index, asked, true)[owner, :, np.arange(len(true))] if len(true) else np.zeros((0, max(TABLES)), int)
        for tables in TABLES:
            least, least_true = scored[:, :tables].min(axis=1), found[:, :tables].min(axis=1)
            for probes in PROBES:
                reach = min(probes, len(moves))
                recall = float((least_true < reach).mean()) if len(true) else 1.0
                share = float((least < reach).mean())
                enough = recall >= RECALL
                cost = share + TABLE_COST * tables + VISIT_COST * tables * reach * len(shells)
                rank = (not enough, cost if enough else -recall)
                if best is None or rank < best[0]:
                    used = Index(directions[:tables], index.offsets[:tables], width, moves[:reach], shells)
                    best = rank, Fit(used, recall, share)
    return best[1]


def _nearest_of_few(vectors: DataFrame, asked: np.ndarray, nearest: int) -> list[np.ndarray]:
    """The true nearest vectors of a bounded number of queries: one pass over all vectors."""
    schema = "query int, best array<struct<loss:double,rep:bigint>>"

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        score = asked @ _matrix(b.column("vec")).T
        reps = b.column("rep").to_numpy()
        top = best_of(score, nearest + 1)
        lists = [[{"loss": -float(score[q, i]), "rep": int(reps[i])} for i in top[q]] for q in range(len(asked))]
        kind = pa.list_(pa.struct([("loss", pa.float64()), ("rep", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(range(len(asked)), pa.int32()), pa.array(lists, kind)], ["query", "best"])

    each = map_arrow(vectors.select("rep", "vec"), batch, schema).select("query", F.explode("best").alias("b"))
    by = Window.partitionBy("query").orderBy("b")
    few = each.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= nearest + 1).select("query", "b.rep")
    rows = few.join(vectors.select("rep", "vec"), "rep").collect()  # ASKED_IN_FIT x (nearest + 1) at most
    out: list[list] = [[] for _ in asked]
    for r in rows:
        if not np.array_equal(r.vec, asked[r.query]):
            out[r.query].append(r.vec)
    return [np.array(v, float).reshape(-1, asked.shape[1]) for v in out]


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vec)`` of the vectors that take part."""
    # Single precision stays so until it is multiplied, which halves what is shuffled.
    single = dict(df.dtypes)[vector] == "array<float>"
    vec = column(vector).cast("array<float>" if single else "array<double>")
    rows = df.select(column(key).cast("long").alias("id"), vec.alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.filter(sound)
    sizes = rows.groupBy(F.size("vec").alias("size")).count()
    length = sizes.agg(F.max_by("size", F.struct("count", -F.col("size")))).first()[0] or 0
    return rows.filter(F.size("vec") == length)


def _matrix(column_: pa.ListArray) -> np.ndarray:
    return column_.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column_), -1)


def _as_bytes(column_: pa.ListArray) -> pa.Array:
    """The vectors as bytes, which move as one value each."""
    values = np.ascontiguousarray(column_.flatten().to_numpy(zero_copy_only=False))
    ends = np.arange(len(column_) + 1) * (values.nbytes // max(len(column_), 1))
    return pa.Array.from_buffers(pa.binary(), len(column_), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def _from_bytes(column_: pa.Array, kind: str) -> np.ndarray:
    """The vectors of :func:`_as_bytes` in their own precision."""
    _, offsets, data = column_.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column_) + 1, column_.offset * 4)
    return np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]).view(kind).reshape(len(column_), -1)


def _packed(df: DataFrame, *others: str) -> DataFrame:
    """``others`` and ``vec`` as bytes."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in others), _as_bytes(b.column("vec"))], [*others, "vec"])

    kinds = dict(df.dtypes)
    return map_arrow(df.select(*others, "vec"), batch, ", ".join([*(f"{c} {kinds[c]}" for c in others), "vec binary"]))


def _indexed(vectors: DataFrame, index: Index) -> DataFrame:
    """``(rep, first, vec, bucket)`` for each vector and table, the vector as bytes."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        numbers = index.buckets(_matrix(b.column("vec")))
        ends = np.arange(0, numbers.size + 1, index.tables, dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [b.column("rep"), b.column("first"), _as_bytes(b.column("vec")), pa.ListArray.from_arrays(ends, numbers.ravel())],
            ["rep", "first", "vec", "buckets"],
        )

    named = vectors.select("rep", F.col("ids")[0].alias("first"), "vec")
    hashed = map_arrow(named, batch, "rep long, first long, vec binary, buckets array<bigint>")
    return hashed.select("rep", "first", "vec", F.explode("buckets").alias("bucket"))


@dataclass(frozen=True)
class Held:
    """Which buckets hold vectors and how they are dealt to cells: a few megabytes at most, whatever the table.

    Part ``p`` of a bucket is in the cell ``p`` after the bucket's own.
    """

    cells: int
    split: np.ndarray  # rising numbers of the buckets of several parts
    parts: np.ndarray
    marks: np.ndarray  # bits set for the buckets that hold vectors

    def visits(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(cells, blocks)`` of a query's buckets, rising; empty buckets are left out as far as their bits tell."""
        buckets = buckets[self.marks[buckets & (len(self.marks) - 1)]]
        parts = np.ones(len(buckets), np.int64)
        if len(self.split):
            at = np.minimum(np.searchsorted(self.split, buckets), len(self.split) - 1)
            parts = np.where(self.split[at] == buckets, np.minimum(self.parts[at], self.cells), 1)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        cell = (np.repeat(buckets >> 33 & 0x7FFFFFFF, parts) + part) % self.cells
        both = np.unique(cell << 31 | np.repeat(buckets & 0x7FFFFFFF, parts))
        return both >> 31, both & 0x7FFFFFFF


def _held(sizes: DataFrame, total: int, cells: int) -> tuple[Held, DataFrame]:
    """What queries need to know of ``(bucket, n)``, and ``(bucket, parts)`` of the buckets of several parts.

    Buckets of more than ``BLOCK`` vectors and more than 1/``SPLITS`` of all are split, so there are fewer than ``SPLITS``.
    """
    most = max(BLOCK, -(-total // SPLITS))
    split = sizes.filter(F.col("n") > most).select("bucket", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    rows = split.orderBy("bucket").collect()
    mark = F.col("bucket").bitwiseAND(F.lit(MARKS - 1)) + 1
    bits = sizes.groupBy(F.bitmap_bucket_number(mark).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(mark)).alias("bits"))
    marks = np.zeros((MARKS >> 15, 1 << 15), bool)
    for r in bits.collect():  # MARKS bits at most
        marks[r["at"] - 1] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
    numbers = np.array([r.bucket for r in rows], np.int64)
    return Held(cells, numbers, np.array([r.parts for r in rows], np.int64), marks.ravel()), split


def _probes(queries: DataFrame, index: Index, held: Held) -> DataFrame:
    """``(query, cell, blocks)``: the blocks that a query visits in each cell, one row a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PROBED):
                part = b.slice(at, PROBED)
                numbers = index.visited(_matrix(part.column("vec"))).reshape(part.num_rows, -1)
                each = [held.visits(n) for n in numbers]
                starts = [np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else cell for cell, _ in each]
                query = np.repeat(part.column("query").to_numpy(), [len(s) for s in starts])
                cells = np.concatenate([cell[s] for (cell, _), s in zip(each, starts, strict=True)])
                before = np.cumsum([0, *(len(cell) for cell, _ in each)])
                offsets = np.append(np.concatenate([s + n for s, n in zip(starts, before, strict=False)]), before[-1])
                blocks = np.concatenate([block for _, block in each])
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), blocks.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(cells.astype(np.int32)), lists], ["query", "cell", "blocks"])

    return queries.mapInArrow(run, "query long, cell int, blocks array<int>")


def _block_best(asked: np.ndarray, vectors: np.ndarray, first: np.ndarray, reps: np.ndarray, n: int, least: np.ndarray | None = None):
    """``(query, vector, score)``: each query's ``n`` best of a block by exact score, then by smallest id.

    Those below ``least`` may be left out, and a few more than the best may be there, in any order, if they are not more than ``n`` a query on average.
    """
    norms = np.sqrt((vectors * vectors).sum(axis=1).max())
    step = max(1, min(ASKED, ASKED * ROWS // max(len(vectors), 1)))
    for at in range(0, len(asked), step):
        ask = asked[at : at + step]
        rough = ask @ vectors.T
        # Twice what two ways of adding up the products can differ by.
        slack = 4 * (ask.shape[1] + 1) * np.finfo(float).eps * norms * np.sqrt((ask * ask).sum(axis=1))
        cut = np.full(len(ask), -np.inf) if least is None else least[at : at + step] - slack
        near = ~(rough < cut[:, None])
        if len(vectors) > n and np.count_nonzero(near) > n * len(ask):
            last = np.partition(rough, len(vectors) - n, axis=1)[:, len(vectors) - n]
            near = rough >= np.fmax(cut, last - slack)[:, None]
        q, pick = np.nonzero(near)
        exact = [(ask[q[i : i + PAIRS]] * vectors[pick[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(q), PAIRS)]
        s = np.concatenate([*exact, np.zeros(0)]) + 0.0  # no negative zeros
        if len(q) > n * len(ask):
            order = np.lexsort((reps[pick], first[pick], -s, q))
            order = order[_places(q[order]) < n]
            q, pick, s = q[order], pick[order], s[order]
        yield q + at, pick, s


def _places(q: np.ndarray) -> np.ndarray:
    """The place of each element in its run of equal ones."""
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    return np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))


class Cell:
    """The vectors of a cell by block, in their own precision."""

    def __init__(self, held: list[pa.RecordBatch], kind: str):
        blocks = np.concatenate([b.column("block").to_numpy() for b in held])
        order = np.argsort(blocks, kind="stable")
        self.vectors = np.concatenate([_from_bytes(b.column("vec"), kind) for b in held])[order]
        self.reps = np.concatenate([b.column("rep").to_numpy() for b in held])[order]
        self.first = np.concatenate([b.column("first").to_numpy() for b in held])[order]
        self.blocks, starts = np.unique(blocks[order], return_index=True)
        self.ends = np.append(starts, len(order))

    def best(self, asked: np.ndarray, sizes: np.ndarray, visits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, vector, score)``: each query's ``n`` best of the blocks it visits, ``sizes`` of ``visits`` for each query."""
        by = np.argsort(visits, kind="stable")
        who, visits = np.repeat(np.arange(len(asked)), sizes)[by], visits[by]
        least = np.full(len(asked), -np.inf)
        pending, many = [], 0
        for k in np.flatnonzero(np.isin(self.blocks, visits)):
            ask = who[np.searchsorted(visits, self.blocks[k]) : np.searchsorted(visits, self.blocks[k], "right")]
            for start in range(self.ends[k], self.ends[k + 1], ROWS):
                rows = slice(start, min(start + ROWS, self.ends[k + 1]))
                x = self.vectors[rows].astype(np.float64)
                for part in range(0, len(ask), ASKED):
                    some = ask[part : part + ASKED]
                    for q, pick, s in _block_best(asked[some], x, self.first[rows], self.reps[rows], n, least[some]):
                        pending.append((some[q], pick + start, s))
                        many += len(q)
                    if many > PENDING:
                        pending = [self.sorted(pending, n)]
                        q, _, s = pending[0]
                        last = _places(q) == n - 1
                        least[q[last]] = s[last]  # nothing below has a place any more
                        many = 0
        return self.sorted(pending, n)

    def sorted(self, pending: list, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not pending:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, at, s = (np.concatenate(each) for each in zip(*pending, strict=True))
        order = np.lexsort((self.reps[at], self.first[at], -s, q))
        q, at, s = q[order], at[order], s[order]
        r = self.reps[at]
        new = np.append(True, (q[1:] != q[:-1]) | (r[1:] != r[:-1]))[: len(q)]  # a vector found in several tables
        q, at, s = q[new], at[new], s[new]
        keep = _places(q) < n
        return q[keep], at[keep], s[keep]


def _search_cells(nearest: int, kind: str):
    """Rank the vectors of each block against the queries that visit it, and keep each query's best of the cell.

    Rows come by cell and turn, vectors before queries.  Only a cell's vectors and a bounded part of its queries are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, cell = None, [], None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("cell", "turn")], axis=1)
            asks = batch.column("query").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(names, axis=0) != 0).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for low, high in pairwise([0, *cuts.tolist(), len(asks)] if len(asks) else []):
                if now != tuple(names[low]):
                    now, held, cell = tuple(names[low]), [], None
                part = batch.slice(low, high - low)
                if not asks[low]:
                    held.append(part)
                    continue
                if held:
                    cell, held = Cell(held, kind), []
                if cell is not None:
                    yield from passing(cell, part)
        pa.default_memory_pool().release_unused()

    def passing(cell: Cell, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(queries.column("blocks")).to_numpy().astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = min(start + PASSING, max(start + 1, int(np.searchsorted(ends, before + PASSING_VISITS, "right"))))
            part = queries.slice(start, stop - start)
            asked = _from_bytes(part.column("vec"), kind).astype(np.float64)
            q, at, s = cell.best(asked, sizes[start:stop], part.column("blocks").flatten().to_numpy(), nearest + 1)
            starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
            lists = pa.ListArray.from_arrays(
                np.append(starts, len(q)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(0.0 - s), pa.array(cell.first[at]), pa.array(cell.reps[at])], ["loss", "first", "rep"]),
            )
            yield pa.RecordBatch.from_arrays([part.column("query").take(pa.array(q[starts])), lists], ["query", "best"])
            start = stop

    return run


def _blocks(vectors: DataFrame, asked: DataFrame, index: Index, total: int, cells: int) -> tuple[DataFrame, DataFrame]:
    """``(rep, first, vec, block, cell)`` of all tables, vectors as bytes, and ``(query, cell, blocks)`` of the blocks that queries visit.

    A block is what a cell holds of a bucket.  Its number is the low bits of the bucket's; the cell comes from the high ones.
    """
    indexed = _indexed(vectors, index)
    sizes = stage(indexed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    held, split = _held(sizes, total * index.tables, cells)
    part = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1)))
    cell = F.pmod(F.shiftrightunsigned("bucket", 33) + part, F.lit(cells)).cast("int").alias("cell")
    block = F.col("bucket").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("block")
    left = lookup(indexed, split, "bucket").select("rep", "first", "vec", block, cell)
    return left, _probes(asked.select("query", "vec"), index, held)


def _everything(vectors: DataFrame, asked: DataFrame, cells: int) -> tuple[DataFrame, DataFrame]:
    """The same for queries that are to be compared with all vectors: each cell is one block."""
    cell = F.pmod(F.xxhash64("rep"), F.lit(cells)).cast("int")
    named = _packed(vectors.select("rep", F.col("ids")[0].alias("first"), "vec"), "rep", "first")
    left = named.select("rep", "first", "vec", cell.alias("block"), cell.alias("cell"))
    every = asked.select("query", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"))
    return left, every.select("query", "cell", F.array("cell").alias("blocks"))


def _ranked(vectors: DataFrame, asked: DataFrame, left: DataFrame, visits: DataFrame, nearest: int, tables: int = 1) -> DataFrame:
    """``(query, query_id, rank, vec_id, score)`` from blocks and the queries that visit them; a vector is in ``tables`` cells at most."""
    visits = stage(visits, "visits")
    load = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("turns"))
    load = stage(load.filter("turns > 1"), "cells")
    turns = F.coalesce("turns", F.lit(1))
    turn = F.explode(F.sequence(F.lit(0), turns - 1)).alias("turn")
    left = lookup(left, load, "cell").select("rep", "first", "vec", "block", "cell", turn)
    turn = F.pmod(F.xxhash64("query"), turns).cast("int").alias("turn")
    vec = stage(_packed(asked, "query"), "asked")
    right = lookup(visits, load, "cell").select("query", "cell", "blocks", turn)
    right = right.join(F.broadcast(vec) if fits_broadcast(vec) else vec, "query")
    # One number to sort by: the queries of a cell come after its vectors.
    order = F.shiftleft(F.col("cell").cast("long"), 32) + F.col("turn") * 2 + F.col("query").isNotNull().cast("int")
    both = left.unionByName(right, allowMissingColumns=True).repartition("cell", "turn")
    both = both.withColumn("order", order).sortWithinPartitions("order").drop("order")
    kind = "f4" if dict(asked.dtypes)["vec"] == "array<float>" else "f8"
    found = both.mapInArrow(_search_cells(nearest, kind), "query long, best array<struct<loss:double,first:long,rep:long>>")
    # At most (nearest + 1) entries from each cell a query visits.
    merged = found.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("best"))).alias("best"))
    best = F.array_distinct(F.slice("best", 1, (nearest + 1) * tables))
    merged = merged.select("query", F.slice(best, 1, nearest + 1).alias("best"))
    each = merged.select("query", F.explode("best").alias("b")).select("query", (F.lit(0.0) - F.col("b.loss")).alias("score"), "b.rep")
    each = each.join(vectors.select("rep", "ids"), "rep").join(asked.select("query", F.col("id").alias("query_id")), "query")
    each = each.select("query", "query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= nearest)
    return ranked.select("query", "query_id", "rank", "vec_id", "score")


def fitted(vectors: DataFrame, nearest: int = NEAREST, seed: int = 7) -> Fit:
    """The fit for ``(rep, vec)``: the shells of all vectors, a sample, and the true neighbours of its first few."""
    sample = np.array([r.vec for r in vectors.orderBy("rep").limit(SAMPLE).select("vec").collect()])

    def shells(b: pa.RecordBatch) -> pa.RecordBatch:
        norm = norms(_matrix(b.column("vec")))
        return pa.RecordBatch.from_arrays([pa.array(shell_of(norm)), pa.array(norm)], ["shell", "norm"])

    top = map_arrow(vectors.select("vec"), shells, "shell long, norm double").groupBy("shell").agg(F.max("norm").alias("norm"))
    tops = {r.shell: r.norm for r in top.collect()}  # one for each power of two
    asked = sample[:ASKED_IN_FIT]
    return fit(sample, asked, _nearest_of_few(vectors, asked, nearest), tops, seed)


def search(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, seed: int = 7) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``nearest`` by inner product.

    ``queries`` is a condition on the column ``id`` that says which rows are queries.  Runs jobs: the distinct vectors, the
    fit, the bucket sizes, the visits, the neighbours found, and those of queries whose buckets hold too few.
    """
    rows = valid_vectors(df, key, vector).distinct()
    among = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(among)).filter(F.col("n") <= nearest + 1)
    vectors = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("rep", F.col("ids")[0])
    # One id may stand for several vectors: a number of its own for each vector.
    vectors = stage(vectors.withColumn("rep", F.xxhash64("rep", "vec")), "vectors")
    total, held = vectors.agg(F.count(F.lit(1)), F.sum(F.size("ids"))).first()
    if not total:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = stage(rows.filter(queries).select(F.xxhash64("id", "vec").alias("query"), "id", "vec"), "queries")
    plan = fitted(vectors, nearest, seed)
    columns = ["query_id", "rank", "vec_id", "score"]
    if plan.recall < FEWEST_FOUND:
        every = _everything(vectors, asked, int(max(CELLS, total // CELL_ROWS)))
        return _ranked(vectors, asked, *every, nearest).select(columns)
    cells = int(max(CELLS, total * plan.index.tables // CELL_ROWS))
    found = stage(_ranked(vectors, asked, *_blocks(vectors, asked, plan.index, total, cells), nearest, plan.index.tables), "neighbours")
    full = found.groupBy("query").count().filter(F.col("count") >= min(nearest, held - 1))
    short = stage(asked.join(full, "query", "left_anti"), "short")
    if short.isEmpty():
        return found.select(columns)
    rest = _ranked(vectors, short, *_everything(vectors, short, int(max(CELLS, total // CELL_ROWS))), nearest)
    return found.join(full, "query", "left_semi").unionByName(rest).select(columns)
