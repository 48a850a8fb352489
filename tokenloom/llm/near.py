"""Near duplicates by Order MinHash, verified by banded alignment.

* Each text's five-word shingles are labelled with their occurrence number.  A sketch takes the
  ``TAKEN`` shingles with the smallest hashes and keeps them in text order; two texts share it
  only if they share these shingles in this order, so it is sensitive to edit similarity.  The
  sketches are the buckets in which candidates meet.
* A candidate pair is verified by an alignment of the two shingle sequences in the band of
  diagonals that a pair above the threshold cannot leave.  The similarity is
  ``aligned / (shingles of a + shingles of b - aligned)``, at least 0.8.
* Classes are the connected components of verified links.  Equal texts are one node from the start.

Before two texts are brought together, their signatures are compared: one bit for each cell of a hash table, set if an odd number of
labelled shingles falls into the cell, so that the bits that differ are at most as many as the shingles that only one of them has.  A
pair with more than the threshold allows is no link; none is lost.

Pairs that are linked already, in one component, are never emitted.  Candidates are met in three turns:

1. Every member of a bucket meets one centre, the member whose buckets are the largest (as those of a text that the others were copied
   from are); links are verified and components joined.  A bucket of n copies of one text costs n pairs.
2. Every member meets ``CENTRES`` members outside the bucket's largest component.  A bucket no larger than its centres is done.
3. Rest: what is left are members of larger buckets outside the largest component.  One can only be linked to a text with
   which it shares one of its rarest shingles: two texts at the threshold t share at least ``t * size``
   shingles of either, so they share one among the first ``size - t * size + 1`` in any common order.  Members
   whose rare shingles (by a hashed count table of fixed size, which steers the cost only) are in no text of another
   component are done; the others meet the members of other components, signature by signature in blocks of ``BLOCK`` rows, and only
   pairs that pass are emitted.  The worst case is a bucket of many texts that are all alike below the threshold and have no rare
   shingles: their signatures are compared in pairs, because dropping one could lose a link.

Edge cases: a null or empty text, or one without words, is a class of its own row; a text
of fewer than five words is one shingle, so only equal word sequences meet; equal texts are always one class; null
ids are members like others, and a class of null ids only has a null ``class_id``; repeated rows get
a row each; an empty table gives an empty one; only the two named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import ROW, WordIds, byte_parts, column, map_arrow, mix, nested, odd_numbers, window_hashes
from tokenloom.operators.lookup import fits_broadcast
from tokenloom.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 14
TAKEN = 3
#: The count table that orders shingles: 2 ** COUNT_BITS cells in blocks of 2 ** BLOCK_BITS.
COUNT_BITS, BLOCK_BITS = 20, 16
CENTRES = 8
#: Rows of a bucket whose signatures meet at once, and cells of a signature at least and at most.
BLOCK = 4_096
LEAST_CELLS, MOST_CELLS = 64, 1 << 13

_MULTIPLIERS = odd_numbers(SHINGLE, 5)
_WORDS = WordIds()


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the runs of five words, in text order; a shorter text is one run."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    ids = _WORDS.of(words)
    if len(words) < SHINGLE:
        return window_hashes(_WORDS.low[ids], _MULTIPLIERS[: len(words)]) + np.uint64(len(words))
    return window_hashes(_WORDS.low[ids], _MULTIPLIERS)


def _runs(texts: pa.Array) -> Iterator[np.ndarray]:
    """Shingles of each text of a column."""
    for part in byte_parts(texts):
        _WORDS.trim()
        for text in part:
            yield shingles(text)


def labelled(run: np.ndarray) -> np.ndarray:
    """Each shingle with the number of its earlier occurrences."""
    order = np.argsort(run, kind="stable")
    ordered = run[order]
    first = np.append(True, ordered[1:] != ordered[:-1])
    if first.all():
        return run
    place = np.arange(len(run))
    out = np.empty_like(run)
    earlier = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    out[order] = np.where(earlier > 0, mix(ordered + earlier * _MULTIPLIERS[0]), ordered)
    return out


def sketches(marked: np.ndarray, number: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """``number`` hashes, each of the ``taken`` smallest labelled shingles kept in text order."""
    seeds = odd_numbers(number, 7)
    per = max(1, (1 << 20) // max(len(marked), 1))  # sketches made at once, so that memory stays bounded
    out = np.arange(1, number + 1, dtype=np.uint64)
    for at in range(0, number, per):
        rank = mix(marked[None, :] ^ seeds[at : at + per, None])
        if rank.shape[1] > taken:
            smallest = np.sort(np.argpartition(rank, taken - 1, axis=1)[:, :taken], axis=1)
            rank = np.take_along_axis(rank, smallest, axis=1)
        for j in range(rank.shape[1]):
            out[at : at + per] = mix(out[at : at + per] * _MULTIPLIERS[1] ^ rank[:, j])
    return out


def signature(marked: np.ndarray) -> bytes:
    """Parities of the labelled shingles by cell; about a cell for each, a power of two."""
    cells = 1 << max(LEAST_CELLS - 1, min(MOST_CELLS, len(marked)) - 1).bit_length()
    odd = np.bincount((marked & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Signatures (rows of 64-bit words) as they would be with fewer cells."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def least_common(sizes, threshold: float = THRESHOLD):
    """How many shingles two texts with so many in all have to share."""
    return np.ceil(threshold / (1 + threshold) * sizes - 1e-9)


def may_be_similar(x: list[bytes], y: list[bytes], x_size: np.ndarray, y_size: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of signatures leave enough shingles to be shared."""
    ok = np.zeros(len(x), bool)
    widths = np.array([[len(s) for s in x], [len(s) for s in y]]).reshape(2, -1)
    for pair in np.unique(widths, axis=1).T:
        at = np.flatnonzero((widths == pair[:, None]).all(axis=0))
        a, b = (np.frombuffer(b"".join([side[i] for i in at]), np.uint64).reshape(len(at), -1) for side in (x, y))
        width = min(a.shape[1], b.shape[1])
        differ = np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum(axis=1)
        total = x_size[at] + y_size[at]
        ok[at] = (total - differ) // 2 >= least_common(total, threshold)
    return ok


def _in_order(a: np.ndarray, b: np.ndarray, up: int, down: int) -> int | None:
    """The aligned number if no shingle is repeated and the shared ones are in one order within the band, else nothing."""
    order = np.argsort(b)
    ordered = b[order]
    if (ordered[1:] == ordered[:-1]).any():
        return None
    at = np.minimum(np.searchsorted(ordered, a), len(b) - 1)
    i = np.flatnonzero(ordered[at] == a)
    j = order[at[i]]
    if len(i) and ((j[1:] <= j[:-1]).any() or (i - j).max() > up or (j - i).max() > down):
        return None
    return len(i)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two runs share, repeated ones as often as both have them."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> int:
    """Longest common subsequence of two shingle sequences inside the band, bit-parallel; 0 if out of reach.

    At ``threshold`` at least ``least`` shingles are aligned, so a pair that qualifies is at most
    ``len(b) - least`` (or ``len(a) - least``) off the main diagonal.  Only the columns in the band are held.
    """
    least = int(least_common(len(a) + len(b), threshold))
    if least > min(len(a), len(b)):
        return 0
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    head = int(np.argmax(differ)) if differ.any() else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = a[len(a) - n :][::-1] != b[len(b) - n :][::-1]
    tail = int(np.argmax(differ)) if differ.any() else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    same = head + tail
    if not len(a) or not len(b):
        return same
    up, down = len(a) + same - least, len(b) + same - least
    found = _in_order(a, b, up, down)
    if found is not None:
        return same + found
    if _common(a, b) < least - same:
        return 0
    return same + _in_band(a, b, up, down, least - same)


def _in_band(a: np.ndarray, b: np.ndarray, up: int, down: int, least: int) -> int:
    """The longest common subsequence inside the band, or 0 once ``least`` cannot be reached.

    ``v`` holds the columns from ``low`` to ``high``; a column left of it keeps its bit for good.
    """
    order = np.argsort(b, kind="stable")
    ordered = b[order]
    first, last = np.searchsorted(ordered, a).tolist(), np.searchsorted(ordered, a, "right").tolist()
    wide: dict[int, int] = {}  # masks over all columns of shingles that are repeated very often, few as they are
    v = low = high = found = 0
    for i, (start, end) in enumerate(zip(first, last, strict=True)):
        to = min(len(b), i + down + 1)
        if to > high:
            v |= ((1 << (to - high)) - 1) << (high - low)
            high = to
        to = min(max(0, i - up), high)
        if to > low:
            gone = to - low
            found += gone - (v & ((1 << gone) - 1)).bit_count()
            v >>= gone
            low = to
        if start == end:
            continue
        m, full = 0, (1 << (high - low)) - 1
        if end - start <= 64:
            for j in order[start:end].tolist():
                if low <= j < high:
                    m |= 1 << (j - low)
        else:
            if start not in wide:
                bits = np.zeros(len(b), np.uint8)
                bits[order[start:end]] = 1
                wide[start] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            m = (wide[start] >> low) & full
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
        if i % 512 == 511 and found + high - low - v.bit_count() + len(a) - i - 1 < least:
            return 0
    return found + high - low - v.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    if not len(a) or not len(b):
        return False
    m = aligned(a, b, threshold)
    return m >= threshold * (len(a) + len(b) - m)


# --- distributed part -------------------------------------------------------


def _node(text):
    """128 bits of a text, by which equal texts are one node; null where there is no word."""
    return F.when(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), F.unhex(F.md5(text)))


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, node, size, keys, sig)`` of each row with a word; ``size`` counts shingles."""
    kind = docs.schema[key].dataType.simpleString()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sizes, found, signed = [], [], []
        for run in _runs(b.column("text")):
            marked = labelled(run)
            sizes.append(len(run))
            found.append(sketches(marked))
            signed.append(signature(marked))
        keys = np.concatenate(found).view(np.int64)
        arrays = [
            b.column("id"),
            b.column("node"),
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(np.arange(0, len(keys) + 1, SKETCHES, dtype=np.int32), keys),
            pa.array(signed, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["id", "node", "size", "keys", "sig"])

    light = docs.select(column(key).alias("id"), _node(column(text)).alias("node"), column(text).alias("text"))
    return map_arrow(light.filter("node IS NOT NULL"), batch, f"id {kind}, node binary, size long, keys array<bigint>, sig binary")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The similar ones of the short names ``(a, b)``, as nodes; each text travels only to its pairs."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        both = zip(_runs(b.column("text_a")), _runs(b.column("text_b")), strict=True)
        ok = [similar(x, y, threshold) for x, y in both]
        found = pa.RecordBatch.from_arrays([b.column("node_a"), b.column("node_b")], ["a", "b"])
        return found.filter(pa.array(ok, pa.bool_()))

    def side(name: str) -> DataFrame:
        return texts.select(F.col("short").alias(name), F.col("node").alias(f"node_{name}"), F.col("text").alias(f"text_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return map_arrow(both.select("node_a", "node_b", "text_a", "text_b"), batch, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` of each node of the links ``(a, b)``: the smallest node connected to it.

    Each turn takes the smallest label among the neighbours and then the label of that label, so
    the turns grow with the logarithm of a component's diameter.  Nothing comes to the driver but a count.
    """
    both = stage(links.union(links.select("b", "a")), "links")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        joined = labels.join(near, labels["node"] == near["a"], "left").select("node", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("jump"))
        moved = joined.join(jump, "next").select("node", F.col("jump").alias("comp"), F.col("comp").alias("old"))
        moved = stage(moved, "labels")
        changed = not moved.filter("comp <> old").isEmpty()
        labels = moved.select("node", "comp")
        if not changed:
            return labels


def _members(sketched: DataFrame) -> DataFrame:
    """``(bucket, node, id, size, sig, keys, score)`` of the buckets with two nodes or more; ``id`` is the node's smallest.

    ``score`` adds up the sizes of a node's buckets: a text that others were copied from shares sketches with most of them.
    """
    same = [F.min(c).alias(c) for c in ("id", "size", "keys", "sig")]
    nodes = stage(sketched.groupBy("node").agg(*same), "nodes")
    each = nodes.select("node", F.explode(F.array_distinct("keys")).alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = each.join(shared, "bucket").groupBy("node").agg(F.sum("n").alias("score"), F.sort_array(F.collect_list("bucket")).alias("keys"))
    return nodes.drop("keys").join(kept, "node").select(F.explode("keys").alias("bucket"), "node", "id", "size", "sig", "keys", "score")


def _pair(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _placed(members: DataFrame, comps: DataFrame | None, done: int) -> DataFrame:
    """Members of the buckets that have several components and more than ``done`` members.

    Adds ``comp`` and ``minor``, which is false in the bucket's largest component.
    """
    if comps is None:
        return members.withColumns({"comp": F.col("node"), "minor": F.lit(True)})
    named = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    parts = named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).getField("comp").alias("largest"), F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n")
    )
    unfinished = named.join(buckets.filter((F.col("comps") > 1) & (F.col("n") > done)).select("bucket", "largest"), "bucket")
    return unfinished.withColumn("minor", F.col("comp") != F.col("largest")).drop("largest")


def _star(placed: DataFrame, number: int, threshold: float) -> DataFrame:
    """``(a, b)``: members of a bucket with its ``number`` centres, if components differ and sizes and signatures allow a link."""
    first = Window.partitionBy("bucket").orderBy(F.desc("score"), F.asc_nulls_last("id"), "node")
    centres = placed.filter("minor").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= number)
    centres = centres.select("bucket", *[F.col(c).alias(f"c_{c}") for c in ("node", "comp", "size", "sig")])
    reach = F.least("size", "c_size") >= threshold * F.greatest("size", "c_size")
    met = placed.join(centres, "bucket").filter((F.col("comp") != F.col("c_comp")) & reach)
    met = met.select(F.xxhash64("node").alias("x"), F.xxhash64("c_node").alias("y"), "size", "c_size", "sig", "c_sig")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [b.column(c).to_numpy() for c in ("size", "c_size")]
        ok = may_be_similar(b.column("sig").to_pylist(), b.column("c_sig").to_pylist(), *sizes, threshold)
        return b.select(["x", "y"]).filter(pa.array(ok))

    return map_arrow(met, batch, "x long, y long").select(*_pair("x", "y")).distinct()


def _shingle_counts(texts: DataFrame) -> np.ndarray:
    """How often shingles fall into each cell of a hashed table; the blocks are summed by key."""
    size, number = 1 << BLOCK_BITS, 1 << (COUNT_BITS - BLOCK_BITS)

    def count(batches):
        table = np.zeros(1 << COUNT_BITS, np.uint32)
        for b in batches:
            for run in _runs(b.column("text")):
                np.add.at(table, _cells(run), 1)
        small = np.minimum(table, 0xFFFF).astype(np.uint16).reshape(number, size)
        rows = [(i, zlib.compress(x.tobytes(), 1)) for i, x in enumerate(small) if x.any()]
        arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(size, np.uint32)
        for b in batches:
            block = b.column("block")[0].as_py()
            for x in b.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(x), np.uint16)
        arrays = [pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "counts"])

    schema = "block int, counts binary"
    table = np.zeros((number, size), np.uint32)
    for r in texts.select("text").mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema).collect():
        table[r.block] = np.frombuffer(bytes(r.counts), np.uint32)
    return table.ravel()


def _cells(run: np.ndarray) -> np.ndarray:
    return (mix(run) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def prefix(run: np.ndarray, counts: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The labelled shingles of which a text shares one with any text at the threshold, in the common order."""
    marked = labelled(run)
    n = len(marked) - int(np.ceil(threshold * len(marked) - 1e-9)) + 1
    return marked[np.lexsort((marked, counts[_cells(marked)]))[:n]]


def _alive(placed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``(short)``: nodes that share a prefix shingle with a node of another component."""
    nodes = placed.select("node", "comp").distinct()
    rows = stage(texts.join(nodes, "node").select("short", F.xxhash64("comp").alias("comp"), "text"), "rest")
    shared = placed.sparkSession.sparkContext.broadcast(_shingle_counts(rows))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        firsts = [prefix(run, shared.value, threshold) for run in _runs(b.column("text"))]
        take = pa.array(np.repeat(np.arange(len(firsts)), [len(f) for f in firsts]))
        arrays = [pa.array(np.concatenate(firsts).view(np.int64)), b.column("short").take(take), b.column("comp").take(take)]
        return pa.RecordBatch.from_arrays(arrays, ["shingle", "short", "comp"])

    entries = stage(map_arrow(rows, batch, "shingle long, short long, comp long"), "prefixes")
    comps = entries.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    met = entries.join(comps.filter("low <> high").select("shingle"), "shingle")
    return met.select("short").distinct()


def _rest(placed: DataFrame, alive: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: members outside a bucket's largest component with those of other components that sizes and signatures allow.

    A bucket is dealt in blocks of about ``BLOCK`` rows; every block of the one side meets every block of the other in a
    stream, and only pairs that may be links are emitted.
    """
    rows = placed.withColumn("short", F.xxhash64("node")).join(alive, "short")
    rows = stage(rows.select("short", "bucket", F.xxhash64("comp").alias("comp"), "size", "minor", "sig", "keys"), "rest")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    dealt = rows.join(sizes.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "bucket")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("short"), "parts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    columns = ["bucket", "left", "right", "side", "short", "comp", "size", "sig", "keys"]
    one = dealt.filter("minor").withColumn("right", every).withColumns({"left": F.col("own"), "side": F.lit(0)}).select(*columns)
    other = dealt.withColumn("left", every).withColumns({"right": F.col("own"), "side": F.lit(1)}).select(*columns)
    both = one.unionByName(other).repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asked = None, []
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in ("bucket", "left", "right")], strict=True))
            rest = list(zip(*[b.column(c).to_pylist() for c in ("side", "short", "comp", "size", "sig", "keys")], strict=True))
            found: list[tuple[int, int]] = []
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != block:
                    block, asked = keys[at], []
                asked += [r for r in rest[at:end] if r[0] == 0]  # the first side of a block comes before the other
                found += _met(block[0], asked, [r for r in rest[at:end] if r[0] == 1], threshold)
                at = end
            arrays = [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["x", "y"])

    return both.mapInArrow(run, "x long, y long").select(*_pair("x", "y")).distinct()


def _met(bucket: int, asked: list[tuple], others: list[tuple], threshold: float) -> list[tuple[int, int]]:
    """Pairs of ``(side, short, comp, size, sig, keys)`` of different components that may be links, in the first bucket they share."""
    found = []
    by_width: dict[int, list[tuple]] = {}
    for r in others:
        by_width.setdefault(len(r[4]), []).append(r)
    for mates in by_width.values():
        comps, sizes = (np.array([r[i] for r in mates], np.int64) for i in (2, 3))
        signs = np.frombuffer(b"".join(r[4] for r in mates), np.uint64).reshape(len(mates), -1)
        folded = {signs.shape[1]: signs}
        for _, short, comp, size, sig, keys in asked:
            own = np.frombuffer(sig, np.uint64).reshape(1, -1)
            width = min(own.shape[1], signs.shape[1])
            if width not in folded:
                folded[width] = _folded(signs, width)
            total = sizes + size
            at = np.flatnonzero((comps != comp) & (np.minimum(sizes, size) >= threshold * np.maximum(sizes, size)))
            differ = np.bitwise_count(folded[width][at] ^ _folded(own, width)).sum(axis=1)
            at = at[(total[at] - differ) // 2 >= least_common(total[at], threshold)]
            keys = set(keys)
            found += [(short, mates[i][1]) for i in at.tolist() if min(keys.intersection(mates[i][5])) == bucket]
    return found


def _texts(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """``(short, node, text)`` of the members, from the row with the node's smallest id."""
    first = stage(members.select("node", "id").distinct().select(_row_key("node", "id").alias("k")), "candidates")
    rows = docs.select(column(key).alias("id"), _node(column(text)).alias("node"), column(text).alias("text"))
    named = rows.withColumn("k", _row_key("node", "id")).join(_measured(first), "k")
    return named.select(F.xxhash64("node").alias("short"), "node", "text")


def _measured(table: DataFrame) -> DataFrame:
    """Mark a table for broadcast if it measures small enough; beyond that both sides are shuffled."""
    return F.broadcast(table) if fits_broadcast(table) else table


def _row_key(node: str, key: str):
    return F.concat_ws(":", F.hex(node), F.coalesce(F.col(key).cast("string"), F.lit("null")))


def _labels(docs: DataFrame, sketched: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """``(node, comp)`` of the nodes with a link."""
    members = stage(_members(sketched), "members")
    texts = stage(_texts(docs, members, key, text), "texts")
    links, comps = None, None
    for done, centres in ((0, 1), (2, CENTRES)):
        placed = _placed(members, comps, done)
        found = stage(_verified(stage(_star(placed, centres, threshold), "pairs"), texts, threshold), "verified")
        if links is not None and found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        comps = components(links)
    placed = stage(_placed(members, comps, CENTRES + 1), "unfinished")
    if placed.isEmpty():
        return comps
    pairs = stage(_rest(placed, _alive(placed, texts, threshold), threshold), "pairs")
    more = stage(_verified(pairs, texts, threshold), "verified")
    return comps if more.isEmpty() else components(links.unionByName(more))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, node, class_id, class_node)`` of each row.

    ``class_id`` is the smallest id of the row's class and ``class_node`` the text it belongs to; a row without words
    is a class of its own and has no node.  Runs jobs: sketches, candidates, links and components.
    """
    sketched = stage(sketch(docs, key, text), "sketches")
    labels = _labels(docs, sketched, key, text, threshold)
    nodes = sketched.groupBy("node").agg(F.min("id").alias("id")).join(labels, "node", "left")
    nodes = stage(nodes.withColumn("comp", F.coalesce("comp", "node")), "nodes")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "node")).alias("first")
    heads = nodes.groupBy("comp").agg(first)
    heads = heads.select("comp", F.col("first.id").alias("class_id"), F.col("first.node").alias("class_node"))
    named = stage(nodes.join(heads, "comp").select("node", "class_id", "class_node"), "named")
    found = sketched.select("id", "node").join(named, "node").select("id", "node", "class_id", "class_node")
    blank = docs.select(column(key).alias("id"), _node(column(text)).alias("node")).filter("node IS NULL")
    return found.unionByName(blank.withColumns({"class_id": F.col("id"), "class_node": F.lit(None).cast("binary")}))


def class_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(key, class_id)`` of each row; rows of one near-duplicate class share the smallest id among them."""
    return classes(docs, key, text, threshold).select(F.col("id").alias(key), "class_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, one for each near-duplicate class (the one with the smallest id), with all columns.

    Rows without words all stay.
    """
    found = classes(docs, key, text, threshold).filter("node IS NOT NULL")
    by_row = found.select(_row_key("node", "id").alias("k"), (_row_key("class_node", "class_id") == _row_key("node", "id")).alias("head"))
    heads = stage(by_row.filter("head").groupBy("k").agg(F.count(F.lit(1)).alias("times")), "heads")
    rows = docs.select(nested(docs), column(key).alias("id"), _node(column(text)).alias("node"))
    kept = rows.filter("node IS NOT NULL").withColumn("k", _row_key("node", "id")).join(_measured(heads), "k")
    copies = Window.partitionBy("k").orderBy(F.xxhash64(ROW))
    repeated = kept.filter("times > 1").withColumn("copy", F.row_number().over(copies)).filter("copy = 1")
    parts = [kept.filter("times = 1"), repeated, rows.filter("node IS NULL")]
    return reduce(DataFrame.unionByName, [p.select(f"{ROW}.*") for p in parts])
