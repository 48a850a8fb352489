"""Conversation structure repair: cheapest edits by auction shortest paths over a lattice of rows and states.

A conversation is to read ``(s?(ua)+)?`` in the initials of its roles.  Nodes of the lattice are (row, state); arcs keep, rerole or
delete a row or insert an empty one, at whole-number costs.  A path starts at an entry node and is extended along the arc of least
cost plus price of its head; where a node's price is below that, the price is raised and the path contracted.  When it ends, prices are
dual feasible and the arcs of every cheapest path are tight, so the path whose labels come first in ASCII order is traced over tight arcs alone.
The lattice is cut into blocks of ``BLOCK`` rows, from the last one; the entry prices of a block are the exit prices of the one before it.

Conversations of any length: rows travel without their texts, as one byte each.  A range partitioning of (conversation, turn) spreads a long
conversation over many tasks and cuts it into chunks of at most ``CHUNK`` rows.  Chunks that are whole conversations are solved at once.  For the
others each task finds the costs between all entry and exit states, a small table for each conversation turns these into exit prices, and each
task traces its chunk for every entry state.  Only the edited rows themselves are read in one stream for each conversation, as a digest of
a whole conversation is made in order; memory there does not grow with its rows, but for the edits (a byte for each).

Order of rows: turn (nulls first), then role, then the md5 of the text; rows equal in all of these follow each other.  Faults, the first that
holds counts: blank (no character but white space), duplicate (role and text seen earlier in the conversation), truncated (the last character
that is not white space is none of ``.!?``).

Edge cases: nulls in role and text are one space, a null id is a conversation of its own; a conversation without rows has zeros, no
edits and no text; repeated rows are duplicates; an empty table gives an empty one; only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import column, map_arrow
from tokenloom.staging import stage

BLOCK = 16
CHUNK = 1 << 16
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
WHITE = " \t\n\x0b\x0c\r"
ROLES = ("user", "assistant")

#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the next user or assistant row.
NEXT = (USER, USER, ASSISTANT, USER)
NONE, BLANK, DUPLICATE, CUT = range(4)
OTHER = 3
#: Followers of a row by initial: s, u, a, other.
LEGAL = frozenset(((0, 1), (1, 2), (2, 1)))
INFINITE = float("inf")

Arc = tuple[int, int, str]  # cost, head, label


# --- the lattice ------------------------------------------------------------------


def row_arcs(code: int, state: int) -> list[tuple[int, int, str]]:
    """``(cost, next state, label)`` of what may be done with a row: ``code`` is ``fault * 4 + initial``."""
    fault, initial = divmod(code, 4)
    arcs = [(DELETE, state, "D")]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        expected = 2 if state == USER else 1
        if initial == expected:
            arcs.append((extra, NEXT[state], "K"))
        elif initial == 0 and state == START:
            arcs.append((extra, SYSTEM, "K"))
        arcs.append((REROLE + extra, NEXT[state], "R"))
    return arcs


_ROW = [[row_arcs(code, state) for state in range(4)] for code in range(16)]


def auction(origin: int, arcs: list[list[Arc]], price: list[float], settled: list[bool]) -> None:
    """Raise prices until the cheapest path from ``origin`` to a settled node is known, and settle its nodes.

    Prices are at most ``cost + price of the head`` for every arc, before and after.
    """
    path = [origin]
    while not settled[path[-1]]:
        tail = path[-1]
        best, head = INFINITE, -1
        for cost, to, _ in arcs[tail]:
            if cost + price[to] < best:
                best, head = cost + price[to], to
        if price[tail] < best:
            price[tail] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)
    for node in path:
        settled[node] = True


def _leads_on(arcs: list[list[Arc]], ends: list[bool]) -> list[bool]:
    """Which nodes have a path to an end."""
    can, grown = list(ends), True
    while grown:
        grown = False
        for i in reversed(range(len(arcs))):
            if not can[i] and any(can[to] for _, to, _ in arcs[i]):
                can[i] = grown = True
    return can


def _first_path(node: int, arcs: list[list[Arc]], price: list[float], ends: list[bool]) -> tuple[str, int]:
    """``(labels, end)`` of the tight path to an end whose labels come first."""
    known: dict[int, bool] = {}

    def tight(i: int) -> list[Arc]:
        return [arc for arc in arcs[i] if price[i] == arc[0] + price[arc[1]]]

    def good(i: int) -> bool:
        if i not in known:
            known[i] = ends[i] or any(good(to) for _, to, _ in tight(i))
        return known[i]

    labels = []
    while not ends[node]:
        _, node, label = min((arc for arc in tight(node) if good(arc[1])), key=lambda arc: arc[2])
        labels.append(label)
    return "".join(labels), node


def _solve(arcs: list[list[Arc]], exits: dict[int, float]) -> list[tuple[float, str, int]]:
    """``(cost, labels, exit)`` from each of the four entry nodes 0 to 3; an unreachable exit costs infinity."""
    ends = [i in exits for i in range(len(arcs))]
    can = _leads_on(arcs, ends)
    arcs = [[arc for arc in out if can[arc[1]]] for out in arcs]
    price = [exits.get(i, min(exits.values())) for i in range(len(arcs))]  # dual feasible, as no cost is negative
    settled = list(ends)
    found = []
    for entry in range(4):
        if can[entry]:
            auction(entry, arcs, price, settled)
            found.append((price[entry], *_first_path(entry, arcs, price, ends)))
        else:
            found.append((INFINITE, "", entry))
    return found


@lru_cache(maxsize=1 << 16)
def _block(codes: bytes, terminal: tuple[float, ...]) -> tuple[tuple[float, str, int], ...]:
    """``(cost, labels, exit state)`` for each entry state of some rows, given the cost from each exit state on."""
    arcs: list[list[Arc]] = []
    for i, code in enumerate(codes):
        for state in range(4):
            on = [(cost, 4 * (i + 1) + to, label) for cost, to, label in _ROW[code][state]]
            arcs.append([*on, (INSERT, 4 * i + NEXT[state], "I")])
    last = 4 * len(codes)
    arcs += [[] for _ in range(4)]
    found = _solve(arcs, {last + q: cost for q, cost in enumerate(terminal) if cost < INFINITE})
    return tuple((cost, labels, end % 4) for cost, labels, end in found)


def _ending() -> list[tuple[float, str, int]]:
    """What is left after the last row, by state: only insertions."""
    arcs: list[list[Arc]] = [[(INSERT, NEXT[q], "I")] for q in range(4)] + [[]]
    for q in (START, ASSISTANT):
        arcs[q].append((0, 4, ""))
    return _solve(arcs, {4: 0})


ENDING = _ending()
FINAL = tuple(cost for cost, _, _ in ENDING)


def solve(codes: bytes, terminal: tuple[float, ...] = FINAL) -> list[tuple[float, str, int]]:
    """``(cost, edits, exit state)`` for each entry state of a run of rows, given the cost from each exit state on."""
    made, after = [], terminal
    for at in reversed(range(0, len(codes), BLOCK)):
        least = min(after)  # prices count from the cheapest exit on, so that alike blocks are solved once
        block = _block(codes[at : at + BLOCK], tuple(c - least for c in after))
        after = tuple(cost + least for cost, _, _ in block)
        made.append(block)
    out = []
    for entry in range(4):
        state, edits = entry, []
        if after[entry] < INFINITE:
            for block in reversed(made):
                _, labels, state = block[state]
                edits.append(labels)
        out.append((after[entry], "".join(edits), state))
    return out


def solve_whole(codes: bytes) -> tuple[int, str]:
    """``(cost, edits)`` of a whole conversation."""
    cost, edits, state = solve(codes)[START]
    return int(cost), edits + ENDING[state][1]


def exit_costs(codes: bytes) -> list[list[float]]:
    """Cost of each exit state (outer) from each entry state (inner)."""
    only = [tuple(0 if q == end else INFINITE for q in range(4)) for end in range(4)]
    return [[cost for cost, _, _ in solve(codes, terminal)] for terminal in only]


def illegal_pairs(codes: bytes) -> int:
    initials = [c & 3 for c in codes]
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


def counts(codes: bytes) -> list[int]:
    """Blank, duplicate and truncated rows, and illegal pairs."""
    faults = [c >> 2 for c in codes]
    return [faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal_pairs(codes)]


# --- rows without texts -------------------------------------------------------------


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text)`` with a twentieth of the rows each dropped, emptied, cut, repeated or given to the user."""

    def named(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    rows = df.select(column(conv).alias("conv"), column(turn).alias("turn"), named(column(role)).alias("role"), named(column(text)).alias("text"))
    rows = rows.withColumn("part", F.crc32(F.concat(named(F.col("conv")), F.lit(":"), named(F.col("turn")))) % 20).filter("part <> 0")
    times = F.when(F.col("part") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    damaged = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    owner = F.when(F.col("part") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv", "turn", owner.alias("role"), damaged.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _plain(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text)`` as they are, nulls in role and text as one space."""
    filled = [F.coalesce(column(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    return df.select(column(conv).alias("conv"), column(turn).alias("turn"), *filled)


def _coded(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, h, code, n, first)``: equal rows of a turn once, with their number.

    ``code`` is that of a row seen first; ``first`` says whether the earliest of the rows is.
    """
    bare = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), NONE).otherwise(CUT)
    light = rows.select("conv", "turn", "role", F.unhex(F.md5("text")).alias("h"), (fault * 4 + number).alias("code"))
    light = light.groupBy("conv", "turn", "role", "h").agg(F.min("code").alias("code"), F.count(F.lit(1)).alias("n"))
    light = stage(light, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("named"), "turn")
    early = light.groupBy("conv", "role", "h").agg(F.min(place).alias("early"))
    early = early.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("hash"), "early")
    met = light.join(early, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("hash")))
    first = F.col("early.turn").eqNullSafe(F.col("turn"))
    return stage(met.select("conv", "turn", "role", "h", "code", "n", first.alias("first")), "coded")


def _expanded(code: int, n: int, first: bool) -> bytes:
    again = code if code >> 2 == BLANK else DUPLICATE * 4 + (code & 3)
    return bytes([code]) * first + bytes([again]) * (n - first)


def _chunks(coded: DataFrame, most: int) -> DataFrame:
    """``(uid, conv, place, codes)``: runs of at most ``most`` rows of a conversation, in the order of ``place``."""
    kinds = {f.name: f.dataType.simpleString() for f in coded.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        open_, types = None, None  # conversation, place of the first row, codes

        def record(done: list) -> pa.RecordBatch:
            nonlocal made
            arrays = [
                pa.array([f"{part}-{made + i}" for i in range(len(done))]),
                pa.array([d[0] for d in done], types["conv"]),
                pa.array([d[1][0] for d in done], types["turn"]),
                pa.array([d[1][1] for d in done], pa.string()),
                pa.array([d[1][2] for d in done], pa.binary()),
                pa.array([made + i for i in range(len(done))], pa.int64()),
                pa.array([bytes(d[2]) for d in done], pa.binary()),
            ]
            made += len(done)
            return pa.RecordBatch.from_arrays(arrays, ["uid", "conv", "turn", "role", "h", "sub", "codes"])

        for b in batches:
            types = {f.name: f.type for f in b.schema}
            done = []
            for conv, turn, role, h, code, n, first in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True):
                left, seen = n, first
                while left:
                    if open_ is None or open_[0] != conv or len(open_[2]) >= most:
                        if open_ is not None:
                            done.append(open_)
                        open_ = (conv, (turn, role, h), bytearray())
                    take = min(left, most - len(open_[2]))
                    open_[2].extend(_expanded(code, take, seen))
                    left, seen = left - take, False
            if done:
                yield record(done)
        if open_ is not None:
            yield record([open_])

    order = ("conv", "turn", "role", "h")
    placed = coded.select(*order, "code", "n", "first").repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, f"uid string, conv {kinds['conv']}, turn {kinds['turn']}, role string, h binary, sub long, codes binary")


_REPORT = ("blank", "duplicate", "truncated", "illegal", "cost")


def _report_schema(kind: str) -> str:
    return f"conv {kind}, {', '.join(f'{c} long' for c in _REPORT)}, audit string"


def _whole(chunks: DataFrame, kind: str) -> DataFrame:
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for codes in b.column("codes").to_pylist():
            cost, audit = solve_whole(codes)
            rows.append((*counts(codes), cost, audit))
        arrays = [b.column("conv"), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], pa.array([r[5] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["conv", *_REPORT, "audit"])

    return map_arrow(chunks.select("conv", "codes"), batch, _report_schema(kind))


def _by_place(t: pa.Table) -> pa.Table:
    """The chunks of a conversation in order; null turns first."""
    named = pa.array([x is not None for x in t.column("turn").to_pylist()])
    return t.append_column("named", named).sort_by([(c, "ascending") for c in ("named", "turn", "role", "h", "sub")])


def _pieces(chunks: DataFrame, kind: str) -> DataFrame:
    """Reports of conversations that are cut into several chunks, as :func:`_whole` gives them."""

    def matrices(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [[c if c < INFINITE else -1 for row in exit_costs(codes) for c in row] for codes in b.column("codes").to_pylist()]
        names = ["uid", "conv", "turn", "role", "h", "sub"]
        costs = pa.array([[int(c) for c in f] for f in found], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*[b.column(n) for n in names], costs], [*names, "costs"])

    def onward(t: pa.Table) -> pa.Table:
        t = _by_place(t)
        after, out = FINAL, []
        for costs in reversed(t.column("costs").to_pylist()):
            out.append(list(after))
            by_end = [[c if c >= 0 else INFINITE for c in costs[4 * end : 4 * end + 4]] for end in range(4)]
            after = tuple(min(by_end[end][q] + after[end] for end in range(4)) for q in range(4))
        terminal = pa.array([[int(c) for c in o] for o in reversed(out)], pa.list_(pa.int64()))
        return pa.Table.from_arrays([t.column("uid"), terminal], ["uid", "terminal"])

    def traced(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [solve(codes, tuple(t)) for codes, t in zip(b.column("codes").to_pylist(), b.column("terminal").to_pylist(), strict=True)]
        names = ["conv", "turn", "role", "h", "sub"]
        codes = b.column("codes").to_pylist()
        more = [
            pa.array([[e for _, e, _ in r] for r in rows], pa.list_(pa.string())),
            pa.array([[s for _, _, s in r] for r in rows], pa.list_(pa.int32())),
            pa.array([int(r[START][0]) for r in rows], pa.int64()),
            pa.array([counts(c) for c in codes], pa.list_(pa.int64())),
            pa.array([[c[0] & 3, c[-1] & 3] for c in codes], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays([*[b.column(n) for n in names], *more], [*names, "edits", "exits", "cost", "counts", "ends"])

    def joined(t: pa.Table) -> pa.Table:
        t = _by_place(t)
        state, edits, total, last = START, [], [0, 0, 0, 0], None
        for e, exits, n, (head, tail) in zip(*[t.column(c).to_pylist() for c in ("edits", "exits", "counts", "ends")], strict=True):
            edits.append(e[state])
            state = exits[state]
            total = [a + b for a, b in zip(total, n, strict=True)]
            total[3] += last is not None and (last, head) not in LEGAL
            last = tail
        audit = "".join(edits) + ENDING[state][1]
        values = [*total, t.column("cost")[0].as_py()]
        arrays = [t.column("conv").slice(0, 1).combine_chunks(), *[pa.array([v], pa.int64()) for v in values], pa.array([audit])]
        return pa.Table.from_arrays(arrays, ["conv", *_REPORT, "audit"])

    turn = chunks.schema["turn"].dataType.simpleString()
    place = f"conv {kind}, turn {turn}, role string, h binary, sub long"
    exits = map_arrow(chunks, matrices, f"uid string, {place}, costs array<long>")
    after = stage(exits.groupBy("conv").applyInArrow(onward, "uid string, terminal array<long>"), "exits")
    edited = map_arrow(
        chunks.join(after, "uid"), traced,
        f"{place}, edits array<string>, exits array<int>, cost long, counts array<long>, ends array<int>",
    )
    return edited.groupBy("conv").applyInArrow(joined, _report_schema(kind))


def reports(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of the conversations of ``(conv, turn, role, text)``.

    ``audit`` holds the cheapest edits' initials (D, I, K, R) in order.  Staged; runs jobs.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    coded = _coded(rows)
    chunks = stage(_chunks(coded, chunk), "chunks")
    cut = chunks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv").alias("c"))
    cut = stage(cut, "cut")
    if cut.isEmpty():
        found = _whole(chunks, kind)
    else:
        same = F.col("conv").eqNullSafe(F.col("c"))
        pieces = stage(chunks.join(cut, same, "left_semi"), "pieces")
        found = _whole(chunks.join(cut, same, "left_anti"), kind).unionByName(_pieces(pieces, kind))
    spans = coded.groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
    gaps = F.coalesce(F.col("high").cast("long") - F.col("low").cast("long") + 1 - F.col("turns"), F.lit(0).cast("long"))
    spans = spans.select(F.col("conv").alias("c"), gaps.alias("gaps"))
    both = found.join(spans, F.col("conv").eqNullSafe(F.col("c")))
    return stage(both.select("conv", "gaps", *_REPORT, "audit"), "reports")


# --- the edited rows ----------------------------------------------------------------


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of ``(conversation, role, text)``; ``(conversation, None, None)`` ends one.

    A conversation comes as a row of kind 0, whose text is its edits, and then its rows in order.
    """
    conv, audit, at, state, begun = None, "", 0, START, False

    def step(row: tuple[str, str] | None) -> Iterator[tuple]:
        """Insertions before a row (or at the end), and the row itself."""
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield conv, ROLES[state == USER], ""
            state, at = NEXT[state], at + 1
        if row is not None:
            edit, at = audit[at], at + 1
            if edit == "K":
                yield conv, *row
                state = SYSTEM if state == START and row[0][:1] == "s" else NEXT[state]
            elif edit == "R":
                yield conv, ROLES[state == USER], row[1]
                state = NEXT[state]

    for b in batches:
        out = []
        for c, kind, role, text in zip(*[b.column(n).to_pylist() for n in ("conv", "kind", "role", "text")], strict=True):
            if kind:
                out.extend(step((role, text)))
                continue
            if begun:
                out.extend(step(None))
                out.append((conv, None, None))
            conv, audit, at, state, begun = c, text, 0, START, True
        yield out
    if begun:
        yield [*step(None), (conv, None, None)]


def _ordered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Edits and rows of each conversation, in one partition and in order."""
    turn = rows.schema["turn"].dataType
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(turn).alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("h"), F.col("audit").alias("text"))
    every = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.md5("text")).alias("h"), "text")
    every = heads.unionByName(every).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "h")
    return every.select("conv", "kind", "role", "text")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv, position, role, text)``: the conversations after the edits of :func:`reports`."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, position = {}, 0

        def seen(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in each:
                types["conv"] = b.schema.field("conv").type
                yield b

        for out in _edited(seen(batches)):
            lines = []
            for conv, role, text in out:
                if role is None:
                    position = 0
                    continue
                lines.append((conv, position, role, text))
                position += 1
            arrays = [pa.array([x[i] for x in lines], t) for i, t in enumerate((types["conv"], pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "position", "role", "text"])

    return _ordered(rows, found).mapInArrow(run, f"conv {kind}, position long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)`` of the lines ``role:text`` of each repaired conversation."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, digest, begun = {}, hashlib.sha256(), False

        def seen(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in each:
                types["conv"] = b.schema.field("conv").type
                yield b

        for out in _edited(seen(batches)):
            done = []
            for conv, role, text in out:
                if role is None:
                    done.append((conv, digest.hexdigest()))
                    digest, begun = hashlib.sha256(), False
                else:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], types["conv"]), pa.array([d[1] for d in done], pa.string())], ["conv", "repaired_sha256"])

    return _ordered(rows, found).mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def audit(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damaged: bool = False, chunk: int = CHUNK
) -> DataFrame:
    """One row for each conversation of ``df``: its report and the digest of its repaired text.

    ``damaged`` applies :func:`damage` first.  ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``
    """
    rows = (damage if damaged else _plain)(df, conv, turn, role, text)
    found = reports(rows, chunk)
    made = digests(rows, found).withColumnRenamed("conv", "c")
    ids = df.select(column(conv).alias("id")).distinct()
    both = found.join(made, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    # A conversation without rows is in no report; a null id needs more than a null to be told apart.
    every = ids.join(both.withColumn("there", F.lit(True)), F.col("id").eqNullSafe(F.col("conv")), "left")
    zero = F.lit(0).cast("long")
    return every.select(
        F.col("id").alias(conv),
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", *_REPORT)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
