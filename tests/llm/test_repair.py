import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tokenloom.llm import repair

SPACE = " \t\n\v\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        part = zlib.crc32(key.encode()) % 20
        if part == 0:
            continue
        text = "" if part == 1 else re.sub(r"[.!?]", "", text) if part == 2 else text
        out += [(conv, turn, "user" if part == 4 else role, text)] * (2 if part == 3 else 1)
    return out


def cheapest(items):
    """The least ``(cost, edits)``: every sequence of edits, by recursion over rows and by relaxing insertions."""
    expects = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, ""), "a": (0, ""), "s": (10, "II"), "u": (5, "I")}
    for role, fault in reversed(items):
        now = {}
        for state in expects:
            options = [(best[state][0] + 2, "D" + best[state][1])]
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                if role[:1] == expects[state] or role[:1] == "s" and state == "":
                    cost, rest = best[role[:1]]
                    options.append((cost + extra, "K" + rest))
                cost, rest = best[expects[state]]
                options.append((cost + extra + 1, "R" + rest))
            now[state] = min(options)
        for _ in range(4):
            for state in expects:
                cost, rest = now[expects[state]]
                now[state] = min(now[state], (cost + 5, "I" + rest))
        best = now
    return best[""]


def brute(rows, damage=True):
    ids = {r[0] for r in rows}
    groups = defaultdict(list)
    for r in damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        groups[r[0]].append(r[1:])
    out = {}
    for conv in ids:
        got = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = [r[0] for r in got if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in got:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        initials = [r[1][:1] for r in got]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits = cheapest([(r[1], f) for r, f in zip(got, faults)])
        lines, state, rest = [], "", iter(got)
        for e in edits:
            r = next(rest) if e != "I" else None
            if e == "D":
                continue
            expected = "assistant" if state == "u" else "user"
            lines.append(f"{r[1]}:{r[2]}" if e == "K" else f"{expected}:{r[2] if r else ''}")
            state = lines[-1][:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, code string, h int"


def rows_of(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        length = rng.choice((0, 1, 2, 3, 5, 8, 40))
        turn = rng.randrange(3)
        for _ in range(length):
            role = rng.choice(("user", "assistant", "system", "tool", None, "", "ux", "Assistant"))
            text = rng.choice(("Hi there.", "No end", "", " \t", None, "Why?  \n", "One. two", "Yes!", f"Text {rng.random()}."))
            rows.append((conv if conv else None, rng.choice((turn, turn, turn, None)), role, text))
            turn += rng.choice((0, 1, 1, 1, 4))
    return rows


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_edits_of_codes_equal_brute_force():
    rng = random.Random(1)
    names = (None, "blank", "duplicate", "truncated")
    for _ in range(400):
        codes = bytes(rng.randrange(16) for _ in range(rng.choice((0, 1, 2, 5, 17, 40, 70))))
        want = cheapest([("suax"[c % 4], names[c // 4]) for c in codes])
        assert repair.solve_whole(codes) == want


@pytest.mark.parametrize("chunk", [repair.CHUNK, 3])
def test_equals_brute_force(spark, chunk):
    rows = rows_of(2)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)
    got = result(repair.audit(df, damaged=True, chunk=chunk))
    assert got == brute(rows)


def test_without_damage_and_with_long_texts(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "a" * 1_000_000), (2, 5, "assistant", "Hm."), (2, 5, "assistant", "Hm.")]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    assert result(repair.audit(df)) == brute(rows, damage=False)


def test_a_long_conversation_is_cut_into_chunks(spark):
    rng = random.Random(7)
    rows = [(9, i, rng.choice(("user", "assistant")), rng.choice(("Same.", f"{i}.", f"{i}", ""))) for i in range(3_000)] + [(9, 1, "user", "Same.")] * 500
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    assert result(repair.audit(df, damaged=True, chunk=100)) == brute(rows)


def test_rows_after_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hello?"), (2, 0, "assistant", "")]
    plain = repair._plain(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA), "conv_id", "turn", "role", "text")
    got = repair.repaired(plain, repair.reports(plain)).orderBy("conv", "position").collect()
    assert [tuple(r) for r in got] == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello?")]


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.audit(df, damaged=True).count() == 0
    gone = [(c, t, "user", "Hi.") for c in range(40) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = result(repair.audit(spark.createDataFrame([(*r, "", 0) for r in gone], SCHEMA), damaged=True))
    assert got and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
