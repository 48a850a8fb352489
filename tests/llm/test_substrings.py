import hashlib
import random

import numpy as np
import pytest

from tokenloom.llm import substrings


def brute(rows):
    """By a dictionary of all windows."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for at in range(len(w) - 12):
            key = tuple(w[at : at + 13])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for at in range(len(w) - 12):
            if i is not None and first[tuple(w[at : at + 13])] < i:
                gone.update(range(at, at + 13))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def rows(seed=4):
    rng = random.Random(seed)
    word = lambda n=3000: f"w{rng.randrange(n)}"
    passage = [word() for _ in range(60)]
    out = []
    for i in range(60):
        text = [word() for _ in range(rng.choice([0, 5, 13, 40, 200]))]
        if i % 3 == 0:
            cut = rng.randrange(40)
            text[len(text) // 2 : len(text) // 2] = passage[cut : cut + rng.randrange(10, 40)]
        if i % 7 == 0:
            text = ["same"] * 20 + text + ["same"] * 15
        out.append((i, " ".join(text)))
    out += [(100, " ".join(passage)), (100, " ".join(passage)), (101, " ".join(passage[5:])), (101, "x " + "\n".join(passage[:30]))]
    out += [(None, " ".join(passage)), (None, " ".join(passage)), (102, None), (103, ""), (None, None), (104, " ".join(passage * 400))]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("most_bits", [31, substrings.BLOCK_BITS + 1])
def test_equals_brute_force(spark, monkeypatch, most_bits):
    monkeypatch.setattr(substrings, "MOST_BITS", most_bits)
    data = rows()
    docs = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, places int").repartition(5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedupe(docs).collect()), key=str)
    assert got == brute(data)


def test_a_crowded_table_only_lets_more_windows_pass(spark, monkeypatch):
    """Every cell counted twice: nothing is filtered, the result stays."""
    monkeypatch.setattr(substrings, "_maybe_repeated", lambda low, table, bits: np.ones(len(low), bool))
    data = rows(8)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedupe(docs).collect()), key=str)
    assert got == brute(data)


def test_empty_table(spark):
    assert substrings.dedupe(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cells_survive_packing():
    rng = np.random.default_rng(1)
    for n in (1, 5, 3000, 500_000):
        at = np.unique(rng.integers(0, 1 << substrings.BLOCK_BITS, n))
        flags = rng.random(len(at)) < 0.3
        back, again = substrings._cells_of(substrings._gaps(at, flags))
        assert np.array_equal(back, at) and np.array_equal(again, flags)


def test_sketch_never_counts_less():
    """Every window in two documents passes, whatever else is in the table."""
    words = [f"a{i}".encode() for i in range(400)]
    low, _ = substrings.fingerprints(b" ".join(words))
    bits = substrings.BLOCK_BITS + 1
    table = np.zeros(1 << (bits - 3), np.uint8)
    for at in substrings.cells(low, bits):
        np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), (128 >> (at & np.uint64(7)).astype(np.int64)).astype(np.uint8))
    assert substrings._maybe_repeated(low, table, bits).all()
    other, _ = substrings.fingerprints(b" ".join(b"b" + w for w in words))
    assert substrings._maybe_repeated(other, table, bits).mean() < 0.01
