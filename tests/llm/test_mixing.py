import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Share, stop the sources above twice their size, share the excess among the others, again."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def table(spark, seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "ü", "z", None, "tiny" if i % 40 == 0 else "b"])
        rows.append((i, " ".join(f"w{j}" for j in range(rng.randrange(0, 60))), source, i, "x"))
    rows += [(1000, None, "b", 1, "x"), (1000, None, "b", 1, "x"), (None, " one two\tthree ", "empty", 2, "x"), (None, "", "blank", 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, taken long, size string").repartition(4)


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = brute_targets(sizes)
    source = {r.doc_id: r.source for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id] if r.doc_id is not None else ("empty" if r.size else "blank")
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert taken[s] == round(want[s])


def test_targets_and_budgets(spark):
    docs = table(spark)
    rows, got = docs.collect(), mixing.shares(docs).collect()
    assert len(got) == len(rows)
    check(rows, got)
    again = mixing.shares(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_many_cells_give_the_same_prefix_sums(spark, monkeypatch):
    docs = table(spark, 2)
    whole = {(r.doc_id, r.size, r.taken) for r in mixing.shares(docs).collect()}
    monkeypatch.setattr(mixing, "CELL_ROWS", 7)
    assert {(r.doc_id, r.size, r.taken) for r in mixing.shares(docs).collect()} == whole


def test_mixed_rows_hold_exactly_the_words_taken(spark):
    docs = table(spark)
    shares = defaultdict(int)
    for r in mixing.shares(docs).collect():
        shares[r.doc_id] += r.taken
    mixed = mixing.mix(docs, length="taken")
    assert mixed.columns == docs.columns
    texts = defaultdict(list)  # several rows may have a null id
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert any(t.startswith(r.text) for t in texts[r.doc_id]) and r.size == "x"
        assert r.text in texts[r.doc_id] or r.taken == len(r.text)
    assert {k: v for k, v in shares.items() if v} == dict(words)


def test_first_words(spark):
    rows = spark.createDataFrame([(" a  b\tc ", 2), ("a b", 1), ("a", 1), ("\n\n x y", 1)], "t string, n int")
    got = [r[0] for r in rows.select(mixing.first_words(F.col("t"), F.col("n"))).collect()]
    assert got == [" a  b\t", "a ", "a", "\n\n x "]


def test_nothing_to_mix(spark):
    docs = table(spark)
    assert mixing.shares(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    blank = docs.withColumn("text", F.lit(""))
    assert {(r.target, r.taken) for r in mixing.shares(blank).collect()} == {(0.0, 0)}
    assert mixing.mix(blank).count() == 0
