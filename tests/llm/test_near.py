import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import near


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(best[j] + 1 if x == y else max(row[j], best[j + 1]))
        best = row
    return best[-1]


def brute_similar(a, b):
    a, b = ([tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] for w in (a.split(), b.split()))
    common = (Counter(a) & Counter(b)).total()  # no alignment has more
    if common < 0.8 * (len(a) + len(b) - common):
        return False
    m = lcs(a, b)
    return m >= 0.8 * (len(a) + len(b) - m)


def brute_classes(rows):
    """Classes by comparing every two texts."""
    parent = {t: t for _, t in rows}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    texts = [t for t in parent if t.split()]
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if brute_similar(a, b):
                parent[root(a)] = root(b)
    members = defaultdict(list)
    for i, t in rows:
        members[root(t)].append(i)
    return {i: min(members[root(t)]) for i, t in rows}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=40))
def test_alignment_equals_the_table_within_reach(a, b):
    m = lcs(a, b)
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    got = near.aligned(x, y)
    assert got <= m
    if a and b:
        assert near.similar(x, y) == (m >= 0.8 * (len(a) + len(b) - m))


def edited(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at : at + 1] = [] if kind == 0 else [f"new{rng.random()}"] if kind == 1 else [words[at], f"x{rng.random()}"]
    return words


def test_sketches_find_nearly_all_pairs_at_the_threshold():
    rng, found, total = random.Random(3), 0, 0
    for _ in range(200):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        a, b = " ".join(words), " ".join(edited(words, 4, rng))
        if brute_similar(a, b):
            total += 1
            x, y = (near.sketches(near.labelled(near.shingles(t.encode()))) for t in (a, b))
            found += bool(np.any(x == y))
    assert total > 80 and found >= 0.99 * total


def test_order_matters():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    blocks = [words[i : i + 10] for i in range(0, 300, 10)]
    rng.shuffle(blocks)
    a, b = (near.shingles(" ".join(w).encode()) for w in (words, [w for x in blocks for w in x]))
    assert not near.similar(a, b)


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for group in range(12):
        words = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 80, 150]))]
        for size in range(rng.choice([1, 2, 5, 25])):
            text = " ".join(words if size % 4 == 1 else edited(words, rng.randrange(4), rng))
            rows.append((n := n + 1, text))
            if size % 3 == 0:
                words = text.split()
    rows += [(n + 1, "short one"), (n + 2, "short one"), (n + 3, "short  one"), (n + 4, "short two")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, class_id long").repartition(5)
    got = {r.doc_id: r.class_id for r in near.class_ids(docs).collect()}
    assert got == brute_classes(rows)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_a_bucket_of_many_unlike_texts_needs_no_cap(spark):
    """All share one sketch (three shingles decide it), few are alike: every pair still meets."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(45):
        tail = [f"t{i // 2}x{j}" for j in range(60)]
        rows.append((i, " ".join(base + (tail if i % 2 else edited(tail, 1, rng)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near.class_ids(docs).collect()} == brute_classes(rows)


def test_prefixes_of_similar_texts_meet():
    """A pair at the threshold shares a prefix shingle with enough left after it, in any order of shingles."""
    rng = random.Random(4)
    for trial in range(200):
        words = [f"w{rng.randrange(60 if trial % 2 else 4000)}" for _ in range(rng.randrange(6, 120))]
        a, b = (near.shingles(" ".join(w).encode()) for w in (words, edited(words, rng.randrange(4), rng)))
        if not near.similar(a, b):
            continue
        counts = np.array([rng.randrange(3) for _ in range(1 << 10)]).repeat(1 << (near.COUNT_BITS - 10))
        x, y = (near.prefix(r, counts).tolist() for r in (a, b))
        least = np.ceil(0.8 / 1.8 * (len(a) + len(b)) - 1e-9)
        assert any(min(len(a) - x.index(h), len(b) - y.index(h)) >= least for h in set(x) & set(y))


def test_loose_groups_are_joined_without_their_centre(spark):
    """Copies of copies: many are unlike the first text and like each other."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        words = edited(base, rng.choice([2, 8, 9]), rng)
        rows.append((i, " ".join(words)))
        if i % 6 == 0:
            base = words
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_classes(rows)
    assert 3 < len(set(want.values())) < 58
    assert {r.doc_id: r.class_id for r in near.class_ids(docs).collect()} == want


def test_edge_cases(spark):
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (None, "only null"),
        (None, "only null"), (5, long), (6, long + " end"), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in near.class_ids(docs).collect()), key=str)
    want = [(1, 1), (2, 2), (3, 3), (None, 4), (4, 4), (4, 4), (None, None), (None, None), (5, 5), (6, 5), (None, None)]
    assert got == sorted(want, key=str)
    kept = sorted((str(r.doc_id), (r.text or "")[:9]) for r in near.one_of_each(docs).collect())
    assert kept == sorted([("1", ""), ("2", ""), ("3", " \n"), ("4", "a b c d e"), ("None", "only null"), ("5", long[:9]), ("None", "")])
    empty = docs.limit(0)
    assert near.class_ids(empty).count() == 0 and near.one_of_each(empty).count() == 0
