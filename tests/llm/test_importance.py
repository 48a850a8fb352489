import math
import random
from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import importance

SF = "/root/testdata/sf0.01"


def table(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [f"good{rng.randrange(80)}" if good or rng.random() < 0.3 else f"junk{rng.randrange(5000)}" for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(words), "x"))
        if i % 3 == 0:
            labels.append((i, int(good)))
    rows += [(1000, None, "x"), (None, "", "x"), (None, "good1 good2 good3", "x"), (5, "good1", "x"), (5, "good1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, selected string").repartition(4)
    return rows, docs, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int"), labels


def test_weights_equal_brute_force(spark):
    rows, docs, labels, known = table(spark)
    good = {i for i, y in known if y}
    target, raw = Counter(), Counter()
    for i, t, _ in rows:
        g = importance.grams((t or "").encode()).tolist()
        raw.update(g)
        if i in good:
            target.update(g)
    nt, nr, v = target.total(), raw.total(), importance.BUCKETS
    ratio = lambda g: math.log((target[g] + 1) / (nt + v)) - math.log((raw[g] + 1) / (nr + v))
    got = importance.resample(docs, labels).collect()
    assert len(got) == len(rows)
    want = Counter((i, round(sum(map(ratio, importance.grams((t or "").encode()).tolist())), 6)) for i, t, _ in rows if t)
    assert Counter((r.doc_id, round(r.log_weight, 6)) for r in got if r.log_weight is not None) == want
    assert sum(r.log_weight is None and not r.selected for r in got) == 2


def test_the_largest_keys_are_selected(spark):
    _, docs, labels, _ = table(spark)
    got = importance.resample(docs, labels, share=0.5).collect()
    keys = sorted((r.sample_key for r in got if r.sample_key is not None), reverse=True)
    chosen = sorted((r.sample_key for r in got if r.selected), reverse=True)
    n = round(0.5 * len(got))
    assert chosen == keys[: len(chosen)] and n <= len(chosen) <= n + 1
    assert {(r.doc_id, r.selected) for r in importance.resample(docs.repartition(2), labels, share=0.5).collect()} == {
        (r.doc_id, r.selected) for r in got
    }


@pytest.mark.parametrize("n", [1, 2, 17, 99, 100, 101])
def test_border_is_the_nth_largest(spark, n):
    rng = random.Random(n)
    pairs = [(rng.choice([0, 7, -(1 << 62), 1 << 62, rng.randrange(-50, 50)]), rng.randrange(-(1 << 63), 1 << 63)) for _ in range(100)]
    rows = spark.createDataFrame(pairs, "k long, tie long")
    assert importance.border(rows, n) == (sorted(pairs, reverse=True)[n - 1] if n <= 100 else None)


def test_junk_scores_below_good_text(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in importance.resample(docs, labels).collect()}
    y = {r.doc_id: r.quality for r in labels.collect()}
    scored = sorted((rows[i].log_weight, q) for i, q in y.items() if i in rows)
    rank = np.array([q for _, q in scored])
    ones = np.flatnonzero(rank == 1)
    auc = (ones.sum() - len(ones) * (len(ones) - 1) / 2) / (len(ones) * (len(rank) - len(ones)))
    assert auc > 0.85


def test_empty_tables(spark):
    _, docs, labels, _ = table(spark, 20)
    assert importance.resample(docs.limit(0), labels).count() == 0
    assert not any(r.selected for r in importance.resample(docs, labels.limit(0)).collect())
