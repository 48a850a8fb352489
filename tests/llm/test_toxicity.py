import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tokenloom.llm import toxicity

BAD = ("idiot", "scum", "loweistra", "loweichen", "loweient")


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sentences = [" ".join(f"word{rng.randrange(60)}" for _ in range(8)) for _ in range(rng.randrange(2, 12))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(BAD) + " there"
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return rows, docs, toxicity.fit(docs, labels, held_out=F.col("id") % 4 == 0)


def test_held_out_accuracy_and_located_sentences(fitted):
    rows, docs, model = fitted
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(y, t, got[i]) for i, t, y in rows if i % 4 == 0]
    assert np.mean([(r.score >= 0.5) == y for y, _, r in held]) >= 0.97
    found = [(t, s) for y, t, r in held if y for s in r.offending]
    assert found and all(any(b in t[s.start : s.end] for b in BAD) for t, s in found)


def test_noisy_or_is_one_minus_the_product():
    z = np.array([-2.0, 0.5, -1.0])
    clean = np.exp(-toxicity.LEAK) * np.prod(1 - 1 / (1 + np.exp(-z)))
    assert toxicity.noisy_or(z) == pytest.approx(1 - clean)
    assert toxicity.noisy_or(z, 0.6) == pytest.approx(1 - np.exp(-toxicity.LEAK))


def plain_score(text, weights, bias, floor):
    """The score of a text from the formula, sentence by sentence and word by word."""
    words = []
    for sentence in re.findall(r"[^.!?\n]+[.!?]*", text or ""):
        found = [m[0] for m in re.finditer(r"\w+", sentence.lower())]
        long = len(sentence) > 2 * toxicity.LONGEST
        words += [found[i : i + toxicity.LONGEST] for i in range(0, len(found), toxicity.LONGEST)] if long else [found] * bool(found)
    total = toxicity.LEAK
    for sentence in words:
        z = bias
        for word in set(sentence):
            parts = {"w" + word} | ({"4" + word[:4], "5" + word[:5]} if len(word) > 3 else set())
            z += sum(float(weights[xxhash.xxh32_intdigest(p) >> (32 - toxicity.BITS)]) for p in parts)
        total += max(0.0, math.log1p(math.exp(min(z, 700))) - math.log1p(math.exp(floor)))
    return 1 - math.exp(-total)


def test_scores_equal_the_plain_formula(spark, fitted):
    rows, docs, (weights, bias, floor) = fitted
    more = [(9_001, None), (9_002, ""), (9_003, "Idiot word1, " * 500 + "!! scum? ..."), (9_004, "é idiot\nword2")]
    asked = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    want = {i: plain_score(t, weights, bias, floor) for i, t in [r[:2] for r in rows] + more}
    got = {r.doc_id: r.score for r in toxicity.score(asked, (weights, bias, floor)).collect()}
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=1e-5) for i in want)


def test_the_last_round_lowers_the_objective_of_the_scores(spark, fitted, monkeypatch):
    """Negative log likelihood of the very scores, toxic documents weighted up, plus the decay of the weights."""
    rows, docs, _ = fitted
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    clean = sum(1 - y for _, _, y in rows)
    balance = clean / (len(rows) - clean)

    def objective(model):
        p = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        loss = sum(-balance * math.log(p[i]) if y else -math.log1p(-min(p[i], 1 - 1e-12)) for i, _, y in rows)
        return loss / (2 * clean) + toxicity.DECAY / 2 * float((model[0].astype(float) ** 2).sum())

    after = objective(toxicity.fit(docs, labels))
    monkeypatch.setattr(toxicity, "LAST_TURNS", 0)
    assert after < objective(toxicity.fit(docs, labels))


@pytest.mark.parametrize("floor", [-np.inf, -0.3])
def test_gradient_equals_differences(floor):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    ids, sizes = [[1, 2, 3, 1], [0, 2], []], [[2, 2], [1, 1], []]
    b = pa.RecordBatch.from_arrays(
        [pa.array([1, 0, 0], pa.int32()), pa.array(ids, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))],
        ["y", "ids", "sizes"],
    )
    w = rng.normal(size=5)

    def loss(v):
        total = 0.0
        for y, i, s in zip([1, 0, 0], ids, sizes, strict=True):
            z = [v[4] + sum(v[k] for k in i[sum(s[:j]) : sum(s[: j + 1])]) for j in range(len(s))]
            a = toxicity.LEAK + sum(max(0.0, np.logaddexp(0, x) - np.logaddexp(0, floor)) for x in z)
            total += -3.0 * np.log(-np.expm1(-a)) if y else a
        return total

    g = toxicity.gradient(b, w[:4], w[4], 3.0, floor)
    for k in range(5):
        e = np.eye(5)[k] * 1e-6
        assert g[k] == pytest.approx((loss(w + e) - loss(w - e)) / 2e-6, rel=1e-4, abs=1e-6)


def test_edge_cases(spark, fitted):
    _, _, model = fitted
    rows = [(1, None), (None, ""), (2, "word1 scum there. " * 5000), (2, "...!"), (2, "...!")]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, score double")
    got = toxicity.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert max(r.score for r in got) > 0.99 and sum(r.n_sentences for r in got) == 5000
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    flat = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert all(r.score == pytest.approx(-np.expm1(-toxicity.LEAK)) for r in flat)


def test_length_neither_makes_nor_hides_an_insult(spark, fitted):
    _, _, model = fitted
    rng = random.Random(5)
    word = lambda: f"word{rng.randrange(60)}"
    clean = " ".join(" ".join(word() for _ in range(12)) + "." for _ in range(1_700))
    unmarked = " ".join(word() for _ in range(20_000))
    rows = [(1, clean), (2, unmarked), (3, unmarked + " scum there " + unmarked), (4, clean + " You scum there.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].score < 0.1 and got[2].score < 0.1
    for i in (3, 4):
        assert got[i].score >= 0.5 and any("scum" in rows[i - 1][1][s.start : s.end] for s in got[i].offending)


def test_long_sentences_are_cut_into_parts_without_loss():
    text = "a b c. " + "é word, " * 95 + "end! x"
    spans = toxicity.sentences(text)
    assert len(spans) == 7 and [len(text[s:e].split()) for s, e in spans] == [3, 40, 40, 40, 40, 31, 1]


def test_a_rare_insult_among_many_documents_gets_a_weight(spark):
    """Four of 1,200 documents have the word, a third of a per cent."""
    rows = [(i, f"word{i % 7} word{i % 11}. word{i % 13} again." + " You zounds." * (i < 4), int(i < 4)) for i in range(1_200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    asked = spark.createDataFrame([(1, "You zounds. word1 again."), (2, "word1 again.")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert got[1] >= 0.5 > got[2]
