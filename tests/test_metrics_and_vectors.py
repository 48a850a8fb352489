import math

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.losses import argmax, cross_entropy
from tokenloom.operators import metrics, vectors


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(0, [1.0, 2.0, 3.0], 2), (1, [5.0, 5.0, 1.0], 1), (2, [0.0, 0.0, 0.0], 0), (3, [900.0, -900.0, 0.0], 0), (4, [2.0, 1.0, 0.0], -100)]
    return spark.createDataFrame(rows, "i INT, x ARRAY<DOUBLE>, y INT")


def by_hand(x, y):
    top = max(x)
    return top + math.log(sum(math.exp(v - top) for v in x)) - x[y]


def test_cross_entropy_and_argmax(scored):
    rows = scored.withColumn("loss", cross_entropy("x", "y", -100)).withColumn("p", argmax("x")).orderBy("i").collect()
    for r in rows[:4]:
        assert r.loss == pytest.approx(by_hand(r.x, r.y), abs=1e-12)
    assert rows[4].loss is None
    assert [r.p for r in rows] == [2, 0, 0, 0, 0]


def test_losses_over_batches(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0), (1, 1, 8.0), (2, 0, 2.0)], "batch INT, rank INT, loss DOUBLE")
    assert metrics.eval_loss_by_batch(df).first().eval_loss == pytest.approx(4.0)
    r = metrics.eval_loss_reduced(df).first()
    assert (r.total_loss, r.total_steps) == (12.0, 3) and r.eval_loss == pytest.approx(4.0)


def test_accuracy_and_custom_loss(scored):
    real = scored.filter("i < 4")
    r = metrics.accuracy(metrics.score(real, "x", "y"), label="y").first()
    assert (r.correct, r.total, r.accuracy) == (3, 4, 0.75)
    custom = metrics.score(real, "x", "y", lambda x, y: F.get(x, y)).orderBy("i").collect()
    assert [r.loss for r in custom] == [3.0, 5.0, 0.0, 900.0]


def test_log_every(spark):
    steps = spark.range(1, 13).withColumnRenamed("id", "step")
    assert [r.step for r in metrics.log_every(steps, 5).orderBy("step").collect()] == [5, 10]
    assert [r.step for r in metrics.log_every(steps, 5, first=True).orderBy("step").collect()] == [1, 5, 10]


@pytest.fixture(scope="module")
def ranks(spark):
    return spark.createDataFrame([(r, [float(r + 1)] * 5) for r in (2, 0, 3, 1)], "shard INT, vec ARRAY<FLOAT>")


def by_shard(df, column="vec"):
    return {r.shard: r[column] for r in df.collect()}


def test_sums(ranks):
    assert vectors.vector_sum(ranks).first().vec == [10.0] * 5
    assert by_shard(vectors.vector_sum_all(ranks)) == {r: [10.0] * 5 for r in range(4)}
    assert by_shard(vectors.vector_sum(ranks.union(ranks), by="shard")) == {r: [2.0 * (r + 1)] * 5 for r in range(4)}


def test_broadcast_gather_scatter(ranks):
    assert by_shard(vectors.broadcast_vector(ranks, 1)) == {r: [2.0] * 5 for r in range(4)}
    every = [[float(r)] * 5 for r in (1, 2, 3, 4)]
    assert vectors.gather_vectors(ranks).first().vecs == every
    assert by_shard(vectors.gather_vectors_all(ranks), "vecs") == {r: every for r in range(4)}
    assert by_shard(vectors.scatter_vectors(vectors.gather_vectors(ranks))) == {r: every[r] for r in range(4)}


def test_segment_sum(spark):
    rows = [(r, [float(((r + 1) * i) ** (j + 1)) for j in range(4) for i in (1, 2)]) for r in range(4)]
    df = spark.createDataFrame(rows, "shard INT, vec ARRAY<FLOAT>")
    assert by_shard(vectors.segment_sum(df, 4)) == {0: [10, 20], 1: [30, 120], 2: [100, 800], 3: [354, 5664]}


def test_quantization(spark):
    levels = list(vectors.NF4_LEVELS)
    rows = [(0, [2 * v for v in levels] + [-4 * v for v in levels]), (1, [0.0] * 32)]
    df = spark.createDataFrame(rows, "id INT, embedding ARRAY<FLOAT>")
    coded = vectors.quantize_vectors(df, block=16)
    first, zero = coded.orderBy("id").collect()
    assert first.scales == [2.0, 4.0] and first.codes[:16] == list(range(16))
    assert first.codes[16] == 15 and first.codes[31] == 0
    assert zero.scales == [0.0, 0.0] and zero.codes == [7] * 32
    back = vectors.dequantize_vectors(coded, block=16).orderBy("id").first().embedding
    assert back[:16] == pytest.approx([2 * v for v in levels], abs=1e-6)
    assert max(abs(a - b) for a, b in zip(back, rows[0][1])) < 4 * 0.16


def test_gather_refuses_a_table_of_vectors(spark, ranks, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_SHARDS", 3)
    with pytest.raises(ValueError):
        vectors.gather_vectors(ranks)


def test_a_label_without_a_score_is_an_error(spark):
    rows = spark.createDataFrame([([0.0, 1.0], 0), ([0.0, 1.0], 5)], "x ARRAY<DOUBLE>, y INT")
    with pytest.raises(Exception, match="no score for label 5"):
        rows.select(cross_entropy("x", "y")).collect()
    kept = rows.select(cross_entropy("x", "y", ignore=5).alias("loss")).collect()
    assert [r.loss is None for r in kept] == [False, True]
