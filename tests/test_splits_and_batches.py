import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.hashing import shuffle_key
from tokenloom.operators import batches, splits
from tokenloom.operators.ordering import key_ranges


def by_hand(seed, i, epoch=None):
    text = f"{seed}-{i}" if epoch is None else f"{seed}-{epoch}-{i}"
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(500).withColumnRenamed("id", "k").repartition(3)


def test_shuffle_key_is_seeded(rows):
    got = rows.select("k", shuffle_key("k", 42).alias("a"), shuffle_key("k", 42, 3).alias("b")).collect()
    assert all(r.a == by_hand(42, r.k) and r.b == by_hand(42, r.k, 3) for r in got)


def test_shuffled_and_epochs(rows):
    order = [r.k for r in splits.shuffled(rows, "k", 7).collect()]
    assert order == sorted(range(500), key=lambda k: by_hand(7, k)) and order != list(range(500))
    epochs = splits.epoch_order(rows, "k", 7, 2)
    assert epochs.count() == 1000
    assert {r.k: r.shuffle_key for r in epochs.filter("epoch = 1").collect()} == {k: by_hand(7, k, 1) for k in range(500)}


@pytest.mark.parametrize("n", [1, 50, 499, 500, 10_000])
def test_holdout_takes_the_last_rows(rows, n):
    train, held = splits.holdout(rows, "k", n, 42)
    order = sorted(range(500), key=lambda k: by_hand(42, k))
    assert sorted(r.k for r in held.collect()) == sorted(order[-n:])
    assert sorted(r.k for r in train.collect()) == sorted(order[:-n])


def test_sample_takes_the_first_rows(rows):
    order = sorted(range(500), key=lambda k: by_hand(42, k))
    assert {r.k for r in splits.sample_n(rows, "k", 60, 42).collect()} == set(order[:60])
    assert splits.sample_n(rows, "k", 501).count() == 500


@pytest.mark.parametrize("bits", [0, 3, 12])
@pytest.mark.parametrize("n", [1, 20, 250, 499])
def test_cuts_are_exact_for_any_cells(rows, monkeypatch, bits, n):
    monkeypatch.setattr(splits, "CELL_BITS", bits)
    order = sorted(range(500), key=lambda k: by_hand(42, k))
    _, held = splits.holdout(rows, "k", n, 42)
    assert {r.k for r in held.collect()} == set(order[-n:])
    assert {r.k for r in splits.sample_n(rows, "k", n, 42).collect()} == set(order[:n])


def test_ordinals_of_any_key_type_over_many_ranges(spark):
    rows = spark.range(120_000).select(
        "id",
        F.timestamp_micros(F.col("id") * 1_000_003 - 10**12).alias("ts"),
        F.date_from_unix_date((F.col("id") / 7 - 9000).cast("int")).alias("day"),
        (F.col("id") * F.lit(Decimal("0.01")) - 500).cast("decimal(20,4)").alias("money"),
        (F.col("id") / 3 - 20000.0).alias("ratio"),
        F.format_string("é%07d", "id").alias("name"),
        (F.col("id") >= 60_000).alias("late"),
    )
    rows = rows.repartition(3)
    for keys in (["ts"], ["money"], ["ratio"], ["name"], ["day", "id"], ["late", "ts"]):
        ranges = key_ranges(rows, keys)
        assert ranges.buckets > 1
        assert batches.with_ordinal(rows, keys).filter("ordinal <> id").isEmpty()
        at = batches.row_at(rows, keys, 70_001).collect()
        assert [(r.id, r.ordinal) for r in at] == [(70_001, 70_001)]
    assert batches.row_at(rows, ["ts"], 120_000).count() == 0


def test_keys_without_a_written_order_are_refused_at_any_size(spark):
    with pytest.raises(TypeError, match="cannot order by"):
        batches.with_ordinal(spark.range(3).select(F.array("id").alias("a")), ["a"])


def test_row_at_shuffles_one_range_only(spark):
    plan = batches.row_at(spark.range(200_000), ["id"], 150_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Filter", plan.index("Exchange"))


def test_collate_takes_a_hook(spark):
    b = batches.assign_batches(spark.range(5), ["id"], 2)
    summed = batches.collate(b, ["id"], hook=lambda rows: F.aggregate(rows, F.lit(0).cast("long"), lambda t, r: t + r["id"]))
    assert {r.batch: r.rows for r in summed.collect()} == {0: 1, 1: 5, 2: 4}


def test_a_split_does_not_shuffle(rows):
    plan = splits.assign_split(rows, "k", 20)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_batches_and_collate(spark):
    df = spark.createDataFrame([(i * 3, f"t{i}") for i in range(21)], "k LONG, t STRING").repartition(4)
    b = batches.assign_batches(df, ["k"], 8)
    got = batches.collate(b, ["t"]).orderBy("batch").collect()
    assert [[r.t for r in g.rows] for g in got] == [[f"t{i}" for i in range(s, min(s + 8, 21))] for s in (0, 8, 16)]
    ranks = batches.shard_by_rank(b, 2).select("batch", "rank").distinct().collect()
    assert {(r.batch, r.rank) for r in ranks} == {(0, 0), (1, 1), (2, 0)}


def loop(mode, epochs, per_epoch, accum):
    """The update each micro-batch joins, by running the loop; None where it joins none."""
    waiting, update, out = [], 0, {}
    for e in range(epochs):
        for s in range(per_epoch):
            waiting.append((e, s))
            fires = {
                "vanilla": s % accum == 0,
                "accelerate": (s + 1) % accum == 0 or s == per_epoch - 1,
                "pipeline": (s + 1) % accum == 0,
            }[mode]
            if fires:
                out.update(dict.fromkeys(waiting, update))
                waiting, update = [], update + 1
        if mode == "pipeline":
            waiting = []
    return out


@pytest.mark.parametrize("mode", batches.MODES)
def test_updates_equal_the_loop(spark, mode):
    for per_epoch, accum in ((10, 4), (8, 4), (3, 8), (1, 1), (9, 4)):
        steps = spark.range(per_epoch).withColumnRenamed("id", "step")
        got = batches.assign_updates(steps, 3, per_epoch, accum, mode).collect()
        assert len(got) == 3 * per_epoch
        applied = {(r.epoch, r.step): r.update for r in got if r.applied}
        assert applied == loop(mode, 3, per_epoch, accum)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        batches.assign_updates(spark.range(1), 1, 1, 1, "other")


@pytest.mark.parametrize("mode,total,warmup", [("vanilla", 9, 0), ("accelerate", 9, 0), ("pipeline", 9, 0), ("raw", 75, 0)])
def test_plan_summary(spark, mode, total, warmup):
    r = batches.plan_summary(spark.range(199), 8, 4, 8, 3, mode).first()
    assert (r.examples, r.batches, r.total_steps, r.warmup_steps, r.effective_batch) == (199, 25, total, warmup, 256)


def test_warmup_is_a_tenth(spark):
    assert batches.plan_summary(spark.range(1000), 1, 1, 8, 3).first().warmup_steps == 37
    assert batches.plan_summary(spark.range(1000).select(F.col("id")), 1, 1, 8, 3, "vanilla").first().total_steps == 375
