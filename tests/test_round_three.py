"""Best fit, exact balance, permutations, the store, templates, sequence losses, second-level scales, gradient fits."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import losses
from tokenloom.functions.permute import Permutation
from tokenloom.functions.templates import TemplateError, compile_template
from tokenloom.operators import balance, bestfit, classifier, metrics, splits, vectors
from tokenloom.operators.batches import with_ordinal
from tokenloom.sources import sinks


def one_by_one(lengths, length):
    """Best fit of samples taken longest first."""
    bins, homes = [], []
    for n in lengths:
        fits = [(left, i) for i, left in enumerate(bins) if left >= n]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append(length)
        bins[i] -= n
        homes.append(i)
    return homes


def test_the_plan_by_lengths_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice((1, 5, 16, 100))
        lengths = sorted((rng.randint(1, length) for _ in range(rng.randrange(80))), reverse=True)
        plan = bestfit.best_fit_plan({n: lengths.count(n) for n in set(lengths)}, length)
        homes = []
        for n, count in itertools.groupby(lengths):
            for rank in range(len(list(count))):
                (hit,) = [p for p in plan if p[0] == n and p[1] <= rank < p[2]]
                homes.append(hit[4] + (rank - hit[1]) // hit[3])
        assert homes == one_by_one(lengths, length)


def test_best_fit_keeps_samples_whole(spark):
    rng = random.Random(2)
    rows = [(i, [i * 100 + j for j in range(rng.choice((0, 1, 3, 7, 7, 7, 20)))]) for i in range(200)]
    df = spark.createDataFrame(rows, "id LONG, input_ids ARRAY<INT>")
    got = bestfit.pack_best_fit(df, "id", 16, -1).orderBy("seq_id").collect()
    ids = dict(rows)
    order = sorted((i for i in ids if ids[i]), key=lambda i: (-min(16, len(ids[i])), i))
    homes = one_by_one([min(16, len(ids[i])) for i in order], 16)
    for r in got:
        mine = [i for i, b in zip(order, homes) if b == r.seq_id]
        assert r["keys"] == mine and r.lengths == [min(16, len(ids[i])) for i in mine]
        whole = [x for i in mine for x in ids[i][:16]]
        assert r.input_ids == whole + [-1] * (16 - len(whole)) and r.real == len(whole)
    assert len(got) == max(homes) + 1
    assert bestfit.pack_best_fit(df.limit(0), "id", 16, -1).count() == 0


def least_by_trying(weights, shards):
    ends = list(itertools.accumulate(weights))
    for bound in range(max(weights), sum(weights) + 1):
        at, cuts = 0, []
        for _ in range(shards):
            at = max((e for e in ends if e <= at + bound), default=0)
            cuts.append(at)
        if at >= ends[-1]:
            return [sum(c < e for c in cuts) for e in ends], bound
    raise AssertionError


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_least_possible_largest_share(spark, most):
    rng = random.Random(3)
    for shards, n in ((1, 20), (3, 50), (7, 6), (5, 200)):
        weights = [rng.choice((0, 1, 2, 50, 7)) for _ in range(n)]
        df = spark.createDataFrame(list(enumerate(weights)), "id LONG, w LONG")
        got = balance.shard_by_least_weight(df, ["id"], "w", shards, most).orderBy("id").collect()
        shares, bound = least_by_trying(weights, shards)
        assert [r.shard for r in got] == shares
        assert max(sum(r.w for r in got if r.shard == s) for s in range(shards)) == bound
    empty = balance.shard_by_least_weight(df.limit(0), ["id"], "w", 3)
    assert empty.count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 99, 1000])
def test_permutation_and_its_inverse(spark, n):
    rows = spark.range(n)
    for epoch in (0, 1):
        p = Permutation(n, 42, epoch)
        got = rows.select("id", p.place(F.col("id")).alias("place")).select("*", p.position(F.col("place")).alias("back")).collect()
        assert sorted(r.place for r in got) == list(range(n)) and all(r.back == r.id for r in got)
    if n == 1000:
        assert len({tuple(r.place for r in got[:9]), tuple(range(9))}) == 2


def test_resuming_inside_an_epoch(spark):
    rows = with_ordinal(spark.range(100).withColumn("id", F.col("id") * 3), ["id"])
    whole = {r.place: r.id for r in splits.epoch_places(rows.drop("ordinal"), ["id"], 7, 2).filter("epoch = 1").collect()}
    rest = splits.rows_at_places(rows, 100, 7, 1, 60, 100).collect()
    assert {r.place: r.id for r in rest} == {k: v for k, v in whole.items() if k >= 60}
    assert splits.rows_at_places(rows, 100, 7, 1, 100, 100).count() == 0


def test_store_opens_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(KeyError):
        sinks.read_store(spark, path)
    rows = spark.createDataFrame([(i, [i, i + 1]) for i in range(95)], "seq_id LONG, input_ids ARRAY<INT>")
    sinks.write_store(rows, path, per_file=10)
    assert [(r.first, r.rows, r.tokens) for r in sinks.store_manifest(spark, path).orderBy("file").collect()][-1] == (90, 5, 10)
    part = sinks.read_store(spark, path, rank=1, ranks=3, start=20)
    assert sorted(r.seq_id for r in part.collect()) == list(range(45, 70))
    assert len(part.inputFiles()) == 3
    # A write that ended before its manifest: its files are there and nobody reads them.
    rows.filter("seq_id < 5").withColumn("file", F.lit(0)).write.partitionBy("file").parquet(f"{path}/data/unfinished")
    (tmp_path / "store/manifest/version=2/_temporary").mkdir(parents=True)
    assert sinks.read_store(spark, path).count() == 95
    sinks.write_store(rows.filter("seq_id < 30"), path, per_file=10)
    assert sinks.read_store(spark, path).count() == 30 and sinks.read_store(spark, path, start=99).count() == 0


MESSAGES = [[("system", " Be kind. "), ("user", "Hi 'you'\n"), ("assistant", "Yes")], [("user", "a")], []]


def rendered(spark, template, **names):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(MESSAGES)], "id INT, messages ARRAY<STRUCT<role: STRING, content: STRING>>")
    text = compile_template(template, messages=F.col("messages"), **names)
    return [r.t for r in df.select("id", text.alias("t")).orderBy("id").collect()]


def test_templates(spark):
    loop = "{%- for m in messages %}{{ loop.index }}/{{ m.role | trim }}{% if not loop.last %}, {% endif %}{%- endfor %}"
    assert rendered(spark, loop) == ["1/system, 2/user, 3/assistant", "1/user", ""]
    first = (
        "{% if messages[0]['role'] == 'system' %}\n    {% set head = messages[0]['content'] | trim %}\n    {% set rest = messages[1:] %}\n"
        "{% else %}\n{% set head = 'none|true' %}{% set rest = messages %}{% endif %}\n[{{ head }}] {% for m in rest %}"
        "{% if m['role'] in 'user' and m.content != '' or false %}{{ m['content'] + '\\n' }}{% elif m['role'] == 'assistant' %}A{{ eos }}{% else %}?{% endif %}"
        "{% endfor %}"
    )
    assert rendered(spark, first, eos="</s>") == ["[Be kind.] Hi 'you'\n\nA</s>", "[none|true] a\n", "[none|true] "]
    fixed = "{% if add %}x{% else %}{{ messages | length }}{% endif %}{# gone #}\n!"
    assert rendered(spark, fixed, add=True) == ["x!"] * 3 and rendered(spark, fixed, add=False) == ["3!", "1!", "0!"]


@pytest.mark.parametrize("bad", ["{% macro f() %}{% endmacro %}", "{{ x }}", "{{ messages | tojson }}", "{% for m in messages %}", "{{ f(1) }}", "{% if a %}"])
def test_other_templates_are_refused(spark, bad):
    with pytest.raises((TemplateError, ValueError)):
        compile_template(bad, messages=F.col("messages"))


def test_sequence_losses_weigh_positions(spark):
    rng = np.random.default_rng(1)
    rows, want, n = [], 0.0, 0
    for i in range(30):
        steps = int(rng.integers(0, 6))
        x = rng.normal(size=(steps, 4))
        y = [int(v) if rng.random() > 0.3 else -100 for v in rng.integers(0, 4, steps)]
        rows.append((i, x.tolist(), y))
        for a, b in zip(x, y):
            if b != -100:
                want += math.log(np.exp(a).sum()) - a[b]
                n += 1
    df = spark.createDataFrame(rows, "id INT, x ARRAY<ARRAY<DOUBLE>>, y ARRAY<INT>").withColumn("loss", losses.sequence_loss("x", "y"))
    got = metrics.eval_loss_by_position(df).first()
    assert got.positions == n and abs(got.eval_loss - want / n) < 1e-9
    assert metrics.eval_loss_by_position(df.limit(0)).first().eval_loss is None


def test_scales_of_two_levels(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(70, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id LONG, embedding ARRAY<FLOAT>")
    coded, tops, mean = vectors.quantize_scales(vectors.quantize_vectors(df, block=4), ["id"], per_vector=2, group=10)
    scales = np.abs(x.astype(float)).reshape(70, 2, 4).max(axis=2)
    assert abs(mean - scales.mean()) < 1e-6
    far = np.abs(scales - mean).ravel().reshape(14, 10).max(axis=1)
    assert np.allclose([r.far for r in tops.orderBy("group").collect()], far)
    codes = np.array([r.scale_codes for r in coded.orderBy("id").collect()])
    assert np.abs(codes).max() == 127
    back = np.array([r.scales for r in vectors.dequantize_scales(coded, ["id"], tops, mean, 2, 10).orderBy("id").collect()])
    assert np.abs(back - scales).max() <= far.max() / 254 + 1e-9


def test_gradient_fit_separates(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(9)) + (" good" if i % 2 else " bad"), i % 2) for i in range(80)]
    df = spark.createDataFrame([*rows, (80, "", 0), (81, None, 0)], "doc_id LONG, text STRING, label INT")
    x = classifier.hashed_features(df, "doc_id")
    weights = classifier.train_gradient(x, turns=30)
    got = classifier.classify_gradient(x, weights)
    assert got.count() == 82 and got.filter("prediction = label AND doc_id < 80").count() == 80
    assert classifier.train_gradient(x.limit(0)) == []
