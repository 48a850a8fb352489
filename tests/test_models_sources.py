import json
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.prompts import prompt_full
from tokenloom.functions.tokens import split_tokens
from tokenloom.operators import bigram, blocks, classifier, lookup, metrics, udfs, vocab
from tokenloom.sources import sinks, tables


def sequences(seed=3, rows=60, tokens=12):
    rng = random.Random(seed)
    return [[rng.randrange(tokens) for _ in range(rng.randrange(9))] + [99] for _ in range(rows)]


def pairs(seqs):
    return Counter((a, b) for s in seqs for a, b in zip(s, s[1:]))


def frame(spark, seqs):
    return spark.createDataFrame(list(enumerate(seqs)), "id INT, input_ids ARRAY<INT>")


def test_pair_counts_and_perplexity(spark):
    train, held = sequences(1), sequences(2)
    model, seen = (bigram.pair_counts(frame(spark, s)) for s in (train, held))
    assert {(r.prev, r.next): r.n for r in model.collect()} == dict(pairs(train))
    m, context = pairs(train), Counter(a for s in train for a in s[:-1])
    losses = [-math.log((m[a, b] + 1) / (context[a] + 20)) for s in held for a, b in zip(s, s[1:])]
    r = bigram.eval_ngram(model, seen, 20).first()
    assert r.tokens == len(losses) and r.eval_loss == pytest.approx(sum(losses) / len(losses))
    assert r.perplexity == pytest.approx(math.exp(r.eval_loss))


def test_delta_lifecycle(spark, tmp_path):
    base, delta = sequences(4), sequences(5)
    path = str(tmp_path / "delta")
    bigram.save_delta(bigram.pair_counts(frame(spark, delta)), path)
    merged = bigram.load_delta(bigram.pair_counts(frame(spark, base)), path)
    assert {(r.prev, r.next): r.n for r in merged.collect()} == dict(pairs(base + delta))


@pytest.mark.parametrize("small", [True, False])
def test_greedy_generation_equals_the_loop(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(bigram, "fits_broadcast", lambda table: False)
        monkeypatch.setattr(lookup, "fits_broadcast", lambda table: False)
    train = sequences(6)
    counts = pairs(train)
    best = {}
    for (a, b), n in counts.items():
        if a not in best or (n, -b) > (counts[a, best[a]], -best[a]):
            best[a] = b
    prompts = [[5, i] for i in range(14)] + [[99], [3]]
    limit = 6

    def walk(t):
        out = []
        while len(out) < limit and t != 99 and t in best:
            t = best[t]
            out.append(t)
        return out

    got = bigram.generate_greedy(frame(spark, prompts), bigram.pair_counts(frame(spark, train)), ["id"], 99, limit)
    assert {r.id: r.generated for r in got.collect()} == {i: walk(p[-1]) for i, p in enumerate(prompts)}


def test_classifier_learns_a_clear_word(spark):
    rows = [(i, "good fine day" if i % 2 else "bad poor day", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id INT, text STRING, label INT")
    model = classifier.train_classifier(df)
    assert metrics.accuracy(classifier.classify(model, df)).first().accuracy == 1.0


def test_json_array_and_lines(spark, tmp_path):
    rows = [
        {"instruction": "a", "input": "", "output": "x"},
        {"instruction": "b", "input": None, "output": "y"},
        {"instruction": "c", "output": "z {}"},
    ]
    array, lines = tmp_path / "a.json", tmp_path / "l.json"
    array.write_text(json.dumps(rows, indent=2))
    lines.write_text("\n".join(json.dumps(r) for r in rows))
    want = [("a", "", "x"), ("b", None, "y"), ("c", None, "z {}")]
    read = tables.read_instructions(spark, str(array)).orderBy("id").collect()
    assert [tuple(r)[1:] for r in read] == [(i, *w) for i, w in enumerate(want)]
    assert [tuple(r) for r in tables.read_instructions(spark, str(lines), lines=True).collect()] == want
    split = tables.convert_instructions(spark, str(array), str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.id, r.instruction) for r in split] == [(0, "a"), (1, "b"), (2, "c")]


def test_text_sources(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one\ntwo\n")
    assert [r.text for r in tables.read_text(spark, str(tmp_path / "t.txt")).collect()] == ["one", "two"]
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "id INT, text STRING, split STRING")
    sinks.write_packed(df, str(tmp_path / "p"))
    assert [r.text for r in tables.read_text(spark, str(tmp_path / "p"), "test").collect()] == ["b"]
    assert [tuple(r) for r in sinks.read_packed(spark, str(tmp_path / "p"), "train").collect()] == [(1, "a")]


def test_conversations_become_instructions(spark):
    turns = [
        (1, 0, "system", "S"),
        (1, 1, "user", "u1"),
        (1, 2, "assistant", "a1"),
        (1, 3, "user", "u2"),
        (1, 4, "user", "u3"),
        (1, 5, "assistant", "a3"),
        (2, 0, "user", "v"),
        (2, 1, "assistant", "w"),
        (2, 2, "assistant", "again"),
    ]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING")
    got = sorted(tuple(r) for r in tables.from_conversations(df).collect())
    assert got == [(1001, "u1", "S", "a1"), (1004, "u3", "S", "a3"), (2000, "v", "", "w")]
    wide = {r.id for r in tables.from_conversations(df, 10).collect()}
    assert wide == {11, 14, 20}
    with pytest.raises(Exception, match="larger one"):
        tables.from_conversations(df, 4).collect()


def test_the_reply_is_the_next_turn(spark):
    turns = [(1, 0, "system", "S"), (1, 1, "user", "u"), (1, 3, "assistant", "a"), (1, 4, "user", "v"), (1, 5, "assistant", "b")]
    turns += [(2, 1, "user", "u"), (2, 2, "system", "late"), (2, 3, "assistant", "a"), (2, 7, "user", "w"), (2, 9, "assistant", "x")]
    turns += [(3, 1, "user", "last"), (4, 0, "assistant", "first"), (None, 1, "user", "u"), (5, None, "user", "u")]
    turns += [(6, 1, "user", "twice"), (6, 1, "user", "twice"), (6, 2, "assistant", "once")]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING").repartition(3)
    got = sorted(tuple(r) for r in tables.from_conversations(df).collect())
    assert got == [(1001, "u", "S", "a"), (1004, "v", "S", "b"), (2007, "w", "late", "x"), (6001, "twice", "", "once")]


def test_only_finished_steps_count(spark, tmp_path):
    path = str(tmp_path / "steps")
    assert sinks.latest_step(spark, path) is None
    (tmp_path / "steps").mkdir()
    assert sinks.latest_step(spark, path) is None
    rows = spark.createDataFrame([(1,), (2,)], "w INT")
    sinks.write_step(rows, path, 5)
    sinks.write_step(rows.limit(0), path, 10)
    rows.write.parquet(f"{path}/data/step=20/unfinished")
    assert sinks.latest_step(spark, path) == 10
    assert sinks.read_step(spark, path, 10).count() == 0 and sinks.read_step(spark, path, 5).count() == 2
    sinks.write_step(rows.limit(1), path, 5)
    assert sinks.read_step(spark, path, 5).count() == 1
    with pytest.raises(KeyError):
        sinks.read_step(spark, path, 20)


def test_naive_bayes_equals_the_formula(spark):
    train = [(1, 0, "a a b"), (2, 1, "b c c C"), (3, 1, "c d"), (4, 0, "")]
    held = [(10, 0, "a b x"), (11, 1, "c d d"), (12, 0, ""), (13, 1, None)]
    schema = "doc_id LONG, label INT, text STRING"
    model = classifier.train_naive_bayes(spark.createDataFrame(train, schema))
    got = classifier.classify_naive_bayes(model, spark.createDataFrame(held, schema), "doc_id")
    counts = {y: Counter(w.lower() for _, l, t in train if l == y for w in t.split()) for y in (0, 1)}
    size = len(counts[0] | counts[1])

    def score(y, text):
        words = (text or "").lower().split()
        return math.log(0.5) + sum(math.log((counts[y][w] + 1) / (counts[y].total() + size)) for w in words)

    want = {i: max((0, 1), key=lambda y: (round(score(y, t), 9), -y)) for i, _, t in held}
    assert {r.doc_id: r.prediction for r in got.collect()} == want


def test_steps_are_saved_and_resumed(spark, tmp_path):
    path = str(tmp_path / "ckpt")
    for step in (50, 100, 9):
        sinks.write_step(spark.createDataFrame([(step * 1.5,)], "w DOUBLE"), path, step)
    assert sinks.latest_step(spark, path) == 100
    assert sinks.read_step(spark, path, 9).first().w == 13.5
    plan = spark.range(1, 121).withColumnRenamed("id", "step")
    assert sinks.resume_after(plan, 100).count() == 20 and sinks.resume_after(plan, None).count() == 120
    due = sinks.save_due(plan.withColumn("epoch_end", F.col("step") == 70), 50)
    assert [r.step for r in due.orderBy("step").collect()] == [50, 70, 100]


def test_user_functions(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(25)], "id LONG, text STRING").repartition(4)

    def repeat(batch):
        return pd.concat([batch, batch]).assign(n=lambda b: b["text"].str.len())

    twice = udfs.map_batches(df, repeat, "id LONG, n LONG", ["text"])
    assert sorted(tuple(r) for r in twice.collect()) == sorted([(i, i) for i in range(25)] * 2)
    rows = udfs.map_rows(df, lambda r: {"id": r["id"], "up": r["text"].upper()}, "id LONG, up STRING")
    assert {r.id: r.up for r in rows.collect()} == {i: "X" * i for i in range(25)}
    sizes = udfs.map_fixed_batches(
        df, lambda b: pd.DataFrame({"ids": [",".join(map(str, b["id"]))]}), "ids STRING", ["id"], 10
    )
    assert sorted(r.ids for r in sizes.collect()) == sorted(
        ",".join(map(str, range(s, min(s + 10, 25)))) for s in (0, 10, 20)
    )


def test_column_functions_on_a_stream(spark, tmp_path):
    rows = [(i, f"say {i}", "", str(i)) for i in range(5)]
    schema = "id INT, instruction STRING, input STRING, output STRING"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    texts = stream.select("id", prompt_full().alias("text"), F.size(split_tokens(prompt_full())).alias("n"))
    query = texts.writeStream.format("memory").queryName("prompts").trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = {r.id: r.text for r in spark.table("prompts").collect()}
    assert set(got) == set(range(5)) and got[3].endswith("say 3\n\n### Response:\n3")


def test_generation_from_texts_without_tokens(spark):
    """An empty and a null text have no last token, an empty list of ids no last id."""
    rows = [(0, "a b"), (1, ""), (2, None), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    v = vocab.build_vocab(docs, specials=("<unk>", "<eos>"))
    model = bigram.text_pair_counts(docs, v, specials=("<unk>", "<eos>"), end="<eos>")
    last = bigram.last_ids(docs, v, ["doc_id"], specials=("<unk>", "<eos>"))
    ids = vocab.token_ids(v, ["a", " b", "<eos>"])
    assert {r.doc_id: r.input_ids for r in last.collect()} == {0: [ids[" b"]], 1: [], 2: [], 3: [ids["a"]]}
    best = ids[" b"] if ids[" b"] < ids["<eos>"] else ids["<eos>"]  # a tie: the lowest id
    got = bigram.generate_greedy(last, model, ["doc_id"], ids["<eos>"], 3)
    after_a = [best] if best == ids["<eos>"] else [best, ids["<eos>"]]
    assert {r.doc_id: r.generated for r in got.collect()} == {0: [ids["<eos>"]], 1: [], 2: [], 3: after_a}


def test_walks_are_the_same_one_broadcast_at_a_time(spark, monkeypatch):
    model = spark.createDataFrame([(i, (i * 7 + 1) % 40, 1) for i in range(40)], "prev INT, next INT, n LONG")
    prompts = spark.createDataFrame([(i, [i]) for i in range(45)], "id INT, input_ids ARRAY<INT>")

    def walk(t):
        out = []
        while len(out) < 9 and t != 12 and t < 40:
            t = (t * 7 + 1) % 40
            out.append(t)
        return out

    for limit in (bigram.BROADCAST_BYTES, 80 * 50):
        monkeypatch.setattr(bigram, "BROADCAST_BYTES", limit)
        got = bigram.generate_greedy(prompts, model, ["id"], 12, 9)
        assert {r.id: r.generated for r in got.collect()} == {i: walk(i) for i in range(45)}


def test_pairs_are_counted_by_sorting():
    both, n = blocks.counts_of(np.array([5, 3, 5, -1, 3, 5]))
    assert both.tolist() == [-1, 3, 5] and n.tolist() == [1, 2, 3]
    assert [len(x) for x in blocks.counts_of(np.zeros(0, np.int64))] == [0, 0]
