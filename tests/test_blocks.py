import random
from collections import Counter
from itertools import pairwise

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.tokens import split_tokens, text_lengths, token_arrays
from tokenloom.operators import batches, bigram, blocks, tokenize, vocab

SPECIALS = ("<unk>", "<eos>", "<eos>+")


def odd_texts():
    rng = random.Random(3)
    made = ["".join(rng.choice([" ", "\n", "\t", "\r", "\f", " ", "é", "日", "a", "b", "<eos>", "<eos>+", "<"]) for _ in range(rng.randrange(40))) for _ in range(400)]
    return [*made, None, "", " ", "a", "<unk>", " <unk> ", "a\n"]


def test_token_arrays_split_as_the_expression_does(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    for specials in ((), SPECIALS):
        rows = df.select("id", split_tokens("text", specials).alias("t"), text_lengths("text", specials).alias("n")).orderBy("id").collect()
        tokens, sizes = token_arrays(pa.array(["x y", *texts], pa.string()).slice(1), specials)
        assert tokens.to_pylist() == [t for r in rows for t in r.t]
        assert sizes.tolist() == [len(r.t) for r in rows] == [r.n for r in rows]
        want = {r.token: r.n for r in df.select(F.explode(split_tokens("text", specials)).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
        got = {r.token: r.n for r in vocab.token_counts(df, specials=specials).collect()}
        assert got == {t: n for t, n in want.items() if t not in specials}


@pytest.mark.parametrize("limit", [3_000, 1 << 26])
def test_no_token_is_a_row_of_its_own(spark, monkeypatch, limit):
    """Many small blocks, equal and null keys: the same ids and texts as by ranges, without a row for each token."""
    monkeypatch.setattr(blocks, "BLOCK_KEYS", 50)
    monkeypatch.setattr(blocks, "KEYS_IN_ROW", 7)
    monkeypatch.setattr(blocks, "SLICE", 20)
    texts = odd_texts()
    df = spark.createDataFrame([(i // 3 if i < 60 else None if i < 62 else i, t) for i, t in enumerate(texts)], "id INT, text STRING")
    words = vocab.build_vocab(df, specials=SPECIALS)
    ids = tokenize.encode(df, words, ["id"], specials=SPECIALS, limit=limit)
    by_range = tokenize.encode(df, words, ["id"], specials=SPECIALS, limit=0)
    assert {r.id: r.input_ids for r in ids.collect()} == {r.id: r.input_ids for r in by_range.collect()}
    single = df.filter("id >= 62")
    ids = tokenize.encode(single, words, ["id"], specials=SPECIALS, limit=limit)
    text = tokenize.decode(ids, words, ["id"], limit=limit)
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (ids, text)]
    assert not any("ObjectHashAggregate" in p or "Window" in p for p in plans)
    assert {r.id: r.text for r in text.collect()} == {r.id: r.text or "" for r in single.collect()}
    tokens = tokenize.decode_tokens(ids, words, ["id"], limit=limit).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "token_id"))).alias("t"))
    known = {r.id: r.input_ids for r in ids.collect()}
    assert {r.id: [x.token_id for x in r.t] for r in tokens.collect()} == {i: v for i, v in known.items() if v}


def test_decoding_lists_of_one_key_and_unknown_ids(spark):
    words = spark.createDataFrame([(0, "a", False), (1, " b", False), (2, "<eos>", True)], vocab.VOCAB_SCHEMA)
    df = spark.createDataFrame([(1, [0, 9, 1, None, 2]), (2, None), (3, [])], "id INT, input_ids ARRAY<INT>")
    assert {r.id: r.text for r in tokenize.decode(df, words, ["id"]).collect()} == {1: "a b<eos>", 2: "", 3: ""}
    assert {r.id: r.text for r in tokenize.decode(df, words, ["id"], skip_special=True, limit=0).collect()} == {1: "a b", 2: "", 3: ""}
    twice = df.union(spark.createDataFrame([(1, [1, 0])], df.schema))
    assert {r.id: r.text for r in tokenize.decode(twice, words, ["id"]).collect()}[1] == " baa b<eos>"


def test_ranges_compare_plain_numbers_first(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-3, 9)]) if i % 50 else None, f"k{rng.randrange(10**6)}") for i in range(900)]
    df = spark.createDataFrame(rows, "a INT, b STRING")
    from tokenloom.operators.ordering import key_ranges

    ranges = key_ranges(df.filter("a IS NOT NULL"), ["a", "b"], buckets=40)
    both = df.select(ranges.column().alias("x"), ranges._searched().alias("y")).collect()
    assert all(r.x == r.y for r in both) and len({r.x for r in both}) > 20
    full = [tuple(r) for r in df.filter("a IS NOT NULL").collect()]
    got = batches.with_ordinal(df.filter("a IS NOT NULL").distinct(), ["a", "b"]).orderBy("ordinal").collect()
    assert [(r.a, r.b) for r in got] == sorted(set(full))


def test_pairs_are_counted_before_they_are_rows(spark, monkeypatch):
    """Small blocks, specials, null and empty texts, unknown tokens: the pairs of the encoded texts, without a row for each token."""
    monkeypatch.setattr(blocks, "BLOCK_KEYS", 50)
    monkeypatch.setattr(blocks, "KEYS_IN_ROW", 7)
    df = spark.createDataFrame(list(enumerate(odd_texts())), "id INT, text STRING").repartition(3)
    words = vocab.build_vocab(df.filter("id % 7 > 0"), specials=SPECIALS)
    ids = {r.id: r.input_ids for r in tokenize.encode(df, words, ["id"], specials=SPECIALS).collect()}
    mark = vocab.token_id(words, "<eos>")
    for end, tail in ((None, []), ("<eos>", [mark]), ("nowhere", [vocab.token_id(words, "<unk>")])):
        got = bigram.text_pair_counts(df, words, specials=SPECIALS, end=end)
        assert "Generate explode" not in got._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
        want = Counter(p for v in ids.values() for p in pairwise([*v, *tail]))
        rows = got.collect()
        assert {(r.prev, r.next): r.n for r in rows} == want and len(rows) == len(want)
    with pytest.raises(ValueError):
        bigram.text_pair_counts(df, words.union(words.limit(1)), specials=SPECIALS)


def test_pairs_come_out_of_arrow_already_counted(spark):
    df = spark.createDataFrame([("a b " * 500,)] * 4, "text STRING").coalesce(1)
    words = vocab.build_vocab(df, specials=SPECIALS)
    rows, known = tokenize.numbered_texts(df, words.select("token", F.col("id").alias("token_id")), [], "text", SPECIALS, 0, True)
    assert blocks.adjacent(rows, known).count() <= 5 * 4  # 4,000 pairs


def test_ranges_look_up_the_distinct_tokens_of_blocks(spark):
    """With nothing broadcast, a token is looked up once a block, however often and in however many texts it stands."""
    df = spark.createDataFrame([(i, "a b " * 50) for i in range(40)], "id INT, text STRING").coalesce(1)
    words = vocab.build_vocab(df, specials=SPECIALS)
    known = words.select("token", F.col("id").alias("token_id"))
    ids, repeated = tokenize.encode_in_ranges(df, known, ["id"], "text", SPECIALS, vocab.token_id(words, "<unk>"), "input_ids")
    assert not repeated and {r.n for r in ids.select(F.size("input_ids").alias("n")).collect()} == {101}
    staged = blocks.numbered_rows(df, ["id"], "text", blocks.numbered_tokens(SPECIALS), blocks.keys_of_texts, T.StringType())
    assert blocks.each_key("token")(staged).filter("token IS NOT NULL").count() <= 400  # of 4,040 tokens
