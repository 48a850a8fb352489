import random
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.tokens import split_tokens
from tokenloom.operators import tokenize, vocab
from tokenloom.operators.lookup import lookup, split_lookup

SPECIALS = ("<unk>", "<bos>", "<eos>", "<|x.y|>", "<|x.y|>+")


def by_hand(text, specials):
    out, rest = [], text or ""
    pattern = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    for i, part in enumerate(re.split(f"({pattern})", rest) if specials else [rest]):
        out += [part] if i % 2 else re.findall(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+", part)
    return out


def random_texts(n=400):
    rng = random.Random(5)
    pieces = ["a", "bb", "é", "漢字", " ", "  ", "\n", "\t", "\r\n", "<eos>", "<|x.y|>", "<|x.y|>+", "<", " ", "😀", "$1\\"]
    return [None, "", " "] + ["".join(rng.choices(pieces, k=rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("specials", [(), SPECIALS])
def test_split_matches_hand_written_rule_and_loses_nothing(spark, specials):
    df = spark.createDataFrame(list(enumerate(random_texts())), "id INT, text STRING")
    for r in df.select("text", split_tokens("text", specials).alias("t")).collect():
        assert r.t == by_hand(r.text, specials)
        assert "".join(r.t) == (r.text or "")


@pytest.fixture(scope="module")
def corpus(spark):
    texts = ["the cat the dog", "the cat", "", None, "a <eos>b", "\n"]
    return spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")


@pytest.fixture(scope="module")
def words(corpus):
    return vocab.build_vocab(corpus, specials=("<unk>", "<eos>"))


def test_vocabulary_ranks_by_count_then_token(words):
    got = [tuple(r) for r in words.orderBy("id").collect()]
    assert got == [
        (0, " cat", False),
        (1, "the", False),
        (2, "\n", False),
        (3, " ", False),
        (4, " dog", False),
        (5, " the", False),
        (6, "a", False),
        (7, "b", False),
        (8, "<unk>", True),
        (9, "<eos>", True),
    ]


def test_encode_and_decode(spark, corpus, words):
    ids = tokenize.encode(corpus, words, ["id"], specials=("<unk>", "<eos>"))
    got = {r.id: r.input_ids for r in ids.collect()}
    assert got == {0: [1, 0, 5, 4], 1: [1, 0], 2: [], 3: [], 4: [6, 3, 9, 7], 5: [2]}
    back = {r.id: r.text for r in tokenize.decode(ids, words, ["id"]).collect()}
    assert back == {0: "the cat the dog", 1: "the cat", 2: "", 3: "", 4: "a <eos>b", 5: "\n"}
    plain = {r.id: r.text for r in tokenize.decode(ids, words, ["id"], skip_special=True).collect()}
    assert plain[4] == "a b"
    tokens = tokenize.decode_tokens(ids, words, ["id"]).filter("id = 1").orderBy("pos").collect()
    assert [(t.pos, t.token_id, t.token) for t in tokens] == [(0, 1, "the"), (1, 0, " cat")]


def test_unknown_words(spark, words):
    df = spark.createDataFrame([(1, "the zebra")], "id INT, text STRING")
    assert tokenize.encode(df, words, ["id"]).first().input_ids == [1, 8]


def test_vocabulary_edits(spark, words):
    renamed, kept = vocab.rename_token(words, "<eos>", "<|tool_call|>")
    assert kept == 9 and vocab.token_id(renamed, "<|tool_call|>") == 9
    assert vocab.vocab_size(renamed) == vocab.vocab_size(words) == 10
    with pytest.raises(ValueError):
        vocab.rename_token(words, "<eos>", "the")
    with pytest.raises(KeyError):
        vocab.rename_token(words, "nope", "x")
    grown, added = vocab.add_tokens(words, ["<TIME>", "the", "<DATE>", "<TIME>"])
    assert added == 2 and vocab.token_ids(grown, ["<TIME>", "<DATE>"]) == {"<TIME>": 10, "<DATE>": 11}
    assert vocab.vocab_size(grown, added=False) == 8
    assert [r.token for r in vocab.added_tokens(grown).collect()] == ["<unk>", "<eos>", "<TIME>", "<DATE>"]
    same, none = vocab.add_tokens(words, ["the"])
    assert none == 0 and vocab.vocab_size(same) == 10


def test_added_tokens_are_not_split(spark, words):
    grown, _ = vocab.add_tokens(words, ["<DATE>"])
    df = spark.createDataFrame([(1, "the<DATE> cat")], "id INT, text STRING")
    ids = tokenize.encode(df, grown, ["id"], specials=("<unk>", "<eos>", "<DATE>"))
    assert ids.first().input_ids == [1, 10, 0]


def test_special_tokens_map(words):
    roles = vocab.special_tokens_map(words, {"eos": "<eos>", "pad": "<eos>", "bos": "<bos>"})
    assert {r.role: r.id for r in roles.collect()} == {"eos": 9, "pad": 9, "bos": None}


def test_resize_embeddings(spark, words):
    known = spark.createDataFrame([(0, [1.0, 2.0]), (50, [9.0, 9.0])], "id INT, embedding ARRAY<FLOAT>")
    rows = {r.id: r.embedding for r in vocab.resize_embeddings(words, known, 2).collect()}
    again = {r.id: r.embedding for r in vocab.resize_embeddings(words.repartition(3), known, 2).collect()}
    assert rows == again and sorted(rows) == list(range(10)) and rows[0] == [1.0, 2.0]
    fresh = [tuple(rows[i]) for i in range(1, 10)]
    assert len(set(fresh)) == 9 and all(0 < abs(x) < 0.2 for v in fresh for x in v)


def test_large_table_lookup_equals_broadcast(spark):
    rng = random.Random(1)
    keys = [rng.choice(["hot"] * 5 + ["absent"] * 3 + [None] + [f"k{rng.randrange(3000)}"]) for _ in range(8000)]
    df = spark.createDataFrame(list(enumerate(keys)), "id INT, key STRING")
    table = spark.createDataFrame([(f"k{i}", i) for i in range(2500)] + [("hot", -1)], "key STRING, v INT")
    want = sorted((r.id, r.v) for r in lookup(df, table, "key").collect())
    got = sorted((r.id, r.v) for r in split_lookup(df, table, "key").collect())
    assert got == want and len(got) == 8000


def test_large_vocabulary_encodes_alike(corpus, words):
    both = [tokenize.encode(corpus, words, ["id"], small=s).orderBy("id").collect() for s in (True, False)]
    assert both[0] == both[1]


def test_token_lengths(corpus):
    lengths = tokenize.token_lengths(corpus, specials=("<eos>",))
    assert [r.n for r in lengths.orderBy("id").select(F.col("n")).collect()] == [4, 2, 0, 0, 4, 1]
