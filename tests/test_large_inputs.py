import json
import random

import pytest

from tests.test_plans import exchanges
from tokenloom.operators import tokenize, vocab
from tokenloom.plans import flows
from tokenloom.plans.flows import SPECIALS
from tokenloom.sources.arrays import read_array


def hard_text(rng):
    return "".join(rng.choice(["}", "{", '"', "\\", "[", "]", ",", "x", "é", "\n", " }{ ", '\\"']) for _ in range(rng.randrange(30)))


@pytest.mark.parametrize("range_bytes", [None, 700])
def test_arrays_cut_anywhere(spark, tmp_path, range_bytes):
    rng, want = random.Random(1), {}
    for k, n in enumerate((300, 1, 57)):
        rows = [{"a": hard_text(rng), "meta": {"b": {"c": hard_text(rng)}, "l": [{"z": 1}, {}]}} for _ in range(n)]
        name = f"f{k}.json"
        (tmp_path / name).write_text(json.dumps(rows, indent=(None, 2, 1)[k], ensure_ascii=k == 0) + "\n" * k)
        want |= {(name, i): (r["a"], r["meta"]["b"]["c"]) for i, r in enumerate(rows)}
    (tmp_path / "none.json").write_text("[ ]\n")
    df = read_array(spark, str(tmp_path), "a STRING, meta STRUCT<b: STRUCT<c: STRING>>", range_bytes)
    got = {(r.file.rsplit("/", 1)[1], r.id): (r.a, r.meta.b.c) for r in df.collect()}
    assert got == want


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.choice((0, 1, 5, 60))))) for i in range(300)]
    return spark.createDataFrame([*rows, (300, None), (301, "new <eos> unseen")], "id LONG, text STRING").cache()


@pytest.fixture(scope="module")
def learned(spark, corpus):
    return vocab.build_vocab(corpus.filter("id < 300"), specials=SPECIALS)


@pytest.mark.parametrize("limit", [0, 3_000, 1 << 26])
def test_any_broadcast_limit_gives_the_same_ids_and_texts(spark, corpus, learned, limit):
    def ids(**args):
        return tokenize.encode(corpus, learned, ["id"], specials=SPECIALS, **args)

    want = {r.id: r.input_ids for r in ids(small=True).collect()}
    got = ids(limit=limit)
    assert {r.id: r.input_ids for r in got.collect()} == want
    texts = {r.id: r.text for r in tokenize.decode(got, learned, ["id"], limit=limit).collect()}
    assert texts == {r.id: r.text for r in tokenize.decode(got, learned, ["id"]).collect()}
    assert texts[301].endswith(" <unk>") or "<unk>" in texts[301]
    assert all(texts[r.id] == (r.text or "") for r in corpus.filter("id <= 300").collect())
    tokens = tokenize.decode_tokens(got, learned, ["id"], limit=limit)
    assert sorted(map(tuple, tokens.collect())) == sorted(map(tuple, tokenize.decode_tokens(got, learned, ["id"]).collect()))
    packed = [flows.pack_corpus(corpus, learned, ["id"], length=16, limit=n).collect() for n in (limit, 1 << 26)]
    assert sorted(map(tuple, packed[0])) == sorted(map(tuple, packed[1]))


def test_texts_move_once_and_tokens_never(spark, corpus, learned):
    """One exchange of texts; the others are of distinct tokens of a range and of the vocabulary."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tokenize.encode(corpus, learned, ["id"], specials=SPECIALS, limit=0)
        assert exchanges(plan) == ["hashpartitioning"] * 4
        text = plan._jdf.queryExecution().executedPlan().toString()
        above = text[: text.index("REPARTITION_BY_NUM")]  # from the result down to the exchange of the texts
        assert above.count("Exchange") == 1 and "posexplode" in above and "Window" in above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
