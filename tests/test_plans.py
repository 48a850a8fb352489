"""Physical plans and skewed inputs."""

import re

import pytest

from tokenloom.operators import packing, tokenize, vocab
from tokenloom.operators.ordering import key_ranges, running_total
from tokenloom.plans.flows import SPECIALS, pack_corpus
from tokenloom.sources.tables import from_conversations
from tokenloom.staging import stage


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", plan)


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [f"w{i % 11} " * (i % 9) for i in range(300)]
    return stage(spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING"))


def test_packing_a_corpus_moves_the_texts_once(corpus):
    v = vocab.build_vocab(corpus, specials=SPECIALS)
    for packer in (packing.pack_overlap, packing.pack_disjoint):
        packed = pack_corpus(corpus, v, ["id"], packer, length=16, buckets=4)
        assert exchanges(packed) == ["shufflepartitionidpassthrough"]


def test_packing_ids_moves_them_once(corpus):
    v = vocab.build_vocab(corpus, specials=SPECIALS)
    ids = stage(tokenize.encode(corpus, v, ["id"], specials=SPECIALS))
    assert exchanges(packing.pack_overlap(ids, ["id"], 16, buckets=4)) == ["shufflepartitionidpassthrough"]
    assert exchanges(packing.group_texts(ids, ["id"], 16, 10, buckets=4)) == ["shufflepartitionidpassthrough"]


def test_only_the_range_table_is_in_one_partition(corpus):
    ranges = key_ranges(corpus, ["id"], buckets=4)
    found = exchanges(running_total(corpus, ["id"], ranges=ranges))
    assert sorted(found) == ["SinglePartition", "hashpartitioning", "shufflepartitionidpassthrough"]


def test_ids_are_collected_where_the_texts_are(corpus):
    v = vocab.build_vocab(corpus, specials=SPECIALS)
    assert exchanges(tokenize.encode(corpus, v, ["id"], specials=SPECIALS)) == ["hashpartitioning"]


def test_one_conversation_with_most_turns(spark, monkeypatch):
    from tokenloom.operators import lookup

    monkeypatch.setattr(lookup, "fits_broadcast", lambda table: False)
    turns = [(1, 0, "system", "S")]
    for t in range(1, 801):
        turns.append((1, t, "user" if t % 2 else "assistant", f"t{t}"))
    for c in range(2, 60):
        turns += [(c, 0, "user", "q"), (c, 1, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING")
    rows = from_conversations(df).collect()
    assert len(rows) == 400 + 58 and sum(r.input == "S" for r in rows) == 400


def test_one_token_with_most_occurrences_and_a_large_vocabulary(spark):
    texts = ["the " * 50 + f"rare{i}" for i in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING")
    v = vocab.build_vocab(df, specials=SPECIALS)
    ids = [tokenize.encode(df, v, ["id"], specials=SPECIALS, small=s).orderBy("id").collect() for s in (True, False)]
    assert ids[0] == ids[1]
    back = tokenize.decode(tokenize.encode(df, v, ["id"], specials=SPECIALS), v, ["id"]).orderBy("id").collect()
    assert [r.text for r in back] == texts


def test_uneven_lengths_and_sparse_keys(spark):
    """Half of the tokens in a tenth of the key range, and a far outlier."""
    lengths = [200 if i < 20 else 3 for i in range(300)]
    stream, rows = 0, []
    for i, n in enumerate(lengths):
        rows.append((i if i < 299 else 10**15, list(range(stream, stream + n))))
        stream += n
    df = spark.createDataFrame(rows, "key LONG, input_ids ARRAY<INT>").repartition(5)
    got = packing.pack_padded(df, ["key"], 32, -1, buckets=6).orderBy("seq_id").collect()
    flat = [t for r in got for t in r.input_ids if t >= 0]
    assert flat == list(range(stream)) and len(got) == -(-stream // 32)
    layout = packing.stream_layout(df.selectExpr("key", "size(input_ids) AS n"), ["key"], 32, buckets=6)
    assert layout.ranges.buckets >= 4


def test_staged_tables_are_released(spark, tmp_path):
    import os

    from tokenloom.staging import released, stage, staging_root

    kept = stage(spark.range(3), "kept")
    with released():
        table = stage(spark.range(5), "mine")
        assert table.count() == 5
        folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and kept.count() == 3 and staging_root(spark)
