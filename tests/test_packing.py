import random

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import sequences
from tokenloom.operators import packing
from tokenloom.operators.batches import row_at, shard_by_weight, with_ordinal
from tokenloom.operators.ordering import key_ranges
from tokenloom.operators.vocab import build_vocab, token_ids
from tokenloom.plans.flows import pack_corpus


def frame(spark, lists, partitions=3):
    """Rows whose key order is the list order, stored in another order."""
    rows = [(i * 7 - 40, ids) for i, ids in enumerate(lists)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "key LONG, input_ids ARRAY<INT>").repartition(partitions)


def chunks(stream, chunk, stride):
    return [stream[i : i + chunk] for i in range(0, len(stream), stride)]


def lists(seed, rows, longest):
    rng = random.Random(seed)
    counter = iter(range(10**6))
    return [[next(counter) for _ in range(rng.choice([0, 1, 2, longest]))] for _ in range(rows)]


CASES = [lists(1, 40, 9), lists(2, 120, 30), lists(3, 3, 100), [[]], [], [[1]], [[], [5, 6], []]]


@pytest.mark.parametrize("case,buckets,length", [(0, 1, 4), (0, 8, 11), (1, 5, 4), (2, 3, 7), (3, 1, 4), (4, 3, 4), (6, 3, 1)])
def test_packers_equal_one_long_list(spark, case, buckets, length):
    rows = CASES[case]
    stream = [t for ids in rows for t in ids]
    df = frame(spark, rows)
    a = packing.pack_disjoint(df, ["key"], length, buckets=buckets).orderBy("seq_id").collect()
    want = [c for c in chunks(stream, length + 1, length + 1) if len(c) == length + 1]
    assert [(r.input_ids, r.labels) for r in a] == [(c[:-1], c[1:]) for c in want]
    b = packing.pack_overlap(df, ["key"], length, buckets=buckets).orderBy("seq_id").collect()
    want = [stream[i : i + length + 1] for i in range(0, len(stream) - length, length)]
    assert [(r.seq_id, r.input_ids, r.labels) for r in b] == [(k, c[:-1], c[1:]) for k, c in enumerate(want)]
    d = packing.pack_padded(df, ["key"], length, -1, buckets=buckets).orderBy("seq_id").collect()
    want = chunks(stream, length, length)
    assert [r.input_ids for r in d] == [c + [-1] * (length - len(c)) for c in want]
    assert [r.real for r in d] == [len(c) for c in want]


@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_sequence_counts_around_the_length(spark, extra):
    length = 6
    for n in (length + extra, 2 * length + extra):
        df = frame(spark, [list(range(n))])
        assert packing.pack_disjoint(df, ["key"], length).count() == n // (length + 1)
        assert packing.pack_overlap(df, ["key"], length).count() == max(0, (n - 1) // length)
        assert packing.pack_padded(df, ["key"], length, 0).count() == -(-n // length)


def test_most_chunks_far_longer_than_ranges(spark):
    """Ranges shorter than a chunk are joined."""
    rows = [[i, i] for i in range(60)]
    df = frame(spark, rows)
    layout = packing.stream_layout(df.select("key", F.lit(2).alias("n")), ["key"], 25, buckets=20)
    gaps = [b - a for a, b in zip(layout.starts, layout.starts[1:])]
    assert layout.ranges.buckets > 1 and min(gaps) >= 24
    stream = [t for ids in rows for t in ids]
    got = packing.chunk_stream(df, ["key"], 25, 25, buckets=20).orderBy("seq_id").collect()
    assert [r.tokens for r in got] == chunks(stream, 25, 25)


def test_result_does_not_depend_on_partitions(spark):
    rows = lists(9, 200, 17)
    results = []
    for shuffle, stored in ((1, 1), (3, 7), (8, 2)):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        df = packing.pack_overlap(frame(spark, rows, stored), ["key"], 8)
        results.append(sorted(tuple(r.input_ids) for r in df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1] == results[2]


def group_by_hand(rows, block, batch, workers):
    out, first = [], 0
    for w in range(workers):
        size = len(rows) // workers + (w < len(rows) % workers)
        shard = rows[first : first + size]
        first += size
        for b in range(0, len(shard), batch):
            stream = [t for ids in shard[b : b + batch] for t in ids]
            for k in range(len(stream) // block):
                out.append((w, b // batch, k, stream[k * block : (k + 1) * block]))
    return out


@pytest.mark.parametrize(
    "count,batch,workers,buckets", [(103, 10, 4, 9), (103, 10, 4, 1), (30, 7, 3, 4), (2, 10, 4, 4), (0, 3, 2, 1), (64, 1000, 1, 4)]
)
def test_group_texts_restarts_per_batch(spark, count, batch, workers, buckets):
    rows = lists(count, count, 12)
    df = frame(spark, rows)
    got = packing.group_texts(df, ["key"], 5, batch, workers, buckets=buckets)
    got = got.orderBy("worker", "batch", "block").collect()
    want = group_by_hand(rows, 5, batch, workers)
    assert [(r.worker, r.batch, r.block, r.input_ids) for r in got] == want
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * 5 for r in got)


def test_group_texts_cuts_a_given_mask(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [0, 1, 1]), (2, [4, 5], [1, 0])], "key INT, input_ids ARRAY<INT>, m ARRAY<INT>")
    got = packing.group_texts(df, ["key"], 2, workers=1, mask="m").orderBy("block").collect()
    assert [(r.input_ids, r.attention_mask) for r in got] == [([1, 2], [0, 1]), ([3, 4], [1, 1])]


def test_padding_numbers(spark):
    df = frame(spark, [[1] * 5, [2] * 30, []])
    before = packing.padding_waste(df, 20).first()
    assert (before.rows, before.total_tokens, before.pad_tokens) == (3, 60, 15 - 10 + 20)
    r = packing.packing_report(df, 20).first()
    assert (r.real_tokens, r.sequences, r.total_after, r.pad_after) == (38, 2, 40, 2)
    assert r.percent_before == pytest.approx(25 / 60 * 100) and r.percent_after == pytest.approx(5.0)


def test_corpus_is_packed_with_marks(spark):
    texts = [f"w{i % 7} x{i % 3} y" * (i % 4) for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING").repartition(5)
    specials = ("<unk>", "<bos>", "<eos>")
    v = build_vocab(df, specials=specials)
    words = {r.token: r.id for r in v.collect()}
    marks = token_ids(v, specials)
    from tests.test_tokens import by_hand

    stream = []
    for t in texts:
        stream += [marks["<bos>"], *[words[w] for w in by_hand(t, specials)], marks["<eos>"]]
    for buckets in (1, 6):
        got = pack_corpus(df, v, ["id"], packing.pack_disjoint, bos="<bos>", length=9, buckets=buckets)
        want = [c[:-1] for c in chunks(stream, 10, 10) if len(c) == 10]
        assert [r.input_ids for r in got.orderBy("seq_id").collect()] == want


def test_ordinals_follow_composite_keys(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(3), f"é{rng.randrange(10**6)}\"\\", i) for i in range(500)]
    df = spark.createDataFrame(rows, "a INT, b STRING, i INT").repartition(6)
    ranges = key_ranges(df, ["a", "b"], buckets=7)
    assert ranges.buckets > 2
    ranked = sorted(rows)
    got = {r.i: r.ordinal for r in with_ordinal(df, ["a", "b"]).collect()}
    assert [got[i] for _, _, i in ranked] == list(range(500))
    assert row_at(df, ["a", "b"], 17).first().i == ranked[17][2]
    parts = df.withColumn("bucket", ranges.column()).collect()
    by_key = [r.bucket for r in sorted(parts, key=lambda r: (r.a, r.b))]
    assert by_key == sorted(by_key) and len(set(by_key)) == ranges.buckets


def test_weight_shards_are_contiguous_and_even(spark):
    rng = random.Random(4)
    weights = [rng.randrange(1, 50) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(weights)), "i LONG, w INT").repartition(5)
    got = shard_by_weight(df, ["i"], "w", 5).orderBy("i").collect()
    before = 0
    for r in got:
        assert r.before == before and r.shard == min(4, 5 * before // sum(weights))
        before += r.w


def test_sequence_columns(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), ([1, 2, 3, 4, 5, 6],)], "ids ARRAY<INT>")

    def column(c):
        return [r[0] for r in df.select(c).collect()]

    assert column(sequences.pad("ids", 5, 9)) == [[1, 2, 3, 9, 9], [9] * 5, [1, 2, 3, 4, 5, 6]]
    assert column(sequences.pad("ids", 5, 9, "left")) == [[9, 9, 1, 2, 3], [9] * 5, [1, 2, 3, 4, 5, 6]]
    assert column(sequences.fit("ids", 4, 9)) == [[1, 2, 3, 9], [9] * 4, [1, 2, 3, 4]]
    assert column(sequences.truncate("ids", 2)) == [[1, 2], [], [1, 2]]
    assert column(sequences.attention_mask("ids", 5)) == [[1, 1, 1, 0, 0], [0] * 5, [1] * 6]
    assert column(sequences.attention_mask("ids", 5, "left")) == [[0, 0, 1, 1, 1], [0] * 5, [1] * 6]
    assert column(sequences.with_eos(sequences.with_bos("ids", 7), 8))[:2] == [[7, 1, 2, 3, 8], [7, 8]]
    pairs = column(sequences.next_token_pairs("ids"))
    assert [[tuple(p) for p in r] for r in pairs[:2]] == [[(1, 2), (2, 3)], []]
    assert column(sequences.layout_string("ids", 1, 3)) == ["_T|", "", "_T|TTT"]
    assert column(sequences.layout_string("ids", 3, 3))[0] == "TT|"
    assert column(sequences.sample_layout("ids", 5)) == ["TTT__", "_____", "TTTTTT"]
    assert column(sequences.strip_generated("ids", 1, [3, 5])) == [[2], [], [2, 4, 6]]
