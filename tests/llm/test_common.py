import pyarrow as pa

from tokenloom.llm import common


def test_slices_hold_all_rows_in_order_and_few_bytes():
    texts = ["a" * 30, None, "", "é" * 200, "b" * 50, "c" * 50, "d"]
    b = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["id", "text"])
    parts = list(common.slices(b, 100))
    assert [p.column("id").to_pylist() for p in parts] == [[0, 1, 2], [3], [4, 5], [6]]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([b]))


def test_slices_without_texts_or_rows():
    b = pa.RecordBatch.from_arrays([pa.array([[1], [2, 3]])], ["v"])
    assert [p.num_rows for p in common.slices(b)] == [2]
    assert list(common.slices(b.slice(0, 0))) == []


def test_map_arrow_gives_each_row_once_whatever_the_slices(spark):
    rows = [(i, "x" * (i % 7 * 1_000_000)) for i in range(20)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)

    def batch(b):
        sizes = [len(t) for t in b.column("text").to_pylist()]
        assert len(sizes) == 1 or sum(sizes) <= common.SLICE_BYTES
        return pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64())], ["id", "n"])

    got = common.map_arrow(docs, batch, "id long, n long").collect()
    assert sorted((r.id, r.n) for r in got) == [(i, len(t)) for i, t in rows]
