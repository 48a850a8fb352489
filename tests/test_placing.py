"""Key ranges of rows are found by halving, the same as by counting the cut points at or before a key."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tokenloom.operators.ordering import BUCKET, KeyRanges, key_ranges, running_total


def rows(spark):
    start = datetime.datetime(1969, 12, 28)
    made = [(start + datetime.timedelta(days=i % 7), f"k{i % 11}" if i % 5 else None, i) for i in range(300)]
    made += [(None, "k1", 300), (None, None, 301), *made[:4]]
    return spark.createDataFrame(made, "t TIMESTAMP_NTZ, s STRING, i INT")


def expected(ranges, df):
    """By Python: nulls first, texts by their characters."""
    def placed(key):
        return tuple((v is not None, v if v is not None else 0) for v in key)

    cuts = [placed(b) for b in ranges.bounds]
    keys = [tuple(r) for r in df.select(*ranges.columns()).collect()]
    return sorted(str((k, sum(c <= placed(k) for c in cuts))) for k in keys)


def test_rows_are_placed_by_whole_keys(spark):
    df = rows(spark)
    for keys in (["t", "s", "i"], ["s"], ["t"], ["i"]):
        kinds = tuple(df.schema[c].dataType for c in keys)
        every = KeyRanges(tuple(keys), kinds, (), 0)
        bounds = sorted({tuple(r) for r in df.select(*every.columns()).collect()}, key=lambda k: [(v is not None, v or 0) for v in k])
        for cuts in (bounds[::3], bounds[:1], bounds[1:3], bounds[-5:]):
            ranges = every.with_bounds(cuts)
            got = ranges.place(df).select(F.struct(*ranges.columns()).alias("k"), BUCKET).collect()
            assert sorted(str((tuple(r.k), r[BUCKET])) for r in got) == expected(ranges, df)
            assert ranges.place(df).columns == [*df.columns, BUCKET]


def test_placing_reads_few_cut_points(spark):
    """A row meets about log2 of the cut points, none of them by a function of all."""
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("x"))
    ranges = key_ranges(df, ["x", "id"], buckets=100)
    assert ranges.buckets > 50
    plan = running_total(df, ["x", "id"], ranges=ranges)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "lambda" not in plan
    assert plan.count("CASE WHEN") + plan.count("if (") <= 2 * 7
    got = running_total(df, ["x", "id"], ranges=ranges).select("id", "start").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.start)] == sorted(range(5000), key=lambda i: (i % 3, i))
