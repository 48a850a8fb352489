"""One JSON array of records, read by many tasks.

The file is cut at every closing brace, by Spark's own splitting of byte ranges, so a piece knows its range and its place in it
but not whether it begins inside a string or how deep.  Both are prefix sums: unescaped quotes give the former, and with that braces
outside strings give the depth.  Each is summed over the ranges first, as one row for each, and then within a range.  A record ends where the
depth returns to zero, and how many ended before is its position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.operators.lookup import lookup
from tokenloom.staging import stage, staging_root

RANGE = ("file", "start")


def read_array(spark: SparkSession, path: str, schema: str, range_bytes: int | None = None) -> DataFrame:
    """``(file, id, <columns of schema>)`` of JSON arrays of objects; ``id`` is the position in the file, from 0.

    ``range_bytes`` is the length of the byte ranges (``spark.sql.files.maxPartitionBytes`` if not given).  Objects may be nested and
    laid out in any way.  Runs jobs: the pieces are staged, and sums for each range collected in Spark.
    """
    pieces = _pieces(spark, path, range_bytes)
    placed = _with_bases(pieces, "quotes")
    order = Window.partitionBy(*RANGE).orderBy("o")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    starts_in = (F.col("base") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))) % 2
    placed = placed.withColumn("starts_in", starts_in)
    ends_in = (F.col("starts_in") + F.col("quotes")) % 2
    opens = F.size(F.split(_outside("value", F.col("starts_in")), r"\{")) - 1
    # Braces opened in the piece, less the closing one that ends it if that is outside a string.
    change = opens - F.when(ends_in == 0, 1).otherwise(0)
    deep = stage(placed.select(*RANGE, "o", "value", ends_in.alias("ends_in"), change.cast("long").alias("change")), "deep")
    # What follows the last record of a file is ended by no brace; it is the only piece that falls below zero.
    deep = _with_bases(deep, "change")
    depth = F.col("base") + F.sum("change").over(order)
    ends = ((F.col("ends_in") == 0) & (depth == 0)).cast("long")
    closed = stage(deep.withColumn("ends", ends).select(*RANGE, "o", "value", "ends"), "closed")
    closed = _with_bases(closed, "ends")
    number = F.col("base") + F.coalesce(F.sum("ends").over(so_far), F.lit(0))
    numbered = closed.select("file", number.alias("id"), F.struct("start", "o", "value").alias("piece"), "ends")
    joined = F.concat(F.array_join(F.sort_array(F.collect_list("piece"))["value"], "}"), F.lit("}"))
    records = numbered.groupBy("file", "id").agg(joined.alias("text"), F.max("ends").alias("whole")).filter("whole = 1")
    parsed = F.from_json(F.regexp_replace("text", r"^[^{]*", ""), schema).alias("record")
    return records.select("file", "id", parsed).select("file", "id", "record.*")


def _pieces(spark: SparkSession, path: str, range_bytes: int | None) -> DataFrame:
    """``(file, start, o, value, quotes)``: what lies between closing braces, by byte range, in order of ``o``."""
    reader = spark
    if range_bytes is not None:
        reader = spark.newSession()  # so that the caller's settings stay
        reader.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    rows = reader.read.option("lineSep", "}").text(path)
    bare = F.regexp_replace("value", r"\\(?s:.)", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("o"), "value", quotes.cast("long").alias("quotes"),
    )
    folder = f"{staging_root(spark)}/tokenloom/pieces-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _outside(text: str, starts_in: Column) -> Column:
    """The parts of a piece that are in no string, put together."""
    parts = F.split(F.regexp_replace(text, r"\\(?s:.)", ""), '"')
    kept = F.filter(parts, lambda p, i: (i + starts_in) % 2 == 0)
    return F.array_join(kept, "")


def _with_bases(rows: DataFrame, weight: str) -> DataFrame:
    """Add ``base``: the sum of ``weight`` over the ranges of the same file before a row's own."""
    sums = rows.groupBy(*RANGE).agg(F.sum(weight).alias("w"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.struct(*RANGE).alias("range"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("base"))
    return lookup(rows.withColumn("range", F.struct(*RANGE)), stage(bases, "bases"), "range").drop("range")
