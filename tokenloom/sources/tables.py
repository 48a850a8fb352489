"""Readers of instruction, text, labelled and conversation data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.batches import with_ordinal
from tokenloom.operators.lookup import lookup
from tokenloom.sources.arrays import read_array

INSTRUCTION_SCHEMA = "instruction STRING, input STRING, output STRING"


def read_instructions(spark: SparkSession, path: str, lines: bool = False, range_bytes: int | None = None) -> DataFrame:
    """Instruction rows from JSON: one array per file, or with ``lines`` one object per line.

    A file holding one array is cut into byte ranges and read by many tasks, see
    :func:`~tokenloom.sources.arrays.read_array`; its rows have a ``file`` and their position in it as ``id``.
    """
    if lines:
        return spark.read.schema(INSTRUCTION_SCHEMA).json(path)
    return read_array(spark, path, INSTRUCTION_SCHEMA, range_bytes)


def convert_instructions(spark: SparkSession, path: str, out: str, files: int | None = None) -> DataFrame:
    """Write JSON arrays as splittable parquet, with ``file`` and ``id`` (the position in it), and read it back."""
    rows = read_instructions(spark, path)
    rows.repartition(files or int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "id").write.mode(
        "overwrite"
    ).parquet(out)
    return spark.read.parquet(out)


def read_text(spark: SparkSession, path: str, split: str | None = None, plain: bool | None = None) -> DataFrame:
    """Text rows from parquet or plain text (told by the name, or ``plain``); ``split`` reads one split of a partitioned folder alone."""
    if _is_plain(path) if plain is None else plain:
        df = spark.read.text(path).withColumnRenamed("value", "text")
    else:
        df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def read_labelled(
    spark: SparkSession, texts: str, labels: str, key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """``(key, label, text)``: the texts that have a label."""
    wanted = spark.read.parquet(labels).select(key, F.col(label).alias("label"))
    return spark.read.parquet(texts).select(key, "text").join(wanted, key).select(key, "label", "text")


def from_conversations(turns: DataFrame, stride: int = 1000) -> DataFrame:
    """Instruction rows ``(id, instruction, input, output)`` from a turn table.

    Each user turn whose next turn is the assistant's becomes a row; ``input`` is the first
    system text of the conversation, or empty.  Turn numbers may have gaps.  The next turn is
    found by position in the order of all turns, so a very long conversation is spread over all
    tasks; turns of one number follow each other by a hash of their role and text.  The id
    is ``conv_id * stride + turn``; a turn number of ``stride`` or more is an error, as
    ids would no longer be unique.  Turns without a conversation or number are left out.

    Numbering the turns runs jobs that read ``turns`` several times.
    """
    clash = F.raise_error(F.lit("from_conversations: a turn number reaches stride; pass a larger one"))
    number = F.col("conv_id") * stride + F.col("turn")
    turns = turns.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    turns = turns.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("tie"))
    placed = with_ordinal(turns, ["conv_id", "turn", "tie"])
    user = placed.filter("role = 'user'").select("conv_id", "ordinal", "turn", F.col("text").alias("instruction"))
    reply = placed.filter("role = 'assistant'").select(
        "conv_id", (F.col("ordinal") - 1).alias("ordinal"), F.col("text").alias("output")
    )
    system = (
        turns.filter("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("input"))
    )
    return lookup(user.join(reply, ["conv_id", "ordinal"]), system, "conv_id").select(
        F.when(F.col("turn") < stride, number).otherwise(clash.cast("long")).alias("id"),
        "instruction",
        F.coalesce("input", F.lit("")).alias("input"),
        "output",
    )


def _is_plain(path: str) -> bool:
    return path.endswith((".txt", ".text", ".txt.gz"))
