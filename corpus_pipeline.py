"""From raw documents to token ids: quality rules, near-dedup, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import bpe, mixing, near, pii, rules
from tokenloom.llm.queries import TOKENIZER
from tokenloom.staging import released, staging_root


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go; documents that the rules reject go."""
    return rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id."""
    return near.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows repeated, left out, or cut at a source's budget."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as ``input_ids`` beside the columns of documents."""
    return bpe.encode(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]

#: Near duplicates and BPE cannot be stated in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet in the shared folder and read again.

    Tables that a stage staged for itself are deleted once its rows are written; the stages' rows stay.
    """
    folder = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with released():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
