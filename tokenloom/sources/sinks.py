"""Writers of packed sequences and of step checkpoints."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_packed(df: DataFrame, path: str, split: str = "split") -> None:
    """Packed sequences as parquet, one folder per split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_packed(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def save_due(steps: DataFrame, every: int = 50, step: str = "step", last: str = "epoch_end") -> DataFrame:
    """The steps at which state is saved: each ``every``-th and the last of an epoch."""
    return steps.filter((F.col(step) % every == 0) | F.col(last))


def write_step(df: DataFrame, path: str, step: int) -> None:
    """State of one step, possibly of no rows; writing a step again replaces it.

    The rows go to a folder of their own and then a manifest of one row names it.  A step
    counts as saved once its manifest is there, so an unfinished write is never read.
    """
    root = path.rstrip("/")
    folder = f"{root}/data/step={step}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    manifest = df.sparkSession.createDataFrame([(folder,)], "folder STRING")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/saved/step={step}")


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    """``(folder, step)`` of the saved steps; None if nothing was ever saved."""
    try:
        return spark.read.schema("folder STRING, step LONG").parquet(f"{path.rstrip('/')}/saved")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def latest_step(spark: SparkSession, path: str) -> int | None:
    """The numerically largest saved step, or None; reads manifests only."""
    saved = _manifests(spark, path)
    return None if saved is None else saved.agg(F.max("step")).first()[0]


def read_step(spark: SparkSession, path: str, step: int) -> DataFrame:
    saved = _manifests(spark, path)
    row = None if saved is None else saved.filter(F.col("step") == step).select("folder").first()
    if row is None:
        raise KeyError(f"step {step} is not saved below {path}")
    return spark.read.parquet(row.folder)


def resume_after(plan: DataFrame, step: int | None, column: str = "step") -> DataFrame:
    """The part of a step plan that is still to do."""
    return plan if step is None else plan.filter(F.col(column) > step)


# --- a store read by position ------------------------------------------------


def write_store(df: DataFrame, path: str, position: str = "seq_id", tokens: str = "input_ids", per_file: int = 100_000) -> None:
    """Rows numbered by ``position`` in files of ``per_file`` positions each, in order within a file.

    A manifest - the first position, rows and tokens of each file - is written last, under a version of its own.  Readers take
    the newest version that is there, so a write that was interrupted is never seen and the one before it stays.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    folder = f"{root}/data/{uuid.uuid4().hex}"
    number = F.call_function("div", F.col(position).cast("long"), F.lit(per_file).cast("long"))
    rows = df.withColumn("file", number).repartition("file").sortWithinPartitions("file", position)
    rows.write.partitionBy("file").parquet(folder)
    written = spark.read.schema(f"{position} LONG, {tokens} ARRAY<INT>, file LONG").parquet(folder)
    files = written.groupBy("file").agg(
        F.min(position).alias("first"), F.max(position).alias("last"), F.count(F.lit(1)).alias("rows"), F.sum(F.size(tokens)).alias("tokens")
    )
    before = _store_files(spark, root)
    version = 1 + (0 if before is None else before.agg(F.max("version")).first()[0] or 0)
    named = files.withColumn("folder", F.concat(F.lit(f"{folder}/file="), F.col("file").cast("string")))
    # A folder of that number can only be left from a write that did not end.
    named.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")


def store_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file, first, last, rows, tokens, folder)`` of the newest complete version."""
    files = _store_files(spark, path.rstrip("/"))
    newest = None if files is None else files.agg(F.max("version")).first()[0]
    if newest is None:
        raise KeyError(f"no store below {path}")
    return files.filter(F.col("version") == newest).drop("version")


def _store_files(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(
            "file LONG, first LONG, last LONG, rows LONG, tokens LONG, folder STRING, version LONG"
        ).parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_store(
    spark: SparkSession, path: str, rank: int = 0, ranks: int = 1, start: int = 0, position: str = "seq_id"
) -> DataFrame:
    """The rows from position ``start`` on, and of these the ``rank``-th of ``ranks`` contiguous shares of positions.

    Opens only the files that hold some of them.
    """
    files = store_manifest(spark, path)
    end = files.agg(F.max("last")).first()[0] + 1
    share = -(-max(end - start, 0) // ranks)
    low, high = start + rank * share, min(end, start + (rank + 1) * share)
    wanted = files.filter((F.col("last") >= low) & (F.col("first") < high)).orderBy("file").select("folder").collect()
    if not wanted:
        one = files.orderBy("file").first().folder
        return spark.read.parquet(one).limit(0)
    rows = spark.read.parquet(*[r.folder for r in wanted])  # one path for each file, as in its manifest
    return rows.filter(F.col(position).between(low, high - 1))
