"""Materialise an intermediate table once, where every executor can read it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Only a local-mode session with neither gets a temporary folder; on a cluster that
    is an error, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")  # a file: folder must be one that all machines share
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tokenloom-"))
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return the written table.

    Cuts lineage and survives executor loss like a reliable checkpoint, but runs
    ``df`` only once and lets later readers prune columns.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/tokenloom/{name}-{uuid.uuid4().hex}"
    for owned in _OWNERS:
        owned.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OWNERS: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def released() -> Iterator[None]:
    """Delete, at the end of the block, the tables staged within it.

    ``with released(): result.write.parquet(out)`` - whatever reads a staged table has to run inside.
    """
    owned: list[tuple[SparkSession, str]] = []
    _OWNERS.append(owned)
    try:
        yield
    finally:
        _OWNERS.remove(owned)
        for spark, path in owned:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, per_core: int = 16 << 20) -> DataFrame:
    """Deal the rows of a small input to all cores before costly per-row work.

    A small file, or one of a single row group, is read by one task whatever its
    length.  Only an input the optimizer estimates below ``per_core`` bytes a core is
    moved; a larger one has splits enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if estimate < cores * per_core else df
