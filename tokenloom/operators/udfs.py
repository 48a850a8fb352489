"""User functions over batches of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from tokenloom.operators.batches import assign_batches

Batch = pd.DataFrame


def map_batches(
    df: DataFrame, fn: Callable[[Batch], Batch], schema: str, remove_columns: Sequence[str] = ()
) -> DataFrame:
    """Apply ``fn`` to Arrow batches of rows; it may change columns and row count.

    ``remove_columns`` names input columns that are left out of the result.
    """

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            yield fn(batch).drop(columns=list(remove_columns), errors="ignore")

    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply ``fn`` to one row at a time."""

    def run(batch: Batch) -> Batch:
        return pd.DataFrame([fn(row) for row in batch.to_dict("records")])

    return map_batches(df, run, schema)


def map_fixed_batches(
    df: DataFrame, fn: Callable[[Batch], Batch], schema: str, order_by: Sequence[str], size: int = 1000
) -> DataFrame:
    """Apply ``fn`` to batches of exactly ``size`` rows in key order (the last may be short)."""
    batched = assign_batches(df, order_by, size)
    columns = df.columns

    def run(batch: Batch) -> Batch:
        return fn(batch.sort_values("ordinal")[columns].reset_index(drop=True))

    return batched.groupBy("batch").applyInPandas(run, schema)
