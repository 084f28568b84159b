"""Calendar-month batches on a time column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from batchlens.functions.dates import month_key, time_value

BATCH = "batch_id"


def assign_batches(df: DataFrame, time_column: str, **parsing) -> DataFrame:
    """Rewrite the time column as a timestamp and add batch_id, NULL for rows without a time."""
    timed = df.withColumn(time_column, time_value(df, time_column, **parsing))
    return timed.withColumn(BATCH, month_key(F.col(f"`{time_column}`")))


def split_batches(df: DataFrame, time_column: str, **parsing) -> DataFrame:
    """Rows with their batch_id; rows without a time belong to no batch and are left out."""
    return assign_batches(df, time_column, **parsing).filter(F.col(BATCH).isNotNull())


def rows_per_batch(df: DataFrame) -> DataFrame:
    """Rows per batch_id; a NULL batch_id counts the rows without a time."""
    return df.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n_rows"))
