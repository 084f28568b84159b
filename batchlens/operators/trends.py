"""Aggregates over quality records. Means are unweighted over records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def by_batch(dq: DataFrame) -> DataFrame:
    """Per batch: number of features and the mean missing rate and distinct count."""
    return dq.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.avg("missing_rate").alias("avg_missing_rate"),
        F.avg("unique_count").alias("avg_unique_count"),
    )


def by_feature(dq: DataFrame) -> DataFrame:
    """Per feature over the batches: mean, min and max; the kind is that of the earliest batch."""
    return dq.groupBy("feature").agg(
        F.min_by("value_type", "batch_id").alias("value_type"),
        F.count(F.lit(1)).alias("n_batches"),
        F.avg("missing_rate").alias("avg_missing_rate"),
        F.min("missing_rate").alias("min_missing_rate"),
        F.max("missing_rate").alias("max_missing_rate"),
        F.avg("unique_count").alias("avg_unique_count"),
        F.min("unique_count").alias("min_unique_count"),
        F.max("unique_count").alias("max_unique_count"),
    )


def summary(dq: DataFrame) -> DataFrame:
    """Number of batches, features and records."""
    return dq.agg(
        F.countDistinct("batch_id").alias("batches"),
        F.countDistinct("feature").alias("features"),
        F.count(F.lit(1)).alias("records"),
    )
