"""Labelled rows for the classifiers: a bounded sample, chosen by a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def training_sample(labels: DataFrame, label: str, held_out: Column, rows: int, id_col: str = "doc_id") -> DataFrame:
    """(id, y) of at most `rows` labelled rows that are not held out; NULL ids and labels are left out.

    The hash of the id ranks the rows, so the sample is the same on every run and follows no order of the table.
    """
    known = labels.filter(~held_out & labels[label].isNotNull() & labels[id_col].isNotNull())
    return (
        known.select(labels[id_col].alias("id"), labels[label].cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(rows)
    )
