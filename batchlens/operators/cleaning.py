"""Dropping of columns that fail quality thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from batchlens.functions.values import column, number, text
from batchlens.kinds import NUMERIC
from batchlens.operators.batching import BATCH
from batchlens.session import stage

KEEP = "keep"

# The usual thresholds, for verdicts(dq, **THRESHOLDS).
THRESHOLDS = {"max_missing_rate": 0.5, "min_unique_ratio": 0.10, "max_unique_ratio": 0.90}


def verdicts(
    dq: DataFrame,
    *,
    max_missing_rate: float,
    min_unique_ratio: float | None,
    max_unique_ratio: float | None,
) -> DataFrame:
    """(batch_id, feature, verdict): the first threshold that fails, or keep.

    Distinct values are taken relative to all rows of the batch. A ratio of None is not checked.
    """
    ratio = F.col("unique_count") / F.col("n_rows")
    verdict = F.when(F.col("n_rows") == 0, KEEP).when(
        F.col("missing_rate") > max_missing_rate, "drop_missing"
    )
    if min_unique_ratio is not None:
        verdict = verdict.when(ratio < min_unique_ratio, "drop_low_unique")
    if max_unique_ratio is not None:
        verdict = verdict.when(ratio > max_unique_ratio, "drop_high_unique")
    return dq.select(BATCH, "feature", verdict.otherwise(KEEP).alias("verdict"))


def clean_batch(df: DataFrame, batch_verdicts: DataFrame) -> DataFrame:
    """One batch without its failing columns. Columns without a verdict stay.

    The verdicts hold one row per column of the table, so reading them here is bounded.
    """
    dropped = {r.feature for r in batch_verdicts.filter(F.col("verdict") != KEEP).collect()}
    return df.select(*[column(c) for c in df.columns if c not in dropped])


def clean_long(
    df: DataFrame, kinds: Mapping[str, str], all_verdicts: DataFrame, id_columns: Sequence[str] = ()
) -> DataFrame:
    """Many batches: kept cells as (batch_id, id columns, feature, num, text).

    Which columns survive differs by batch, hence the long form. Failing (batch, feature) pairs
    are written out first, so the join is broadcast by their real size, never the cells.
    """
    no_num, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    lanes = []
    for name, kind in kinds.items():
        lanes.append(F.lit(name))
        lanes += [number(df, name), no_text] if kind == NUMERIC else [no_num, text(df, name)]
    cells = df.select(
        BATCH, *id_columns, F.stack(F.lit(len(kinds)), *lanes).alias("feature", "num", "text")
    )
    dropped = stage(
        all_verdicts.filter(F.col("verdict") != KEEP).select(BATCH, "feature"), "dropped"
    )
    return cells.join(dropped, [BATCH, "feature"], "left_anti")
