"""Exact quantiles with linear interpolation, per group and column.

Small tables use the built-in percentile, which takes one pass and keeps all distinct values of a task in memory.
Larger ones are counted digit by digit (`operators.selection`), which moves neither the table nor a group of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from batchlens.functions.values import number
from batchlens.operators.batching import BATCH
from batchlens.operators.selection import quantiles_by_digits

# Tables with up to this many rows use the built-in percentile.
SMALL_TABLE = 5_000_000


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (BATCH,),
    *,
    n_rows: int | None = None,
    small_table: int = SMALL_TABLE,
) -> DataFrame:
    """(keys, feature, p, value) for every column with values; rows with a NULL key are left out.

    n_rows is the size of the table where the caller knows it.
    """
    values = df.select(*keys, *[number(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    for key in keys:
        values = values.filter(F.col(key).isNotNull())
    if (values.count() if n_rows is None else n_rows) <= small_table:
        return _by_aggregate(values, columns, probs, keys)
    lanes = [lane for i, c in enumerate(columns) for lane in (F.lit(c), F.col(f"x{i}"))]
    long = values.select(*keys, F.stack(F.lit(len(columns)), *lanes).alias("feature", "x"))
    cells = long.filter(F.col("x").isNotNull()).withColumn("cnt", F.lit(1).cast("long"))
    return quantiles_by_digits(cells, probs, keys)


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """The same over values that are counted already: (keys, feature, value, cnt)."""
    return quantiles_by_digits(counts.select(*keys, "feature", F.col("value").alias("x"), "cnt"), probs, keys)


def _by_aggregate(values, columns, probs, keys) -> DataFrame:
    ps = F.array(*[F.lit(float(p)) for p in probs])
    wide = values.groupBy(*keys).agg(
        *[F.percentile(f"x{i}", ps).alias(f"q{i}") for i in range(len(columns))]
    )
    records = [
        F.struct(F.lit(c).alias("feature"), F.lit(float(p)).alias("p"), F.col(f"q{i}")[j].alias("value"))
        for i, c in enumerate(columns)
        for j, p in enumerate(probs)
    ]
    long = wide.select(*keys, F.explode(F.array(*records)).alias("r")).select(*keys, "r.*")
    return long.filter(F.col("value").isNotNull())
