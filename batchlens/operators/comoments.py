"""Co-moments of all pairs of numeric columns in one pass, whatever the number of columns.

Spark has no aggregate that carries a matrix, and one aggregate per pair makes code that grows with the square of the
columns. So each task multiplies its Arrow batches as matrices and gives one row per pair; merging these takes counts,
means and centred sums of two parts to those of both, so nothing cancels between large values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from batchlens.functions.values import number

PARTS = ("mean_x", "mean_y", "m_xx", "m_yy", "m_xy")
#: Groups whose matrices a task holds before it hands them on.
GROUPS_AT_ONCE = 64


def pair_sums(values: np.ndarray) -> np.ndarray:
    """(n, mean_x, mean_y, m_xx, m_yy, m_xy) as k x k matrices over the rows that have both; NaN is missing.

    Values are centred first: on the mean, or on the value itself where there is only one, so that a constant column
    has no spread at all.
    """
    here = ~np.isnan(values)
    count = here.sum(axis=0)
    filled = np.where(here, values, 0.0)
    centre = filled.sum(axis=0) / np.maximum(count, 1)
    low = np.where(here, values, np.inf).min(axis=0)
    high = np.where(here, values, -np.inf).max(axis=0)
    centre = np.where((low == high) & (count > 0), low, centre)
    mask = here.astype(float)
    x = np.where(here, values - centre, 0.0)
    n = mask.T @ mask
    some = np.maximum(n, 1)
    sum_x = x.T @ mask
    mean = sum_x / some
    m_xx = (x * x).T @ mask - sum_x * mean
    m_xy = x.T @ x - sum_x * mean.T
    mean_x = centre[:, None] + mean
    return np.stack([n, mean_x, mean_x.T, np.maximum(m_xx, 0), np.maximum(m_xx.T, 0), m_xy])


def merge_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy = b[1] - a[1], b[2] - a[2]
    first = a[0] == 0
    dx, dy = np.where(first | (b[0] == 0), 0, dx), np.where(first | (b[0] == 0), 0, dy)
    mean_x = np.where(first, b[1], a[1] + dx * share)
    mean_y = np.where(first, b[2], a[2] + dy * share)
    both = a[0] * share
    return np.stack(
        [n, mean_x, mean_y, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both]
    )


def comoments(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, n, mean_x, mean_y, m_xx, m_yy, m_xy) for each pair of columns, x not after y in their order.

    n counts the rows that have both; the moments are about those rows. Several rows of one pair, from several tasks,
    remain to be merged by `merged`.
    """
    values = df.select(*keys, *[number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    upper = np.triu_indices(len(columns))
    names = np.array(columns, dtype=object)
    types = [values.schema[k].dataType.simpleString() for k in keys]
    schema = ", ".join([*[f"{k} {t}" for k, t in zip(keys, types)], "x string, y string, n bigint"])
    schema += "".join(f", {p} double" for p in PARTS)

    def rows(held: dict, batch_schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for key, sums in held.items():
            flat = [m[upper] for m in sums]
            some = np.flatnonzero(flat[0] > 0)
            if not len(some):
                continue
            fixed = [pa.array([v] * len(some), batch_schema.field(k).type) for k, v in zip(keys, key)]
            pairs = [pa.array(names[u[some]], pa.string()) for u in upper]
            numbers = [pa.array(flat[0][some].astype(np.int64)), *[pa.array(f[some]) for f in flat[1:]]]
            yield pa.RecordBatch.from_arrays([*fixed, *pairs, *numbers], names=[*keys, "x", "y", "n", *PARTS])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        seen = None
        for batch in batches:
            seen = batch.schema
            matrix = np.column_stack(
                [batch[f"c{i}"].to_numpy(zero_copy_only=False).astype(float) for i in range(len(columns))]
            )
            groups: dict[tuple, list[int]] = {}
            if keys:
                for at, key in enumerate(zip(*[batch[k].to_pylist() for k in keys])):
                    groups.setdefault(key, []).append(at)
            else:
                groups[()] = list(range(batch.num_rows))
            for key, at in groups.items():
                sums = pair_sums(matrix[at]) if at else None
                if sums is not None:
                    held[key] = merge_sums(held[key], sums) if key in held else sums
            if len(held) > GROUPS_AT_ONCE:
                yield from rows(held, seen)
                held.clear()
        if seen is not None:
            yield from rows(held, seen)

    return values.mapInArrow(partial, schema)


def merged(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, x, y). A pair has one part per task or batch; they are taken one after the other."""

    def step(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        share = b["n"] / n
        dx, dy, both = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"], a["n"] * share
        after = F.struct(
            n.alias("n"),
            (a["mean_x"] + dx * share).alias("mean_x"),
            (a["mean_y"] + dy * share).alias("mean_y"),
            (a["m_xx"] + b["m_xx"] + dx * dx * both).alias("m_xx"),
            (a["m_yy"] + b["m_yy"] + dy * dy * both).alias("m_yy"),
            (a["m_xy"] + b["m_xy"] + dx * dy * both).alias("m_xy"),
        )
        return F.when(a["n"] == 0, b).otherwise(after)

    part = F.struct("n", *PARTS)
    none = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(p) for p in PARTS])
    lists = parts.groupBy(*keys, "x", "y").agg(F.collect_list(part).alias("parts"))
    return lists.select(*keys, "x", "y", F.aggregate("parts", none, step).alias("m")).select(*keys, "x", "y", "m.*")


def correlations(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, corr) for every two columns from merged pairs, both ways round; NULL when either is constant."""
    corr = F.try_divide(F.col("m_xy"), F.sqrt("m_xx") * F.sqrt("m_yy"))
    one_way = pairs.select("x", "y", F.when(F.col("x") == F.col("y"), F.when(F.col("m_xx") > 0, 1.0)).otherwise(corr).alias("corr"))
    back = one_way.filter("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "corr")
    every = pairs.sparkSession.createDataFrame([(c,) for c in columns], "x string")
    every = every.withColumn("y", F.explode(F.lit(list(columns))))
    return every.join(one_way.unionByName(back), ["x", "y"], "left")
