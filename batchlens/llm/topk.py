"""Exact top-k inner products by multi-resolution segment statistics.

Components are scaled to integers, so scores are exact. A vector cut into segments is summed up by the mean and the
deviation of each segment; with both of a query and a candidate,

    <q, x>  <=  sum over segments of  length * (mean_q * mean_x + deviation_q * deviation_x)

which is the distance bound of segment means and deviations, written for inner products. A query goes from few long
segments to many short ones: candidates whose bound falls below the k-th best exact score seen so far are dropped,
and only the survivors of the finest level are scored exactly. Equal bounds survive, so ties end with the smaller id.

Queries and candidates form a grid of bounded blocks (query block, candidate slice); each cell is one group that
holds at most about `QUERY_BLOCK` queries and a slice of the candidates. The best k of every cell are merged by a
window over (query, cell results).

Defined results: vectors that are NULL or empty or hold NULL or non-finite components take no part, nor do rows
with a NULL id; only vectors of the query's own length are candidates. Rows with the query's id are its own and are
left out; an id that repeats among queries asks once, with its smallest vector. Scores must fit 64 bits. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
QUERY_BLOCK = 2048
LARGEST_SLICE = 65_536
SMALLEST_SLICE = 512
#: Queries whose coarse bounds are held as one matrix.
QUERIES_AT_ONCE = 64


def scaled(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): integer components of the vectors that take part."""
    finite = F.forall(
        "raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return (
        vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("raw"))
        .filter(F.col("id").isNotNull() & (F.size("raw") > 0) & finite)
        .select("id", F.transform("raw", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    )


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: sqrt(length) * mean and sqrt(length) * deviation of each segment; products of them are bounds."""
    starts = np.linspace(0, x.shape[1], segments + 1).astype(int)[:-1]
    lengths = np.diff(np.append(starts, x.shape[1]))
    means = np.add.reduceat(x, starts, axis=1) / lengths
    spread = np.maximum(np.add.reduceat(x * x, starts, axis=1) / lengths - means * means, 0)
    return np.concatenate([means, np.sqrt(spread)], axis=1) * np.sqrt(np.tile(lengths, 2))


def levels(dims: int) -> list[int]:
    """Numbers of segments from coarse to fine; a segment keeps two components at least."""
    found = [1]
    while found[-1] * 8 <= dims:
        found.append(found[-1] * 4)
    return found


def cell_top_k(query_ids, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query id, id, score) of the best k rows for each query, as three lists of arrays."""
    stages = levels(rows.shape[1])
    real, asked = rows.astype(float), queries.astype(float)
    row_stats = [segment_statistics(real, s) for s in stages]
    query_stats = [segment_statistics(asked, s) for s in stages]
    # Scores are whole numbers: bounds may fall short by rounding, but by less than this.
    slack = 0.5 + 1e-11 * np.linalg.norm(asked, axis=1) * (np.linalg.norm(real, axis=1).max() if len(rows) else 0)
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        coarse = query_stats[0][at : at + QUERIES_AT_ONCE] @ row_stats[0].T
        for i, bounds in enumerate(coarse, start=at):
            alive = np.flatnonzero(ids != query_ids[i])
            if len(alive) > k:
                best = alive[np.argpartition(-bounds[alive], k - 1)[:k]]
                least = (rows[best] @ queries[i]).min() - slack[i]
                alive = alive[bounds[alive] >= least]
                for row_level, query_level in zip(row_stats[1:], query_stats[1:]):
                    fine = row_level[alive] @ query_level[i]
                    best = alive[np.argpartition(-fine, k - 1)[:k]]
                    least = max(least, (rows[best] @ queries[i]).min() - slack[i])
                    alive = alive[fine >= least]
            scores = rows[alive] @ queries[i]
            top = np.lexsort((ids[alive], -scores))[:k]
            out[0].append(np.full(len(top), query_ids[i]))
            out[1].append(ids[alive][top])
            out[2].append(scores[top])
    return out


def _matrix(table: pa.Table) -> np.ndarray:
    column = table["v"].combine_chunks()
    return column.flatten().to_numpy().reshape(table.num_rows, -1)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the k best rows for every row that `is_query` picks.

    `is_query` is an expression over a column named `id`.
    """
    usable = scaled(vectors, id_col, vector_col)
    asked = usable.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n, n_queries = usable.count(), asked.count()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-n // LARGEST_SLICE), min(-(-n // SMALLEST_SLICE), tasks))
    blocks = max(1, -(-n_queries // QUERY_BLOCK))

    def spread(own: int, name: str, other: int, other_name: str):
        return (
            "id",
            "v",
            F.size("v").alias("dims"),
            F.pmod(F.xxhash64("id", F.lit(name)), F.lit(own)).cast("int").alias(name),
            F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(other_name),
        )

    left = asked.select(*spread(blocks, "block", slices, "slice"))
    right = usable.select(*spread(slices, "slice", blocks, "block"))
    id_type = usable.schema["id"].dataType.simpleString()

    def cell(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table({"query_id": [], "id": [], "score": []}, schema=schema(queries))
        found = cell_top_k(
            queries["id"].to_numpy(), _matrix(queries), rows["id"].to_numpy(), _matrix(rows), k
        )
        return pa.table(dict(zip(("query_id", "id", "score"), map(np.concatenate, found))), schema=schema(queries))

    def schema(queries: pa.Table) -> pa.Schema:
        kind = queries.schema.field("id").type
        return pa.schema([("query_id", kind), ("id", kind), ("score", pa.int64())])

    keys = ["block", "slice", "dims"]
    best = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(cell, f"query_id {id_type}, id {id_type}, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
