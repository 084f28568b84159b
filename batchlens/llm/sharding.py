"""Reproducible shuffle into shards by a keyed permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of (id, size, checksum). A balanced Feistel network permutes the smallest
even-bit range that holds n; a value outside 0 to n - 1 is fed back (cycle walking), which leaves a permutation of
exactly the n row numbers. Permuted number p goes to shard p mod shards, slot p div shards: row counts differ by
one at most, slots have no gaps, and the place of any row, or the row at any place, is computed without a lookup
(`permute`, `restore`).

Global numbers come from a range partitioning of the narrow rows; only the row count of each partition is summed
up, in a table with a row per partition. Rows that agree in all three columns may swap numbers; the result is the
same set of rows. NULL ids come first, NULL text has no bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from batchlens.session import stage

ROUNDS = 6
SEED = 42
#: Bytes a row counts besides its text.
ROW_BYTES = 16


def _mixed(half: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser of one half under a round key (constants of the public splitmix64 generator)."""
    x = half + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int, rounds: int) -> list[int]:
    return [(seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) % 2**64 for r in range(rounds)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for key in keys:
        left, right = right, left ^ (_mixed(right, key) & mask)
    return (left << np.uint64(bits)) | right


def _inverse_network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for key in reversed(keys):
        left, right = right ^ (_mixed(left, key) & mask), left
    return (left << np.uint64(bits)) | right


def _walk(step, numbers: np.ndarray, n: int, seed: int, rounds: int) -> np.ndarray:
    bits, keys = _half_bits(n), _keys(seed, rounds)
    out = step(np.asarray(numbers).astype(np.uint64), bits, keys)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = step(out[outside], bits, keys)
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The place of each row number in the shuffled order of n rows."""
    return _walk(_network, numbers, n, seed, rounds)


def restore(places: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The row number at each place: the inverse of `permute`."""
    return _walk(_inverse_network, places, n, seed, rounds)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32 and row_number (from 0) of every row."""
    text = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    narrow = docs.select(
        docs[id_col].alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = ["id", "size", "text_crc32"]
    # monotonically_increasing_id holds the partition above bit 33 and the place in it below.
    placed = stage(
        narrow.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
        .withColumn("place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("place", 33)
    # A row per partition: the single task of this window holds as many rows as there were tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        placed.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    return (
        placed.withColumn("part", part)
        .join(first, "part")
        .select(*order, (F.col("first") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("row_number"))
    )


def shard(
    docs: DataFrame,
    shards: int = 40,
    seed: int = SEED,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row; the law is `rows`."""
    rows = numbered(docs, id_col, text_col)
    n = rows.count()
    out = rows.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.lit(0).alias("shard"),
        F.col("row_number").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ).schema
    schema = to_arrow_schema(out)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            places = permute(part.column("row_number").to_numpy(), n, seed, rounds)
            count = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("size"),
                    part.column("text_crc32"),
                    pa.array(["rows"] * count),
                    pa.array((places % shards).astype(np.int32)),
                    pa.array(places // shards),
                    pa.nulls(count, pa.int32()),
                ],
                schema=schema,
            )

    return rows.mapInArrow(place, out)
