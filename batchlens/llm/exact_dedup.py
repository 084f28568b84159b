"""Exact duplicates through an extendible-hash index kept in shared files.

A 64-bit hash of the text is its key, and the leading bits of the key are its slot in a directory. The directory
starts with one bucket; while a bucket holds more keys than its capacity it is split, which doubles the directory
where the bucket was as deep as the directory. At `MAX_DEPTH` buckets stop splitting and just grow (overflow), so
the directory has at most 2**MAX_DEPTH entries at any corpus size and nothing is left out.

Tasks fold the copies they read before anything is shuffled, so a text that makes up a third of all rows sends a
few rows to its owner. An owner task walks its buckets in key order and compares the bytes of all texts under one
key; different texts with equal keys make a chain. The finished index (a row per text) is a table in the shared
folder, and documents look themselves up in it.

Defined results: NULL text equals empty text. The row with the largest id stays; NULL ids lose to any other, and
rows that agree in id and text stay or go together. An empty table gives an empty result. Only the id and the
text column are read, so other columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from batchlens.llm.common import id_and_text
from batchlens.session import stage

MAX_DEPTH = 16
BUCKET_CAPACITY = 256
#: Bytes of different texts that a task holds while it folds copies.
FOLD_BYTES = 16 << 20


def directory(slot_counts: np.ndarray, capacity: int) -> np.ndarray:
    """Bucket (its first slot) of each of the 2**MAX_DEPTH slots, after all splits.

    Splitting a bucket halves its range of slots; a bucket ends at the first depth at which it is not overfull.
    """
    slots = len(slot_counts)
    bucket = np.zeros(slots, dtype=np.int32)
    overfull = np.array([slot_counts.sum() > capacity])
    width = slots
    while overfull.any() and width > 1:
        width //= 2
        # The directory doubles; only children of overfull buckets become buckets of their own.
        split = np.repeat(overfull, 2)
        starts = np.arange(0, slots, width, dtype=np.int32)
        bucket = np.where(np.repeat(split, width), np.repeat(starts, width), bucket)
        overfull = split & (slot_counts.reshape(-1, width).sum(axis=1) > capacity)
    return bucket


def _fold(bucket_of: np.ndarray, schema: pa.Schema, flush_bytes: int):
    """Joins equal texts of one task: (bucket, key, text, largest id, rows)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}
        size = 0

        def flush():
            keys = np.fromiter((k for k, _ in held), np.int64, len(held))
            slots = keys.view(np.uint64) >> np.uint64(64 - MAX_DEPTH)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket_of[slots.astype(np.int64)]),
                    pa.array(keys),
                    pa.array([t for _, t in held], schema.field("text").type),
                    pa.array([v[0] for v in held.values()], schema.field("keep_id").type),
                    pa.array([v[1] for v in held.values()], pa.int64()),
                ],
                schema=schema,
            )

        for part in parts:
            for i, text, key in zip(*(part.column(c).to_pylist() for c in ("id", "text", "key"))):
                entry = held.get((key, text))
                if entry is None:
                    held[(key, text)] = [i, 1]
                    size += len(text) + 100
                    if size >= flush_bytes:
                        yield flush()
                        held.clear()
                        size = 0
                    continue
                entry[1] += 1
                if i is not None and (entry[0] is None or i > entry[0]):
                    entry[0] = i
        if held:
            yield flush()

    return run


def _chain(schema: pa.Schema):
    """Compares the texts under each key, in key order: a row per different text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain, done = None, [], []

        def close():
            for place, (text, keep_id, n) in enumerate(chain):
                sha = hashlib.sha256(text.encode()).hexdigest()
                done.append((*current, place, sha, keep_id, n))

        def flush():
            out = pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*done)))), schema=schema)
            done.clear()
            return out

        for part in parts:
            for bucket, key, text, i, n in zip(
                *(part.column(c).to_pylist() for c in ("bucket", "key", "text", "keep_id", "n"))
            ):
                if (bucket, key) != current:
                    if chain:
                        close()
                    current, chain = (bucket, key), []
                for entry in chain:
                    if entry[0] == text:
                        entry[2] += n
                        if i is not None and (entry[1] is None or i > entry[1]):
                            entry[1] = i
                        break
                else:
                    chain.append([text, i, n])
            if done:
                yield flush()
        if chain:
            close()
            yield flush()

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY
) -> DataFrame:
    """The index: bucket, key, chain, text_sha256, keep_id, group_size; a row per different text."""
    keyed = _keyed(docs, id_col, text_col)
    slot = F.shiftrightunsigned("key", 64 - MAX_DEPTH)
    counts = keyed.groupBy("key").agg(F.lit(1)).groupBy(slot.alias("slot")).count().collect()
    slot_counts = np.zeros(1 << MAX_DEPTH, dtype=np.int64)
    for row in counts:
        slot_counts[row["slot"]] = row["count"]
    id_type = keyed.schema["id"].dataType
    folded = StructType(
        [
            StructField("bucket", IntegerType()),
            StructField("key", LongType()),
            StructField("text", StringType()),
            StructField("keep_id", id_type),
            StructField("n", LongType()),
        ]
    )
    chained = StructType(
        [
            StructField("bucket", IntegerType()),
            StructField("key", LongType()),
            StructField("chain", IntegerType()),
            StructField("text_sha256", StringType()),
            StructField("keep_id", id_type),
            StructField("group_size", LongType()),
        ]
    )
    entries = keyed.mapInArrow(
        _fold(directory(slot_counts, bucket_capacity), to_arrow_schema(folded), FOLD_BYTES), folded
    )
    owned = entries.repartition("bucket").sortWithinPartitions("bucket", "key")
    index = owned.mapInArrow(_chain(to_arrow_schema(chained)), chained)
    return stage(index, "text-index")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_capacity: int = BUCKET_CAPACITY
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row."""
    index = build_index(docs, id_col, text_col, bucket_capacity)
    own = _keyed(docs, id_col, text_col).select("id", "key", F.sha2("text", 256).alias("text_sha256"))
    return own.join(index.drop("bucket", "chain"), ["key", "text_sha256"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
