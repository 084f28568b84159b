"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.session import stage


#: Rows, and bytes, that pass between Spark and a Python worker at once. Texts may be long, so these are fewer than usual.
ROWS_AT_ONCE = 1000
BYTES_AT_ONCE = 8 << 20

_holder: tuple[str, Callable[[], None]] | None = None


def hold_tables(owner: str, clear: Callable[[], None]) -> None:
    """Say that this worker now fills tables of `owner`, which `clear` empties.

    Workers serve one stage after the other. What another operator's tables hold is given back to the system first, so
    that the tables of a pipeline do not add up.
    """
    global _holder
    if _holder is not None and _holder[0] == owner:
        return
    before, _holder = _holder, (owner, clear)
    if before is not None:
        before[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # Another C library, which has no such call.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) only, so that no other column can clash with an operator's own names; NULL text is empty."""
    return docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def stage_and_free(df: DataFrame, label: str) -> DataFrame:
    """`stage`, and the shuffle files of the write go as soon as it is done: the written table replaces them."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark = df.sparkSession
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        return stage(df, label)
    finally:
        spark.conf.set(setting, before)


def crc_mod(column: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo `mod`; a NULL value counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % mod


def chunks(batch: pa.RecordBatch, rows: int) -> Iterable[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))
