"""Stream form of the ingest: every micro-batch goes through the same save as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from batchlens.operators.batching import assign_batches
from batchlens.session import configure
from batchlens.sources.warehouse import Warehouse


def ingest_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    time_column: str,
    checkpoint: str,
    *,
    late: str = "drop",
    name: str = "stream",
    available_now: bool = True,
    interval: str = "1 minute",
    **parsing,
) -> StreamingQuery:
    """Start storing the batches of a streaming DataFrame.

    The first micro-batch that brings a month stores it. With late='drop' rows of that month in
    later micro-batches are dropped, as in repeated batch runs; late='append' keeps them when a
    month may arrive in several parts. The ingest id names the query, as its checkpoint keeps it, and
    the micro-batch: one that is replayed after a failure is not stored twice, and another stream, or
    the same one with a fresh checkpoint, is not taken for it. Further arguments go to the parsing of dates.
    """

    def store(part: DataFrame, epoch: int) -> None:
        spark = configure(part.sparkSession)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = assign_batches(part, time_column, **parsing)
        Warehouse(spark, warehouse.root).save(rows, ingest_id=f"{query}-{epoch}", late=late)

    writer = stream.writeStream.queryName(name).foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
