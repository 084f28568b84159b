"""Months of a stream, stored once they are closed by event time.

Rows go to the arrivals of the warehouse as they come, by the exactly-once file sink. A second query reads the time of
each arrival, with a watermark; the days it has passed come out of a windowed count, and with the end of a day all
months before it are closed. A closed month is stored whole, from as many micro-batches as brought it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from batchlens.functions.dates import month_key
from batchlens.functions.values import column
from batchlens.operators.batching import BATCH, assign_batches, rows_per_batch
from batchlens.session import configure
from batchlens.sources.warehouse import Saved, Warehouse

ARRIVALS = "arrivals"


def collect_arrivals(
    stream: DataFrame, warehouse: Warehouse, time_column: str, checkpoint: str, *, interval: str | None = None, **parsing
) -> StreamingQuery:
    """Start writing the rows of a streaming DataFrame to the arrivals, by month.

    Without an interval the query takes what is there and ends. Further arguments go to the parsing of dates.
    """
    configure(warehouse.spark)
    rows = assign_batches(stream, time_column, **parsing)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = rows.writeStream.format("parquet").partitionBy(BATCH).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(f"{warehouse.root.rstrip('/')}/{ARRIVALS}")


def arrivals(warehouse: Warehouse, schema: StructType) -> DataFrame:
    """All rows that arrived, stored or not; the schema is that of the written rows."""
    return warehouse.spark.read.schema(_with_batch(schema)).parquet(f"{warehouse.root.rstrip('/')}/{ARRIVALS}")


def _with_batch(schema: StructType) -> StructType:
    return StructType([*[f for f in schema.fields if f.name != BATCH], StructField(BATCH, StringType())])


def store_months(warehouse: Warehouse, schema: StructType, before: str | None, ingest_id: str | None = None) -> Saved:
    """Store the months among the arrivals that are not stored yet, those before the given one or all."""
    rows = arrivals(warehouse, schema)
    months = rows.select(BATCH).filter(F.col(BATCH).isNotNull()).distinct()
    if before is not None:
        months = months.filter(F.col(BATCH) < before)
    # One row per month; only their folders are read again.
    todo = [r[0] for r in months.join(warehouse.ledger(), BATCH, "left_anti").collect()]
    return warehouse.save(rows.filter(F.col(BATCH).isin(todo)), ingest_id=ingest_id)


def store_closed_months(
    warehouse: Warehouse,
    schema: StructType,
    time_column: str,
    checkpoint: str,
    *,
    delay: str = "1 day",
    interval: str | None = None,
) -> StreamingQuery:
    """Start storing the months that the watermark has passed, `delay` behind the latest time that arrived.

    `schema` is that of the arrivals, with `time_column` a timestamp. A month that is stored stays as it is: arrivals
    of it that come later are counted by `late_arrivals`. Months after the last closed day wait.
    """
    spark = configure(warehouse.spark)
    source = spark.readStream.schema(_with_batch(schema)).parquet(f"{warehouse.root.rstrip('/')}/{ARRIVALS}")
    days = (
        source.select(column(time_column).alias("time"))
        .withWatermark("time", delay)
        .groupBy(F.window("time", "1 day").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def store(passed: DataFrame, epoch: int) -> None:
        session = configure(passed.sparkSession)
        month = passed.agg(month_key(F.max("day.end")).alias("month")).first()[0]
        if month is not None:
            query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
            store_months(Warehouse(session, warehouse.root), schema, month, f"{query}-{epoch}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = days.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def late_arrivals(warehouse: Warehouse, schema: StructType) -> DataFrame:
    """(batch_id, n_rows, late_rows) of the stored months that more rows arrived for after they were stored."""
    counts = rows_per_batch(arrivals(warehouse, schema)).withColumnRenamed("n_rows", "arrived")
    late = (F.col("arrived") - F.col("n_rows")).alias("late_rows")
    return warehouse.ledger().join(counts, BATCH).select(BATCH, "n_rows", late).filter("late_rows > 0")
