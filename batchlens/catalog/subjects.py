"""The tables the registered queries run on, as monitored tables with kinds and a time column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators.batching import BATCH, split_batches
from batchlens.session import configure

SHIPMENT_KINDS = {
    "l_quantity": NUMERIC,
    "l_extendedprice": NUMERIC,
    "l_discount": NUMERIC,
    "tax": NUMERIC,
    "flag": CATEGORICAL,
    "l_linestatus": CATEGORICAL,
    "l_linenumber": CATEGORICAL,
}
# Profiles and exploratory tables cover all columns; rules are mined over the ones above.
ALL_SHIPMENT_KINDS = {
    "l_orderkey": NUMERIC,
    "l_partkey": NUMERIC,
    "l_suppkey": NUMERIC,
    "l_shipdate": CATEGORICAL,
    **SHIPMENT_KINDS,
}
ORDER_KINDS = {"o_totalprice": NUMERIC, "o_orderstatus": CATEGORICAL, "o_orderpriority": CATEGORICAL}
ALL_ORDER_KINDS = {"o_orderkey": NUMERIC, "o_custkey": NUMERIC, "o_orderdate": CATEGORICAL, **ORDER_KINDS}
DOCUMENT_KINDS = {
    "doc_id": NUMERIC,
    "text": CATEGORICAL,
    "lang": CATEGORICAL,
    "source": CATEGORICAL,
    "n_chars": NUMERIC,
    "quality": CATEGORICAL,
    "toxic": CATEGORICAL,
}
EVENT_KINDS = {
    "event_id": NUMERIC,
    "ts": CATEGORICAL,
    "user_id": NUMERIC,
    "event_type": CATEGORICAL,
    "value": NUMERIC,
    "props": CATEGORICAL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shipment_columns(df: DataFrame) -> DataFrame:
    """Line items with a zero tax and the flag N standing for missing values."""
    return df.withColumn("tax", F.nullif("l_tax", F.lit(0.0))).withColumn(
        "flag", F.nullif("l_returnflag", F.lit("N"))
    )


def shipments(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    df = split_batches(shipment_columns(table(spark, sf_dir, "lineitem")), "l_shipdate")
    return df.select(BATCH, *extra, *SHIPMENT_KINDS)


def all_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments(spark, sf_dir, *(c for c in ALL_SHIPMENT_KINDS if c not in SHIPMENT_KINDS))


def monthly_orders(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    df = split_batches(table(spark, sf_dir, "orders"), "o_orderdate")
    return df.select(BATCH, *extra, *ORDER_KINDS)


def all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_orders(spark, sf_dir, *(c for c in ALL_ORDER_KINDS if c not in ORDER_KINDS))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").select(*DOCUMENT_KINDS)


def monthly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_batches(table(spark, sf_dir, "events"), "ts").select(BATCH, *EVENT_KINDS)
