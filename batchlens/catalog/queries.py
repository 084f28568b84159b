"""Registered queries: one callable (spark, sf_dir) -> DataFrame per name."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from batchlens.catalog.subjects import (
    ALL_ORDER_KINDS,
    ALL_SHIPMENT_KINDS,
    DOCUMENT_KINDS,
    EVENT_KINDS,
    ORDER_KINDS,
    SHIPMENT_KINDS,
    all_orders,
    all_shipments,
    labelled_documents,
    monthly_events,
    monthly_orders,
    shipment_columns,
    shipments,
    table,
)
from batchlens.functions.dates import month_key, parse_timestamp
from batchlens.functions.jsons import list_to_json, row_from_json, row_to_json, stats_to_json
from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators import checks, cleaning, eda, itemsets, items, rules, states, trends
from batchlens.operators.batching import BATCH, assign_batches, rows_per_batch
from batchlens.operators.profile import numeric_statistics, profile, quality_records, text_counts, top_values
from batchlens.plans.report import HISTOGRAMS, dq_lines, write_report
from batchlens.plans.update import backfill_dq, backfill_states, ingest, seed, update
from batchlens.session import scratch_path, stage
from batchlens.sources.csvs import read_csvs
from batchlens.sources.warehouse import Warehouse, pending, split_late
from batchlens.streaming.closing import collect_arrivals, late_arrivals, store_closed_months
from batchlens.streaming.ingest import ingest_stream

# Thresholds of the cleaning queries.
CLEANING = {"max_missing_rate": 0.3, "min_unique_ratio": 0.005, "max_unique_ratio": 0.9}

# A table with 14 numeric columns.
WIDE_KINDS = {f"p{i}": NUMERIC for i in range(14)}
# Formats in which dates are rendered; a day-first text is left out where it would read as month-first.
RENDERED = (
    "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss.SSS",
    "M-d-yyyy", "d-MMM-yy", "d-MMM-yy H:mm:ss", "d-MMM-yyyy", "d MMM yyyy", "MMMM d, yyyy", "yyyy/M/d",
    "yyyy/M/d H:mm:ss", "yyyy.M.d", "yyyyMMdd",
)


def _rounded(df: DataFrame, *exact: str) -> DataFrame:
    """Sums and interpolations of doubles to six decimals, as their last digits depend on the order of rows.

    Columns named as exact are ratios of counts, which every engine computes alike.
    """
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    floats -= set(exact)
    return df.select(*[F.round(c, 6).alias(c) if c in floats else F.col(c) for c in df.columns])


def _joined(c: str):
    return F.array_join(c, ",").alias(c)


def _flat_profile(dq: DataFrame) -> DataFrame:
    """Quality records with their nested parts as plain columns."""
    top = F.transform("top", lambda t: F.concat(t["value"], F.lit(":"), t["cnt"].cast("string")))
    return _rounded(
        dq.select(
            BATCH,
            "feature",
            "value_type",
            "n_rows",
            "missing_rate",
            "unique_count",
            "stats.*",
            F.array_join(top, ";").alias("top"),
        ),
        "missing_rate",
    )


# --- quality profile


def batch_ledger(spark, sf_dir):
    return rows_per_batch(shipments(spark, sf_dir)).orderBy(BATCH)


def dq_profile(spark, sf_dir):
    return _flat_profile(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS))


def dq_profile_orders(spark, sf_dir):
    return _flat_profile(profile(all_orders(spark, sf_dir), ALL_ORDER_KINDS))


def dq_profile_events(spark, sf_dir):
    return _flat_profile(profile(monthly_events(spark, sf_dir), EVENT_KINDS))


def dq_missing_unique(spark, sf_dir):
    dq = quality_records(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS, top_k=None)
    return dq.select(BATCH, "feature", "missing_rate", "unique_count")


def dq_numeric_stats(spark, sf_dir):
    stats = numeric_statistics(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)
    return _rounded(stats.filter(F.col("value_type") == NUMERIC).select(BATCH, "feature", "stats.*"))


def dq_top10(spark, sf_dir):
    cats = [c for c, k in ALL_SHIPMENT_KINDS.items() if k != NUMERIC]
    return top_values(text_counts(all_shipments(spark, sf_dir), cats), 10)


def dq_stats_json(spark, sf_dir):
    """Value counts of the categorical columns as JSON text."""
    dq = profile(all_orders(spark, sf_dir), ALL_ORDER_KINDS)
    return dq.filter(F.col("value_type") != NUMERIC).select(
        BATCH, "feature", stats_to_json(F.col("stats"), F.col("top")).alias("stats_json")
    )


def dq_stats_json_numeric(spark, sf_dir):
    """Statistics of the numeric columns as JSON text, read back as numbers."""
    dq = profile(all_orders(spark, sf_dir), ALL_ORDER_KINDS).filter(F.col("value_type") == NUMERIC)
    text = stats_to_json(F.col("stats"), F.col("top"))
    parts = [F.get_json_object(text, f"$.{s}").cast("double").alias(s) for s in ("min", "max", "mean", "std")]
    return _rounded(dq.select(BATCH, "feature", *parts))


def dq_by_batch(spark, sf_dir):
    return _rounded(trends.by_batch(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)))


def dq_by_feature(spark, sf_dir):
    found = trends.by_feature(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS))
    return _rounded(found, "min_missing_rate", "max_missing_rate")


def dq_summary(spark, sf_dir):
    return trends.summary(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS))


def report_lines(spark, sf_dir):
    return dq_lines(stage(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS), "dq"))


# --- cleaning


def clean_verdicts(spark, sf_dir):
    return cleaning.verdicts(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS), **CLEANING)


def clean_long(spark, sf_dir):
    """Kept cells by batch and feature, with a checksum of the numeric ones."""
    df = all_shipments(spark, sf_dir)
    verdicts = cleaning.verdicts(profile(df, ALL_SHIPMENT_KINDS), **CLEANING)
    kept = cleaning.clean_long(df, ALL_SHIPMENT_KINDS, verdicts)
    return _rounded(
        kept.groupBy(BATCH, "feature").agg(
            F.count(F.lit(1)).alias("cells"), F.avg("num").alias("mean"), F.max("text").alias("last_text")
        )
    )


def clean_batch_orders(spark, sf_dir):
    """All orders as one batch, without the columns that are nearly unique or mostly missing."""
    orders = table(spark, sf_dir, "orders")
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("closed_priority")
    df = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", closed)
    kinds = {c: NUMERIC if t in ("bigint", "double") else CATEGORICAL for c, t in df.dtypes}
    dq = profile(df.withColumn(BATCH, F.lit("all")), kinds)
    found = cleaning.verdicts(dq, max_missing_rate=0.5, min_unique_ratio=None, max_unique_ratio=0.9)
    return cleaning.clean_batch(df, found)


# --- exploratory tables


def eda_summary(spark, sf_dir):
    return eda.summary(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)


def eda_overview(spark, sf_dir):
    return eda.overview(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)


def eda_overview_documents(spark, sf_dir):
    return eda.overview(labelled_documents(spark, sf_dir), DOCUMENT_KINDS)


def eda_describe(spark, sf_dir):
    return eda.describe(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)


def eda_describe_ranged(spark, sf_dir):
    """The same with quartiles found digit by digit, as for tables of any size."""
    return eda.describe(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS, small_table=0)


def eda_describe_documents(spark, sf_dir):
    return eda.describe(labelled_documents(spark, sf_dir), DOCUMENT_KINDS)


def eda_correlation(spark, sf_dir):
    return _rounded(eda.correlation(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS))


def eda_histogram(spark, sf_dir):
    return _rounded(eda.histogram(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS))


def eda_top10(spark, sf_dir):
    return eda.top_values(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS)


def eda_top10_documents(spark, sf_dir):
    return eda.top_values(labelled_documents(spark, sf_dir), DOCUMENT_KINDS)


def eda_histogram_wide(spark, sf_dir):
    """A table with more numeric columns than a page of charts would hold."""
    df = table(spark, sf_dir, "orders").select(*[(F.col("o_totalprice") + i).alias(f"p{i}") for i in range(14)])
    return _rounded(eda.histogram(df, WIDE_KINDS, bins=5))


def eda_histogram_first(spark, sf_dir):
    """The same table cut to the first twelve columns, as a report shows them."""
    df = table(spark, sf_dir, "orders").select(*[(F.col("o_totalprice") + i).alias(f"p{i}") for i in range(14)])
    return _rounded(eda.histogram(df, WIDE_KINDS, bins=5, max_columns=HISTOGRAMS))


def _stored_states(spark, sf_dir):
    """Value counts and co-moments of the shipments, kept per batch: months of the first half, then all of them."""
    warehouse = _warehouse(spark)
    df = all_shipments(spark, sf_dir)
    warehouse.save(df.filter(F.col(BATCH) < "1998-06"))
    backfill_states(warehouse, ALL_SHIPMENT_KINDS)
    warehouse.save(df)
    backfill_states(warehouse, ALL_SHIPMENT_KINDS)
    return warehouse.states()


def stored_describe(spark, sf_dir):
    values, _ = _stored_states(spark, sf_dir)
    return states.describe(states.merged(values), ALL_SHIPMENT_KINDS)


def stored_correlation(spark, sf_dir):
    return _rounded(states.correlation(_stored_states(spark, sf_dir)[1], ALL_SHIPMENT_KINDS))


# --- rules


def batch_medians(spark, sf_dir):
    nums = [c for c, k in SHIPMENT_KINDS.items() if k == NUMERIC]
    return _rounded(items.batch_medians(shipments(spark, sf_dir), nums))


def batch_medians_ranged(spark, sf_dir):
    nums = [c for c, k in SHIPMENT_KINDS.items() if k == NUMERIC]
    return _rounded(items.batch_medians(shipments(spark, sf_dir), nums, small_table=0))


def row_items(spark, sf_dir):
    keys = ("l_orderkey", "l_partkey", "l_suppkey")
    df = shipments(spark, sf_dir, *keys)
    out = items.with_items(df, SHIPMENT_KINDS, exclude=keys)
    return out.select(BATCH, *keys, "l_linenumber", _joined("items"))


def _sets(df: DataFrame) -> DataFrame:
    return df.select(BATCH, _joined("items"), "cnt", "support")


def frequent_itemsets(spark, sf_dir):
    return _sets(itemsets.frequent_itemsets(shipments(spark, sf_dir), SHIPMENT_KINDS, 0.05))


def frequent_itemsets_stepwise(spark, sf_dir):
    """The same item by item, as for baskets with too many subsets to count at once."""
    return _sets(itemsets.frequent_itemsets(shipments(spark, sf_dir), SHIPMENT_KINDS, 0.05, whole=0))


def _rules(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(BATCH, *extra, _joined("antecedents"), _joined("consequents"), "support", "confidence", "lift")


def rules_fixed(spark, sf_dir):
    return _rules(rules.rules_at(shipments(spark, sf_dir), SHIPMENT_KINDS, 0.05, 0.3))


def rules_ladder(spark, sf_dir):
    return _rules(rules.by_lift(rules.mine_rules(shipments(spark, sf_dir), SHIPMENT_KINDS, min_rules=500)))


def rules_listing(spark, sf_dir):
    """Rules of the orders by falling lift, with their place."""
    found = rules.mine_rules(monthly_orders(spark, sf_dir), ORDER_KINDS, exclude=["o_totalprice"])
    place = F.monotonically_increasing_id()
    return _rules(rules.by_lift(found).coalesce(1).withColumn("place", place), "place")


def rules_json(spark, sf_dir):
    """Stored rules of the orders with their sides as JSON text."""
    warehouse = _warehouse(spark)
    source = table(spark, sf_dir, "orders").select("o_orderdate", *ORDER_KINDS)
    update(warehouse, source, {"o_orderdate": "categorical", **ORDER_KINDS}, "o_orderdate", target="o_totalprice")
    sides = [list_to_json(F.col(c)).alias(c) for c in ("antecedents", "consequents")]
    return warehouse.rules().select(BATCH, *sides, "support", "confidence", "lift")


def rules_orders(spark, sf_dir):
    """Default ladder on orders, with the price as target left out of the mining."""
    found = rules.mine_rules(monthly_orders(spark, sf_dir), ORDER_KINDS, exclude=["o_totalprice"])
    return _rules(found)


# --- ledger, constraints, sources


def pending_dq(spark, sf_dir):
    """Months with shipments for which no order month was profiled."""
    done = profile(monthly_orders(spark, sf_dir), ORDER_KINDS)
    return pending(rows_per_batch(shipments(spark, sf_dir)), done)


def pending_rules(spark, sf_dir):
    """Months with shipments for which no rules of orders were mined."""
    done = rules.mine_rules(monthly_orders(spark, sf_dir), ORDER_KINDS)
    return pending(rows_per_batch(shipments(spark, sf_dir)), done)


def late_rows(spark, sf_dir):
    """Shipments by month when the months of the orders are stored already: new and late rows."""
    ledger = rows_per_batch(monthly_orders(spark, sf_dir))
    new, late = split_late(shipments(spark, sf_dir), ledger)
    tagged = [
        rows_per_batch(df).select(BATCH, F.lit(state).alias("state"), "n_rows")
        for df, state in ((new, "new"), (late, "late"))
    ]
    return tagged[0].unionByName(tagged[1])


def constraint_checks(spark, sf_dir):
    """Violations of table rules, by rule: shipment records against the ledger of orders, and keys."""
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    ledger = rows_per_batch(monthly_orders(spark, sf_dir))
    dq = stage(profile(shipments(spark, sf_dir), SHIPMENT_KINDS), "dq")
    stored = checks.violations(ledger, dq).groupBy("check").agg(F.sum("n").alias("n"))
    found = {
        "line key unique": checks.duplicate_keys(line, ["l_orderkey", "l_linenumber"]),
        "order status domain": checks.outside_domain(order, "o_orderstatus", ["F", "O"]),
        "tax not null": checks.null_values(shipments(spark, sf_dir), ["tax", "flag"]),
        "line order exists": checks.orphans(line, order.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"),
    }
    for name, bad in found.items():
        stored = stored.unionByName(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n"))
    return stored.filter(F.col("n") > 0)


def json_roundtrip(spark, sf_dir):
    df = shipments(spark, sf_dir, "l_orderkey")
    columns = [c for c in df.columns if c != BATCH]
    schema = StructType([df.schema[c] for c in columns])
    text = df.select(BATCH, row_to_json(df, columns).alias("row_json"))
    return row_from_json(text, "row_json", schema, keep=[BATCH])


def csv_union(spark, sf_dir):
    """Orders and customers written as CSV files with different columns and read as one table."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("segment"),
        "c_acctbal",
    )
    for part in (orders, customers):
        part.write.mode("append").option("header", True).csv(path)
    # A subfolder is no part of the table, whatever its name looks like.
    orders.write.option("header", True).csv(f"{path}/p=1")
    kinds = {"o_orderkey": NUMERIC, "custkey": NUMERIC, "o_totalprice": NUMERIC, "c_acctbal": NUMERIC}
    return read_csvs(spark, path, kinds).select("o_orderkey", "custkey", "o_totalprice", "segment", "c_acctbal")


def time_parse(spark, sf_dir):
    """Order dates as day-month-year text, missing for pending orders, parsed back and counted by month."""
    orders = table(spark, sf_dir, "orders")
    shown = F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    texts = orders.select(F.when(F.col("o_orderstatus") != "P", shown).alias("day"))
    months = texts.select(month_key(parse_timestamp(F.col("day"))).alias(BATCH))
    return rows_per_batch(months)


def time_parse_formats(spark, sf_dir):
    """Order dates written in every accepted format by turns, parsed back and counted by day."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").isNotNull())
    turn = F.col("o_orderkey") % len(RENDERED)
    shown = F.coalesce(*[F.when(turn == i, F.date_format("o_orderdate", f)) for i, f in enumerate(RENDERED)])
    day = F.date_format(parse_timestamp(F.upper(shown)), "yyyy-MM-dd").alias("day")
    return orders.select(turn.cast("int").alias("turn"), day).groupBy("turn", "day").agg(F.count(F.lit(1)).alias("n"))


def time_parse_bad(spark, sf_dir):
    """Texts that are no date count as missing when asked for; the others are read."""
    orders = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy.M.d"))
    dated = orders.withColumn("o_orderdate", text)
    return rows_per_batch(assign_batches(dated, "o_orderdate", on_bad="null"))


def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def _dated_shipments(spark, sf_dir) -> DataFrame:
    return shipment_columns(table(spark, sf_dir, "lineitem")).select("l_shipdate", *SHIPMENT_KINDS)


def latest_batch(spark, sf_dir):
    """Shipments stored as batches; the rows of the last batch read back."""
    warehouse = _warehouse(spark)
    ingest(warehouse, _dated_shipments(spark, sf_dir), "l_shipdate")
    last = warehouse.ledger().agg(F.max(BATCH)).first()[0]
    return warehouse.load_batch(last).select(*SHIPMENT_KINDS)


def seed_from_csv(spark, sf_dir):
    """Orders written as a CSV folder with text dates, then read, typed and stored; the resulting ledger."""
    path = scratch_path(spark, "csv")
    day = F.upper(F.date_format("o_orderdate", "dd-MMM-yy")).alias("o_orderdate")
    table(spark, sf_dir, "orders").select(day, *ORDER_KINDS).write.option("header", True).csv(path)
    warehouse = _warehouse(spark)
    seed(warehouse, path, ORDER_KINDS, "o_orderdate")
    return warehouse.list_batches().select(BATCH, "n_rows")


def stream_ingest(spark, sf_dir):
    """Line items as a file stream, stored month by month; the resulting ledger."""
    source = table(spark, sf_dir, "lineitem")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    warehouse = _warehouse(spark)
    query = ingest_stream(stream, warehouse, "l_shipdate", scratch_path(spark, "stream"))
    query.awaitTermination()
    return warehouse.list_batches().select(BATCH, "n_rows")


def stream_two_sources(spark, sf_dir):
    """Orders, then line items, as two streams with default names into one warehouse; the first to bring a month
    stores it."""
    warehouse = _warehouse(spark)
    for name, day in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        schema = table(spark, sf_dir, name).schema
        stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
        ingest_stream(stream, warehouse, day, scratch_path(spark, "stream")).awaitTermination()
    return warehouse.list_batches().select(BATCH, "n_rows")


def two_writers(spark, sf_dir):
    """The same orders stored by two writers at once: rows of the ledger and stored rows, by month."""
    warehouse = _warehouse(spark)
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", *ORDER_KINDS)
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(ingest, warehouse, source, "o_orderdate") for _ in range(2)]:
            done.result()
    stored = rows_per_batch(warehouse.raw()).withColumnRenamed("n_rows", "stored_rows")
    return warehouse.ledger().join(stored, BATCH).select(BATCH, "n_rows", "stored_rows")


def guarded_ingest(spark, sf_dir):
    """Months of orders that keep all rules are stored, the others refused: violations by month and rule."""
    warehouse = _warehouse(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", *ORDER_KINDS)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    guard = checks.Guard(
        rows={"price in range": ~F.col("o_totalprice").between(1000, 499_700)},
        unique={"one order a day, customer and priority": ["o_custkey", "o_orderdate", "o_orderpriority"]},
        references={"customer exists": ("o_custkey", customers.filter("o_custkey > 1"))},
    )
    ingest(warehouse, orders, "o_orderdate", guard=guard)
    kept = rows_per_batch(warehouse.raw()).select(BATCH, F.lit("stored").alias("check"), F.col("n_rows").alias("n"))
    return kept.unionByName(warehouse.refused().select(BATCH, "check", "n"))


def stream_closed_months(spark, sf_dir):
    """Orders that arrive in three parts, cut within months, and some again at the end: rows of the months that the
    watermark has closed, and how many came too late."""
    warehouse, source = _warehouse(spark), scratch_path(spark, "landing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    marks = (scratch_path(spark, "stream"), scratch_path(spark, "stream"))

    def run(part: DataFrame) -> None:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(orders.schema).parquet(source)
        collect_arrivals(stream, warehouse, "o_orderdate", marks[0]).awaitTermination()
        store_closed_months(warehouse, schema, "o_orderdate", marks[1], delay="10 days").awaitTermination()

    schema = assign_batches(orders, "o_orderdate").schema
    day = F.col("o_orderdate")
    run(orders.filter(day < "1997-03-15"))
    run(orders.filter((day >= "1997-03-15") & (day < "1999-06-20")))
    run(orders.filter(day >= "1999-06-20"))
    run(orders.filter(F.col("o_orderkey") % 50 == 0))
    late = late_arrivals(warehouse, schema).select(BATCH, "late_rows")
    return (
        rows_per_batch(warehouse.raw())
        .join(late, BATCH, "left")
        .select(BATCH, "n_rows", F.coalesce("late_rows", F.lit(0)).cast("long").alias("late_rows"))
    )


def raw_mixed_types(spark, sf_dir):
    """Two ingests whose customer keys are whole numbers and decimals, read back as one table."""
    warehouse = _warehouse(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    early = F.col("o_orderdate") < "1998-01-01"
    ingest(warehouse, orders.filter(early), "o_orderdate")
    later = orders.filter(~early).withColumn("o_custkey", F.col("o_custkey") + 0.5).withColumn("note", F.lit("n"))
    ingest(warehouse, later, "o_orderdate")
    return warehouse.raw().select(BATCH, "o_orderkey", "o_custkey", "note")


def dq_listing(spark, sf_dir):
    """Stored quality records as listed, with their place, and the rows of the ledger."""
    warehouse = _warehouse(spark)
    source = table(spark, sf_dir, "orders").select("o_orderdate", *ORDER_KINDS)
    kinds = {"o_orderdate": CATEGORICAL, **ORDER_KINDS}
    ingest(warehouse, source, "o_orderdate")
    backfill_dq(warehouse, kinds)
    total = warehouse.ledger().agg(F.sum("n_rows")).first()[0]
    place = F.monotonically_increasing_id()
    listed = warehouse.list_dq().select(BATCH, "feature", "unique_count").coalesce(1).withColumn("place", place)
    return listed.select("place", BATCH, "feature", "unique_count", F.lit(total).alias("ledger_rows"))


def written_report(spark, sf_dir):
    """The quality part of a written report, line by line, as it is read back."""
    warehouse = _warehouse(spark)
    path = scratch_path(spark, "report")
    warehouse.save_dq(profile(all_shipments(spark, sf_dir), ALL_SHIPMENT_KINDS), 84)
    write_report(warehouse, ALL_SHIPMENT_KINDS, path)
    return spark.read.text(f"{path}/text").select(F.col("value").alias("line")).filter("line <> ''")


def written_report_stored(spark, sf_dir):
    """A whole written report over stored orders, quality and exploratory part, line by line as it is read back."""
    warehouse = _warehouse(spark)
    path = scratch_path(spark, "report")
    kinds = {"o_orderdate": CATEGORICAL, **ORDER_KINDS}
    ingest(warehouse, table(spark, sf_dir, "orders").select(*kinds), "o_orderdate")
    backfill_dq(warehouse, kinds)
    write_report(warehouse, kinds, path)
    return spark.read.text(f"{path}/text").select(F.col("value").alias("line")).filter("line <> ''")


def row_items_equals_one(spark, sf_dir):
    """Items where a whole-number category counts when it is 1, with a column that is always missing."""
    keys = ("l_orderkey", "l_partkey", "l_suppkey")
    df = shipments(spark, sf_dir, *keys).withColumn("never", F.lit(None).cast("string"))
    kinds = {**SHIPMENT_KINDS, "never": CATEGORICAL}
    out = items.with_items(df, kinds, exclude=keys, numeric_categorical="equals_one")
    return out.select(BATCH, *keys, "l_linenumber", _joined("items"))


_UPDATE_KINDS = {"l_shipdate": "categorical", **SHIPMENT_KINDS}


def update_run_dq(spark, sf_dir):
    """Two update runs over the shipments; the stored quality records, time column included."""
    warehouse = _warehouse(spark)
    for _ in range(2):
        update(warehouse, _dated_shipments(spark, sf_dir), _UPDATE_KINDS, "l_shipdate", target="l_quantity")
    return _flat_profile(warehouse.dq())


def update_run_rules(spark, sf_dir):
    """Two update runs over the orders; the stored rules, with the price as target left out."""
    warehouse = _warehouse(spark)
    source = table(spark, sf_dir, "orders").select("o_orderdate", *ORDER_KINDS)
    kinds = {"o_orderdate": "categorical", **ORDER_KINDS}
    for _ in range(2):
        update(warehouse, source, kinds, "o_orderdate", target="o_totalprice")
    return _rules(warehouse.rules())


def undated_rows(spark, sf_dir):
    """Orders by month, those without a date under no month."""
    orders = table(spark, sf_dir, "orders")
    dated = orders.withColumn("day", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return rows_per_batch(assign_batches(dated, "day"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        batch_ledger,
        dq_profile,
        dq_profile_orders,
        dq_profile_events,
        dq_missing_unique,
        dq_numeric_stats,
        dq_top10,
        dq_stats_json,
        dq_stats_json_numeric,
        dq_by_batch,
        dq_by_feature,
        dq_summary,
        report_lines,
        clean_verdicts,
        clean_long,
        clean_batch_orders,
        eda_summary,
        eda_overview,
        eda_overview_documents,
        eda_describe,
        eda_describe_ranged,
        eda_describe_documents,
        eda_correlation,
        eda_histogram,
        eda_top10,
        eda_top10_documents,
        eda_histogram_wide,
        eda_histogram_first,
        stored_describe,
        stored_correlation,
        batch_medians,
        batch_medians_ranged,
        row_items,
        frequent_itemsets,
        frequent_itemsets_stepwise,
        rules_fixed,
        rules_ladder,
        rules_orders,
        rules_listing,
        rules_json,
        pending_dq,
        pending_rules,
        late_rows,
        constraint_checks,
        json_roundtrip,
        csv_union,
        time_parse,
        time_parse_formats,
        time_parse_bad,
        undated_rows,
        latest_batch,
        seed_from_csv,
        stream_ingest,
        stream_two_sources,
        stream_closed_months,
        two_writers,
        guarded_ingest,
        raw_mixed_types,
        dq_listing,
        written_report,
        written_report_stored,
        row_items_equals_one,
        update_run_dq,
        update_run_rules,
    )
}
