import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators import checks
from batchlens.operators.batching import BATCH
from batchlens.plans.report import dq_lines, write_report
from batchlens.plans.update import backfill_rules, seed, update
from batchlens.session import scratch_dir
from batchlens.sources.warehouse import Warehouse
from batchlens.streaming.ingest import ingest_stream

KINDS = {"day": CATEGORICAL, "x": NUMERIC, "c": CATEGORICAL, "y": NUMERIC}
SCHEMA = "day timestamp, x double, c string, y double"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def rows(spark, *months, n=12):
    out = [
        (dt.datetime(2024, month, 1 + i), float(i), "ab"[i % 2], float(i // 2)) for month in months for i in range(n)
    ]
    return spark.createDataFrame(out, SCHEMA)


def batched(spark, *months, n=12):
    return rows(spark, *months, n=n).withColumn(BATCH, F.date_format("day", "yyyy-MM"))


def ids(df):
    return [r[BATCH] for r in df.select(BATCH).collect()]


def test_empty_warehouse(warehouse):
    assert warehouse.ledger().isEmpty() and warehouse.raw().isEmpty() and warehouse.rules().isEmpty()
    assert warehouse.pending_dq() == [] == warehouse.pending_rules()
    with pytest.raises(ValueError):
        warehouse.load_batch("2024-01")


def test_first_write_wins(spark, warehouse):
    assert warehouse.save(batched(spark, 1)).inserted == 1
    saved = warehouse.save(batched(spark, 1, 2, n=5))
    assert (saved.inserted, saved.late_rows) == (1, {"2024-01": 5})
    assert [(r[BATCH], r.n_rows) for r in warehouse.list_batches().collect()] == [("2024-01", 12), ("2024-02", 5)]
    assert warehouse.load_batch("2024-01").count() == 12
    assert not warehouse.save_batch("2024-02", rows(spark, 2))
    assert warehouse.save_batch("2024-03", rows(spark, 3))


def test_rows_without_time_are_counted(spark, warehouse):
    df = batched(spark, 1).union(spark.createDataFrame([(None, 1.0, "a", 1.0, None)], f"{SCHEMA}, batch_id string"))
    assert warehouse.save(df).undated_rows == 1
    assert warehouse.raw().count() == 12


def test_uncommitted_rows_are_invisible(spark, warehouse):
    warehouse.save(batched(spark, 1))
    stray = f"{warehouse.root}/raw/ingest_id=dead"
    batched(spark, 2).write.partitionBy(BATCH).parquet(stray)
    assert set(ids(warehouse.raw())) == {"2024-01"}
    assert warehouse.save(batched(spark, 2, n=3)).inserted == 1
    assert warehouse.load_batch("2024-02").count() == 3


def test_ingest_is_not_repeated(spark, warehouse):
    assert warehouse.save(batched(spark, 1), ingest_id="one").inserted == 1
    assert warehouse.save(batched(spark, 2), ingest_id="one").inserted == 0
    assert ids(warehouse.list_batches()) == ["2024-01"]


def test_columns_may_differ_between_ingests(spark, warehouse):
    warehouse.save(batched(spark, 1))
    warehouse.save(batched(spark, 2).withColumn("z", F.lit(1)).drop("c"))
    df = warehouse.raw()
    assert set(df.columns) == {BATCH, "day", "x", "c", "y", "z"}
    assert df.filter("z = 1 and c is null").count() == 12 == df.filter("z is null and c is not null").count()


def test_only_wanted_partitions_are_read(spark, warehouse):
    warehouse.save(batched(spark, 1, 2, 3))
    plan = warehouse.raw(["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_update_twice(spark, warehouse):
    first = update(warehouse, rows(spark, 1, 2), KINDS, "day", "y")
    assert (first.saved.inserted, first.profiled, first.mined) == (2, 2, 2)
    state = lambda: (
        sorted(map(str, warehouse.dq().collect())),
        sorted(map(str, warehouse.rules().collect())),
    )
    before = state()
    second = update(warehouse, rows(spark, 1, 2), KINDS, "day", "y")
    assert (second.saved.inserted, second.profiled, second.mined) == (0, 0, 0)
    assert state() == before
    items = {i for r in warehouse.rules().collect() for i in r.antecedents + r.consequents}
    assert items == {"x=above_median", "c=a", "c=b"}
    third = update(warehouse, rows(spark, 2, 3), KINDS, "day", "y")
    assert (third.saved.inserted, third.profiled, third.mined) == (1, 1, 1)
    assert warehouse.list_dq().count() == 12


def test_dq_and_rules_are_replaced_per_batch(spark, warehouse):
    update(warehouse, rows(spark, 1, 2), KINDS, "day", "y")
    one = warehouse.dq().filter("batch_id = '2024-01'").limit(1).withColumn("missing_rate", F.lit(0.5))
    warehouse.save_dq(spark.createDataFrame(one.collect(), one.schema))
    counts = {r[BATCH]: r["count"] for r in warehouse.dq().groupBy(BATCH).count().collect()}
    assert counts == {"2024-01": 1, "2024-02": 4}
    none = spark.createDataFrame([], warehouse.rules().schema)
    warehouse.save_rules(none, ["2024-01"])
    assert set(ids(warehouse.rules())) == {"2024-02"}


def test_batch_without_rules_is_retried_only_on_request(spark, warehouse):
    lone = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0, None, None)], SCHEMA)
    update(warehouse, lone, KINDS, "day", "y")
    assert warehouse.rules().isEmpty()
    assert warehouse.pending_rules(retry_empty=True) == ["2024-01"]
    assert warehouse.pending_rules(retry_empty=False) == []
    assert backfill_rules(warehouse, KINDS, ["day"], retry_empty=False) == 0


def test_late_rows_can_be_appended(spark, warehouse):
    update(warehouse, rows(spark, 1), KINDS, "day", "y")
    saved = warehouse.save(batched(spark, 1, n=3), late="append")
    assert (saved.inserted, saved.late_rows) == (0, {"2024-01": 3})
    assert warehouse.pending_dq() == ["2024-01"] == warehouse.pending_rules()
    update(warehouse, rows(spark, 1), KINDS, "day", "y")
    assert {r.n_rows for r in warehouse.dq().collect()} == {15}
    assert warehouse.list_batches().count() == 1


def test_unknown_column_stops_the_update(spark, warehouse):
    with pytest.raises(ValueError):
        update(warehouse, rows(spark, 1).withColumn("X", F.lit(1)), KINDS, "day")


def test_constraint_violations(spark):
    ledger = spark.createDataFrame([("1",), ("1",), ("2",)], "batch_id string")
    dq = spark.createDataFrame(
        [
            ("1", "x", 0.0, 1, "numeric"),
            ("2", "x", 0.0, 1, "text"),
            ("3", "x", 0.0, 1, "numeric"),
            ("2", None, 0.0, 1, "numeric"),
        ],
        "batch_id string, feature string, missing_rate double, unique_count bigint, value_type string",
    )
    found = {(r.check, r.key): r.n for r in checks.violations(ledger, dq).collect()}
    assert found == {
        ("ledger batch_id unique", "1"): 1,
        ("dq value_type domain", "2/x"): 1,
        ("dq batch in ledger", "3/x"): 1,
        ("dq not null", "2/NULL"): 1,
    }


def test_stored_tables_keep_the_constraints(spark, warehouse):
    update(warehouse, rows(spark, 1, 2), KINDS, "day", "y")
    assert checks.violations(warehouse.ledger(), warehouse.dq(), warehouse.rules()).isEmpty()


def test_stream_stores_each_month_once(spark, warehouse, tmp_path):
    source = tmp_path / "in"
    rows(spark, 1, 2).coalesce(1).write.parquet(str(source))

    def run(late="drop"):
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        query = ingest_stream(stream, warehouse, "day", str(tmp_path / "checkpoint"), late=late)
        query.awaitTermination()
        return {r[BATCH]: r.n_rows for r in warehouse.ledger().collect()}

    assert run() == {"2024-01": 12, "2024-02": 12}
    rows(spark, 2, 3, n=4).coalesce(1).write.mode("append").parquet(str(source))
    assert run() == {"2024-01": 12, "2024-02": 12, "2024-03": 4}
    rows(spark, 3, n=2).coalesce(1).write.mode("append").parquet(str(source))
    assert run("append") == {"2024-01": 12, "2024-02": 12, "2024-03": 6}


def test_seed_from_csv(spark, warehouse, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("day,x,c,y\n08-AUG-13,1,a,2\n09-AUG-13,NA,b,\n")
    (folder / "b.csv").write_text("day,c\n07-JUL-14,\n,a\n")
    saved = seed(warehouse, str(folder), KINDS, "day")
    assert (saved.inserted, saved.undated_rows) == (2, 1)
    assert warehouse.raw(["2014-07"]).first().x is None


def test_report(spark, warehouse, tmp_path):
    update(warehouse, rows(spark, 1, 2), KINDS, "day", "y")
    target = str(tmp_path / "report")
    names = write_report(warehouse, KINDS, target)
    assert set(names) == {
        "dq_summary",
        "dq_by_batch",
        "dq_by_feature",
        "eda_summary",
        "eda_overview",
        "eda_describe",
        "eda_correlation",
        "eda_histogram",
        "eda_top_values",
    }
    files = list((tmp_path / "report" / "text").glob("part-*"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[:7] == [
        "# Data Quality Report",
        "",
        "## Summary",
        "",
        "- **Batches:** 2",
        "- **Features:** 4",
        "- **Records:** 8",
    ]
    assert "| 2024-01 | 4 | 0.0000 | 8.0 |" in lines
    assert "| c | categorical | 2 | 0.0000 | 0.0000 | 0.0000 | 2.0 | 2 | 2 |" in lines
    assert "- **Rows:** 24" in lines
    assert "| x | numeric | 0.00% | 12 |" in lines
    assert lines.index("| index | x | y |") + 2 == lines.index("| count | 24.0 | 24.0 |")
    assert "| 25% | 2.75 | 1.0 |" in lines
    at = lines.index("### c")
    assert lines[at : at + 6] == ["### c", "", "| value | count |", "|-------|-------|", "| a | 12 |", "| b | 12 |"]
    assert spark.read.parquet(f"{target}/eda_histogram").count() == 60


def test_report_without_records(spark, warehouse):
    lines = [r.line for r in dq_lines(warehouse.dq()).orderBy("ord").collect()]
    assert lines == ["# Data Quality Report", "", "No data quality records in the database."]


def test_files_follow_batches(spark, warehouse, tmp_path):
    """A large batch is split between tasks and a small one is not scattered over files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(60000, numPartitions=8).select(
            F.when(F.col("id") < 50000, "2024-01").otherwise("2024-02").alias(BATCH),
            F.sha2(F.col("id").cast("string"), 256).alias("c"),
        )
        warehouse.save(df, ingest_id="i")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    raw = tmp_path / "warehouse" / "raw" / "ingest_id=i"
    files = {d.name: len(list(d.glob("*.parquet"))) for d in raw.glob("batch_id=*")}
    assert files["batch_id=2024-01"] > 4 > 0 < files["batch_id=2024-02"]
    assert json.dumps({r[BATCH]: r.n_rows for r in warehouse.list_batches().collect()}) == (
        '{"2024-01": 50000, "2024-02": 10000}'
    )


def test_two_streams_and_a_fresh_checkpoint(spark, tmp_path):
    """A stream is not taken for another one, or for an earlier run of itself."""
    schema = "day timestamp, x long"
    for name, month in (("one", 1), ("two", 2)):
        rows = spark.sql(f"SELECT timestamp '2024-0{month}-01' AS day, 1L AS x")
        rows.write.parquet(str(tmp_path / name))
    warehouse = Warehouse(spark, str(tmp_path / "w"))

    def run(name, checkpoint, **options):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / name))
        ingest_stream(stream, warehouse, "day", str(tmp_path / checkpoint), **options).awaitTermination()
        return {r.batch_id: r.n_rows for r in warehouse.list_batches().collect()}

    assert run("one", "c1") == {"2024-01": 1}
    assert run("two", "c2") == {"2024-01": 1, "2024-02": 1}
    assert run("one", "c1", late="append") == {"2024-01": 1, "2024-02": 1}  # nothing new since its checkpoint
    assert run("one", "c3", late="append") == {"2024-01": 2, "2024-02": 1}  # a fresh checkpoint reads all again


def test_an_empty_batch_is_stored_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    none = spark.createDataFrame([], "x long")
    assert warehouse.save_batch("2024-01", none)
    assert [(r.batch_id, r.n_rows) for r in warehouse.list_batches().collect()] == [("2024-01", 0)]
    assert not warehouse.save_batch("2024-01", none)
    assert not warehouse.save_batch("2024-01", spark.range(2).withColumnRenamed("id", "x"))
    assert warehouse.load_batch("2024-01").collect() == []


def test_raw_rows_of_differing_types(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.save_batch("2024-01", spark.sql("SELECT 1 AS x, 'a' AS y, 5L AS z"))
    warehouse.save_batch("2024-02", spark.sql("SELECT 2.5D AS x, 7 AS y"))
    df = warehouse.raw()
    assert dict(df.dtypes) == {"batch_id": "string", "x": "double", "y": "string", "z": "bigint"}
    assert {tuple(r) for r in df.collect()} == {("2024-01", 1.0, "a", 5), ("2024-02", 2.5, "7", None)}
    assert warehouse.load_batch("2024-02").select("x").first()[0] == 2.5


def test_update_leaves_no_staged_table(spark, tmp_path):
    rows = [(f"2024-0{1 + k % 2}-03", float(k), "ab"[k % 3 == 0]) for k in range(60)] + [("soon", 1.0, "a")]
    df = spark.createDataFrame(rows, "day string, x double, y string")
    warehouse = Warehouse(spark, str(tmp_path / "w"))

    def staged():
        folder = scratch_dir(spark)
        return sorted(os.listdir(folder)) if os.path.isdir(folder) else []

    before = staged()
    kinds = {"day": CATEGORICAL, "x": NUMERIC, "y": CATEGORICAL}
    with pytest.raises(Exception, match="unparseable time value"):
        update(warehouse, df, kinds, "day", min_rules=1)
    found = update(warehouse, df, kinds, "day", min_rules=1, on_bad="null")
    assert (found.saved.inserted, found.saved.undated_rows, found.profiled, found.mined) == (2, 1, 2, 2)
    write_report(warehouse, kinds, str(tmp_path / "report"))
    assert staged() == before
    assert warehouse.rules().count() > 0
