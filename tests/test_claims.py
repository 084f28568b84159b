"""Writers that meet, sources read once, batches that break a rule, months closed by event time."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from batchlens.operators.batching import BATCH, assign_batches
from batchlens.operators.checks import Guard
from batchlens.session import OPEN_FILES
from batchlens.sources import warehouse as warehouses
from batchlens.sources.claims import names_in, publish, read_file
from batchlens.sources.warehouse import Saved, Warehouse
from batchlens.streaming.closing import collect_arrivals, late_arrivals, store_closed_months, store_months

SCHEMA = "k long, day timestamp, x double"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def batched(spark, *months, n=6):
    rows = [(i, dt.datetime(2024, m, 1 + i), float(i)) for m in months for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).withColumn(BATCH, F.date_format("day", "yyyy-MM"))


def ledger(warehouse):
    return [(r[BATCH], r.n_rows) for r in warehouse.list_batches().collect()]


def test_one_of_many_publishes(spark, tmp_path):
    path = str(tmp_path / "claims" / "2024-01")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: (publish(spark, path, f"writer {i} é"), i), range(8)))
    winners = [i for ok, i in won if ok]
    assert len(winners) == 1
    assert read_file(spark, path) == f"writer {winners[0]} é"
    assert names_in(spark, str(tmp_path / "claims")) == ["2024-01"]
    assert names_in(spark, str(tmp_path / "nothing")) == []


def test_two_writers_store_a_month_once(spark, warehouse):
    with ThreadPoolExecutor(2) as pool:
        saved = list(pool.map(lambda n: warehouse.save(batched(spark, 1, 2, n=n)), (5, 9)))
    assert sum(s.inserted for s in saved) == 2
    found = dict(ledger(warehouse))
    assert set(found) == {"2024-01", "2024-02"} and set(found.values()) <= {5, 9}
    stored = {r[BATCH]: r["count"] for r in warehouse.raw().groupBy(BATCH).count().collect()}
    assert stored == found
    lost = sum(sum(s.late_rows.values()) for s in saved)
    assert lost + sum(found.values()) == 2 * (5 + 9)


def test_claim_of_a_dead_ingest_is_completed(spark, warehouse, monkeypatch):
    def die(self, own, others):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "_commit", die)
        with pytest.raises(RuntimeError):
            warehouse.save(batched(spark, 1, n=4), ingest_id="dying")
    assert ledger(warehouse) == []
    # Another ingest finds the claim and commits the rows it names.
    assert warehouse.save(batched(spark, 1, 2, n=6)) == Saved(1, {"2024-01": 6})
    assert ledger(warehouse) == [("2024-01", 4), ("2024-02", 6)]
    assert warehouse.load_batch("2024-01").count() == 4


def test_replay_of_a_dead_ingest_stores_the_rest(spark, warehouse, monkeypatch):
    real = warehouses.publish

    def once(spark, path, text):
        if path.endswith("2024-02"):
            raise RuntimeError("lost")
        return real(spark, path, text)

    with monkeypatch.context() as broken:
        broken.setattr(warehouses, "publish", once)
        with pytest.raises(RuntimeError):
            warehouse.save(batched(spark, 1, 2), ingest_id="epoch-0")
    assert warehouse.save(batched(spark, 1, 2), ingest_id="epoch-0") == Saved(2)
    assert ledger(warehouse) == [("2024-01", 6), ("2024-02", 6)]
    assert warehouse.raw().count() == 12
    assert warehouse.save(batched(spark, 1, 2), ingest_id="epoch-0") == Saved(0)


def test_source_is_read_once(spark, warehouse):
    warehouse.save(batched(spark, 1))
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    undated = spark.createDataFrame([(9, None, 1.0, None)], f"{SCHEMA}, {BATCH} string")
    source = batched(spark, 1, 2, 3).union(undated)
    saved = warehouse.save(source.mapInArrow(counting, source.schema))
    assert saved == Saved(2, {"2024-01": 6}, 1)
    assert read.value == 19
    # What is not stored leaves no files behind.
    names = {p.name for p in __import__("pathlib").Path(warehouse.root, "raw").glob("*/*") if p.name.startswith("batch_id")}
    assert names == {"batch_id=2024-01", "batch_id=2024-02", "batch_id=2024-03"}


def test_unwanted_rows_share_one_folder_of_a_write(spark, warehouse, monkeypatch):
    """However many batches they are of, a task holds one writer for them and need not sort them."""

    def days(first, last, n):
        rows = spark.range(first * n, last * n).withColumn("x", F.col("id") * 0.5)
        return rows.withColumn(BATCH, F.concat(F.lit("day "), (F.col("id") / n).cast("int").cast("string")))

    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == OPEN_FILES
    many = OPEN_FILES + 8
    assert warehouse.save(days(0, many, 3)) == Saved(many)
    written = []
    drop = Warehouse._drop_folders

    def look(self, folder, kept, arrived):
        written.extend(p.name for p in Path(self._ingest(folder)).iterdir() if p.name.startswith(BATCH))
        drop(self, folder, kept, arrived)

    monkeypatch.setattr(Warehouse, "_drop_folders", look)
    undated = spark.createDataFrame([(9, 1.0, None)] * 4, f"id long, x double, {BATCH} string")
    saved = warehouse.save(days(0, many + 2, 5).union(undated))
    assert saved == Saved(2, {f"day {i}": 5 for i in range(many)}, 4)
    assert set(written) == {f"batch_id=day {many}", f"batch_id=day {many + 1}", "batch_id=__HIVE_DEFAULT_PARTITION__"}
    assert warehouse.raw().columns == [BATCH, "id", "x"]
    counts = {r[BATCH]: r["count"] for r in warehouse.raw().groupBy(BATCH).count().collect()}
    assert counts == {f"day {i}": 3 if i < many else 5 for i in range(many + 2)}


def test_guard_refuses_whole_batches(spark, warehouse):
    known = spark.createDataFrame([(i,) for i in range(6)], "k long")
    guard = Guard(
        rows={"x small": F.col("x") >= 100},
        unique={"one row a key": ["k"]},
        references={"key known": ("k", known)},
    )
    df = batched(spark, 1, 2, 3, 4)
    bad_x = df.withColumn("x", F.when((F.col(BATCH) == "2024-01") & (F.col("k") < 2), 100.0).otherwise(F.col("x")))
    twice = bad_x.union(bad_x.filter("batch_id = '2024-02' and k = 3"))
    lost = twice.withColumn("k", F.when((F.col(BATCH) == "2024-03") & (F.col("k") == 5), 77).otherwise(F.col("k")))
    saved = warehouse.save(lost, guard=guard)
    assert saved.refused == {"2024-01": {"x small": 2}, "2024-02": {"one row a key": 1}, "2024-03": {"key known": 1}}
    assert saved.inserted == 1 and ledger(warehouse) == [("2024-04", 6)]
    assert {r[BATCH] for r in warehouse.raw().collect()} == {"2024-04"}
    assert warehouse.raw().columns == [BATCH, "k", "day", "x"]
    listed = {(r[BATCH], r["check"], r["n"]) for r in warehouse.refused().collect()}
    assert listed == {("2024-01", "x small", 2), ("2024-02", "one row a key", 1), ("2024-03", "key known", 1)}
    # A corrected batch may come again.
    assert warehouse.save(df, guard=guard) == Saved(3, {"2024-04": 6})


def test_guard_looks_at_missing_values_and_stored_batches(spark, warehouse):
    guard = Guard(rows={"x there": F.col("x").isNull()}, unique={"key": ["k"]}, references={"known": ("k", batched(spark, 1))})
    warehouse.save(batched(spark, 1))
    nulls = batched(spark, 1, 2).withColumn("k", F.lit(None).cast("long"))
    assert warehouse.save(nulls, guard=guard) == Saved(1, {"2024-01": 6})
    gone = batched(spark, 1, 3).withColumn("x", F.lit(None).cast("double"))
    assert warehouse.save(gone, guard=guard).refused == {"2024-03": {"x there": 6}}
    assert Guard().rows == {} and warehouse.save(batched(spark, 4), guard=Guard()).inserted == 1


def test_month_over_three_micro_batches_is_stored_whole(spark, warehouse, tmp_path):
    landing = str(tmp_path / "landing")
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(75)]
    df = spark.createDataFrame(rows, SCHEMA)
    schema = assign_batches(df, "day").schema
    for lo, hi in ((0, 10), (10, 20), (20, 75)):
        df.filter((F.col("k") >= lo) & (F.col("k") < hi)).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(landing)

    def run(stream):
        collect_arrivals(stream, warehouse, "day", str(tmp_path / "one")).awaitTermination()
        store_closed_months(warehouse, schema, "day", str(tmp_path / "two"), delay="3 days").awaitTermination()

    run(stream)
    # 2024-03-15 is the last day: January and February are over, March is not.
    assert ledger(warehouse) == [("2024-01", 31), ("2024-02", 29)]
    assert late_arrivals(warehouse, schema).isEmpty()
    days = [dt.datetime(2024, 1, 5), dt.datetime(2024, 4, 10), dt.datetime(2024, 4, 20)]
    late = spark.createDataFrame([(100 + i, day, 1.0) for i, day in enumerate(days)], SCHEMA)
    late.coalesce(1).write.mode("append").parquet(landing)
    run(stream)
    assert ledger(warehouse) == [("2024-01", 31), ("2024-02", 29), ("2024-03", 15)]
    assert [(r[BATCH], r.n_rows, r.late_rows) for r in late_arrivals(warehouse, schema).collect()] == [("2024-01", 31, 1)]
    assert store_months(warehouse, schema, None).inserted == 1
    assert ledger(warehouse)[-1] == ("2024-04", 2)
