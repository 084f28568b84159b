"""What the plans look like: columns read, shuffles shared, joins and partitions chosen."""

import re

import pytest
from pyspark.sql import functions as F

from batchlens.catalog.subjects import SHIPMENT_KINDS, shipments
from batchlens.operators.items import coded_baskets, item_book, item_columns
from batchlens.operators.profile import profile
from batchlens.session import clear_scratch, scratch_dir, stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def profile_plan(spark):
    df = profile(shipments(spark, SF_DIR), SHIPMENT_KINDS)
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_lanes_read_their_columns(profile_plan):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", profile_plan)
    columns = {frozenset(c.split("#")[0] for c in scan.split(",")) for scan in scans}
    numbers = {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"}
    texts = {"l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate"}
    assert columns == {frozenset(numbers), frozenset(texts)}


def test_text_counts_are_shuffled_once(profile_plan):
    assert "ReusedExchange" in profile_plan


def test_top_values_are_cut_before_their_shuffle(profile_plan):
    assert re.search(r"WindowGroupLimit .* Partial", profile_plan)


def test_baskets_are_collapsed_before_their_shuffle(spark):
    df = shipments(spark, SF_DIR)
    book = item_book(df, item_columns(df, SHIPMENT_KINDS), 0.05)
    plan = plan_of(coded_baskets(df, book, 0.05))
    assert "BroadcastHashJoin" in plan and "partial_count" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_large_side_tables_are_not_broadcast(spark):
    """A staged table beyond the threshold is shuffled: no join is forced to broadcast."""
    df = shipments(spark, SF_DIR)
    book = item_book(df, item_columns(df, SHIPMENT_KINDS), 0.05)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        baskets = coded_baskets(df, book, 0.05)
        assert "SortMergeJoin" in plan_of(baskets)
        assert baskets.agg(F.sum("w")).first()[0] == df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_scratch_follows_the_checkpoint_dir(spark):
    folder = scratch_dir(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = stage(spark.range(3), "kept")
    assert kept.count() == 3 and folder in kept.inputFiles()[0]
    other = spark.newSession()
    assert scratch_dir(other) == folder


def test_scratch_can_be_cleared(spark, monkeypatch, tmp_path):
    from batchlens import session

    monkeypatch.setattr(session, "scratch_dir", lambda s: str(tmp_path / "scratch"))
    stage(spark.range(3), "gone")
    assert (tmp_path / "scratch").exists()
    clear_scratch(spark)
    assert not (tmp_path / "scratch").exists()
