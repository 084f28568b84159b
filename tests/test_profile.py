import math

import pytest

from batchlens.functions.jsons import stats_to_json
from batchlens.kinds import CATEGORICAL, INSURANCE_KINDS, NUMERIC, kind_of, resolve
from batchlens.operators import eda, trends
from batchlens.operators.batching import BATCH
from batchlens.operators.cleaning import THRESHOLDS, clean_batch, clean_long, verdicts
from batchlens.operators.profile import profile

NAN = float("nan")


def numbers(spark, values, batch="2024-01"):
    return spark.createDataFrame([(batch, v) for v in values], "batch_id string, x double")


def texts(spark, values):
    return spark.createDataFrame([("2024-01", v) for v in values], "batch_id string, x string")


def record(df, kind):
    return profile(df, {"x": kind}).first()


def test_nan_counts_as_missing(spark):
    r = record(numbers(spark, [1.0, NAN, None, 3.0]), NUMERIC)
    assert (r.missing_rate, r.unique_count, r.n_rows) == (0.5, 2, 4)
    assert (r.stats.min, r.stats.max, r.stats.mean) == (1, 3, 2)
    assert r.stats.std == pytest.approx(1.414214, abs=1e-6)


def test_spread_of_one_value(spark):
    df = numbers(spark, [7.0, None])
    r = record(df, NUMERIC)
    assert (r.missing_rate, r.unique_count, r.stats.std) == (0.5, 1, 0.0)
    assert eda.describe(df, {"x": NUMERIC}).first()["std"] is None


def test_all_missing(spark):
    r = record(numbers(spark, [None, NAN]), NUMERIC)
    assert (r.missing_rate, r.unique_count, r.stats) == (1, 0, None)


def test_all_missing_text(spark):
    r = record(texts(spark, [None, None]), CATEGORICAL)
    assert (r.missing_rate, r.unique_count, r.top) == (1, 0, None)


def test_zero_and_minus_zero_are_one_value(spark):
    assert record(numbers(spark, [0.0, -0.0]), NUMERIC).unique_count == 1


def test_top_values_ties_and_missing(spark):
    values = [f"v{i:02d}" for i in range(1, 12)] + ["v12", "v12"] + [None] * 3
    top = [(t.value, t.cnt) for t in record(texts(spark, values), CATEGORICAL).top]
    assert top == [("v12", 2)] + [(f"v{i:02d}", 1) for i in range(1, 10)]


def test_unknown_column(spark):
    df = numbers(spark, [1.0])
    with pytest.raises(ValueError):
        profile(df, {})
    assert profile(df, {}, unknown=NUMERIC).first().value_type == NUMERIC
    assert [r.feature for r in eda.overview(df.withColumn("y", df.x), {"x": NUMERIC}).collect()] == ["x"]


def test_kind_registry():
    assert list(INSURANCE_KINDS.values()).count(NUMERIC) == 8 == list(INSURANCE_KINDS.values()).count(CATEGORICAL)
    assert kind_of("MAKE", INSURANCE_KINDS) == CATEGORICAL
    with pytest.raises(ValueError):
        kind_of("X", INSURANCE_KINDS)
    assert resolve(["MAKE", "X"], INSURANCE_KINDS, "skip") == {"MAKE": CATEGORICAL}


def test_stats_as_json(spark):
    number = profile(numbers(spark, [1.0, 3.0]), {"x": NUMERIC})
    text = profile(texts(spark, ["a", "a", "b"]), {"x": CATEGORICAL})
    empty = profile(numbers(spark, [None]), {"x": NUMERIC})
    shown = [
        df.select(stats_to_json(df.stats, df.top)).first()[0] for df in (number, text, empty)
    ]
    assert shown[0].startswith('{"min":1.0,"max":3.0,"mean":2.0,"std":1.414213')
    assert shown[1:] == ['{"a":2,"b":1}', None]


def test_trends_are_unweighted_over_batches(spark):
    df = numbers(spark, [1.0, None], "2024-01").union(numbers(spark, [1.0] * 8, "2024-02"))
    dq = profile(df, {"x": NUMERIC})
    feature = trends.by_feature(dq).first()
    assert (feature.n_batches, feature.avg_missing_rate, feature.max_missing_rate) == (2, 0.25, 0.5)
    total = trends.summary(dq).first()
    assert (total.batches, total.features, total.records) == (2, 1, 2)


def test_cleaning_boundaries(spark):
    rows = [
        ("a", 0.50, 10),
        ("b", 0.51, 50),
        ("c", 0.0, 9),
        ("d", 0.0, 91),
        ("e", 0.0, 90),
    ]
    dq = spark.createDataFrame(
        [("2024-01", f, m, u, 100) for f, m, u in rows],
        "batch_id string, feature string, missing_rate double, unique_count bigint, n_rows bigint",
    )
    found = verdicts(dq, **THRESHOLDS)
    assert {r.feature: r.verdict for r in found.collect()} == {
        "a": "keep",
        "b": "drop_missing",
        "c": "drop_low_unique",
        "d": "drop_high_unique",
        "e": "keep",
    }
    loose = verdicts(dq, max_missing_rate=1.0, min_unique_ratio=None, max_unique_ratio=None)
    assert {r.verdict for r in loose.collect()} == {"keep"}
    # A column without a record stays.
    table = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], "a int, b int, c int, d int, e int, other int")
    assert clean_batch(table, found).columns == ["a", "e", "other"]


def test_cleaning_of_many_batches(spark):
    df = spark.createDataFrame(
        [("1", 1.0, None), ("1", 2.0, "u"), ("2", None, "v"), ("2", None, "w")],
        "batch_id string, x double, y string",
    )
    kinds = {"x": NUMERIC, "y": CATEGORICAL}
    bad = verdicts(profile(df, kinds), max_missing_rate=0.4, min_unique_ratio=None, max_unique_ratio=None)
    kept = clean_long(df, kinds, bad).groupBy(BATCH, "feature").count().collect()
    assert {(r[0], r[1]): r[2] for r in kept} == {("1", "x"): 2, ("2", "y"): 2}


def test_record_count_and_missing_invariants(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    from batchlens.operators.batching import split_batches

    kinds = {"o_totalprice": NUMERIC, "o_orderstatus": CATEGORICAL}
    monthly = split_batches(df, "o_orderdate").select(BATCH, *kinds)
    dq = profile(monthly, kinds)
    total = trends.summary(dq).first()
    assert total.records == total.batches * total.features
    n = {r.batch_id: r.n_rows for r in dq.collect()}
    assert sum(n.values()) == df.count()
    for r in dq.filter("feature = 'o_orderstatus'").collect():
        assert sum(t.cnt for t in r.top) == n[r.batch_id]
        assert math.isclose(r.missing_rate, 0.0)
