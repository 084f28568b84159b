import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators import eda
from batchlens.operators.quantiles import quantiles


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 1.0, 1.0), (None, 4.0, 1.0), (5.0, 9.0, 1.0)]
    return spark.createDataFrame(rows, "a double, b double, k double")


KINDS = {"a": NUMERIC, "b": NUMERIC, "k": NUMERIC}


def test_correlation_pairwise_and_constant(small):
    found = {(r.x, r.y): r["corr"] for r in eda.correlation(small, KINDS).collect()}
    assert len(found) == 9
    assert found["a", "b"] == found["b", "a"] == pytest.approx(0.802955, abs=1e-6)
    assert found["a", "a"] == 1.0
    assert [v for key, v in found.items() if "k" in key] == [None] * 5


def test_correlation_needs_two_columns(small):
    assert eda.correlation(small, {"a": NUMERIC}).isEmpty()


@pytest.mark.parametrize("limit", [10**6, 0])
def test_describe(small, limit):
    r = eda.describe(small, {"a": NUMERIC}, small_table=limit).first()
    assert [r[s] for s in eda.DESCRIBE] == [4, 2.75, 1.7078, 1.0, 1.75, 2.5, 3.5, 5.0]


@pytest.mark.parametrize("values", [[5.0, 5.0, 5.0], [0.0, 1.0, 2.0, 3.0]])
def test_histogram_of_three_bins(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = eda.histogram(df, {"x": NUMERIC}, bins=3).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=3)
    assert [r.cnt for r in rows] == list(counts)
    assert [r.lo for r in rows] + [rows[-1].hi] == pytest.approx(list(edges))


def test_histogram_ignores_missing_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, None)], "e double, x double")
    rows = eda.histogram(df, {"e": NUMERIC, "x": NUMERIC}, bins=3).orderBy("feature", "bin").collect()
    assert [(r.feature, r.cnt) for r in rows] == [("e", 0)] * 3 + [("x", 0), ("x", 1), ("x", 0)]
    assert (rows[0].lo, rows[2].hi) == (0.0, 1.0)


def test_histogram_on_edges_like_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.uniform(0, 1, 4000), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = eda.histogram(df, {"x": NUMERIC}).orderBy("bin").collect()
    assert [r.cnt for r in rows] == list(np.histogram(values, bins=30)[0])


def test_histogram_takes_first_columns(small):
    found = eda.histogram(small, KINDS, max_columns=2)
    assert {r.feature for r in found.collect()} == {"a", "b"}


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("hot", [3.25, 0.01])
def test_quantiles_with_a_hot_value(spark, limit, hot):
    rng = np.random.default_rng(7)
    values = np.where(rng.random(9000) < 0.4, hot, np.round(rng.normal(size=9000), 4))
    groups = np.where(rng.random(9000) < 0.9, "big", "small")
    rows = [(str(g), float(v)) for g, v in zip(groups, values)]
    df = spark.createDataFrame(rows, "batch_id string, x double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = {(r.batch_id, r.p): r.value for r in quantiles(df, ["x"], probs, small_table=limit).collect()}
    assert len(found) == 14
    for (g, p), value in found.items():
        assert value == pytest.approx(np.quantile(values[groups == g], p), abs=1e-12)


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
AWKWARD += [-1.7976931348623157e308, float("inf"), float("-inf"), 1.0, -1.0, 8.0, 7.999999999999999, 8.000000000000002]


def test_images_are_in_the_order_of_the_doubles(spark):
    from batchlens.operators.selection import with_image

    rng = np.random.default_rng(11)
    bits = rng.integers(-(2**63), 2**63 - 1, 3000, dtype=np.int64).view(np.float64)
    powers = [s * 2.0**e for e in range(-1074, 1024) for s in (1, -1)]
    near = list(np.nextafter(powers, np.inf)) + list(np.nextafter(powers, -np.inf))
    values = [float(x) for x in [*bits[~np.isnan(bits)], *powers, *near, *AWKWARD, *rng.normal(size=2000)]]
    rows = with_image(spark.createDataFrame([(x,) for x in values], "x double")).collect()
    assert len(rows) == len(values)
    for x, i in rows:
        magnitude = int(np.float64(abs(x)).view(np.int64))
        assert i == (-magnitude if x < 0 else magnitude), x
    assert with_image(spark.createDataFrame([(None,)], "x double")).first()["image"] is None


def test_quantiles_of_awkward_values(spark):
    close = [1.0 + k * 2.0**-52 for k in range(400)]
    groups = {"close": close, "one": [3.5], "same": [-2.0] * 50, "mixed": AWKWARD[:8] + AWKWARD[10:] + [None]}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "batch_id string, x double")
    probs = (0.0, 0.3, 0.5, 1.0)
    found = {(r.batch_id, r.p): r.value for r in quantiles(df, ["x"], probs, small_table=0).collect()}
    assert len(found) == 4 * len(groups)
    for (g, p), value in found.items():
        xs = sorted(x for x in groups[g] if x is not None)
        pos = (len(xs) - 1) * p
        lo, hi = int(np.floor(pos)), int(np.ceil(pos))
        assert value == (xs[lo] if lo == hi else (hi - pos) * xs[lo] + (pos - lo) * xs[hi])
    assert quantiles(df.limit(0), ["x"], probs, small_table=0).collect() == []
    assert quantiles(df.filter("x is null"), ["x"], probs, small_table=0).collect() == []


def test_counted_values_weigh_as_often(spark):
    from batchlens.operators.quantiles import quantiles_of_counts

    rows = [("f", 1.0, 3), ("f", 2.0, 4), ("f", 9.0, 2), ("f", 2.0, 1), ("g", 7.0, 10**12)]
    counts = spark.createDataFrame(rows, "feature string, value double, cnt long")
    found = {(r.feature, r.p): r.value for r in quantiles_of_counts(counts, (0.25, 0.5, 0.75), ()).collect()}
    xs = [1.0] * 3 + [2.0] * 5 + [9.0] * 2
    assert found == {("f", p): np.quantile(xs, p) for p in (0.25, 0.5, 0.75)} | {("g", p): 7.0 for p in (0.25, 0.5, 0.75)}


def test_few_rows_are_shuffled_for_a_quantile(spark):
    """Partial counts per cell are shuffled, not values: 100,000 different ones fall into few cells."""
    from batchlens.operators.selection import _counted, _first_cells

    df = spark.range(100000).select(F.lit("f").alias("feature"), (F.rand(3) + 1).alias("x"), F.lit(1).alias("cnt"))
    assert _counted(_first_cells(df), ["feature"]).count() <= 257


def test_top_values_and_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 1.0)], "c string, x double")
    kinds = {"c": CATEGORICAL, "x": NUMERIC}
    assert [(r.value, r.cnt) for r in eda.top_values(df, kinds, 1).collect()] == [("a", 2)]
    assert tuple(eda.summary(df.withColumn("other", df.x), kinds).first()) == (4, 2)
    assert {r.feature: r.missing_pct for r in eda.overview(df, kinds).collect()} == {"c": 25.0, "x": 25.0}
