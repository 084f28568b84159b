"""Co-moments of many columns, and exploratory tables from kept states."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators import eda, states
from batchlens.operators.batching import BATCH
from batchlens.operators.comoments import comoments, merged
from batchlens.plans.report import write_report
from batchlens.plans.update import backfill_states
from batchlens.sources.warehouse import Warehouse

KINDS = {"x": NUMERIC, "y": NUMERIC, "never": NUMERIC, "c": CATEGORICAL, "long": CATEGORICAL}
SCHEMA = "x double, y double, never double, c string, long string, batch_id string"


def rows(spark, months, n=40, seed=1):
    r = random.Random(seed)
    some = lambda v: None if r.random() < 0.2 else v
    data = [
        (some(r.choice([1.0, 2.5, 4.0, 1e6])), some(r.gauss(5e9, 3.0)), None, some(r.choice("abc")), "z" * r.choice([3, 256, 300]), m)
        for m in months
        for _ in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def table(df, digits=9):
    def cell(v):
        return round(v, digits) if isinstance(v, float) else v

    return sorted((tuple(cell(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_correlation_of_a_hundred_columns(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 5))
    wide = base @ rng.normal(size=(5, 100)) + 0.3 * rng.normal(size=(300, 100)) + 1e8
    wide[rng.random(wide.shape) < 0.1] = np.nan
    wide[:, 7] = 0.1
    names = [f"c{i}" for i in range(100)]
    frame = pd.DataFrame(wide, columns=names)
    df = spark.createDataFrame(frame).repartition(5)
    found = eda.correlation(df, dict.fromkeys(names, NUMERIC)).toPandas().pivot(index="x", columns="y", values="corr")
    wanted = frame.corr()
    wanted.loc["c7"] = wanted["c7"] = np.nan
    assert np.allclose(found.loc[names, names].to_numpy(float), wanted.to_numpy(), atol=1e-6, equal_nan=True)


def test_comoments_per_group(spark):
    df = rows(spark, ["2024-01", "2024-02"])
    found = {(r[BATCH], r.x, r.y): r for r in merged(comoments(df, ["x", "y", "never"], (BATCH,)), (BATCH,)).collect()}
    assert {k[1:] for k in found} == {("x", "x"), ("x", "y"), ("y", "y")}
    for (month, a, b), r in found.items():
        both = df.filter((F.col(BATCH) == month) & F.col(a).isNotNull() & F.col(b).isNotNull()).toPandas()
        assert r.n == len(both)
        centred = both[[a, b]].to_numpy() - both[[a, b]].to_numpy().mean(axis=0)
        assert r.m_xy == pytest.approx((centred[:, 0] * centred[:, 1]).sum(), rel=1e-6, abs=1e-6)
        assert r.m_xx == pytest.approx((centred[:, 0] ** 2).sum(), rel=1e-6)


def test_comoments_of_no_rows(spark):
    df = rows(spark, ["2024-01"]).limit(0)
    assert comoments(df, ["x", "y"]).isEmpty()
    assert {r["corr"] for r in eda.correlation(df, KINDS).collect()} == {None}


def made(warehouse, kinds, n_rows):
    return states.tables(*warehouse.states(), kinds, n_rows)


def test_tables_from_states_equal_those_from_rows(spark, warehouse):
    df = rows(spark, ["2024-01", "2024-02", "2024-03"])
    warehouse.save(df)
    assert backfill_states(warehouse, KINDS) == 3 and backfill_states(warehouse, KINDS) == 0
    found = made(warehouse, KINDS, df.count())
    wanted = {
        "eda_summary": eda.summary(df, KINDS),
        "eda_overview": eda.overview(df, KINDS),
        "eda_describe": eda.describe(df, KINDS),
        "eda_correlation": eda.correlation(df, KINDS),
        "eda_histogram": eda.histogram(df, KINDS),
        "eda_top_values": eda.top_values(df, KINDS),
    }
    assert set(found) == set(wanted)
    for name, whole in wanted.items():
        assert table(found[name], 6) == table(whole, 6), name


def test_rows_of_counted_batches_are_not_opened(spark, warehouse, tmp_path, monkeypatch):
    warehouse.save(rows(spark, ["2024-01", "2024-02"]))
    path = str(tmp_path / "report")
    write_report(warehouse, KINDS, path)
    for name, part in made(warehouse, KINDS, 80).items():
        assert "/raw" not in part._jdf.queryExecution().executedPlan().toString(), name
    opened = []
    real = Warehouse.raw
    monkeypatch.setattr(Warehouse, "raw", lambda self, ids=None: opened.append(ids) or real(self, ids))
    write_report(warehouse, KINDS, path)
    assert opened == [None]
    # Late rows make their batch due again, and only that one.
    warehouse.save(rows(spark, ["2024-02"], n=3, seed=9), late="append")
    write_report(warehouse, KINDS, path)
    assert opened[-1] == ["2024-02"]
    summary = spark.read.parquet(f"{path}/eda_summary").first()
    assert (summary.n_rows, summary.n_columns) == (83, 5)
    assert warehouse.pending_states({**KINDS, "x": CATEGORICAL}) == ["2024-01", "2024-02"]


def test_states_of_columns_that_come_later(spark, warehouse):
    warehouse.save(rows(spark, ["2024-01"]).drop("y"))
    first = {c: k for c, k in KINDS.items() if c != "y"}
    assert backfill_states(warehouse, first) == 1
    warehouse.save(rows(spark, ["2024-02"], seed=4))
    assert backfill_states(warehouse, KINDS) == 1
    df = warehouse.raw()
    found = made(warehouse, KINDS, 80)
    assert table(found["eda_overview"]) == table(eda.overview(df, KINDS).drop("ord").join(found["eda_overview"].select("ord", "feature"), "feature"))
    assert table(found["eda_describe"].drop("ord"), 6) == table(eda.describe(df, KINDS).drop("ord"), 6)
    assert found["eda_correlation"].filter("x = 'x' and y = 'y'").first()["corr"] is not None


def test_stored_time_is_a_category(spark, warehouse):
    day = spark.createDataFrame([(dt.datetime(2024, 1, 3), 1.0), (None, 2.0)], "day timestamp, x double")
    warehouse.save(day.withColumn(BATCH, F.lit("2024-01")))
    kinds = {"day": CATEGORICAL, "x": NUMERIC}
    backfill_states(warehouse, kinds)
    top = made(warehouse, kinds, 2)["eda_top_values"].first()
    assert (top.value, top.cnt) == ("2024-01-03 00:00:00", 1)
