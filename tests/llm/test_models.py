"""Classifiers by held-out accuracy, exact top-k by SQL and brute force, and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import SF_DIR
from oracle import compare, connect
from pyspark.sql import functions as F
from test_dedup import shingle_set

import corpus_pipeline
from batchlens.llm import quality, topk, toxicity
from batchlens.llm.queries import ORACLES, QUERIES

LARGER = "/root/testdata/sf0.1"


def held_out_accuracy(spark, name, label):
    found = QUERIES[name](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id")
    rows = found.filter("held_out").select("predicted", label).toPandas()
    ones = rows[label] == 1
    return (rows["predicted"] == rows[label]).mean(), rows["predicted"][ones].mean(), rows["predicted"][~ones].mean()


def test_quality_held_out(spark):
    accuracy, kept, junk_kept = held_out_accuracy(spark, "op5_quality", "quality")
    assert accuracy > 0.98 and kept > 0.99 and junk_kept < 0.1


def test_toxicity_held_out(spark):
    accuracy, caught, wrong = held_out_accuracy(spark, "op10_toxicity", "toxic")
    assert accuracy > 0.96 and caught > 0.7 and wrong < 0.01


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_scores_of_odd_rows(spark, odd_rows, odd_docs, no_docs):
    labels = labels_of(spark, [(4, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1), (12, 1, 0), (999, 0, 0)])
    never = F.lit(False)
    for docs, count in ((odd_docs, len(odd_rows)), (no_docs, 0)):
        scored = quality.quality(docs, labels, never).collect()
        assert len(scored) == count and all(0 <= r["score"] <= 1 for r in scored)
        machine = toxicity.train(docs, labels, never)
        scored = toxicity.score(docs, machine).collect()
        assert len(scored) == count and all(0 <= r["score"] <= 1 for r in scored)
        clean = toxicity.clean(docs, machine)
        assert clean.schema == docs.schema
        assert clean.count() == sum(r["score"] < toxicity.THRESHOLD for r in scored)
    nothing = labels.limit(0)
    assert {r["score"] for r in quality.quality(odd_docs, nothing, never).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(odd_docs, toxicity.train(odd_docs, nothing, never)).collect()} == {0.5}


def test_machine_learns_a_pair():
    """Toxic only where both words stand together: no additive weights tell these apart."""
    r = random.Random(1)
    rows, y = [], []
    for k in range(1600):
        insult, group = k % 2, k // 2 % 2
        text = " ".join([*(f"f{r.randrange(5000)}" for _ in range(10)), *["insult"] * insult, *["group"] * group])
        rows.append(toxicity.terms(text))
        y.append(float(insult and group))
    machine = toxicity.fit(rows, np.array(y))
    both, one, other = (machine.score(toxicity.terms(t)) for t in ("insult group", "insult", "group"))
    assert both > 0.7 > 0.3 > max(one, other)
    at = np.searchsorted(machine.terms, toxicity.terms("insult group"))
    assert machine.vectors[at[0]] @ machine.vectors[at[1]] > 0.1


def test_machine_learns_words_that_matter_only_in_pairs():
    """Toxic where one of two words stands alone: neither has an effect of its own, so only their pair tells."""
    r = random.Random(2)
    rows, y = [], []
    for k in range(2400):
        one, other = k % 2, k // 2 % 2
        text = " ".join([*(f"f{r.randrange(3000)}" for _ in range(10)), *["one"] * one, *["other"] * other])
        rows.append(toxicity.terms(text))
        y.append(float(one != other))
    machine = toxicity.fit(rows, np.array(y))
    assert set(machine.terms) == set(toxicity.terms("one other"))
    both, one, other, none = (machine.score(toxicity.terms(t)) for t in ("one other", "one", "other", ""))
    assert min(one, other) > toxicity.THRESHOLD > 0.5 > max(both, none)


def test_score_is_the_double_sum():
    r = np.random.default_rng(4)
    known = np.unique(r.integers(0, 2**30, 50)).astype(np.int32)
    machine = toxicity.Machine(known, -0.3, r.normal(size=len(known)), r.normal(0, 0.5, (len(known), 4)))
    for size in (0, 1, 2, 9):
        found = np.sort(r.choice(known, size, replace=False))
        at = [int(np.flatnonzero(known == t)[0]) for t in found]
        margin = -0.3 + sum(machine.weights[i] for i in at)
        margin += sum(machine.vectors[i] @ machine.vectors[j] for k, i in enumerate(at) for j in at[:k])
        strange = np.setdiff1d(r.integers(0, 2**30, 5).astype(np.int32), known)
        score = machine.score(np.union1d(found, strange).astype(np.int32))
        assert np.isclose(score, 1 / (1 + np.exp(-margin)))


def test_fit_does_not_depend_on_row_order():
    r = random.Random(3)
    rows = [toxicity.terms(" ".join(["bad"] * (k % 4 == 0) + [f"f{r.randrange(50)}" for _ in range(8)])) for k in range(200)]
    y = np.array([float(k % 4 == 0) for k in range(200)])
    order = np.random.default_rng(0).permutation(200)
    a, b = toxicity.fit(rows, y), toxicity.fit([rows[i] for i in order], y[order])
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_compiled_rules_equal_the_fit(spark):
    r = np.random.default_rng(0)
    x = r.random((600, len(quality.NAMES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    model = quality.fit(x, y)
    assert 0 < len(model.rules) < 60
    margin = np.full(len(x), model.bias)
    for rule in model.rules:
        holds = np.ones(len(x), bool)
        for name, cut, above in rule.conditions:
            v = x[:, quality.NAMES.index(name)]
            holds &= v > cut if above else v <= cut
        margin += rule.weight * holds
    expected = 1 / (1 + np.exp(-margin))
    rows = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(x)], ["k", *quality.NAMES])
    found = [r["p"] for r in rows.select("k", quality.rule_score(model).alias("p")).orderBy("k").collect()]
    assert np.allclose(found, expected)
    assert ((expected > 0.5) == y).mean() > 0.98
    plan = rows.select(quality.rule_score(model))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


# top-k


def top_brute(rows, is_query, k):
    usable = [(i, [int(np.floor(1024 * float(c))) for c in v]) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = set()
    for q, a in usable:
        if is_query(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def test_topk_query_matches_sql(spark):
    rows, differences = compare(QUERIES["op9_topk"](spark, SF_DIR), connect(SF_DIR), ORACLES["op9_topk"])
    assert rows and not differences


def test_topk_odd_rows(spark):
    r = random.Random(6)
    centres = [[r.gauss(0, 1) for _ in range(24)] for _ in range(5)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in r.choice(centres)]) for i in range(900)]
    rows += [(900 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2010, [1.0, None] * 12), (2020, [float("nan")] * 24), (2030, [float("inf")] * 24), (2040, [])]
    rows += [(2050, [1.0, 2.0]), (2060, [0.5, 2.0]), (None, [0.0] * 24), (2070, [0.0] * 24)]
    table = spark.createDataFrame([(v, i, "q", None) for i, v in rows], "embedding array<double>, vec_id long, id string, rank int")
    found = topk.top_k(table, F.col("id") % 10 == 0, k=7)
    assert {tuple(x) for x in found.collect()} == top_brute(rows, lambda i: i % 10 == 0, 7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(table.limit(0), F.col("id") % 10 == 0).collect() == []


def test_bounds_never_undercut():
    r = np.random.default_rng(2)
    x, q = r.normal(size=(200, 50)) * 1000, r.normal(size=(20, 50)) * 1000
    for segments in topk.levels(50):
        bound = topk.segment_statistics(q, segments) @ topk.segment_statistics(x, segments).T
        assert (bound >= q @ x.T - 1e-6).all()


# pipeline


def test_pipeline_stages(spark):
    """Each stage against its operator's own decisions, on the rows the stage before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "repeated_passages", "packing"]
    kept = [docs.toPandas()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        kept.append(out.toPandas())
        docs = spark.createDataFrame(kept[-1], docs.schema)
    assert 0 < len(kept[4]) <= len(kept[3]) <= len(kept[2]) < len(kept[1]) <= len(kept[0])
    # Exact copies: the largest id of each text.
    assert set(kept[2].doc_id) == set(kept[1].groupby("text").doc_id.max())
    # Passages are cut from the later of two documents only; nobody goes.
    assert set(kept[4].doc_id) == set(kept[3].doc_id)
    assert (kept[4].n_chars == kept[4].text.str.len()).all()
    packed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert set(packed.doc_id) == set(kept[4].doc_id)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_rejects_toxic_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r[0] for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    toxic = {r[0]: r[1] for r in labels.select("doc_id", "toxic").collect()}
    caught = [t for i, t in toxic.items() if i not in kept]
    assert len(caught) > 20 and sum(caught) >= 0.95 * len(caught)


def test_pipeline_odd_rows(spark, odd_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in odd_rows], schema)
    for rows in (docs, docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            rows = function(spark, rows, SF_DIR)
            rows.count()


def test_pipeline_dedup_keeps_one_row_of_each_group(spark, odd_rows):
    """NULL ids, an id with two texts, and an input that comes twice."""
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000]
    rows += [(8, f"{odd_rows[3][1]} more"), (None, f"{odd_rows[3][1]} again"), (None, odd_rows[9][1]), (4, odd_rows[9][1])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, f"s{k}", len(t or "")) for k, (i, t) in enumerate(rows * 2)], schema)

    largest = {}
    for i, t in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    exact = corpus_pipeline.drop_exact_copies(spark, docs, SF_DIR).collect()
    assert Counter((r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in exact) == Counter(largest.items())

    unique = sorted(set(rows), key=lambda x: (x[0] is None, x[0] or 0, hashlib.sha256((x[1] or "").encode()).hexdigest()))
    sets = [shingle_set(t) for _, t in unique]
    group = list(range(len(unique)))
    for a in range(len(unique)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * len(sets[a] | sets[b]):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    near = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()
    assert Counter((r["doc_id"], r["text"]) for r in near) == Counter(unique[g] for g in set(group))


@pytest.mark.parametrize("name", ["op5_quality", "op10_toxicity"])
def test_held_out_column(spark, name):
    mod, rest = (5, 0) if name == "op5_quality" else (3, 1)
    for r in QUERIES[name](spark, SF_DIR).select("doc_id", "held_out").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest)
