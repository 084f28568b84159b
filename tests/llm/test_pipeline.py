"""Stages of the pipeline against brute force, and on tables with names of their own."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import SF_DIR, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from batchlens.llm import toxicity
from batchlens.llm.common import hold_tables
from batchlens.llm.queries import QUERIES, TOKENIZERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def without_repeats_brute(rows):
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            s = raw[k : k + 50]
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        stays = np.ones(len(raw), bool)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < order(i):
                stays[k : k + 50] = False
        text = bytes(b for b, s in zip(raw, stays) if s).decode("utf-8", "ignore")
        out.append((i, text, len(text)))
    return Counter(out)


def test_cut_passages_equal_brute_force(spark, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000]
    r = random.Random(11)
    passage = words(r, 30)
    rows += [(30 + k, f"{words(r, 20)} é{passage} {words(r, 10)}") for k in range(4)]
    found = corpus_pipeline.cut_repeats(spark, frame(spark, rows), SF_DIR)
    assert Counter((r["doc_id"], r["text"] or "", r["n_chars"]) for r in found.collect()) == without_repeats_brute(rows)


def best_fit_bins(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [(f, k) for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits)[1]] -= n
        else:
            free.append(capacity - n)
    return sorted(free)


def test_packed_pieces_equal_plain_best_fit(spark, odd_rows):
    rows = [(k, t) for k, (_, t) in enumerate(odd_rows)]
    rows += [(100 + k, words(random.Random(k), 40 + 9 * k)) for k in range(60)]
    tokenizer = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    wanted = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[at : at + 2048], "<u4").tobytes()
            wanted.append((i, piece, at, len(own) // 4, zlib.crc32(own)))
    found = corpus_pipeline.pack_sequences(spark, frame(spark, rows), SF_DIR).toPandas()
    assert Counter(found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == Counter(wanted)
    bins = found.sort_values("offset").groupby("sequence_id")
    for _, own in bins:
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
    assert sorted(2048 - bins.length.sum()) == best_fit_bins([w[3] for w in wanted], 2048)


def test_stages_take_any_further_columns(spark, odd_rows):
    """Columns named as inner ones, and a map, which cannot be compared."""
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000] * 2
    docs = frame(spark, rows).withColumns(
        {c: F.lit(c) for c in ("key", "row", "digest", "kept", "order", "cls", "group_size")}
    )
    docs = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id"))).drop("n_chars")
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        kept = after.collect()
        assert kept and all(r["tags"] == {"a": r["doc_id"]} and r["digest"] == "digest" for r in kept)
        docs = spark.createDataFrame(kept, docs.schema)
    assert corpus_pipeline.pack_sequences(spark, docs, SF_DIR).select("doc_id").distinct().count() > 5


def test_machine_scores_the_double_sum():
    r = np.random.default_rng(2)
    machine = toxicity.Machine(np.sort(r.choice(10_000, 40, False)).astype(np.int32), -0.3, r.normal(size=40), r.normal(size=(40, 3)))
    for size in (0, 1, 2, 25):
        here = np.sort(r.choice(40, size, False))
        found = np.sort(np.concatenate([machine.terms[here], [-5, 10_001]])).astype(np.int32)
        margin = machine.bias + sum(machine.weights[a] for a in here)
        margin += sum(machine.vectors[a] @ machine.vectors[b] for a in here for b in here if a < b)
        assert machine.score(found) == pytest.approx(1 / (1 + np.exp(-margin)))


def test_sharding_query_follows_its_laws(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_sharding"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    slots = {}
    for r in rows:
        text = docs[r.doc_id]
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and {r["law"] for r in rows} == {"rows"}


def test_tables_of_one_operator_at_a_time():
    a, b = {1: 1}, {2: 2}
    hold_tables("a", a.clear)
    hold_tables("a", a.clear)
    assert a
    hold_tables("b", b.clear)
    assert not a and b
    hold_tables("none", dict().clear)
    assert not b
