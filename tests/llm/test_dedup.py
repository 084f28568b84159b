"""Exact dedup, the Jaccard join and repeated strings against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import SF_DIR, make_docs, words
from oracle import compare, connect

from batchlens.llm import exact_dedup, jaccard_join, repeats
from batchlens.llm.queries import ORACLES, QUERIES
from batchlens.llm.shingles import shingles


def sample(sf_dir=SF_DIR):
    return connect(sf_dir).execute("SELECT doc_id, text FROM documents").fetchall()


# exact dedup


def exact_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        group = groups[t or ""]
        keep = max((x for x in group if x is not None), default=None)
        out.append((i, keep, len(group), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return Counter(out)


def test_exact_query_matches_sql(spark):
    rows, differences = compare(QUERIES["op2_exact_dedup"](spark, SF_DIR), connect(SF_DIR), ORACLES["op2_exact_dedup"])
    assert rows and not differences


def test_exact_odd_rows(spark, odd_rows, odd_docs, no_docs):
    found = exact_dedup.exact_duplicates(odd_docs, bucket_capacity=2)
    assert Counter(map(tuple, found.collect())) == exact_brute(odd_rows)
    assert exact_dedup.exact_duplicates(no_docs).collect() == []


def test_directory_splits_overfull_buckets_only():
    counts = np.zeros(1 << exact_dedup.MAX_DEPTH, np.int64)
    counts[:4], counts[40_000] = 5, 3
    bucket = exact_dedup.directory(counts, 10)
    held = Counter()
    for slot, n in enumerate(counts):
        held[bucket[slot]] += n
    assert max(held.values()) <= 10
    assert (bucket[1 << 15 :] == 1 << 15).all()  # never overfull, never split again
    assert set(exact_dedup.directory(counts, 100)) == {0}
    # A slot that is overfull at the last depth just grows.
    counts[7] = 1000
    assert exact_dedup.directory(counts, 10)[7] == 7


def test_equal_keys_of_different_texts_make_a_chain():
    import pyarrow as pa

    schema = pa.schema(
        [("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("text_sha256", pa.string()),
         ("keep_id", pa.int64()), ("group_size", pa.int64())]
    )
    rows = pa.RecordBatch.from_pydict(
        {"bucket": [0] * 4, "key": [9, 9, 9, 10], "text": ["a", "b", "a", "a"], "keep_id": [1, 2, 7, 4], "n": [1, 1, 2, 1]}
    )
    out = [r for b in exact_dedup._chain(schema)([rows]) for r in b.to_pylist()]
    assert [(r["key"], r["chain"], r["keep_id"], r["group_size"]) for r in out] == [(9, 0, 7, 3), (9, 1, 2, 1), (10, 0, 4, 1)]


# Jaccard join


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(found) < 5:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4))


def jaccard_brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
                links[a] += 1
                links[b] += 1
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[root(k)] = min(smallest.get(root(k), i), i)
    return Counter(
        (i, len(sets[k]), i if not sets[k] else smallest.get(root(k)), links[k]) for k, (i, _) in enumerate(rows)
    )


def near_rows(seed=3):
    """Families of near copies at all distances, chains of edits, and a passage that most documents share."""
    r = random.Random(seed)
    passage = words(r, 25)
    rows = []
    for family in range(8):
        text = words(r, 20 + 12 * family, 5000).split()
        for member in range(12):
            own = list(text)
            for _ in range(r.randrange(0, 5)):
                own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
            if member % 4 == 0:
                own = [*own, *passage.split()]
            rows.append((len(rows) + 1, " ".join(own)))
            if member % 3 == 0:
                text = own
    rows += [(1000 + k, passage + " " + words(r, 10 * k)) for k in range(10)]
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_families(spark, seed):
    rows = near_rows(seed)
    found = jaccard_join.jaccard_components(make_docs(spark, rows))
    expected = jaccard_brute(rows)
    assert Counter(map(tuple, found.collect())) == expected
    assert len({c for _, _, c, _ in expected}) < len(rows)


def test_jaccard_bundles_of_many_blocks(spark, monkeypatch):
    """Blocks of four members: links between blocks are found, and each once though many bundles hold both."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = near_rows(5)
    rows += [(2000 + i, t) for i, t in rows[::3]]
    docs = make_docs(spark, rows)
    assert Counter(map(tuple, jaccard_join.jaccard_components(docs).collect())) == jaccard_brute(rows)
    pairs, members = jaccard_join.jaccard_pairs(docs)
    sets = {i: shingle_set(t) for i, t in rows}
    of = {bytes(r["cls"]): sets[r["doc_id"]] for r in members.collect()}
    assert set(of.values()) == set(sets.values())
    found = [frozenset((of[bytes(r["a"])], of[bytes(r["b"])])) for r in pairs.collect()]
    different = list(set(sets.values()))
    expected = {
        frozenset((a, b)) for i, a in enumerate(different) for b in different[:i] if 4 * len(a & b) >= 3 * len(a | b)
    }
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 40


def test_jaccard_repeated_ids(spark):
    """Ids repeat with other texts, and texts with other ids, over several tasks."""
    rows = [(i % 7, t) for i, t in near_rows(6)] * 2
    docs = make_docs(spark, rows).repartition(5)
    assert Counter(map(tuple, jaccard_join.jaccard_components(docs).collect())) == jaccard_brute(rows)


def test_jaccard_odd_rows(spark, odd_rows, odd_docs, no_docs):
    found = jaccard_join.jaccard_components(odd_docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert Counter(map(tuple, found.collect())) == jaccard_brute(odd_rows)
    assert jaccard_join.jaccard_components(no_docs).collect() == []


def test_jaccard_query(spark):
    rows = sample()
    assert Counter(map(tuple, QUERIES["op1_jaccard_join"](spark, SF_DIR).collect())) == jaccard_brute(rows)


def test_cell_filters_lose_no_link():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(80) < 0.93], r.integers(0, 2**63, 4).astype(np.uint64)])) for _ in range(40)]
    rows = []
    for own in sets:
        prefix = len(own) - (-(-3 * len(own) // 4)) + 1
        flags = np.zeros(len(own), np.uint8)
        for bit, seed in enumerate((1, *jaccard_join._ORDER_SEEDS)):
            flags[np.argsort((own ^ np.uint64(seed)) * np.uint64(0x9FB21C651E98DF25))[:prefix]] |= 1 << bit
        rows.append({"tokens": own, "flags": flags, "n": len(own), "pivots": np.array([5, 9 + len(rows) % 2])})
    expected = {
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
        if 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    }
    assert set(zip(*np.nonzero(jaccard_join.linked(rows, rows, 5)))) == expected and len(expected) > 40
    assert not jaccard_join.linked(rows, rows, 9).any()  # all pairs belong to bundle 5


def test_connected_labels():
    links = np.zeros((4, 3), bool)
    for i, j in ((0, 1), (2, 1), (2, 2), (3, 0)):
        links[i, j] = True
    left, right = jaccard_join.connected(links)
    assert left.tolist() == [0, 1, 0, 3] and right.tolist() == [3, 0, 0]


def test_shingles():
    assert len(shingles("")) == len(shingles(" \n")) == 0
    assert shingles("A b\x0bc").tolist() == shingles("a  B C").tolist()
    assert shingles("a b c d").tolist() != shingles("a b c d e").tolist()
    assert len(shingles("a a a a a a a")) == 1
    assert shingles("É b").tolist() != shingles("é b").tolist()  # only A-Z change


# repeated strings


def repeats_brute(rows):
    where = {}
    late = 2**63
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            s = raw[k : k + 50]
            where[s] = min(where.get(s, late), late if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if where[raw[k : k + 50]] < (late if i is None else i):
                gone[k : k + 50] = True
        runs = int((np.diff(np.concatenate([[0], gone, [0]])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def digest(found):
    return Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], len(r["span_starts"]), r["kept_sha256"]) for r in found.collect()
    )


def test_repeats_odd_rows(spark, odd_rows, odd_docs, no_docs):
    assert digest(repeats.remove_repeats(odd_docs)) == repeats_brute(odd_rows)
    assert repeats.remove_repeats(no_docs).collect() == []
    kept = repeats.without_repeats(odd_docs)
    assert kept.schema == odd_docs.schema and kept.count() == len(odd_rows)
    assert repeats.without_repeats(no_docs).collect() == []


def test_repeats_of_periodic_and_overlapping_texts(spark):
    r = random.Random(2)
    letters = [random.Random(9).choice("ab") for _ in range(400)]
    rows = [(k, "".join(r.choice("ab") for _ in range(70)) * 3) for k in range(20)]
    rows += [(100 + k, "".join(letters[a : a + r.randrange(40, 200)])) for k in range(30) for a in [r.randrange(250)]]
    rows += [(200 + k, "ab" * (20 + k)) for k in range(12)]
    assert digest(repeats.remove_repeats(make_docs(spark, rows))) == repeats_brute(rows)


def test_repeats_query(spark):
    found = QUERIES["op6_suffix_dedup"](spark, SF_DIR)
    got = Counter(tuple(r) for r in found.collect())
    assert got == repeats_brute(sample())


def test_windows_of_unique_text_do_not_meet_by_chance():
    raw = np.random.default_rng(7).integers(0, 256, 4 << 20, dtype=np.uint8)
    parsed = repeats.Parsed(raw, np.array([len(raw)]), repeats.LENGTH, repeats.SCREEN_GRAM)
    found = parsed.tokens[parsed.triggers]
    assert len(found) > 500_000 and len(np.unique(found)) == len(found)


def test_equal_half_fingerprints_of_different_strings_remove_nothing():
    import pyarrow as pa

    keys = np.array([5, 9, 9], np.uint64)
    rows = {"part": [0, 0], "unit": [1, 2], "keys": [repeats._packed(keys)] * 2, "ids": [np.array([i]).tobytes() for i in (3, 8)]}
    rows["more"] = [np.array(x, np.uint64).tobytes() for x in ([1, 2, 3], [7, 3, 4])]
    rows["least"] = [np.zeros(3, np.uint16).tobytes()] * 2
    schema = pa.schema([("part", pa.int32()), ("unit", pa.int64()), ("flags", pa.binary())])
    found = repeats._suffix_answers(schema)(pa.table(rows))
    assert [list(x) for x in found["flags"].to_pylist()] == [[0, 0, 0], [0, 1, 0]]
