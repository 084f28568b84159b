"""Operators 11 to 13 against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchlens.llm.collisions import count_needed, fold_pairs, near_duplicates, scheme_for
from batchlens.llm.prefix_trie import list_ranks, numbered, prefix_trie, rebuilt, turns_of
from batchlens.llm.rtree import Tree, hard_negatives, str_order

VECTORS = "key string, vec_id long, embedding array<float>, label int, cls string, tile string"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(None, i, v, lab, "c", "t") for i, v, lab in rows], VECTORS).repartition(3)


def clusters(seed=4, n=240, dims=16, labels=3):
    """Vectors of a few centres, some of them close to each other, with copies and one hot group."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims))
    rows = []
    for i in range(n):
        c = 0 if i % 3 == 0 else int(r.integers(12))
        v = centres[c] + r.normal(size=dims) * (0.03 if i % 2 else 0.25)
        rows.append((i, [float(np.float32(x)) for x in v], int(c % labels)))
    rows += [(1000 + i, v, lab) for i, v, lab in rows[:20]]
    return rows


ODD = [
    (2000, None, 1),
    (2001, [], 1),
    (2002, [0.0] * 16, 1),
    (2003, [float("nan")] + [1.0] * 15, 1),
    (2004, [float("inf")] + [1.0] * 15, 1),
    (2005, [None] + [1.0] * 15, 1),
    (2006, [1.0] * 16, None),
    (2007, [1.0] * 8, 1),
    (None, [1.0] * 16, 1),
    (None, [1.0] * 16, 1),
    (2100, [1e30] * 16, 2),
    (2101, [2e30] * 16, 2),
    (5, [1.0] * 16, 1),
]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


# --- 13


def brute_near(rows, threshold=0.98):
    n = len(rows)
    ok = [usable(v) and any(v) and lab is not None for _, v, lab in rows]
    unit = [np.array(v, float) / np.abs(v).max() if k else None for (_, v, _), k in zip(rows, ok)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    root, links = list(range(n)), [0] * n

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(k) and rows[j][0] is not None]
        least[k] = min(ids, default=None)
    return sorted(
        ((rows[k][0], links[k], least[k], rows[k][0] == least[k]) for k in range(n)), key=str
    )


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_near_duplicates_equal_brute_force(spark, block_rows):
    rows = clusters() + ODD
    found = near_duplicates(vectors_frame(spark, rows), 0.98, block_rows=block_rows)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_near(rows)


def test_bundles_of_several_projections(spark, monkeypatch):
    """Short cells give bundles of several projections, as large tables do."""
    from batchlens.llm import collisions

    monkeypatch.setattr(collisions, "CELL_ROWS", 8)
    assert scheme_for(90, 0.98).width >= 3
    rows = clusters(seed=8)
    found = near_duplicates(vectors_frame(spark, rows), 0.98)
    assert sorted(map(tuple, found.collect()), key=str) == brute_near(rows)


def test_recall_of_the_scheme():
    """Pairs exactly at the threshold meet in a bundle and often enough."""
    r = np.random.default_rng(0)
    for largest in (100, 10**6):
        scheme = scheme_for(largest, 0.98)
        gap = r.normal(size=(20_000, scheme.projections)) * np.sqrt(0.04)
        inside = np.abs(gap) <= scheme.window / 65536
        bundled = inside[:, : scheme.bundles * scheme.width].reshape(-1, scheme.bundles, scheme.width).all(2).any(1)
        assert (bundled & (inside.sum(1) >= scheme.needed)).mean() > 0.999
    assert count_needed(16, 1.0) == 16 and count_needed(16, 0.0) == 0


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(vectors_frame(spark, clusters()).limit(0)).isEmpty()
    none = vectors_frame(spark, [(1, None, None), (2, [0.0], 1)])
    assert sorted(map(tuple, near_duplicates(none).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_fold_to_components():
    r = random.Random(2)
    a, b = np.array([r.randrange(60) for _ in range(40)]), np.array([r.randrange(60) for _ in range(40)])
    root = fold_pairs(60, a, b)
    assert (root[a] == root[b]).all()
    parent = list(range(60))
    for x, y in zip(a, b):
        old, new = parent[x], parent[y]
        parent = [new if p == old else p for p in parent]
    assert len(set(root)) == len(set(parent))


# --- 11


def brute_negatives(rows, is_anchor, scale=256, positives=5, negatives=10):
    known = [
        (i, [int(np.floor(scale * x)) for x in v], lab)
        for i, v, lab in rows
        if i is not None and lab is not None and usable(v) and max(map(abs, v)) < 1e6
    ]
    anchors = {}
    for i, v, lab in known:
        if is_anchor(i) and (i not in anchors or (v, lab) < anchors[i]):
            anchors[i] = (v, lab)
    out = []
    for a, (av, alab) in anchors.items():
        others = [
            (-sum(x * y for x, y in zip(av, v)), i, lab) for i, v, lab in known if i != a and len(v) == len(av)
        ]
        for ps, p in sorted((s, i) for s, i, lab in others if lab == alab)[:positives]:
            inside = sorted((s, i) for s, i, lab in others if lab != alab and -30 * ps <= -100 * s <= -90 * ps)
            out += [(a, p, k, i, -ps, -s) for k, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 40, "page_rows": 4, "block_queries": 3}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rows = clusters() + [o for o in ODD if o[0] not in (2100, 2101)]
    df = vectors_frame(spark, rows)
    found = hard_negatives(df, F.col("id") % 5 == 0, **sizes)
    assert found.columns[:4] == ["anchor_id", "positive_id", "rank", "negative_id"]
    wanted = brute_negatives(rows, lambda i: i % 5 == 0)
    assert wanted and sorted(map(tuple, found.collect())) == wanted


def test_negatives_of_ties_and_equal_rows(spark):
    rows = [(i, [1.0, 0.5 if i % 2 else 0.25], i % 2) for i in range(40)]
    found = hard_negatives(vectors_frame(spark, rows), F.col("id") % 4 == 0, tile_rows=8, page_rows=2)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 4 == 0)


def test_negatives_of_nothing(spark):
    df = vectors_frame(spark, clusters())
    assert hard_negatives(df.limit(0), F.col("id") % 5 == 0).isEmpty()
    assert hard_negatives(df, F.col("id") < 0).isEmpty()
    assert hard_negatives(df.filter("label = 1"), F.col("id") % 5 == 0).isEmpty()


def test_pages_hold_every_row_once():
    v = np.random.default_rng(1).integers(-50, 50, (501, 4))
    pages = str_order(v, np.arange(501), [2, 3], 16)
    assert sorted(np.concatenate(pages)) == list(range(501)) and max(map(len, pages)) == 16


def test_search_opens_few_boxes():
    """Boxes outside the windows or below the k-th score stay closed."""
    import pyarrow as pa

    v = np.random.default_rng(3).integers(0, 1000, (4096, 2))
    pages = str_order(v, np.arange(4096), [0, 1], 16)
    tree = Tree(
        pa.table(
            {
                "page": np.arange(len(pages)),
                "low": [v[p].min(0) for p in pages],
                "high": [v[p].max(0) for p in pages],
                "ids": [p for p in pages],
                "flat": [v[p].ravel() for p in pages],
            }
        )
    )
    opened = []

    class Counting(list):
        def __getitem__(self, i):
            opened.append(i)
            return super().__getitem__(i)

    tree.rows = Counting(tree.rows)
    query = np.array([3, 2])
    scores = v @ query
    least, most = np.array([-(1 << 62), 900]), np.array([1 << 62, 1000])
    ids, found = tree.search(query, -1, least, most, 10)
    for w in range(2):
        inside = [(-s, i) for i, s in enumerate(scores.tolist()) if least[w] <= s <= most[w]]
        assert list(zip((-found[w]).tolist(), ids[w].tolist())) == sorted(inside)[:10]
    assert len(opened) < len(pages) / 4


# --- 12

TURNS = "turn long, key string, conv_id long, role string, text string, depth long, arc string"


def brute_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        below = [m for m in nodes if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in nodes)]
        saved = sum((len(nodes[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = sorted(c for c in members if len(whole[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(children), len(leaves), saved, digest))
    return sorted(out, key=str)


def talk(seed=6, n=60):
    r = random.Random(seed)
    rows = []
    for c in list(range(n)) + [-7, -5, 10**15]:
        if c == 15:
            continue
        for t in range(r.randrange(1, 14)):
            rows.append((c, t, r.choice(["user", "bot", None]), r.choice(["a", "b", "é", "", None])))
    rows += [(c, t, "user", "hot") for c in range(200, 240) for t in range(6)]
    rows += [(None, 0, "user", "lost"), (3, None, "user", "first"), (20, 2, "user", "again"), (20, 2, "user", "again")]
    rows += [(7, t, "user", str(t)) for t in range(20, 400)]
    r.shuffle(rows)
    return [x for x in rows if x[0] != 3 or x[1] is None or x[1] != 0]


def conversations(spark, rows):
    return spark.createDataFrame([(t, "k", c, role, text, 1, "a") for c, t, role, text in rows], TURNS).repartition(5)


@pytest.mark.parametrize("at_once", [65_536, 40])
def test_trie_equals_brute_force(spark, at_once):
    # Turns with equal numbers have an order of their own; here they are equal altogether.
    rows = talk()
    found = prefix_trie(*rebuilt(turns_of(conversations(spark, rows))), at_once=at_once)
    assert sorted(map(tuple, found.collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie(*rebuilt(turns_of(conversations(spark, talk()).limit(0)))).isEmpty()
    alone = conversations(spark, [(4, 0, None, None)])
    found = [tuple(r) for r in prefix_trie(*rebuilt(turns_of(alone))).collect()]
    assert sorted(found, key=str) == brute_trie([(4, 0, None, None)])


def test_a_hot_key_is_numbered_in_pieces(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(2).alias("k"), "id", F.xxhash64("id").alias("h"))
    found = numbered(df.repartition(7), ["k"], ["id"], ["h"])
    assert found.filter(F.when(F.col("k") == 1, F.col("id") + 1).otherwise(F.col("id") - 3999) != F.col("pos")).isEmpty()
    last = found.filter("pos = 4000 and k = 1").first()["x_h"]
    assert last == df.filter("k = 1").agg(F.bit_xor("h")).first()[0]


def test_ranks_of_a_list(spark):
    order = random.Random(1).sample(range(3000), 3000)
    pair = F.struct(F.col("a").alias("n")), F.when(F.col("b").isNotNull(), F.struct(F.col("b").alias("n")))
    links = spark.createDataFrame(list(zip(order, order[1:] + [None])), "a int, b int").select(
        pair[0].alias("arc"), pair[1].alias("next")
    )
    ranks = {r.arc.n: r.place for r in list_ranks(links, at_once=100).collect()}
    assert [ranks[a] for a in order] == list(range(3000))
