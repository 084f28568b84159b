from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC
from batchlens.operators.batching import BATCH
from batchlens.operators.items import with_items
from batchlens.operators.itemsets import frequent_itemsets
from batchlens.operators.rules import CONFIDENCES, SUPPORTS, by_lift, mine_rules, rules_at


def one_hot(spark, baskets, batch="b"):
    """Baskets of letters as rows: a column per letter, 1 where it is in the basket."""
    letters = sorted(set("".join(basket for basket, _ in baskets)))
    rows = [
        (batch, *["1" if x in basket else None for x in letters]) for basket, n in baskets for _ in range(n)
    ]
    schema = "batch_id string, " + ", ".join(f"{x} string" for x in letters)
    return spark.createDataFrame(rows, schema), {x: CATEGORICAL for x in letters}


def sides(rules):
    strip = lambda items: "".join(i.removesuffix("=1") for i in items)
    return {
        (strip(r.antecedents), strip(r.consequents)): (r.support, r.confidence, r.lift) for r in rules.collect()
    }


def brute_itemsets(baskets, min_support):
    n = sum(c for _, c in baskets)
    counts = {}
    for basket, c in baskets:
        for size in range(1, len(basket) + 1):
            for s in combinations(sorted(basket), size):
                counts[s] = counts.get(s, 0) + c
    return {s: c / n for s, c in counts.items() if c / n >= min_support}


def brute_rules(baskets, min_support, min_confidence):
    found = brute_itemsets(baskets, min_support)
    out = {}
    for s, support in found.items():
        for size in range(1, len(s)):
            for a in combinations(s, size):
                c = tuple(x for x in s if x not in a)
                confidence = support / found[a]
                if confidence >= min_confidence:
                    out["".join(a), "".join(c)] = (support, confidence, confidence / found[c])
    return out


def brute_ladder(baskets, min_rules):
    kept = {}
    for s in SUPPORTS:
        for c in CONFIDENCES:
            kept.update(brute_rules(baskets, s, c))
            if len(kept) >= min_rules:
                return kept
    return kept


LADDER = [("ab", 5), ("cd", 3), ("ef", 3), ("gh", 5), ("g", 28), ("h", 20), ("ij", 3), ("i", 12), ("j", 12), ("", 9)]


@pytest.mark.parametrize("limit", [10, 0])
def test_ladder_keeps_the_union_of_attempts(spark, limit):
    df, kinds = one_hot(spark, LADDER)
    found = sides(mine_rules(df, kinds, whole=limit))
    assert set(found) == {
        ("c", "d"),
        ("d", "c"),
        ("e", "f"),
        ("f", "e"),
        ("a", "b"),
        ("b", "a"),
        ("g", "h"),
        ("h", "g"),
    }
    assert found["c", "d"][2] == pytest.approx(33.333333, abs=1e-6)
    assert found["a", "b"][2] == pytest.approx(20)
    assert found["g", "h"][1:] == pytest.approx((0.151515, 0.606061), abs=1e-6)
    assert found["h", "g"][1] == pytest.approx(0.2)


@pytest.mark.parametrize("min_rules", [1, 5, 20, 60, 10**6])
def test_ladder_against_brute_force(spark, min_rules):
    df, kinds = one_hot(spark, LADDER + [("abcg", 4), ("abd", 2), ("bcde", 3), ("acgh", 1)])
    other, _ = one_hot(spark, [("ab", 1), ("abcdefghij", 1), ("aj", 30), ("", 60)], "other")
    both = df.unionByName(other, allowMissingColumns=True)
    rules = mine_rules(both, kinds, min_rules=min_rules)
    expected = brute_ladder(LADDER + [("abcg", 4), ("abd", 2), ("bcde", 3), ("acgh", 1)], min_rules)
    found = sides(rules.filter("batch_id = 'b'"))
    assert set(found) == set(expected)
    for key, metrics in expected.items():
        assert found[key] == pytest.approx(metrics)
    other_expected = brute_ladder([("ab", 1), ("abcdefghij", 1), ("aj", 30), ("", 60)], min_rules)
    assert set(sides(rules.filter("batch_id = 'other'"))) == set(other_expected)
    assert rules.count() == rules.dropDuplicates(["batch_id", "antecedents", "consequents"]).count()


def test_all_splits_of_a_set(spark):
    df, kinds = one_hot(spark, [("abc", 2), ("ab", 1), ("", 1)])
    found = sides(rules_at(df, kinds, 0.5, 0.1))
    assert len(found) == 12
    assert found["a", "bc"] == pytest.approx((0.5, 0.666667, 1.333333), abs=1e-6)


def test_order_by_lift(spark):
    df, kinds = one_hot(spark, LADDER)
    lifts = [r.lift for r in by_lift(mine_rules(df, kinds)).collect()]
    assert lifts == sorted(lifts, reverse=True)


def test_too_few_items_give_no_rules(spark):
    df = spark.createDataFrame([("b", "u"), ("b", "u")], "batch_id string, c string")
    assert mine_rules(df, {"c": CATEGORICAL}).isEmpty()
    assert mine_rules(df, {"c": CATEGORICAL}, exclude=["c"]).isEmpty()


def test_all_missing_column_gives_no_item(spark):
    df = spark.createDataFrame([("b", None), ("b", float("nan"))], "batch_id string, x double")
    assert [r["items"] for r in with_items(df, {"x": NUMERIC}).collect()] == [[], []]


def test_integer_categorical(spark):
    df = spark.createDataFrame([("b", v) for v in (0, 1, 2, 1)], "batch_id string, SEX int")

    def count(mode):
        rows = with_items(df, {"SEX": CATEGORICAL}, numeric_categorical=mode)
        return {r[0]: r[1] for r in rows.select(F.explode("items").alias("i")).groupBy("i").count().collect()}

    assert count("one_hot") == {"SEX=0": 1, "SEX=1": 2, "SEX=2": 1}
    assert count("equals_one") == {"SEX": 2}
    sets = frequent_itemsets(df, {"SEX": CATEGORICAL}, 0.05, numeric_categorical="equals_one")
    assert [(r["items"], r.cnt) for r in sets.collect()] == [(["SEX"], 2)]


def test_unknown_column_is_numeric(spark):
    df = spark.createDataFrame([("b", float(v)) for v in (1, 2, 3, 4)], "batch_id string, X double")
    items = [r["items"] for r in with_items(df, {}).orderBy("X").collect()]
    assert items == [[], [], ["X=above_median"], ["X=above_median"]]


@pytest.mark.parametrize("limit", [10, 0])
def test_itemsets_match_fp_growth(spark, limit):
    from batchlens.catalog.subjects import SHIPMENT_KINDS, shipments

    month = shipments(spark, "/root/testdata/sf0.01").filter("batch_id = '1997-05'")
    found = frequent_itemsets(month, SHIPMENT_KINDS, 0.03, whole=limit)
    ours = {(tuple(sorted(r["items"])), r.cnt) for r in found.collect()}
    model = FPGrowth(itemsCol="items", minSupport=0.03).fit(with_items(month, SHIPMENT_KINDS))
    theirs = {(tuple(sorted(r["items"])), r.freq) for r in model.freqItemsets.collect()}
    assert ours == theirs
    counts = dict(ours)
    for items, cnt in ours:
        for i in range(len(items)):
            assert len(items) == 1 or counts[items[:i] + items[i + 1 :]] >= cnt


def test_column_names_do_not_clash(spark):
    names = ["n_rows", "median0", "values1", "in0", "labels", "a.b c", "items"]
    rows = [("b", *[float(i % (j + 2)) for j in range(len(names))]) for i in range(12)]
    df = spark.createDataFrame(rows, "batch_id string, " + ", ".join(f"`{n}` double" for n in names))
    kinds = {n: NUMERIC if j % 2 else CATEGORICAL for j, n in enumerate(names)}
    plain = {n: f"c{j}" for j, n in enumerate(names)}
    renamed = df.toDF(BATCH, *plain.values())
    expected = mine_rules(renamed, {plain[n]: k for n, k in kinds.items()})
    assert mine_rules(df, kinds).count() == expected.count() > 0
    assert with_items(df.drop("items"), kinds).columns == [BATCH, *names[:-1], "items"]


def test_large_tables_give_the_same_rules(spark):
    from batchlens.catalog.subjects import SHIPMENT_KINDS, shipments

    df = shipments(spark, "/root/testdata/sf0.001", "l_orderkey")
    kinds = {"l_orderkey": CATEGORICAL, **SHIPMENT_KINDS}
    small = mine_rules(df, kinds, min_rules=500)
    large = mine_rules(df, kinds, min_rules=500, small_table=0)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_rule_invariants(spark):
    df, kinds = one_hot(spark, LADDER)
    for r in rules_at(df, kinds, 0.01, 0.1).collect():
        assert 0 <= r.support <= r.confidence <= 1
        assert not set(r.antecedents) & set(r.consequents)
        assert r.antecedents == sorted(r.antecedents)


def wide_baskets(spark, width):
    """One row with a value in every column, and each value in five rows more."""
    names = [f"c{i}" for i in range(width)]
    rows = [("b", *["1"] * width)]
    rows += [("b", *["1" if i == j else None for j in range(width)]) for i in range(width) for _ in range(5)]
    schema = "batch_id string, " + ", ".join(f"{c} string" for c in names)
    return spark.createDataFrame(rows, schema), dict.fromkeys(names, CATEGORICAL)


def test_a_wide_basket_is_no_burden(spark):
    """Forty items in one row: each is frequent alone, none with another, and no row gives 2^40 subsets."""
    df, kinds = wide_baskets(spark, 40)
    found = frequent_itemsets(df, kinds, 0.02).collect()
    assert sorted(r["items"] for r in found) == sorted([f"c{i}=1"] for i in range(40))
    assert {r.cnt for r in found} == {6}


def test_wide_and_narrow_baskets_together(spark):
    """A batch with wide baskets goes prefix by prefix, one with narrow baskets at once; both give all sets."""
    baskets = [("abcdefghijkl", 4), ("abc", 5), ("kl", 6), ("a", 9), ("dk", 7), ("", 10)]
    df, kinds = one_hot(spark, baskets)
    narrow, _ = one_hot(spark, [*LADDER, ("k", 1), ("l", 1)], "n")
    both = df.unionByName(narrow, allowMissingColumns=True)
    for batch, given in (("b", baskets), ("n", [*LADDER, ("k", 1), ("l", 1)])):
        found = frequent_itemsets(both, kinds, 0.05, whole=5).filter(F.col(BATCH) == batch)
        ours = {"".join(i.removesuffix("=1") for i in r["items"]): r.support for r in found.collect()}
        assert ours == {"".join(s): v for s, v in brute_itemsets(given, 0.05).items()}


@pytest.mark.parametrize("whole", [10, 3, 0])
def test_a_support_counts_only_new_sets(spark, whole, monkeypatch):
    """The ladder reads the rows once, and a set is counted at one support of a batch at most."""
    from batchlens.operators import rules as module

    df, kinds = one_hot(spark, LADDER)
    other, _ = one_hot(spark, [("abcd", 2), ("ab", 9), ("cd", 4), ("ej", 3), ("", 70), ("ghif", 2)], "o")
    both = df.unionByName(other, allowMissingColumns=True)
    levels, scans = [], []
    real_level, real_baskets = module.mine_level, module.coded_baskets
    monkeypatch.setattr(module, "coded_baskets", lambda *a: scans.append(1) or real_baskets(*a))

    def watched(baskets, book, support, before, limit):
        sets, after = real_level(baskets, book, support, before, limit)
        levels.append((support, after, before))
        return sets, after

    monkeypatch.setattr(module, "mine_level", watched)
    found = mine_rules(both, kinds, min_rules=200, whole=whole)
    assert len(scans) == 1 and [s for s, _, _ in levels] == list(SUPPORTS)
    for batch, given in (("b", LADDER), ("o", [("abcd", 2), ("ab", 9), ("cd", 4), ("ej", 3), ("", 70), ("ghif", 2)])):
        assert set(sides(found.filter(F.col(BATCH) == batch))) == set(brute_ladder(given, 200))
    for support, after, before in levels:
        sets = [(r[BATCH], tuple(r.ids)) for r in after.sets.collect()]
        assert len(sets) == len(set(sets))
        if before and whole == 10:
            assert set(sets) >= {(r[BATCH], tuple(r.ids)) for r in before.sets.collect()}
