"""Association rules per batch, at fixed thresholds or down a ladder of relaxing thresholds."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from batchlens.kinds import NUMERIC
from batchlens.operators.batching import BATCH
from batchlens.operators.items import ItemBook, coded_baskets, item_book, item_columns
from batchlens.operators.itemsets import WHOLE, mine, mine_level
from batchlens.operators.quantiles import SMALL_TABLE
from batchlens.session import stage

# The thresholds tried in turn, and the number of rules that ends the search.
SUPPORTS = (0.05, 0.03, 0.01)
CONFIDENCES = (0.3, 0.2, 0.1)
MIN_RULES = 5

RULE_SCHEMA = (
    "batch_id string, antecedents array<string>, consequents array<string>, "
    "support double, confidence double, lift double"
)


def split_sets(sets: DataFrame, min_confidence: float) -> DataFrame:
    """Every split of a frequent set in two non-empty sides with enough confidence, in item codes.

    Each split occurs once, so the rules are distinct. All subsets of a frequent set are frequent,
    so the two joins find the count of either side.
    """
    masks = F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, size(ids)) - 2"))
    side = lambda bit: F.filter("ids", lambda x, i: F.getbit(F.col("mask"), i) == bit)
    splits = (
        sets.filter(F.size("ids") >= 2)
        .select(BATCH, "ids", "cnt", "n_rows", F.explode(masks).alias("mask"))
        .select(BATCH, "cnt", "n_rows", side(1).alias("antecedents"), side(0).alias("consequents"))
    )
    share = lambda c: F.col(c) / F.col("n_rows")
    left = sets.select(BATCH, F.col("ids").alias("antecedents"), F.col("cnt").alias("left_cnt"))
    right = sets.select(BATCH, F.col("ids").alias("consequents"), F.col("cnt").alias("right_cnt"))
    return (
        splits.join(left, [BATCH, "antecedents"])
        .withColumn("support", share("cnt"))
        .withColumn("confidence", F.col("support") / share("left_cnt"))
        .filter(F.col("confidence") >= min_confidence)
        .join(right, [BATCH, "consequents"])
        .select(
            BATCH,
            "antecedents",
            "consequents",
            "support",
            "confidence",
            (F.col("confidence") / share("right_cnt")).alias("lift"),
        )
    )


def with_texts(coded: DataFrame, book: ItemBook) -> DataFrame:
    """Rules in item codes to rules in sorted item texts."""
    return coded.join(book.labels(), BATCH).select(
        BATCH,
        book.text_of("antecedents").alias("antecedents"),
        book.text_of("consequents").alias("consequents"),
        "support",
        "confidence",
        "lift",
    )


def rules_at(
    df: DataFrame,
    kinds: Mapping[str, str],
    min_support: float,
    min_confidence: float,
    exclude: Collection[str] = (),
    *,
    unknown: str = NUMERIC,
    numeric_categorical: str = "one_hot",
    small_table: int = SMALL_TABLE,
    whole: int = WHOLE,
) -> DataFrame:
    """All rules of every batch at one pair of thresholds."""
    columns = item_columns(df, kinds, exclude, unknown=unknown, numeric_categorical=numeric_categorical)
    book = item_book(df, columns, min_support, small_table=small_table)
    sets = mine(df, book, min_support, whole)
    return with_texts(split_sets(sets, min_confidence), book)


def mine_rules(
    df: DataFrame,
    kinds: Mapping[str, str],
    exclude: Collection[str] = (),
    *,
    min_rules: int = MIN_RULES,
    supports: Sequence[float] = SUPPORTS,
    confidences: Sequence[float] = CONFIDENCES,
    unknown: str = NUMERIC,
    numeric_categorical: str = "one_hot",
    small_table: int = SMALL_TABLE,
    whole: int = WHOLE,
) -> DataFrame:
    """Rules of every batch, relaxing first confidence, then support until it has min_rules.

    A batch keeps the rules of all attempts up to the one at which it stops: those with the
    previous support at the lowest confidence, and those with the current support at the
    confidence it stopped at. So one mining per support is enough, and only batches that still
    lack rules are mined at the next support. The rows are read once, as baskets of all items that
    the lowest support may want, and a support counts only sets that the ones before it did not.
    """
    columns = item_columns(df, kinds, exclude, unknown=unknown, numeric_categorical=numeric_categorical)
    if not columns:
        return df.sparkSession.createDataFrame([], RULE_SCHEMA)
    steps = list(accumulate(confidences, min))
    levels = [s for i, s in enumerate(supports) if s < min(supports[:i], default=2.0)]
    book = item_book(df, columns, levels[-1], small_table=small_table)
    baskets = stage(coded_baskets(df, book, levels[-1]), "coded")
    # One id per batch, held here because only the batches still open go on.
    open_batches = [r[0] for r in book.table.select(BATCH).collect()]
    chosen = []
    counted = None
    for level, support in enumerate(levels):
        part = baskets.filter(F.col(BATCH).isin(open_batches))
        sets, counted = mine_level(part, book, support, counted, whole)
        coded = stage(split_sets(sets, steps[-1]), "rules")
        earlier = F.col("support") >= levels[level - 1] if level else F.lit(False)
        within = [earlier | (F.col("confidence") >= c) for c in steps]
        totals = coded.groupBy(BATCH).agg(*[F.count_if(w).alias(f"n{j}") for j, w in enumerate(within)])
        last = level == len(levels) - 1
        stops: dict[int, list[str]] = {}
        for batch, *counts in totals.collect():
            reached = [j for j, n in enumerate(counts) if n >= min_rules]
            if reached or last:
                stops.setdefault(min(reached, default=len(steps) - 1), []).append(batch)
        for j, batches in stops.items():
            chosen.append(coded.filter(F.col(BATCH).isin(batches) & within[j]))
        closed = {batch for batches in stops.values() for batch in batches}
        open_batches = [batch for batch in open_batches if batch not in closed]
        if not open_batches:
            break
    if not chosen:
        return df.sparkSession.createDataFrame([], RULE_SCHEMA)
    return with_texts(reduce(DataFrame.unionByName, chosen), book)


def by_lift(rules: DataFrame) -> DataFrame:
    """Rules of each batch by falling lift, equal lifts in order of their items."""
    return rules.orderBy(BATCH, F.desc("lift"), "antecedents", "consequents")
