"""Frequent item sets of all batches at once.

Search over a prefix tree held in DataFrames. A node is an item set found frequent (the prefix)
with the items that may extend it (the rest) and the number of rows behind it; equal nodes are
merged, so the tables shrink as the sets grow. A prefix is a shard: all baskets that hold it are
there, cut to what follows. Where none of them has more than `WHOLE` items left, one aggregation
counts all subsets; a wider prefix is extended by each item that stays frequent, which makes
narrower shards of it. So no row ever gives more than 2^WHOLE subsets.

Down a ladder of supports, what was counted for a batch is kept with its counts, also the sets that
were too rare. The next support then counts only sets with an item that is new at it.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from batchlens.kinds import NUMERIC
from batchlens.operators.batching import BATCH
from batchlens.operators.items import VALUES, ItemBook, coded_baskets, item_book, item_columns
from batchlens.operators.quantiles import SMALL_TABLE
from batchlens.session import stage

# Items left, up to which all subsets of a basket are counted at once.
WHOLE = 10
# Baskets are small but have many subsets, so tasks are cut by subsets, not by bytes.
SUBSETS_PER_TASK = 250_000

NO_ITEMS = "array<int>"


@dataclass(frozen=True)
class Counted:
    """What earlier supports counted: all sets of the batches `whole` over items of that support or more."""

    support: float
    sets: DataFrame
    whole: frozenset[str]


def mine(df: DataFrame, book: ItemBook, min_support: float, whole: int = WHOLE) -> DataFrame:
    """Item sets in at least min_support of a batch's rows: (batch_id, ids, cnt, n_rows)."""
    baskets = stage(coded_baskets(df, book, min_support), "baskets")
    return mine_level(baskets, book, min_support, None, whole)[0]


def _limits(book: ItemBook, support: float, name: str):
    """Per column the number of values that reach the support; items of other rules always count."""
    often = [
        F.size(F.filter(f"values{i}", lambda v: v["cnt"] / F.col("n_rows") >= support))
        if c.rule == VALUES
        else F.lit(1)
        for i, c in enumerate(book.columns)
    ]
    return F.array(*[F.greatest(n, F.lit(0)) for n in often]).alias(name)


def mine_level(
    baskets: DataFrame, book: ItemBook, support: float, before: Counted | None = None, whole: int = WHOLE
) -> tuple[DataFrame, Counted]:
    """Sets of one support, and what is counted by now, over baskets coded at this support or a lower one.

    Sets that are counted already are taken from `before`.
    """
    sizes = book.table.select(BATCH, "n_rows")
    frequent = F.col("cnt") / F.col("n_rows") >= support
    reached = _limits(book, support, "reached")
    known = _limits(book, before.support, "known") if before else F.array().cast(NO_ITEMS).alias("known")
    limits = book.table.select(BATCH, reached, known)
    column_of = lambda c: ((c - c % book.stride) / book.stride).cast("int") + 1
    within = lambda c, limit: c % book.stride <= F.element_at(limit, column_of(c))
    rest = F.filter("basket", lambda c: within(c, F.col("reached"))).alias("rest")
    again = F.col(BATCH).isin(sorted(before.whole)) if before else F.lit(False)
    fresh = F.when(again, F.filter("rest", lambda c: ~within(c, F.col("known")))).otherwise(F.col("rest"))
    nodes = stage(
        baskets.join(limits, BATCH)
        .select(BATCH, rest, "w", "known")
        .select(BATCH, F.array().cast(NO_ITEMS).alias("prefix"), "rest", fresh.alias("fresh"), "w")
        .groupBy(BATCH, "prefix", "rest", "fresh")
        .agg(F.sum("w").alias("w")),
        "baskets",
    ).filter(F.size("rest") > 0)
    found, kept = [], []
    counted_whole: set[str] = set()
    while True:
        left = F.size("rest")
        shards = nodes.groupBy(BATCH, "prefix").agg(
            F.max(left).alias("width"), F.sum(F.pow(F.lit(2.0), left)).alias("load")
        )
        widths = stage(shards, "widths")
        narrow = F.col("width") <= whole
        if not found and not kept:
            # One row per batch: the prefix is empty still.
            counted_whole = {r[BATCH] for r in widths.filter(narrow).select(BATCH).collect()}
        loads = widths.agg(F.sum(F.when(narrow, F.col("load"))).alias("narrow"), F.count_if(~narrow).alias("wide")).first()
        sized = nodes.join(widths.drop("load"), [BATCH, "prefix"])
        if loads.narrow is not None:
            some = sized.filter(narrow & (F.size("fresh") > 0))
            spread = some.repartition(1 + int(loads.narrow // SUBSETS_PER_TASK))
            counted = stage(_count_subsets(spread).join(sizes, BATCH), "counted")
            kept.append(counted)
            found.append(counted.filter(frequent))
        if not loads.wide:
            break
        # Sets of a batch that is wide by now are counted anew, whatever was known of it.
        nodes = sized.filter(~narrow).select(BATCH, "prefix", "rest", F.col("rest").alias("fresh"), "w")
        alive = stage(_extensions(nodes, sizes, frequent), "extensions")
        grown = F.concat("prefix", F.array("e.item")).alias("ids")
        found.append(
            alive.select(BATCH, "n_rows", "prefix", F.explode("alive").alias("e")).select(
                BATCH, grown, "e.cnt", "n_rows"
            )
        )
        nodes = stage(_descend(nodes, alive), "nodes")
    none = sizes.filter(F.lit(False)).select(
        BATCH, F.array().cast(NO_ITEMS).alias("ids"), F.lit(0).cast("long").alias("cnt"), "n_rows"
    )
    kept = [none, *[k.select(*none.columns).filter(F.col(BATCH).isin(sorted(counted_whole))) for k in kept]]
    if before:
        old = before.sets.filter(F.col(BATCH).isin(sorted(counted_whole & before.whole)))
        kept.append(old)
        found.append(old.filter(frequent))
    sets = reduce(DataFrame.unionByName, [none, *[f.select(*none.columns) for f in found]])
    return stage(sets, "itemsets"), Counted(support, reduce(DataFrame.unionByName, kept), frozenset(counted_whole))


def _count_subsets(nodes: DataFrame) -> DataFrame:
    """Rows behind every extension of a prefix by items of its rest, one of them fresh at least."""
    every = F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, size(rest)) - 1"))
    subset = F.filter("rest", lambda x, i: F.getbit(F.col("mask"), i) == 1)
    bits = F.transform("rest", lambda x, i: F.when(F.array_contains("fresh", x), F.expr("1L")).otherwise(F.expr("0L")))
    fresh = F.aggregate(F.reverse(bits), F.expr("0L"), lambda mask, bit: mask * 2 + bit)
    return (
        nodes.select(BATCH, "prefix", "rest", "w", fresh.alias("fresh"), F.explode(every).alias("mask"))
        .filter(F.col("mask").bitwiseAND(F.col("fresh")) != 0)
        .select(BATCH, F.concat("prefix", subset).alias("ids"), "w")
        .groupBy(BATCH, "ids")
        .agg(F.sum("w").alias("cnt"))
    )


def _extensions(nodes: DataFrame, sizes: DataFrame, frequent) -> DataFrame:
    """Per prefix the items that extend it to a frequent set, in rising order with their counts.

    A list holds frequent items of one batch, of which there are at most columns / min_support.
    """
    counted = (
        nodes.select(BATCH, "prefix", "w", F.explode("rest").alias("item"))
        .groupBy(BATCH, "prefix", "item")
        .agg(F.sum("w").alias("cnt"))
    )
    return (
        counted.join(sizes, BATCH)
        .filter(frequent)
        .groupBy(BATCH, "prefix", "n_rows")
        .agg(F.sort_array(F.collect_list(F.struct("item", "cnt"))).alias("alive"))
    )


def _descend(nodes: DataFrame, alive: DataFrame) -> DataFrame:
    """Nodes one item longer; items that do not extend the prefix cannot extend its supersets."""
    items = alive.select(BATCH, "prefix", F.transform("alive", lambda e: e["item"]).alias("items"))
    pruned = nodes.join(items, [BATCH, "prefix"]).select(
        BATCH, "prefix", F.array_intersect("rest", "items").alias("rest"), "w"
    )
    left = F.size("rest") - F.col("pos") - 1
    return (
        pruned.filter(F.size("rest") > 1)
        .select(BATCH, "prefix", "rest", "w", F.posexplode("rest").alias("pos", "item"))
        .filter(left > 0)
        .select(
            BATCH,
            F.concat("prefix", F.array("item")).alias("prefix"),
            F.slice("rest", F.col("pos") + 2, left).alias("rest"),
            "w",
        )
        .groupBy(BATCH, "prefix", "rest")
        .agg(F.sum("w").alias("w"))
        .withColumn("fresh", F.col("rest"))
    )


def frequent_itemsets(
    df: DataFrame,
    kinds: Mapping[str, str],
    min_support: float,
    exclude: Collection[str] = (),
    *,
    unknown: str = NUMERIC,
    numeric_categorical: str = "one_hot",
    small_table: int = SMALL_TABLE,
    whole: int = WHOLE,
) -> DataFrame:
    """Frequent item sets with their item texts: (batch_id, items, cnt, n_rows, support)."""
    columns = item_columns(df, kinds, exclude, unknown=unknown, numeric_categorical=numeric_categorical)
    book = item_book(df, columns, min_support, small_table=small_table)
    sets = mine(df, book, min_support, whole)
    return sets.join(book.labels(), BATCH).select(
        BATCH,
        book.text_of("ids").alias("items"),
        "cnt",
        "n_rows",
        (F.col("cnt") / F.col("n_rows")).alias("support"),
    )
