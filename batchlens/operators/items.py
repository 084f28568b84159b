"""Rows as sets of items: one item per categorical value, one per numeric value above the median."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from batchlens.functions.values import column, number, text
from batchlens.kinds import NUMERIC, resolve
from batchlens.operators.batching import BATCH, rows_per_batch
from batchlens.operators.profile import text_cells
from batchlens.operators.quantiles import SMALL_TABLE, quantiles
from batchlens.session import stage

# Hash buckets per value that could be frequent, for the pruning count.
BUCKETS_PER_FREQUENT_VALUE = 20
VALUES, ABOVE_MEDIAN, EQUALS_ONE = "values", "above_median", "equals_one"


@dataclass(frozen=True)
class ItemColumn:
    """How one column turns into items."""

    name: str
    rule: str

    def label(self, value=None):
        if self.rule == VALUES:
            return F.concat(F.lit(f"{self.name}="), value)
        return F.lit(f"{self.name}=above_median" if self.rule == ABOVE_MEDIAN else self.name)


def _labelled(c: ItemColumn):
    return lambda v: c.label(v["value"])


def item_columns(
    df: DataFrame,
    kinds: Mapping[str, str],
    exclude: Collection[str] = (),
    *,
    unknown: str = NUMERIC,
    numeric_categorical: str = "one_hot",
) -> list[ItemColumn]:
    """Item rules in column order. Columns without a kind count as numeric.

    A categorical column of a numeric type gives one item per value, or with
    numeric_categorical='equals_one' a single item that holds where the value is 1.
    """
    if numeric_categorical not in ("one_hot", EQUALS_ONE):
        raise ValueError(f"numeric_categorical must be 'one_hot' or 'equals_one', not {numeric_categorical!r}")
    names = [c for c in df.columns if c != BATCH and c not in exclude]
    out = []
    for name, kind in resolve(names, kinds, unknown).items():
        number_typed = isinstance(df.schema[name].dataType, (NumericType, BooleanType))
        if kind == NUMERIC:
            rule = ABOVE_MEDIAN
        elif number_typed and numeric_categorical == EQUALS_ONE:
            rule = EQUALS_ONE
        else:
            rule = VALUES
        out.append(ItemColumn(name, rule))
    return out


def batch_medians(
    df: DataFrame,
    columns: list[str],
    *,
    n_rows: int | None = None,
    small_table: int = SMALL_TABLE,
) -> DataFrame:
    """Exact median per batch and column: (batch_id, feature, median)."""
    found = quantiles(df, columns, (0.5,), n_rows=n_rows, small_table=small_table)
    return found.select(BATCH, "feature", F.col("value").alias("median"))


def _wide_medians(medians: DataFrame, columns: list[ItemColumn]) -> DataFrame:
    picks = [
        F.max(F.when(F.col("feature") == c.name, F.col("median"))).alias(f"median{i}")
        for i, c in enumerate(columns)
        if c.rule == ABOVE_MEDIAN
    ]
    return medians.groupBy(BATCH).agg(*picks)


def _holds(c: ItemColumn, value, median: str):
    """Condition for the single item of a median or equals-one column; NULL for a missing value."""
    return value > F.col(median) if c.rule == ABOVE_MEDIAN else value == 1


def _inputs(df: DataFrame, columns: list[ItemColumn]):
    """Values of the item columns under names of their own, in0, in1 and so on."""
    return [
        (text(df, c.name) if c.rule == VALUES else number(df, c.name)).alias(f"in{i}")
        for i, c in enumerate(columns)
    ]


def with_items(
    df: DataFrame,
    kinds: Mapping[str, str],
    exclude: Collection[str] = (),
    *,
    unknown: str = NUMERIC,
    numeric_categorical: str = "one_hot",
    small_table: int = SMALL_TABLE,
) -> DataFrame:
    """The rows plus `items`, the texts of the items that hold in the row."""
    columns = item_columns(df, kinds, exclude, unknown=unknown, numeric_categorical=numeric_categorical)
    nums = [c.name for c in columns if c.rule == ABOVE_MEDIAN]
    joined = df
    if nums:
        wide = stage(_wide_medians(batch_medians(df, nums, small_table=small_table), columns), "medians")
        own = {c: f"__{c}" for c in wide.columns if c != BATCH}
        joined = df.join(wide.withColumnsRenamed(own), BATCH, "left")
    found = []
    for i, c in enumerate(columns):
        if c.rule == VALUES:
            found.append(c.label(text(df, c.name)))
        else:
            found.append(F.when(_holds(c, number(df, c.name), f"__median{i}"), c.label()))
    return joined.select(
        *[column(c) for c in df.columns], F.array_compact(F.array(*found)).alias("items")
    )


@dataclass(frozen=True)
class ItemBook:
    """Per batch: row count, medians, and the categorical values frequent enough to matter.

    `table` has one row per batch. A column holds at most 1/min_support frequent values in a
    batch, so a row has at most columns/min_support entries however large the batch is. An item is
    coded as column * stride + position of the value, positions counted from 1 by falling count.
    """

    columns: list[ItemColumn]
    table: DataFrame
    stride: int

    def at(self, min_support: float) -> DataFrame:
        """One row per batch: n_rows, medians and, per categorical column, its frequent values."""
        picks = [F.col(BATCH), F.col("n_rows")]
        for i, c in enumerate(self.columns):
            if c.rule == ABOVE_MEDIAN:
                picks.append(F.col(f"median{i}"))
            elif c.rule == VALUES:
                often = F.filter(f"values{i}", lambda v: v["cnt"] / F.col("n_rows") >= min_support)
                picks.append(F.transform(often, lambda v: v["value"]).alias(f"values{i}"))
        return self.table.select(*picks)

    def labels(self) -> DataFrame:
        """(batch_id, labels): texts of the items by column and position."""
        rows = []
        for i, c in enumerate(self.columns):
            if c.rule == VALUES:
                texts = F.transform(f"values{i}", _labelled(c))
                rows.append(F.coalesce(texts, F.array().cast("array<string>")))
            else:
                rows.append(F.array(c.label()))
        return self.table.select(BATCH, F.array(*rows).alias("labels"))

    def text_of(self, ids):
        """Item codes to sorted item texts, in a frame joined with labels()."""
        column_of = lambda i: ((i - i % self.stride) / self.stride).cast("int")
        return F.array_sort(
            F.transform(ids, lambda i: F.element_at(F.element_at("labels", column_of(i) + 1), i % self.stride))
        )


def frequent_texts(
    df: DataFrame, columns: list[str], sizes: DataFrame, min_support: float, prune: bool
) -> DataFrame:
    """(batch_id, feature, text, cnt, n_rows) of the values in at least min_support of a batch's rows.

    With prune, values are first counted by hash bucket, and only the values of buckets that reach
    the support are counted one by one: a value cannot be more frequent than its bucket. At most
    1/min_support buckets per batch and column reach it, and the rare values of a column with many
    distinct ones are never shuffled.
    """
    frequent = F.col("cnt") / F.col("n_rows") >= min_support
    rows = F.count(F.lit(1)).alias("cnt")
    cells = text_cells(df, columns)
    if prune:
        buckets = int(BUCKETS_PER_FREQUENT_VALUE / min_support)
        cells = cells.withColumn("bucket", F.pmod(F.xxhash64("text"), F.lit(buckets)).cast("int"))
        full = cells.groupBy(BATCH, "feature", "bucket").agg(rows).join(sizes, BATCH).filter(frequent)
        cells = cells.join(
            stage(full.select(BATCH, "feature", "bucket"), "buckets"), [BATCH, "feature", "bucket"], "left_semi"
        )
    return cells.groupBy(BATCH, "feature", "text").agg(rows).join(sizes, BATCH).filter(frequent)


def item_book(
    df: DataFrame,
    columns: list[ItemColumn],
    min_support: float,
    *,
    small_table: int = SMALL_TABLE,
) -> ItemBook:
    """Row counts, medians and frequent values of all batches in df."""
    sizes = stage(rows_per_batch(df).filter(F.col(BATCH).isNotNull()), "sizes")
    table = sizes
    n_rows = sizes.agg(F.sum("n_rows")).first()[0] or 0
    nums = [c.name for c in columns if c.rule == ABOVE_MEDIAN]
    if nums:
        medians = batch_medians(df, nums, n_rows=n_rows, small_table=small_table)
        table = table.join(_wide_medians(medians, columns), BATCH, "left")
    cats = [c.name for c in columns if c.rule == VALUES]
    if cats:
        often = frequent_texts(df, cats, sizes, min_support, prune=n_rows > small_table)
        lists = []
        for i, c in enumerate(columns):
            if c.rule == VALUES:
                entry = F.struct((-F.col("cnt")).alias("order"), F.col("text").alias("value"), "cnt")
                found = F.collect_list(F.when(F.col("feature") == c.name, entry))
                lists.append(
                    F.transform(F.sort_array(found), lambda e: F.struct(e["value"], e["cnt"])).alias(f"values{i}")
                )
        table = table.join(often.groupBy(BATCH).agg(*lists), BATCH, "left")
    return ItemBook(columns, stage(table, "book"), int(1 / min_support) + 2)


def coded_baskets(df: DataFrame, book: ItemBook, min_support: float) -> DataFrame:
    """Distinct item sets of the rows with their number of rows: (batch_id, basket, w).

    Rows are collapsed on the map side, so what is shuffled are distinct baskets, spread by their
    content. A basket lists item codes in rising order and may be empty.
    """
    joined = df.select(BATCH, *_inputs(df, book.columns)).join(book.at(min_support), BATCH)
    codes = []
    for i, c in enumerate(book.columns):
        value = F.col(f"in{i}")
        if c.rule == VALUES:
            position = F.array_position(f"values{i}", value).cast("int")
            code = F.when(position > 0, i * book.stride + position)
        else:
            code = F.when(_holds(c, value, f"median{i}"), F.lit(i * book.stride + 1))
        codes.append(code.alias(f"code{i}"))
    names = [f"code{i}" for i in range(len(codes))]
    grouped = joined.select(BATCH, *codes).groupBy(BATCH, *names).agg(F.count(F.lit(1)).alias("w"))
    return grouped.select(BATCH, F.array_compact(F.array(*names)).alias("basket"), "w")
