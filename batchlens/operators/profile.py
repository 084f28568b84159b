"""Data-quality profile: one record per batch and column, for all batches in one pass.

Three lanes over the data, each reading only the columns it needs. The wide lane aggregates
numeric statistics that combine on the map side. The numeric and the text lane count distinct
values; they spread over the cluster by value, after a first count on the map side, so neither a
hot batch nor a hot value ends up in one task. The text lane is shuffled once and gives distinct
counts, valid counts and top values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchlens.functions.values import number, text
from batchlens.kinds import CATEGORICAL, NUMERIC, of_kind, resolve
from batchlens.operators.batching import BATCH
from batchlens.session import stage

# Characters of a text that are ranked before the text itself is read.
HEAD = 256
STATS = ("min", "max", "mean", "std")
STATS_TYPE = "struct<min:double,max:double,mean:double,std:double>"


def _cells(df, lane, name, keys) -> DataFrame:
    parts = [c for pair in lane for c in pair]
    long = df.select(*keys, F.stack(F.lit(len(lane)), *parts).alias("feature", name))
    return long.filter(F.col(name).isNotNull())


def text_cells(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """(keys, feature, text) of every cell of categorical columns, missing values left out."""
    return _cells(df, [(F.lit(c), text(df, c)) for c in columns], "text", keys)


def number_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """Rows per (keys, feature, num) over numeric columns, missing values left out."""
    cells = _cells(df, [(F.lit(c), number(df, c)) for c in columns], "num", keys)
    return cells.groupBy(*keys, "feature", "num").agg(F.count(F.lit(1)).alias("cnt"))


def text_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """Rows per (keys, feature, text) over categorical columns, missing values left out."""
    cells = text_cells(df, columns, keys)
    return cells.groupBy(*keys, "feature", "text").agg(F.count(F.lit(1)).alias("cnt"))


def _long_digest() -> Column:
    return F.when(F.char_length("text") >= HEAD, F.sha2("text", 256))


def digest_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """Rows per (keys, feature, head, digest): the shuffle carries no text beyond its first HEAD characters.

    A text that ends before is its own head and has no digest.
    """
    cells = text_cells(df, columns, keys).select(
        *keys, "feature", F.left("text", F.lit(HEAD)).alias("head"), _long_digest().alias("digest")
    )
    return cells.groupBy(*keys, "feature", "head", "digest").agg(F.count(F.lit(1)).alias("cnt"))


def distinct_counts(counts: DataFrame, keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """Exact number of distinct values, and of valid rows, per (keys, feature)."""
    return counts.groupBy(*keys, "feature").agg(
        F.count(F.lit(1)).alias("unique_count"), F.sum("cnt").alias("n_valid")
    )


def top_values(counts: DataFrame, k: int = 10, keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """The k most frequent texts of each column, equal counts in value order.

    The filter on the rank makes Spark keep k rows per group in every task before the shuffle.
    """
    order = Window.partitionBy(*keys, "feature").orderBy(F.desc("cnt"), F.asc("text"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*keys, "feature", "rank", F.col("text").alias("value"), "cnt")
    )


def top_long_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent texts of each column over all rows, where texts may be long.

    Values are counted by digest and ranked by count and head; all that tie within the first k stay. These few are
    written out, and only for those longer than their head is the text read again, for the final order.
    """
    order = Window.partitionBy("feature").orderBy(F.desc("cnt"), F.asc("head"))
    ranked = digest_counts(df, columns, ()).withColumn("place", F.rank().over(order))
    likely = stage(ranked.filter(F.col("place") <= k).drop("place"), "top-values")
    cut = F.char_length("head") >= HEAD
    values = likely.filter(~cut).select("feature", F.col("head").alias("text"), "cnt")
    if not likely.filter(cut).isEmpty():
        wanted = likely.filter(cut).select("feature", "digest", "cnt")
        cells = text_cells(df, columns, ()).filter(F.char_length("text") >= HEAD)
        whole = cells.withColumn("digest", F.sha2("text", 256)).join(wanted, ["feature", "digest"])
        values = values.unionByName(whole.select("feature", "text", "cnt").distinct())
    return top_values(values, k, ())


def numeric_statistics(
    df: DataFrame, kinds: Mapping[str, str], keys: Sequence[str] = (BATCH,)
) -> DataFrame:
    """(keys, feature, value_type, n_rows, stats) for all columns; stats of numeric columns with values."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    records = []
    for i, (name, kind) in enumerate(kinds.items()):
        stats = F.lit(None).cast(STATS_TYPE)
        if kind == NUMERIC:
            x = number(df, name)
            parts = (F.min(x), F.max(x), F.avg(x), F.stddev_samp(x))
            aggs += [F.count(x).alias(f"n{i}")]
            aggs += [part.alias(f"{s}{i}") for s, part in zip(STATS, parts)]
            # The spread of a single value is 0.
            std = F.when(F.col(f"n{i}") == 1, 0.0).otherwise(F.col(f"std{i}"))
            fields = [F.col(f"{s}{i}").alias(s) for s in STATS[:3]]
            stats = F.when(F.col(f"n{i}") > 0, F.struct(*fields, std.alias("std"))).otherwise(stats)
        records.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.lit(kind).alias("value_type"),
                F.col("n_rows").alias("n_rows"),
                stats.alias("stats"),
            )
        )
    wide = df.groupBy(*keys).agg(*aggs)
    return wide.select(*keys, F.explode(F.array(*records)).alias("r")).select(*keys, "r.*")


def quality_records(
    df: DataFrame,
    kinds: Mapping[str, str],
    keys: Sequence[str] = (BATCH,),
    top_k: int | None = 10,
) -> DataFrame:
    """Quality records of columns with known kinds; `top` is left empty with top_k=None."""
    on = [*keys, "feature"]
    nums, cats = of_kind(kinds, NUMERIC), of_kind(kinds, CATEGORICAL)
    ranked = None
    counted = []
    if nums:
        counted.append(distinct_counts(number_counts(df, nums, keys), keys))
    if cats:
        texts = text_counts(df, cats, keys) if top_k is not None else digest_counts(df, cats, keys)
        counted.append(distinct_counts(texts, keys))
        if top_k is not None:
            entries = F.sort_array(F.collect_list(F.struct("rank", "value", "cnt")))
            ranked = top_values(texts, top_k, keys).groupBy(*on).agg(entries.alias("ranked"))
    distinct = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])
    out = numeric_statistics(df, kinds, keys).join(distinct, on, "left")
    top = F.lit(None).cast("array<struct<value:string,cnt:bigint>>")
    if ranked is not None:
        out = out.join(ranked, on, "left")
        top = F.transform("ranked", lambda t: F.struct(t["value"], t["cnt"]))
    missing = F.col("n_rows") - F.coalesce("n_valid", F.lit(0))
    return out.select(
        *on,
        "value_type",
        "n_rows",
        F.try_divide(missing, "n_rows").alias("missing_rate"),
        F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"),
        "stats",
        top.alias("top"),
    )


def profile(
    df: DataFrame,
    kinds: Mapping[str, str],
    *,
    unknown: str = "error",
    top_k: int = 10,
) -> DataFrame:
    """(batch_id, feature, value_type, n_rows, missing_rate, unique_count, stats, top) of every column.

    A column without a kind is an error, or with unknown= is skipped or taken as numeric.
    """
    kinds = resolve([c for c in df.columns if c != BATCH], kinds, unknown)
    if not kinds:
        raise ValueError("no columns to profile")
    return quality_records(df, kinds, (BATCH,), top_k)
