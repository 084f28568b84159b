"""What exploratory tables need of a batch, kept per batch and merged over batches.

Value counts give missing shares, distinct counts, moments, quartiles, histograms and top values; co-moments give
correlations. Both merge by adding up, so tables over all batches never open the rows of a batch again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from batchlens.kinds import CATEGORICAL, NUMERIC, of_kind
from batchlens.operators import profile as prof
from batchlens.operators.batching import BATCH
from batchlens.operators.comoments import comoments, correlations, merged as merged_pairs
from batchlens.operators.eda import DESCRIBE, binned, ranges
from batchlens.operators.quantiles import quantiles_of_counts

STATE_SCHEMA = "feature string, num double, text string, cnt bigint"
PAIR_SCHEMA = (
    "x string, y string, n bigint, mean_x double, mean_y double, m_xx double, m_yy double, m_xy double"
)


def value_states(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """(batch_id, feature, num, text, cnt): how often each value of each column occurs in each batch."""
    nums, cats = of_kind(kinds, NUMERIC), of_kind(kinds, CATEGORICAL)
    none = lambda kind: F.lit(None).cast(kind)
    parts = []
    if nums:
        counts = prof.number_counts(df, nums)
        parts.append(counts.select(BATCH, "feature", "num", none("string").alias("text"), "cnt"))
    if cats:
        counts = prof.text_counts(df, cats)
        parts.append(counts.select(BATCH, "feature", none("double").alias("num"), "text", "cnt"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def pair_states(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """(batch_id, co-moments of two columns), one row per batch and pair."""
    return merged_pairs(comoments(df, of_kind(kinds, NUMERIC), (BATCH,)), (BATCH,))


def merged(states: DataFrame) -> DataFrame:
    """(feature, num, text, cnt) over all batches."""
    return states.groupBy("feature", "num", "text").agg(F.sum("cnt").alias("cnt"))


def _numbers(counts: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return counts.filter(F.col("feature").isin(of_kind(kinds, NUMERIC))).select("feature", "num", "cnt")


def _places(counts: DataFrame, kinds: list[str]) -> DataFrame:
    places = [(i, c) for i, c in enumerate(kinds)]
    return counts.sparkSession.createDataFrame(places, "ord int, feature string")


def overview(counts: DataFrame, kinds: Mapping[str, str], n_rows: int) -> DataFrame:
    """As `eda.overview`, from merged counts and the number of rows."""
    found = prof.distinct_counts(counts, ())
    value_type = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("feature")]
    missing = F.lit(n_rows) - F.coalesce("n_valid", F.lit(0))
    return (
        _places(counts, list(kinds))
        .join(found, "feature", "left")
        .select(
            "ord",
            "feature",
            value_type.alias("value_type"),
            (100.0 * F.try_divide(missing, F.lit(n_rows))).alias("missing_pct"),
            F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"),
        )
    )


def describe(counts: DataFrame, kinds: Mapping[str, str], *, digits: int | None = 4) -> DataFrame:
    """As `eda.describe`, from merged counts; the spread is summed about the mean."""
    numbers = _numbers(counts, kinds)
    totals = numbers.groupBy("feature").agg(
        F.sum("cnt").alias("count"),
        (F.sum(F.col("num") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min("num").alias("min"),
        F.max("num").alias("max"),
    )
    about = numbers.join(totals.select("feature", "mean"), "feature").groupBy("feature")
    spread = about.agg(F.sum(F.col("cnt") * F.pow(F.col("num") - F.col("mean"), 2)).alias("squares"))
    parts = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ranked = quantiles_of_counts(numbers.withColumnRenamed("num", "value"), [p for p, _ in parts], ())
    wide = ranked.groupBy("feature").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in parts])
    std = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std")
    out = (
        _places(counts, of_kind(kinds, NUMERIC))
        .join(totals, "feature", "left")
        .join(spread, "feature", "left")
        .join(wide, "feature", "left")
        .select("ord", "feature", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "mean", std, "min", "max", *[n for _, n in parts])
    )
    values = [F.col(s) if digits is None else F.bround(s, digits).alias(s) for s in DESCRIBE[1:]]
    return out.select("ord", "feature", "count", *values)


def histogram(counts: DataFrame, kinds: Mapping[str, str], *, bins: int = 30, max_columns: int | None = None) -> DataFrame:
    """As `eda.histogram`, from merged counts."""
    nums = of_kind(kinds, NUMERIC)[:max_columns]
    numbers = _numbers(counts, kinds)
    # One row per column.
    ends = {r["feature"]: (r["lo"], r["hi"]) for r in numbers.groupBy("feature").agg(F.min("num").alias("lo"), F.max("num").alias("hi")).collect()}
    frame = ranges([(c, *ends.get(c, (None, None))) for c in nums])
    wide = counts.sparkSession.createDataFrame(frame, "feature string, lo double, hi double")
    cells = numbers.withColumnRenamed("num", "x").join(wide, "feature")
    return binned(cells, frame, bins)


def correlation(pairs: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """As `eda.correlation`, from the pairs of all batches."""
    nums = of_kind(kinds, NUMERIC)
    return correlations(merged_pairs(pairs), nums) if len(nums) > 1 else correlations(pairs.limit(0), [])


def top_values(counts: DataFrame, kinds: Mapping[str, str], k: int = 10) -> DataFrame:
    """As `eda.top_values`, from merged counts."""
    texts = counts.filter(F.col("feature").isin(of_kind(kinds, CATEGORICAL))).select("feature", "text", "cnt")
    return prof.top_values(texts, k, ())


def tables(
    states: DataFrame, pairs: DataFrame, kinds: Mapping[str, str], n_rows: int, max_histograms: int | None = None
) -> dict[str, DataFrame]:
    """The exploratory tables of a report, from the states of all batches."""
    counts = merged(states)
    summary = states.sparkSession.createDataFrame([(n_rows, len(kinds))], "n_rows bigint, n_columns int")
    found = {"eda_summary": summary, "eda_overview": overview(counts, kinds, n_rows)}
    if of_kind(kinds, NUMERIC):
        found["eda_describe"] = describe(counts, kinds)
        found["eda_correlation"] = correlation(pairs, kinds)
        found["eda_histogram"] = histogram(counts, kinds, max_columns=max_histograms)
    if of_kind(kinds, CATEGORICAL):
        found["eda_top_values"] = top_values(counts, kinds)
    return found
