"""Exploratory tables over all rows, whatever their batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from batchlens.functions.values import number
from batchlens.kinds import CATEGORICAL, NUMERIC, of_kind, resolve
from batchlens.operators import profile as prof
from batchlens.operators.batching import BATCH
from batchlens.operators.comoments import comoments, correlations, merged
from batchlens.operators.quantiles import SMALL_TABLE, quantiles

DESCRIBE = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def known(df: DataFrame, kinds: Mapping[str, str], unknown: str = "skip") -> dict[str, str]:
    """Kinds of the table's columns, without the batch tag."""
    return resolve([c for c in df.columns if c != BATCH], kinds, unknown)


def summary(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Number of rows and of columns with a kind."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(known(df, kinds))))


def overview(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Per column: kind, missing percentage and distinct count. Columns without a kind are skipped."""
    kinds = known(df, kinds)
    position = F.array_position(F.array(*[F.lit(c) for c in kinds]), F.col("feature")) - 1
    return prof.quality_records(df, kinds, (), top_k=None).select(
        position.cast("int").alias("ord"),
        "feature",
        "value_type",
        (100.0 * F.col("missing_rate")).alias("missing_pct"),
        "unique_count",
    )


def describe(
    df: DataFrame, kinds: Mapping[str, str], *, digits: int | None = 4, small_table: int = SMALL_TABLE
) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles and max. The std of one value is NULL."""
    nums = of_kind(known(df, kinds), NUMERIC)
    aggs = []
    records = []
    for i, c in enumerate(nums):
        x = number(df, c)
        aggs += [
            F.count(x).alias(f"count{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
        fields = [F.col(f"{s}{i}").alias(s) for s in ("count", "mean", "std", "min", "max")]
        records.append(F.struct(F.lit(i).alias("ord"), F.lit(c).alias("feature"), *fields))
    long = df.agg(*aggs).select(F.explode(F.array(*records)).alias("r")).select("r.*")
    qs = quantiles(df, nums, (0.25, 0.5, 0.75), (), small_table=small_table)
    wide = qs.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        ]
    )
    out = long.join(wide, "feature", "left")
    values = [F.col(s) if digits is None else F.bround(s, digits).alias(s) for s in DESCRIBE[1:]]
    return out.select("ord", "feature", "count", *values)


def correlation(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Pearson matrix of the numeric columns as (x, y, corr), each pair over the rows that have both.

    NULL when either column is constant over those rows. Less than two numeric columns give no rows.
    """
    nums = of_kind(known(df, kinds), NUMERIC)
    if len(nums) < 2:
        return df.sparkSession.createDataFrame([], "x string, y string, corr double")
    return correlations(merged(comoments(df, nums)), nums)


def histogram(df: DataFrame, kinds: Mapping[str, str], *, bins: int = 30, max_columns: int | None = None) -> DataFrame:
    """Equal-width histograms of the numeric columns, or the first max_columns: (feature, bin, lo, hi, cnt).

    The last bin is closed on the right. A constant column gets a range of 1 around its value, a
    column without values the range 0 to 1. The ranges, two numbers per column, are computed first
    and become constants of the counting pass, which needs no join.
    """
    nums = of_kind(known(df, kinds), NUMERIC)[:max_columns]
    spark = df.sparkSession
    if not nums:
        return spark.createDataFrame([], "feature string, bin int, lo double, hi double, cnt bigint")
    xs = [number(df, c) for c in nums]
    ends = df.agg(*[f(x).alias(f"{f.__name__}{i}") for i, x in enumerate(xs) for f in (F.min, F.max)]).first()
    frame = ranges([(c, ends[f"min{i}"], ends[f"max{i}"]) for i, c in enumerate(nums)])
    lanes = [v for (name, lo, hi), x in zip(frame, xs) for v in (F.lit(name), x, F.lit(lo), F.lit(hi))]
    cells = df.select(F.stack(F.lit(len(nums)), *lanes).alias("feature", "x", "lo", "hi"))
    return binned(cells.filter(F.col("x").isNotNull()).withColumn("cnt", F.lit(1).cast("long")), frame, bins)


def ranges(ends: list[tuple]) -> list[tuple]:
    """(feature, lo, hi) with a range of 1 for constant columns and for those without values."""

    def widened(lo, hi):
        if lo is None:
            return 0.0, 1.0
        return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)

    return [(name, *widened(lo, hi)) for name, lo, hi in ends]


def binned(cells: DataFrame, frame: list[tuple], bins: int) -> DataFrame:
    """(feature, bin, lo, hi, cnt) over cells (feature, x, lo, hi, cnt) whose ranges are those of the frame."""
    counts = _with_bin(cells, bins).groupBy("feature", "bin").agg(F.sum("cnt").alias("cnt"))
    edge = lambda k: F.when(k == bins, F.col("hi")).otherwise(
        F.col("lo") + k * ((F.col("hi") - F.col("lo")) / bins)
    )
    frames = (
        cells.sparkSession.createDataFrame(frame, "feature string, lo double, hi double")
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select("feature", "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"))
    )
    return frames.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        F.col("left").alias("lo"),
        F.col("right").alias("hi"),
        F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"),
    )


def _with_bin(cells: DataFrame, bins: int) -> DataFrame:
    """Add the bin of x; a value within rounding of an edge is settled by comparing with it."""
    x, lo, step, at = F.col("x"), F.col("lo"), F.col("step"), F.col("at")
    return (
        cells.withColumn("step", (F.col("hi") - lo) / bins)
        .withColumn("at", F.floor((x - lo) / (F.col("hi") - lo) * bins).cast("int"))
        .withColumn("at", F.least(at, F.lit(bins - 1)))
        .withColumn("at", F.when(x < lo + at * step, at - 1).otherwise(at))
        .withColumn("bin", F.when((at < bins - 1) & (x >= lo + (at + 1) * step), at + 1).otherwise(at))
    )


def top_values(df: DataFrame, kinds: Mapping[str, str], k: int = 10) -> DataFrame:
    """The k most frequent values of each categorical column over all rows."""
    return prof.top_long_values(df, of_kind(known(df, kinds), CATEGORICAL), k)
