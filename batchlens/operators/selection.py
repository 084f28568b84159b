"""Exact order statistics of many groups at once, by digits.

Every double has an image, a 64-bit number in the same order. The first pass counts the values by the leading digits of
their images and finds the cell that holds each wanted rank. Such a cell is a narrow range of values; the next pass
counts only the values in it, in 2**DIGIT parts of equal width, and so on. A cell whose values are all equal is settled:
most columns end with the second pass, and after a few no two doubles are left in one cell. Counts combine on the map
side: a pass shuffles a bounded number of rows per task, group and open cell, whatever the number of values, and no
group is gathered anywhere.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchlens.session import stage

#: Leading bits of the image that the first pass tells apart, and bits of a later pass.
FIRST_DIGIT = 20
DIGIT = 16

# The layout of a double.
FRACTION_BITS = 52
LEAST_EXPONENT, INFINITE_EXPONENT = -1022, 1024
LARGEST = sys.float_info.max


def with_image(df: DataFrame, name: str = "image") -> DataFrame:
    """Adds a long in the order of the doubles `x`, the same for 0.0 and -0.0; infinities are outermost."""
    infinite = F.abs("x") == F.lit(float("inf"))
    size = F.least(F.abs("x"), F.lit(LARGEST))
    unit = F.lit(1 << FRACTION_BITS).cast("long")
    guess, exponent = F.col("_guess"), F.col("_exponent")
    # The logarithm may miss the exponent by one; the quotient, which is exact, tells.
    least = F.lit(LEAST_EXPONENT)
    steps = df.withColumn("_guess", F.greatest(F.coalesce(F.floor(F.log2(size)), least), least))
    steps = steps.withColumn("_scaled", size / F.pow(F.lit(2.0), guess))
    low = (F.col("_scaled") < 1) & (guess > least)
    off = F.when(F.col("_scaled") >= 2, 1).when(low, -1).otherwise(0)
    steps = steps.withColumn("_exponent", (guess + off).cast("long"))
    fraction = (size / F.pow(F.lit(2.0), exponent) * F.lit(float(1 << FRACTION_BITS))).cast("long")
    outermost = F.lit(INFINITE_EXPONENT - LEAST_EXPONENT + 1).cast("long") * unit
    magnitude = F.when(infinite, outermost).otherwise((exponent - least) * unit + fraction)
    signed = F.when(F.col("x") < 0, -magnitude).when(F.col("x").isNotNull(), magnitude)
    return steps.withColumn(name, signed).drop("_guess", "_scaled", "_exponent")


def _counted(cells: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows and range of values per `cell`, and the rows before it in its group."""
    counts = cells.groupBy(*group, "cell").agg(
        F.sum("cnt").alias("held"), F.min("x").alias("least"), F.max("x").alias("most")
    )
    # The number of cells bounds the partitions of this window.
    earlier = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))


def _first_cells(values: DataFrame) -> DataFrame:
    return with_image(values).withColumn("cell", F.shiftright("image", 64 - FIRST_DIGIT)).drop("image")


def _hits(counted: DataFrame, group: Sequence[str]) -> DataFrame:
    """The cells that hold a rank of `wants`, an array of (rank, place among the rows counted)."""
    inside = F.filter("wants", lambda w: (w["at"] >= F.col("before")) & (w["at"] < F.col("before") + F.col("held")))
    hits = counted.select(*group, "least", "most", "before", F.explode(inside).alias("w"))
    place = (F.col("w.at") - F.col("before")).alias("at")
    return hits.select(*group, "least", "most", F.col("w.rank").alias("rank"), place)


def quantiles_by_digits(values: DataFrame, probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """(keys, feature, p, value) with linear interpolation, from (keys, feature, x, cnt); x must not be NULL.

    A pair of keys and feature without rows gives no row; equal values may come in any number of rows.
    """
    group = [*keys, "feature"]
    first = stage(_counted(_first_cells(values), group), "digits")
    ps = F.array(*[F.lit(float(p)) for p in probs])
    places = F.transform(ps, lambda p: F.struct(p.alias("p"), ((F.col("n") - 1) * p).alias("pos")))
    totals = (
        first.groupBy(*group)
        .agg(F.sum("held").alias("n"))
        .select(*group, F.explode(places).alias("q"))
        .select(*group, "q.p", "q.pos", F.floor("q.pos").alias("lo"), F.ceil("q.pos").alias("hi"))
    )
    ends = F.array_distinct(F.flatten(F.collect_list(F.array("lo", "hi"))))
    wants = totals.groupBy(*group).agg(
        F.transform(ends, lambda r: F.struct(r.alias("rank"), r.alias("at"))).alias("wants")
    )
    hits = stage(_hits(first.join(wants, group), group), "hits")
    settled = []
    while True:
        done = F.col("least") == F.col("most")
        settled.append(hits.filter(done).select(*group, "rank", F.col("least").alias("value")))
        if hits.filter(~done).isEmpty():
            break
        # One row per open cell: at most two for every group and quantile.
        around = stage(
            hits.filter(~done)
            .groupBy(*group, F.col("least").alias("low"), F.col("most").alias("high"))
            .agg(F.collect_list(F.struct("rank", "at")).alias("wants")),
            "open-cells",
        )
        inside = values.join(around.drop("wants"), group).filter(F.col("x").between(F.col("low"), F.col("high")))
        # The two ends get cells of their own, so every pass makes progress.
        part = F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * (1 << DIGIT))
        counted = _counted(inside.withColumn("cell", part), [*group, "low"])
        hits = stage(_hits(counted.join(around, [*group, "low"]), group), "hits")

    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    ranked = totals.join(found, group).filter((F.col("rank") == F.col("lo")) | (F.col("rank") == F.col("hi")))
    picks = [F.max(F.when(F.col("rank") == F.col(s), F.col("value"))).alias(f"{s}_value") for s in ("lo", "hi")]
    from_lo, from_hi = F.col("hi") - F.col("pos"), F.col("pos") - F.col("lo")
    between = from_lo * F.col("lo_value") + from_hi * F.col("hi_value")
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo_value")).otherwise(between)
    return ranked.groupBy(*group, "p", "pos", "lo", "hi").agg(*picks).select(*group, "p", value.alias("value"))
