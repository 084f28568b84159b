"""Number formatting and table rows of the text report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(c: Column, digits: int) -> Column:
    """A number with so many decimals. A value exactly between two texts takes the even one.

    Only multiples of 1/2**(digits + 1) can lie there; the formatter alone would round them up.
    """
    x = c.cast("double")
    steps = x * float(2 ** (digits + 1))
    between = F.when(steps == F.floor(steps), F.bround(x, digits)).otherwise(x)
    return F.format_string(f"%.{digits}f", between)


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def percent(rate: Column) -> Column:
    """A rate as a percentage with two decimals."""
    return F.concat(fixed(rate * 100.0, 2), F.lit("%"))


def plain(c: Column, digits: int = 4) -> Column:
    """A rounded number without trailing zeros, but with at least one decimal; NULL is nan."""
    return F.coalesce(F.regexp_replace(fixed(c, digits), r"(\.\d+?)0+$", "$1"), F.lit("nan"))


def table_row(*cells: Column) -> Column:
    """Cells as one row of a text table, bars inside a cell escaped."""
    safe = [F.replace(c.cast("string"), F.lit("|"), F.lit("\\|")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |"))
