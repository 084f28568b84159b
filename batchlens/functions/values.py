"""Missing values and typed views of a column. Missing means NULL or NaN everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def column(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL."""
    c = column(name)
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def number(df: DataFrame, name: str, on_bad: str = "error") -> Column:
    """The column as DOUBLE. Text that is no number raises, or becomes NULL with on_bad='null'."""
    if isinstance(df.schema[name].dataType, DoubleType):
        return present(df, name)
    c = present(df, name)
    value = c.try_cast("double") if on_bad == "null" else c.cast("double")
    if isinstance(df.schema[name].dataType, StringType):
        return F.when(~F.isnan(value), value)
    return value


def text(df: DataFrame, name: str) -> Column:
    """The column as STRING, missing stays NULL."""
    return present(df, name).cast("string")
