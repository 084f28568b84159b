"""JSON text of rows, lists and statistics, for exchange with tools that store text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from batchlens.functions.values import column, present
from batchlens.sources.csvs import NA_TOKENS

# from_json turns a bare NaN of a STRING field into this text.
BARE_NAN = '"NaN"'


def row_to_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as one JSON object, missing values as null."""
    fields = F.struct(*[present(df, c).alias(c) for c in columns])
    return F.to_json(fields, {"ignoreNullFields": "false"})


def row_from_json(df: DataFrame, name: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON objects back to typed columns. NaN and text that stands for a missing value become NULL."""
    parsed = df.select(*[column(k) for k in keep], F.from_json(column(name), schema).alias("_row"))
    values = []
    for f in schema.fields:
        c = F.col("_row")[f.name]
        if isinstance(f.dataType, StringType):
            c = F.when(~c.isin(*NA_TOKENS, BARE_NAN), c)
        elif f.dataType.simpleString() in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        values.append(c.alias(f.name))
    return parsed.select(*[column(k) for k in keep], *values)


def list_to_json(c: Column) -> Column:
    return F.to_json(c)


def stats_to_json(stats: Column, top: Column) -> Column:
    """Numeric statistics or value counts of a quality record as JSON text; NULL when there are none."""
    counts = F.map_from_entries(F.transform(top, lambda t: F.struct(t["value"], t["cnt"])))
    return F.when(stats.isNotNull(), F.to_json(stats)).otherwise(
        F.when(F.size(top) > 0, F.to_json(counts))
    )
