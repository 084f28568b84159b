"""CSV directories: files with differing column sets are merged by column name and typed by kind."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from batchlens.functions.values import column, number
from batchlens.kinds import NUMERIC

# Cell texts that count as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# Name of the column that holds what a row has beyond its header.
BEYOND = "_beyond_header"


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """CSV files directly in the folder, in name order; FileNotFoundError when there are none.

    Subfolders are never looked into, whatever their names.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(folder) if system.exists(folder) else []
    names = (s.getPath() for s in found if s.isFile())
    files = sorted(p.toString() for p in names if p.getName().endswith(".csv"))
    if not files:
        raise FileNotFoundError(f"no CSV files in {path}")
    return files


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a file, from its first lines; a repeated name gets a number, a blank one its place."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        text = ""
        while not text.strip() or text.count('"') % 2:
            line = lines.readLine()
            if line is None:
                break
            text = f"{text}\n{line}" if text.strip() else line
    finally:
        lines.close()
    cells = next(csv.reader(io.StringIO(text.removeprefix("\ufeff"))), [])
    names: list[str] = []
    for i, cell in enumerate(cells):
        name, k = cell or f"_c{i}", 0
        while (name if not k else f"{name}.{k}") in names:
            k += 1
        names.append(f"{name}.{k}" if k else name)
    return tuple(names)


def _reader(spark: SparkSession, multiline: bool):
    return spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')


def read_text_csvs(
    spark: SparkSession, path: str, multiline: bool = True, on_bad: str = "error"
) -> DataFrame:
    """All files as STRING columns, merged by name; a column a file lacks is NULL in its rows.

    Files with the same header are read by one scan, so the plan has as many scans as there are
    distinct headers. With multiline=False large files are split between tasks; it needs data
    without line breaks inside quoted cells. A row with more cells than its header raises; with
    on_bad='null' the cells beyond it are left out.
    """
    files = csv_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if not header:
            raise ValueError(f"no header in {file}")
        groups.setdefault(header, []).append(file)
    spellings: dict[str, str] = {}
    for name in (c for header in groups for c in header):
        if spellings.setdefault(name.lower(), name) != name:
            raise ValueError(f"columns {spellings[name.lower()]!r} and {name!r} differ in case only")
    parts = []
    for header, members in groups.items():
        schema = StructType([StructField(c, StringType()) for c in (*header, BEYOND)])
        rows = _reader(spark, multiline).schema(schema).csv(members)
        if on_bad == "error":
            message = F.concat(F.lit("row with more cells than its header: "), F.col(BEYOND))
            # A filter, so that no projection above can leave the check out.
            rows = rows.filter(F.when(F.col(BEYOND).isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
        parts.append(rows.drop(BEYOND))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def blank_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Texts that stand for a missing value become NULL in all STRING columns."""
    out = []
    for f in df.schema.fields:
        c = column(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(~c.isin(*tokens), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def typed(df: DataFrame, kinds: Mapping[str, str], on_bad: str = "error") -> DataFrame:
    """Numeric columns cast to DOUBLE by name; the others stay text."""
    return df.select(
        *[
            (number(df, c, on_bad) if kinds.get(c) == NUMERIC else column(c)).alias(c)
            for c in df.columns
        ]
    )


def read_csvs(
    spark: SparkSession,
    path: str,
    kinds: Mapping[str, str] | None = None,
    *,
    multiline: bool = True,
    on_bad: str = "error",
) -> DataFrame:
    """A CSV folder as one table: merged by name, missing-value texts blanked, numerics cast."""
    df = blank_tokens(read_text_csvs(spark, path, multiline, on_bad))
    return typed(df, kinds or {}, on_bad)
