"""Report over all batches: tables for further use, and the same as lines of text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchlens.functions.texts import fixed, percent, plain, table_row, thousands
from batchlens.kinds import CATEGORICAL, NUMERIC, of_kind
from batchlens.operators import eda, states, trends
from batchlens.plans.update import backfill_states
from batchlens.session import configure, scratch_scope, stage
from batchlens.sources.warehouse import Warehouse

# Numeric columns, the first ones, whose histograms a report holds.
HISTOGRAMS = 12

LINES = "section int, ord string, line string"

# Headings of the report.
DQ_TITLE = "# Data Quality Report"
NO_RECORDS = "No data quality records in the database."
BATCH_HEAD = (
    "## 1. By batch (aggregates)",
    "",
    "| batch_id | n_features | avg missing_rate | avg unique_count |",
    "|----------|------------|------------------|------------------|",
)
FEATURE_HEAD = (
    "## 2. By feature (aggregates)",
    "",
    "| feature | value_type | n_batches | avg missing_rate | min | max | avg unique_count | min | max |",
    "|---------|------------|-----------|------------------|-----|-----|------------------|-----|-----|",
)
EDA_TITLE = "# Automatic EDA"
OVERVIEW_HEAD = (
    "## 1. Overview by column",
    "",
    "| Column | Type | Missing % | Unique count |",
    "|--------|------|-----------|---------------|",
)
NUMERIC_TITLE = "## 2. Numeric features"
CATEGORICAL_TITLE = "## 3. Categorical features (top 10 values)"
VALUE_HEAD = ("| value | count |", "|-------|-------|")
STAT_NAMES = {"p25": "25%", "p50": "50%", "p75": "75%"}


def dq_tables(dq: DataFrame) -> dict[str, DataFrame]:
    """Summary, per-batch series and per-feature aggregates of the quality records."""
    return {
        "dq_summary": trends.summary(dq),
        "dq_by_batch": trends.by_batch(dq),
        "dq_by_feature": trends.by_feature(dq),
    }


def eda_tables(df: DataFrame, kinds: Mapping[str, str]) -> dict[str, DataFrame]:
    """Exploratory tables over all rows, with the data behind the correlation and histogram charts."""
    kinds = eda.known(df, kinds, "error")
    tables = {"eda_summary": eda.summary(df, kinds), "eda_overview": eda.overview(df, kinds)}
    if of_kind(kinds, NUMERIC):
        tables["eda_describe"] = eda.describe(df, kinds)
        tables["eda_correlation"] = eda.correlation(df, kinds)
        tables["eda_histogram"] = eda.histogram(df, kinds, max_columns=HISTOGRAMS)
    if of_kind(kinds, CATEGORICAL):
        tables["eda_top_values"] = eda.top_values(df, kinds)
    return tables


def _fixed_lines(spark: SparkSession, section: int, lines) -> DataFrame:
    return spark.createDataFrame([(section, f"{i:04d}", line) for i, line in enumerate(lines)], LINES)


def _rows(df: DataFrame, section: int | Column, order: Column, line: Column) -> DataFrame:
    section = F.lit(section) if isinstance(section, int) else section
    return df.select(section.alias("section"), order.alias("ord"), line.alias("line"))


def _bullet(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"- **{name}:** "), value.cast("string"))


def _bullets(df: DataFrame, section: int, bullets: list[Column]) -> DataFrame:
    lines = F.posexplode(F.array(*bullets)).alias("i", "line")
    return df.select(lines).select(
        F.lit(section).alias("section"), F.format_string("%04d", "i").alias("ord"), "line"
    )


def dq_lines(dq: DataFrame) -> DataFrame:
    """Quality report as (section, ord, line); one line of content when there are no records."""
    spark = dq.sparkSession
    if dq.isEmpty():
        return _fixed_lines(spark, 0, [DQ_TITLE, "", NO_RECORDS])
    totals = _bullets(
        trends.summary(dq),
        1,
        [
            _bullet("Batches", F.col("batches")),
            _bullet("Features", F.col("features")),
            _bullet("Records", F.col("records")),
        ],
    )
    batches = _rows(
        trends.by_batch(dq),
        3,
        F.col("batch_id"),
        table_row(
            F.col("batch_id"),
            F.col("n_features"),
            fixed(F.col("avg_missing_rate"), 4),
            fixed(F.col("avg_unique_count"), 1),
        ),
    )
    features = _rows(
        trends.by_feature(dq),
        5,
        F.col("feature"),
        table_row(
            F.col("feature"),
            F.col("value_type"),
            F.col("n_batches"),
            *[fixed(F.col(f"{f}_missing_rate"), 4) for f in ("avg", "min", "max")],
            fixed(F.col("avg_unique_count"), 1),
            F.col("min_unique_count"),
            F.col("max_unique_count"),
        ),
    )
    parts = [
        _fixed_lines(spark, 0, [DQ_TITLE, "", "## Summary", ""]),
        totals,
        _fixed_lines(spark, 2, ["", "---", "", *BATCH_HEAD]),
        batches,
        _fixed_lines(spark, 4, ["", *FEATURE_HEAD]),
        features,
        _fixed_lines(spark, 6, [""]),
    ]
    return reduce(DataFrame.unionByName, parts)


def eda_lines(tables: Mapping[str, DataFrame], kinds: Mapping[str, str]) -> DataFrame:
    """Exploratory report as (section, ord, line) from its tables."""
    spark = tables["eda_summary"].sparkSession
    rank = lambda c: F.format_string("%04d", c)
    parts = [
        _fixed_lines(spark, 10, ["", "---", "", EDA_TITLE, "", "## Summary", ""]),
        _bullets(
            tables["eda_summary"],
            11,
            [_bullet("Rows", thousands(F.col("n_rows"))), _bullet("Columns", F.col("n_columns"))],
        ),
        _fixed_lines(spark, 12, ["", *OVERVIEW_HEAD]),
        _rows(
            tables["eda_overview"],
            13,
            rank("ord"),
            table_row(
                F.col("feature"),
                F.col("value_type"),
                percent(F.col("missing_pct") / 100.0),
                F.col("unique_count"),
            ),
        ),
        _fixed_lines(spark, 14, [""]),
    ]
    nums, cats = of_kind(kinds, NUMERIC), of_kind(kinds, CATEGORICAL)
    if nums:
        head = "| " + " | ".join(["index", *[c.replace("|", "\\|") for c in nums]]) + " |"
        parts.append(_fixed_lines(spark, 15, [NUMERIC_TITLE, "", head, "|" + "---|" * (len(nums) + 1)]))
        stats = F.array(
            *[
                F.struct(
                    F.lit(i).alias("i"),
                    F.lit(STAT_NAMES.get(s, s)).alias("stat"),
                    plain(F.col(s)).alias("value"),
                )
                for i, s in enumerate(eda.DESCRIBE)
            ]
        )
        cells = tables["eda_describe"].select("ord", F.explode(stats).alias("s")).select("ord", "s.*")
        by_stat = cells.groupBy("i", "stat").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("ord", "value"))), lambda c: c["value"]).alias("values")
        )
        line = F.concat(F.lit("| "), F.array_join(F.concat(F.array("stat"), "values"), " | "), F.lit(" |"))
        parts += [_rows(by_stat, 16, rank("i"), line), _fixed_lines(spark, 17, [""])]
    if cats:
        place = F.coalesce(*[F.when(F.col("feature") == c, 21 + 2 * i) for i, c in enumerate(cats)])
        for i, c in enumerate(cats):
            lead = ["" if i else CATEGORICAL_TITLE, *([] if i else [""]), f"### {c}", "", *VALUE_HEAD]
            parts.append(_fixed_lines(spark, 20 + 2 * i, lead))
        row = table_row(F.col("value"), F.col("cnt"))
        parts.append(_rows(tables["eda_top_values"], place, rank("rank"), row))
    return reduce(DataFrame.unionByName, parts)


def write_lines(lines: DataFrame, path: str) -> None:
    """The report as one text file. It has a few lines per batch and column, whatever the data size."""
    ordered = lines.repartition(1).sortWithinPartitions("section", "ord")
    ordered.select("line").write.mode("overwrite").text(path)


def write_report(warehouse: Warehouse, kinds: Mapping[str, str], path: str) -> list[str]:
    """Write the report below path: text/ and one Parquet table per part; returns the table names.

    The quality part is always written, the exploratory part when rows are stored. That part is made from the states
    of the batches, so only batches that are new, or have new rows, are read. Intermediate tables are gone when it ends.
    """
    with scratch_scope(configure(warehouse.spark)):
        return _write_report(warehouse, kinds, path)


def _write_report(warehouse: Warehouse, kinds: Mapping[str, str], path: str) -> list[str]:
    dq = warehouse.dq()
    tables = dq_tables(dq)
    lines = dq_lines(dq)
    # The columns of the rows, which are not read.
    columns = warehouse.raw()
    if len(columns.columns) > 1:
        own = eda.known(columns, kinds, "error")
        backfill_states(warehouse, own)
        n_rows = warehouse.ledger().agg(F.sum("n_rows")).first()[0]
        made = states.tables(*warehouse.states(), own, n_rows, HISTOGRAMS)
        found = {name: stage(t, name) for name, t in made.items()}
        tables.update(found)
        lines = lines.unionByName(eda_lines(found, own))
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    write_lines(lines, f"{path.rstrip('/')}/text")
    return list(tables)
