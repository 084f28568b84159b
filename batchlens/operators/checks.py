"""Table rules as queries that return the violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from batchlens.functions.values import column
from batchlens.kinds import CATEGORICAL, NUMERIC


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is present but not allowed."""
    return df.filter(~F.col(column).isin(*allowed))


def null_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of the columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no row in the parent."""
    return child.join(parent.select(key), key, "left_anti")


def violations(ledger: DataFrame, dq: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """All rules of the stored tables: (check, key, n)."""

    def found(name, bad, *keys):
        key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        counted = bad.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return counted.select(F.lit(name).alias("check"), "key", "n")

    parts = [
        found("ledger batch_id unique", duplicate_keys(ledger, ["batch_id"]), "batch_id"),
        found("dq key unique", duplicate_keys(dq, ["batch_id", "feature"]), "batch_id", "feature"),
        found("dq value_type domain", outside_domain(dq, "value_type", (NUMERIC, CATEGORICAL)), "batch_id", "feature"),
        found(
            "dq not null",
            null_values(dq, ["batch_id", "feature", "missing_rate", "unique_count", "value_type"]),
            "batch_id",
            "feature",
        ),
        found("dq batch in ledger", orphans(dq, ledger, "batch_id"), "batch_id", "feature"),
    ]
    if rules is not None:
        parts.append(found("rules batch in ledger", orphans(rules, ledger, "batch_id"), "batch_id"))
        parts.append(
            found(
                "rules not null",
                null_values(rules, ["batch_id", "antecedents", "consequents", "support", "confidence", "lift"]),
                "batch_id",
            )
        )
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Guard:
    """Rules that the rows of a batch keep, or the batch is refused; all of them by name.

    rows: condition of a row that breaks the rule. unique: columns whose values together occur once in a batch, rows
    with a NULL among them aside. references: a column whose values, NULL aside, occur in the column of the same name
    of another table.
    """

    rows: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, tuple[str, DataFrame]] = field(default_factory=dict)

    def watch(self, rows: DataFrame, wanted: str) -> tuple[DataFrame, Observation]:
        """The rows with the rules that each of them breaks, and a count of such rows that fills while they are
        written. `wanted` is a column telling which rows count; it goes."""
        broken = F.array_compact(
            F.array(*[F.when(F.col(wanted) & condition, F.lit(name)) for name, condition in self.rows.items()])
        ).cast("array<string>")
        seen = Observation()
        marked = rows.withColumn("__broken", broken).drop(wanted)
        return marked.observe(seen, F.count_if(F.size("__broken") > 0).alias("rows")), seen

    def violations(self, rows: DataFrame, seen: Observation, key: str) -> DataFrame:
        """(key, check, n) over written rows; the marks of `watch` are read only if it counted any."""

        def counted(name: Column, bad: DataFrame) -> DataFrame:
            return bad.groupBy(key, name.alias("check")).agg(F.count(F.lit(1)).alias("n"))

        parts = []
        if seen.get["rows"]:
            parts.append(counted(F.col("rule"), rows.select(key, F.explode("__broken").alias("rule"))))
        for name, columns in self.unique.items():
            whole = rows.select(key, *[column(c) for c in columns]).dropna(subset=list(columns))
            parts.append(counted(F.lit(name), duplicate_keys(whole, [key, *columns])))
        for name, (own, parent) in self.references.items():
            known = parent.select(column(own).alias("value")).distinct()
            values = rows.select(key, column(own).alias("value")).filter("value is not null")
            parts.append(counted(F.lit(name), values.join(known, "value", "left_anti")))
        if not parts:
            return rows.select(key, F.lit("").alias("check"), F.lit(0).cast("long").alias("n")).limit(0)
        return reduce(DataFrame.unionByName, parts)
