"""The monitored table and its results as partitioned Parquet tables below one folder.

raw/ingest_id=/batch_id=   rows, written once per batch
claims/                    one file per batch, created by the one ingest that stores it
commits/                   one row per ingest and batch, appended after rows and claims are in place
refused/                   one row per batch, ingest and check that kept the batch from being stored
arrivals/                  rows of a stream whose months are still open (see streaming.closing)
dq/batch_id=               quality records, replaced per batch
rules/batch_id=            association rules, replaced per batch
mined/                     one row per mining and batch: the state mined and how many rules it gave
values/batch_id=           value counts, replaced per batch
pairs/batch_id=            co-moments of the numeric columns, replaced per batch
counted/                   one row per count and batch: the state counted, with the kinds of its columns

A batch exists when it has a commit. Rows of an ingest that died before its commit are never read. A claim names rows
that are written in full: should its ingest die before the commit, the next one commits them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StringType, StructField, StructType

from batchlens.functions.values import column
from batchlens.operators.batching import BATCH, rows_per_batch
from batchlens.operators.checks import Guard
from batchlens.operators.states import PAIR_SCHEMA, STATE_SCHEMA
from batchlens.session import stage
from batchlens.sources.claims import delete_folder, exists, names_in, publish, read_file

COMMIT_SCHEMA = (
    "batch_id string, ingest_id string, n_rows bigint, fields string, request string, own boolean, created_at timestamp"
)
REFUSED_SCHEMA = "batch_id string, ingest_id string, check string, n bigint, created_at timestamp"
DQ_SCHEMA = (
    "feature string, value_type string, n_rows bigint, missing_rate double, unique_count bigint, "
    "stats struct<min:double,max:double,mean:double,std:double>, "
    "top array<struct<value:string,cnt:bigint>>, batch_id string"
)
STORED_RULE_SCHEMA = (
    "antecedents array<string>, consequents array<string>, support double, confidence double, "
    "lift double, run_id string, created_at timestamp, batch_id string"
)
RULE_COLUMNS = (BATCH, "antecedents", "consequents", "support", "confidence", "lift")
COUNTED_SCHEMA = "batch_id string, n_rows bigint, kinds string, run_id string, created_at timestamp"
MINED_SCHEMA = "batch_id string, n_rows bigint, n_rules bigint, run_id string, created_at timestamp"
#: Column of written rows that no batch takes: the batch they came with.
UNWANTED = "__unwanted"


@dataclass(frozen=True)
class Saved:
    """Outcome of an ingest. Late rows belong to batches stored before; undated rows have no time; refused are
    batches that break a rule, with the number of violations by rule."""

    inserted: int
    late_rows: dict[str, int] = field(default_factory=dict)
    undated_rows: int = 0
    refused: dict[str, dict[str, int]] = field(default_factory=dict)


def pending(ledger: DataFrame, results: DataFrame) -> DataFrame:
    """Batches of the ledger without results."""
    return ledger.join(results.select(BATCH).distinct(), BATCH, "left_anti")


def split_late(df: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of new batches, and rows of batches the ledger already holds.

    The batch ids, one per month, are written first, so the rows are not shuffled for the joins.
    """
    known = stage(ledger.select(BATCH), "known")
    return df.join(known, BATCH, "left_anti"), df.join(known, BATCH, "left_semi")


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def _path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _add(self, rows: DataFrame, table: str) -> None:
        """Append few rows, in a folder of their own: jobs that append to one folder at a time disturb each other."""
        now = F.current_timestamp().alias("created_at")
        rows.select("*", now).coalesce(1).write.parquet(f"{self._path(table)}/{uuid.uuid4().hex}")

    def _read(self, table: str, schema: str | StructType, added: bool = False) -> DataFrame:
        """A table with a declared schema; empty when nothing was written yet."""
        try:
            reader = self.spark.read.schema(schema).option("recursiveFileLookup", added)
            return reader.parquet(self._path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # --- ledger and raw rows

    def commits(self) -> DataFrame:
        return self._read("commits", COMMIT_SCHEMA, added=True)

    def ledger(self) -> DataFrame:
        """(batch_id, n_rows, created_at), one row per stored batch. A commit that was completed for another ingest may
        be there twice."""
        once = self.commits().groupBy(BATCH, "ingest_id").agg(
            F.max("n_rows").alias("n_rows"), F.min("created_at").alias("created_at")
        )
        return once.groupBy(BATCH).agg(F.sum("n_rows").alias("n_rows"), F.min("created_at").alias("created_at"))

    def list_batches(self) -> DataFrame:
        return self.ledger().orderBy(BATCH)

    def raw(self, batch_ids: Sequence[str] | None = None) -> DataFrame:
        """Rows of all or of the given batches with their batch_id; only their partitions are read.

        The columns come from the commits, so files are not opened for their schema. Ingests with
        different columns are merged by name: each layout is read as it was written, by one scan, and
        a column whose type differs between them becomes DOUBLE if all are numbers, STRING otherwise.
        """
        commits = self.commits()
        if batch_ids is not None:
            commits = commits.filter(F.col(BATCH).isin(list(batch_ids)))
        # One entry per distinct column set, not per batch.
        layouts = [r.fields for r in commits.select("fields").distinct().orderBy("fields").collect()]
        if not layouts:
            return self.spark.createDataFrame([], f"{BATCH} string")
        schemas = {ddl: StructType.fromDDL(ddl) for ddl in layouts}
        types: dict[str, set] = {}
        for f in (f for schema in schemas.values() for f in schema.fields):
            types.setdefault(f.name, set()).add(f.dataType)
        tags = [StructField("ingest_id", StringType()), StructField(BATCH, StringType())]
        parts = []
        for ddl, schema in schemas.items():
            valid = commits.filter(F.col("fields") == ddl).select("ingest_id", BATCH)
            paths = self._paths_of(valid) if len(layouts) > 1 else [self._path("raw")]
            source = self.spark.read.option("basePath", self._path("raw")).schema(StructType([*schema.fields, *tags]))
            rows = source.parquet(*paths)
            if batch_ids is not None:
                rows = rows.filter(F.col(BATCH).isin(list(batch_ids)))
            kept = rows.join(valid, ["ingest_id", BATCH], "left_semi")
            cells = [column(f.name).cast(_common(types[f.name])).alias(f.name) for f in schema.fields]
            parts.append(kept.select(BATCH, *cells))
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return merged.select(BATCH, *[column(c) for c in types])

    def _paths_of(self, valid: DataFrame) -> list[str]:
        """Folders of the ingests, of which there is one per run or micro-batch."""
        return sorted(f"{self._path('raw')}/ingest_id={r[0]}" for r in valid.select("ingest_id").distinct().collect())

    def load_batch(self, batch_id: str) -> DataFrame:
        """Rows of one batch without the tag; ValueError when it is not stored."""
        if self.commits().filter(F.col(BATCH) == batch_id).isEmpty():
            raise ValueError(f"batch {batch_id!r} is not stored")
        return self.raw([batch_id]).drop(BATCH)

    def save(
        self, df: DataFrame, *, ingest_id: str | None = None, late: str = "drop", guard: Guard | None = None
    ) -> Saved:
        """Store all batches of df that are not stored yet; returns their number and what was left out.

        Rows of stored batches are dropped, or with late='append' added to their batch, whose results
        then count as outdated. Repeating an ingest_id that was committed does nothing. A batch that breaks
        a rule of the guard is not stored, and may come again.

        The source is read once: all rows are written to the folder of the ingest, those that will not be
        stored without their cells, and counted there. Several writers may save at the same time: each new
        batch goes to the one that creates its claim; for the others its rows are late.
        """
        if late not in ("drop", "append"):
            raise ValueError(f"late must be 'drop' or 'append', not {late!r}")
        request = ingest_id or uuid.uuid4().hex
        done = F.coalesce("request", "ingest_id") == request
        if ingest_id is not None and not self.commits().filter(done & F.coalesce("own", F.lit(True))).isEmpty():
            return Saved(0)
        committed = {r[BATCH] for r in self.commits().select(BATCH).distinct().collect()}
        claimed = set(self._claimed())
        stored = committed | claimed
        # A request that comes again has rows of its first try.
        folder = f"{request}-{uuid.uuid4().hex}" if exists(self.spark, self._ingest(request)) else request
        arrived, refused = self._write(df, folder, stored if late == "drop" else set(), guard)
        undated = arrived.pop(None, 0)
        fields = _ddl(StructType([f for f in df.schema.fields if f.name != BATCH]))
        record = lambda b: {BATCH: b, "ingest_id": folder, "n_rows": arrived[b], "fields": fields, "request": request}
        new = [b for b in sorted(arrived) if b not in stored and b not in refused]
        won = [b for b in new if publish(self.spark, self._claim(b), json.dumps(record(b)))]
        # Batches that another ingest claimed and did not commit yet, as it runs still or died.
        others = [json.loads(read_file(self.spark, self._claim(b))) for b in sorted((claimed | set(new)) - committed - set(won))]
        again = {c[BATCH] for c in others if c["request"] == request}
        late_rows = {b: n for b, n in sorted(arrived.items()) if b not in won and b not in refused and b not in again}
        kept = won + ([b for b in late_rows] if late == "append" else [])
        self._commit([record(b) for b in kept], [c for c in others if c[BATCH] in arrived])
        self._drop_folders(folder, kept, arrived)
        return Saved(len(won) + len(again & set(arrived)), late_rows, undated, refused)

    def save_batch(self, batch_id: str, df: DataFrame) -> bool:
        """Store one batch; False when it is stored already, in which case nothing is written."""
        tagged = df.withColumn(BATCH, F.lit(batch_id))
        if self.save(tagged).inserted == 1:
            return True
        if not df.isEmpty() or not self.commits().filter(F.col(BATCH) == batch_id).isEmpty():
            return False
        # A batch without rows is stored as well: its commit says so.
        folder = uuid.uuid4().hex
        tagged.limit(0).write.partitionBy(BATCH).parquet(self._ingest(folder))
        empty = {BATCH: batch_id, "ingest_id": folder, "n_rows": 0, "fields": _ddl(df.schema), "request": folder}
        if not publish(self.spark, self._claim(batch_id), json.dumps(empty)):
            return False
        self._commit([empty], [])
        return True

    def refused(self) -> DataFrame:
        """(batch_id, ingest_id, check, n, created_at) of the batches that were not stored."""
        return self._read("refused", REFUSED_SCHEMA, added=True)

    def _ingest(self, folder: str) -> str:
        return f"{self._path('raw')}/ingest_id={folder}"

    def _claim(self, batch_id: str) -> str:
        return f"{self._path('claims')}/{quote(batch_id, safe='')}"

    def _claimed(self) -> list[str]:
        return [unquote(name) for name in names_in(self.spark, self._path("claims"))]

    def _write(self, df: DataFrame, folder: str, known: set[str], guard: Guard | None):
        """Write the rows to the folder of the ingest; returns rows by batch, and violations by batch and rule.

        Rows of known batches and undated rows keep nothing but their batch, so that they are counted with the others.
        They go to the folder of undated rows, their batch in a column of its own: empty rows shrink to almost nothing
        in a shuffle, so a task may get any number of them, and it must not need a writer per batch, or a sort, for them.
        """
        path = self._ingest(folder)
        wanted = F.col(BATCH).isNotNull() & ~F.col(BATCH).isin(sorted(known))
        cells = [F.when(wanted, column(f.name)).alias(f.name) for f in df.schema.fields if f.name != BATCH]
        rows, broken = df.select(BATCH, *cells), None
        if guard is not None:
            rows, broken = guard.watch(df.select(BATCH, *cells, wanted.alias("__wanted")), "__wanted")
        # Files per batch, with a batch too large for one task split between several.
        dealt = rows.hint("rebalance", BATCH)
        apart = {BATCH: F.when(wanted, F.col(BATCH)), UNWANTED: F.when(~wanted, F.col(BATCH)).cast("string")}
        dealt.withColumns(apart).write.partitionBy(BATCH).parquet(path)
        tag = StructField(BATCH, StringType())
        written = self.spark.read.schema(StructType([StructField(UNWANTED, StringType()), tag])).parquet(path)
        batch = F.coalesce(BATCH, UNWANTED).alias(BATCH)
        arrived = {r[BATCH]: r.n_rows for r in rows_per_batch(written.select(batch)).collect()}
        if guard is None:
            return arrived, {}
        back = self.spark.read.schema(StructType([*[f for f in rows.schema.fields if f.name != BATCH], tag])).parquet(path)
        refused: dict[str, dict[str, int]] = {}
        found = guard.violations(back.filter(F.col(BATCH).isNotNull() & ~F.col(BATCH).isin(sorted(known))), broken, BATCH)
        # One row per batch and rule.
        for r in found.orderBy(BATCH, "check").collect():
            refused.setdefault(r[BATCH], {})[r["check"]] = r["n"]
        if refused:
            marks = [(b, folder, c, n) for b, checks in refused.items() for c, n in checks.items()]
            named = self.spark.createDataFrame(marks, "batch_id string, ingest_id string, check string, n bigint")
            self._add(named, "refused")
        return arrived, refused

    def _commit(self, own: list[dict], others: list[dict]) -> None:
        """Append one row per batch of this ingest, and for claims of other ingests that lack their commit."""
        entries = [{**c, "own": True} for c in own] + [{**c, "own": False} for c in others]
        if not entries:
            return
        names = (BATCH, "ingest_id", "n_rows", "fields", "request", "own")
        rows = self.spark.createDataFrame(
            [tuple(e[n] for n in names) for e in entries],
            "batch_id string, ingest_id string, n_rows bigint, fields string, request string, own boolean",
        )
        self._add(rows, "commits")

    def _drop_folders(self, folder: str, kept: list[str], arrived: dict[str, int]) -> None:
        """Delete what an ingest wrote and did not commit; nobody reads it."""
        path = self._ingest(folder)
        if not kept:
            delete_folder(self.spark, path)
            return
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for batch in [b for b in arrived if b not in kept]:
            delete_folder(self.spark, f"{path}/{escape(BATCH, batch)}")
        delete_folder(self.spark, f"{path}/{escape(BATCH, None)}")

    # --- results

    def _replace(self, df: DataFrame, table: str, batches: int) -> None:
        """Replace the rows of the batches in df; other batches stay. One file per batch."""
        tasks = max(1, min(batches, self.spark.sparkContext.defaultParallelism))
        df.repartition(tasks, BATCH).write.partitionBy(BATCH).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(self._path(table))

    def save_dq(self, dq: DataFrame, batches: int = 1) -> None:
        """Replace the quality records of the batches in dq; `batches` is their number, if known."""
        self._replace(dq, "dq", batches)

    def dq(self) -> DataFrame:
        return self._read("dq", DQ_SCHEMA).select(
            BATCH, "feature", "value_type", "n_rows", "missing_rate", "unique_count", "stats", "top"
        )

    def list_dq(self) -> DataFrame:
        return self.dq().orderBy(BATCH, "feature")

    def save_rules(self, rules: DataFrame, batch_ids: Sequence[str]) -> None:
        """Replace the rules of the given batches, also of those that now have none."""
        run = uuid.uuid4().hex
        tagged = rules.withColumn("run_id", F.lit(run)).withColumn("created_at", F.current_timestamp())
        self._replace(tagged, "rules", len(batch_ids))
        counts = (
            self._all_rules()
            .filter(F.col(BATCH).isin(list(batch_ids)) & (F.col("run_id") == run))
            .groupBy(BATCH)
            .agg(F.count(F.lit(1)).alias("n_rules"))
        )
        mined = self.ledger().filter(F.col(BATCH).isin(list(batch_ids)))
        marks = mined.join(counts, BATCH, "left").select(
            BATCH,
            "n_rows",
            F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"),
            F.lit(run).alias("run_id"),
        )
        self._add(marks, "mined")

    def _all_rules(self) -> DataFrame:
        return self._read("rules", STORED_RULE_SCHEMA)

    def mined(self) -> DataFrame:
        """Latest completed mining of each batch."""
        latest = F.max_by(F.struct("n_rows", "n_rules", "run_id"), "created_at").alias("m")
        return self._read("mined", MINED_SCHEMA, added=True).groupBy(BATCH).agg(latest).select(BATCH, "m.*")

    def rules(self) -> DataFrame:
        """Rules of the latest completed mining of each batch."""
        latest = self.mined().select(BATCH, "run_id")
        kept = self._all_rules().join(latest, [BATCH, "run_id"], "left_semi")
        return kept.select(*RULE_COLUMNS)

    # --- states for tables over all batches

    def save_states(self, values: DataFrame, pairs: DataFrame, kinds: Mapping[str, str], batch_ids: Sequence[str]) -> None:
        """Replace the states of the given batches. A batch with many distinct values is written by several tasks."""
        run = uuid.uuid4().hex
        for table, df in (("values", values), ("pairs", pairs)):
            df.withColumn("run_id", F.lit(run)).hint("rebalance", BATCH).write.partitionBy(BATCH).mode(
                "overwrite"
            ).option("partitionOverwriteMode", "dynamic").parquet(self._path(table))
        current = self.ledger().filter(F.col(BATCH).isin(list(batch_ids)))
        marks = current.select(
            BATCH,
            "n_rows",
            F.lit(json.dumps(dict(kinds))).alias("kinds"),
            F.lit(run).alias("run_id"),
        )
        self._add(marks, "counted")

    def counted(self) -> DataFrame:
        """Latest completed count of each batch."""
        latest = F.max_by(F.struct("n_rows", "kinds", "run_id"), "created_at").alias("m")
        return self._read("counted", COUNTED_SCHEMA, added=True).groupBy(BATCH).agg(latest).select(BATCH, "m.*")

    def pending_states(self, kinds: Mapping[str, str]) -> list[str]:
        """Stored batches whose current rows are not counted, or with other kinds of their columns, in order."""
        # One row per batch.
        done = {r[BATCH]: r for r in self.counted().collect()}

        def current(batch) -> bool:
            mark = done.get(batch[BATCH])
            return bool(mark) and mark.n_rows == batch.n_rows and json.loads(mark.kinds).items() <= dict(kinds).items()

        return [b[BATCH] for b in self.list_batches().collect() if not current(b)]

    def states(self) -> tuple[DataFrame, DataFrame]:
        """(values, pairs) of the latest completed count of each batch."""
        latest = self.counted().select(BATCH, "run_id")
        found = []
        for table, schema in (("values", STATE_SCHEMA), ("pairs", PAIR_SCHEMA)):
            rows = self._read(table, f"{schema}, run_id string, batch_id string")
            found.append(rows.join(latest, [BATCH, "run_id"], "left_semi").drop("run_id"))
        return found[0], found[1]

    def pending_dq(self) -> list[str]:
        """Stored batches without quality records of their current rows, in order."""
        done = self.dq().select(BATCH, "n_rows").distinct()
        left = self.ledger().join(done, [BATCH, "n_rows"], "left_anti")
        return [r[0] for r in left.select(BATCH).orderBy(BATCH).collect()]

    def pending_rules(self, retry_empty: bool = True) -> list[str]:
        """Stored batches to be mined, in order; batches that gave no rules count with retry_empty."""
        done = self.mined()
        if retry_empty:
            done = done.filter(F.col("n_rules") > 0)
        left = self.ledger().join(done.select(BATCH, "n_rows"), [BATCH, "n_rows"], "left_anti")
        return [r[0] for r in left.select(BATCH).orderBy(BATCH).collect()]


def _common(types: set) -> DataType:
    """The type that values of all the types can be read as."""
    if len(types) == 1:
        return next(iter(types))
    return DoubleType() if all(isinstance(t, NumericType) for t in types) else StringType()


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
