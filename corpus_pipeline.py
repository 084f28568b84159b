"""A training corpus from raw documents: each stage is one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm import toxicity
from batchlens.llm.common import crc_mod, table
from batchlens.llm.exact_dedup import exact_duplicates
from batchlens.llm.jaccard_join import jaccard_components
from batchlens.llm.packing import pack
from batchlens.llm.queries import word_tokens
from batchlens.llm.repeats import without_repeats
from batchlens.session import stage


def _digest(docs: DataFrame) -> Column:
    return F.sha2(F.coalesce(docs["text"], F.lit("")), 256)


def _one_row_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row for each kept (doc_id, digest of the text).

    The decision is about rows, not ids, which may be NULL or repeat. Rows that agree in both fold to the one whose
    other columns, as JSON, have the least digest, before they move, so no group is gathered. Columns keep to
    themselves inside a struct, so their names and types are free.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    others = [docs[c].alias(n) for c, n in names.items() if c not in ("doc_id", "text")]
    order = F.sha2(F.to_json(F.struct(*others)), 256) if others else F.lit("")
    keyed = docs.select(
        F.struct(docs["doc_id"].alias("doc_id"), _digest(docs).alias("digest")).alias("key"),
        F.struct(*[docs[c].alias(n) for c, n in names.items()]).alias("row"),
        order.alias("order"),
    )
    folded = keyed.groupBy("key").agg(F.min_by("row", "order").alias("row"))
    wanted = kept.select(F.struct("doc_id", "digest").alias("key")).distinct()
    chosen = folded.join(wanted, "key", "left_semi")
    return chosen.select(*(F.col(f"row.{n}").alias(c) for c, n in names.items()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. NULL and empty texts stay, as do all columns; labels of NULL ids are
    not learned from."""
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.clean(docs, machine)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one with the largest id; a NULL text equals an empty one."""
    found = exact_duplicates(docs.select("doc_id", "text")).filter("kept")
    return _one_row_each(docs, found.select("doc_id", F.col("text_sha256").alias("digest")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents one row stays: the smallest id, NULL last, then the smallest digest of the text.

    Documents go by (id is NULL, id, digest) in the join, so that its component ids tell rows of one id apart. Texts
    without words link with nothing and stay.
    """
    own = docs.select("doc_id", "text")
    row = F.struct(F.isnull("doc_id").alias("missing"), "doc_id", _digest(own).alias("digest"))
    found = jaccard_components(own.select(row.alias("row"), "text"), id_col="row")
    return _one_row_each(docs, found.filter(F.col("row") == F.col("component_id")).select("row.doc_id", "row.digest"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; the character count, if there is one, follows the text. A text
    of which nothing is left stays, empty; NULL ids count as the latest."""
    cut = without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens; NULL and empty texts pack their end id alone."""
    return pack(docs, word_tokens(), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("packing", pack_sequences),
]

#: SQL cannot tokenise or fit the classifier; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
