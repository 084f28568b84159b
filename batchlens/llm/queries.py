"""Registered queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm import quality as quality_rules
from batchlens.llm import toxicity
from batchlens.llm.collisions import near_duplicates
from batchlens.llm.common import crc_mod, table
from batchlens.llm.exact_dedup import exact_duplicates
from batchlens.llm.jaccard_join import jaccard_components
from batchlens.llm.packing import pack
from batchlens.llm.prefix_trie import prefix_trie, rebuilt, turns_of
from batchlens.llm.repeats import remove_repeats
from batchlens.llm.rtree import hard_negatives
from batchlens.llm.sentencepiece_bpe import decode, encode
from batchlens.llm.sharding import shard
from batchlens.llm.token_counts import count_edits, derived_edits, keep_trees
from batchlens.llm.topk import top_k
from batchlens.llm.word_bpe import word_encoder
from batchlens.session import stage

TOKENIZERS = "/opt/tokenizers"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle_words=5)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after four edits of its kept tree."""
    ranks = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    trees = stage(keep_trees(table(spark, sf_dir, "documents"), ranks), "token-trees")
    return count_edits(trees, derived_edits(), ranks).select(
        "doc_id",
        F.col("n_tokens_before").alias("n_tokens"),
        F.col("n_pieces_before").alias("n_pieces"),
        "n_edits",
        F.col("n_tokens").alias("n_tokens_edited"),
        "n_encoded",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    both = decode(encode(table(spark, sf_dir, "documents"), model), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    predicted = (F.col("score") >= quality_rules.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"), "kept_sha256"
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=40)


def word_tokens(path: str = f"{TOKENIZERS}/word_bpe_49k.json"):
    return lambda: word_encoder(path).encode_all


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_tokens(), capacity=2048)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.score(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(turns_of(table(spark, sf_dir, "conversations"))))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality": op5_quality,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_sharding": op7_sharding,
    "op8_packing": op8_packing,
    "op9_topk": op9_topk,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
             g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)""",
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
        p AS (
            SELECT * FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
               s.score AS negative_score, row_number() OVER (
                   PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
         AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        QUALIFY rank <= 10""",
    "op12_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        k AS (
            -- crc32 of the decimal number, bit by bit.
            SELECT DISTINCT c, c - c % 5 AS base, xor(4294967295, list_reduce(
                [4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')],
                lambda crc, x: list_reduce([xor(crc, x)] || [0::BIGINT FOR i IN range(8)],
                    lambda r, i: xor(r // 2, 3988292384 * (r % 2))))) % 9 AS h
            FROM t),
        r AS (
            SELECT k.c, 0 AS part, t.pos, t.role, t.text FROM k JOIN t ON t.c = k.base AND t.pos <= k.h
            UNION ALL
            SELECT k.c, 1, t.pos, t.role, t.text FROM k JOIN t ON t.c = k.c AND t.pos > k.h),
        w AS (
            SELECT k.c, coalesce(l.turns, []) AS turns FROM k LEFT JOIN (
                SELECT c, list({'role': role, 'text': text} ORDER BY part, pos) AS turns FROM r GROUP BY c) l
            ON k.c = l.c),
        m AS (SELECT c, turns[1:d] AS node, d, len(turns) = d AS ends
              FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM w)),
        n AS (
            SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ended,
                   CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(node[d].text) END AS saved
            FROM m GROUP BY node, d),
        f AS (
            SELECT n.*, p.conv_id AS parent_conv_id, (
                SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.node[1:n.d] = n.node) AS n_children
            FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.node = n.node[1:p.d])
        SELECT a.conv_id, a.d AS depth, any_value(a.parent_conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs,
               any_value(a.n_children) AS n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
               sum(b.saved)::BIGINT AS saved_tokens, sha256(any_value(a.ended)) AS ends_sha256
        FROM f a JOIN f b ON b.d >= a.d AND b.node[1:a.d] = a.node GROUP BY a.conv_id, a.d""",
    "op13_embedding_dedup": """
        WITH RECURSIVE u AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x FOR x IN embedding IF x <> 0]) > 0),
        l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            AND list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
                  UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
        SELECT a AS vec_id, min(b) AS component_id, a = min(b) AS kept,
               coalesce(any_value(n), 0)::BIGINT AS n_links
        FROM reach LEFT JOIN (SELECT a AS la, count(*) AS n FROM l GROUP BY a) ON a = la GROUP BY a""",
}
