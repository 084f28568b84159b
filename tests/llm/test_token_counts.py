"""Edit-aware token counts against encoding the edited text anew."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from llm_data import SF_DIR
from oracle import connect
from pyspark.sql import functions as F

from batchlens.llm import token_counts
from batchlens.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = "abcXY  \n\t'''sdtrevlm0129½²éß中.,!-_ \u0085́😀"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counts():
    return token_counts.PieceCounts(RANKS)


def test_pattern_is_that_of_the_vocabulary():
    assert token_counts.PATTERN == public_tokenizers.PATTERN


def check(tree, text, library):
    assert tree.text() == text
    assert tree.chars == len(text)
    assert tree.tokens == len(library.encode_ordinary(text))
    assert [p for b, _ in tree._blocks for p in b] == tree._counts.pattern.findall(text)
    assert all(b for b, _ in tree._blocks)


@pytest.mark.parametrize("seed", range(8))
def test_edits_equal_encoding_anew(counts, library, seed):
    r = random.Random(seed)
    for _ in range(60):
        text = "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 5, 60, 900])))
        tree = token_counts.TokenTree(text, counts)
        check(tree, text, library)
        for _ in range(12):
            a = r.randrange(len(text) + 1)
            b = min(len(text), a + r.choice([0, 0, 1, 3, 50, 2000]))
            new = "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 0, 1, 4, 40, 700])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            check(tree, text, library)


def test_an_edit_encodes_a_few_pieces_only(counts):
    tree = token_counts.TokenTree("some words of a long text. " * 20_000, counts)
    before = tree.encoded
    tree.edit(250_000, 250_003, "new")
    assert tree.encoded - before < 10


def test_long_runs_meet_again(counts, library):
    for unit in (" ", "a", "'", "\n", " a"):
        text = unit * 3000
        tree = token_counts.TokenTree(text, counts)
        for at, new in ((1500, "x"), (0, " "), (3001, "'l"), (700, "")):
            tree.edit(at, at + 1, new)
            text = text[:at] + new + text[at + 1 :]
            check(tree, text, library)


def applied(text, edits):
    for a, b, new in edits:
        a = min(max(a or 0, 0), len(text))
        b = min(max(b or 0, a), len(text))
        text = text[:a] + (new or "") + text[b:]
    return text


def test_odd_rows(spark, library, odd_rows, odd_docs, no_docs):
    edits = [(3, 9, "what"), (0, 0, None), (None, 4, "x"), (10**6, 10**7, " end"), (5, 2, "!")]
    column = F.array(*[F.struct(*[F.lit(v).cast(t) for v, t in zip(e, ("int", "int", "string"))]) for e in edits])
    found = token_counts.count_with_edits(odd_docs, column, RANKS).collect()
    expected = sorted(
        (i is None, i or 0, len(library.encode_ordinary(t or "")), len(library.encode_ordinary(applied(t or "", edits))), applied(t or "", edits))
        for i, t in odd_rows
    )
    assert sorted((r[0] is None, r[0] or 0, r["n_tokens"], r["n_tokens_edited"], r["text_edited"]) for r in found) == expected
    none = token_counts.count_with_edits(odd_docs, F.lit(None), RANKS).collect()
    assert all(r["n_tokens"] == r["n_tokens_edited"] and r["n_encoded"] == r["n_edits"] == 0 for r in none)
    assert token_counts.count_with_edits(no_docs, column, RANKS).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_kept_trees_take_further_edits(counts, library, seed):
    """A tree that goes through its stored form before each edit equals encoding anew."""
    r = random.Random(100 + seed)
    for _ in range(20):
        text = "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 60, 900, 6000])))
        tree = token_counts.TokenTree(text, counts)
        for _ in range(8):
            tree = token_counts.TokenTree.kept(tree.stored(), counts)
            a = r.randrange(len(text) + 1)
            b = min(len(text), a + r.choice([0, 1, 3, 50, 7000]))
            new = "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 4, 700])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.chars == len(text)
            assert tree.tokens == len(library.encode_ordinary(text))
            kept = tree.stored()
            assert kept["n_pieces"] == len(counts.pattern.findall(text))
            for i in range(len(tree._blocks)):
                tree._opened(i)
            check(tree, text, library)


def test_a_kept_tree_reads_and_encodes_touched_blocks_only(counts):
    row = token_counts.TokenTree("some words of a long text. " * 20_000, counts).stored()
    tree = token_counts.TokenTree.kept(row, counts)
    tree.edit(250_000, 250_003, "new")
    unread = [b for b in tree._blocks if isinstance(b, token_counts.StoredBlock)]
    assert tree.encoded < 10 and len(tree._blocks) - len(unread) <= 3
    assert token_counts.TokenTree("x" * 300 + " y", counts).stored()["lengths"][0] == 4


def test_an_emptied_text_counts_all_it_encodes(counts):
    tree = token_counts.TokenTree("one two three", counts)
    before = tree.encoded
    tree.edit(0, 13, "")
    tree.edit(0, 0, "four five")
    assert (tree.tokens > 0, tree.encoded - before) == (True, 2)


def test_rounds_of_edits_on_kept_trees(spark, library, odd_rows, odd_docs, no_docs, tmp_path):
    rounds = [[(3, 9, "what"), (None, 4, "x")], [(10**6, 10**7, " end"), (5, 2, "!")], []]
    token_counts.keep_trees(odd_docs, RANKS).write.parquet(f"{tmp_path}/0")
    texts = [t or "" for _, t in odd_rows]
    for n, edits in enumerate(rounds):
        made = [F.struct(*[F.lit(v).cast(t) for v, t in zip(e, ("int", "int", "string"))]) for e in edits]
        column = F.array(*made) if made else F.lit(None)
        trees = spark.read.parquet(f"{tmp_path}/{n}")
        counted = token_counts.count_edits(trees, column, RANKS)
        edited = token_counts.edit_trees(trees, column, RANKS)
        edited.write.parquet(f"{tmp_path}/{n + 1}")
        before, texts = texts, [applied(t, edits) for t in texts]
        size = lambda t: len(library.encode_ordinary(t))
        expected = sorted((t, size(t), size(b), len(edits)) for b, t in zip(before, texts))
        found = spark.read.parquet(f"{tmp_path}/{n + 1}").select("text", "n_tokens", "n_tokens_before", "n_edits").collect()
        assert sorted(tuple(r) for r in found) == expected
        assert sorted(r["n_tokens"] for r in counted.collect()) == sorted(e[1] for e in expected)
    empty = token_counts.keep_trees(no_docs, RANKS)
    assert token_counts.edit_trees(empty, F.lit(None), RANKS).collect() == []


def test_query(spark, library):
    docs = connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    edits = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", token_counts.derived_edits().alias("e"))
    edits = {r["doc_id"]: [tuple(e) for e in r["e"]] for r in edits.collect()}
    found = {r["doc_id"]: r for r in QUERIES["op3_token_counts"](spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        assert found[i]["n_tokens"] == len(library.encode_ordinary(text))
        assert found[i]["n_tokens_edited"] == len(library.encode_ordinary(applied(text, edits[i])))
    big = [r for r in found.values() if r["n_pieces"] > 1000]
    assert big and all(r["n_encoded"] < 0.2 * r["n_pieces"] for r in big)
