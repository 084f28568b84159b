"""SentencePiece, packing and sharding against their libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from llm_data import SF_DIR
from oracle import connect
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from batchlens.llm import packing, sentencepiece_bpe, sharding
from batchlens.llm.queries import QUERIES, word_tokens
from batchlens.llm.word_bpe import WordEncoder

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdehilnorst  ▁\n\t.,_-0123éßñ²中文字😀‍<s>́"


@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.PieceModel(MODEL)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def strange_texts(library, count=4000):
    r = random.Random(1)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    for k in range(count):
        if k % 2:
            yield "".join(r.choice(ALPHABET) for _ in range(r.randrange(40)))
        else:
            yield "".join(r.choice(pieces) for _ in range(r.randrange(1, 7)))


def test_pieces_equal_the_library(model, library, odd_rows):
    for text in [*strange_texts(library), *(t or "" for _, t in odd_rows), " " * 400, "ab" * 300]:
        ids = library.encode(text, add_eos=True)
        assert model.encode(text).tolist() == ids, text
        assert model.decode(np.array(ids, "<i4")) == library.decode(ids), text


def test_decoding_any_ids(model, library):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(4)]) for _ in range(r.randrange(9))]
        assert model.decode(np.array(ids, "<i4")) == library.decode(ids), ids


def test_backtracking_in_one_unit(model, library):
    """A whole text as one unit gives the same pieces as its cut units."""
    for text in strange_texts(library, 400):
        if text and "\n" not in text:
            whole = model.pieces("▁" + text.replace(" ", "▁"))
            cut = [p for u in model._cut.findall("▁" + text.replace(" ", "▁")) for p in model.pieces(u)]
            assert whole == cut


def test_sentencepiece_odd_rows(spark, library, odd_rows, odd_docs, no_docs):
    both = sentencepiece_bpe.decode(sentencepiece_bpe.encode(odd_docs, MODEL), MODEL)
    expected = Counter()
    for i, t in odd_rows:
        ids = library.encode(t or "", add_eos=True)
        expected[(i, tuple(ids), library.decode(ids))] += 1
    assert Counter((r[0], tuple(r[1]), r[2]) for r in both.collect()) == expected
    assert sentencepiece_bpe.decode(sentencepiece_bpe.encode(no_docs, MODEL), MODEL).collect() == []


def test_sentencepiece_query(spark, library):
    expected = Counter()
    for i, t in connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall():
        ids = library.encode(t, add_eos=True)
        shas = (" ".join(map(str, ids)), library.decode(ids))
        expected[(i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in shas))] += 1
    assert Counter(map(tuple, QUERIES["op4_sentencepiece"](spark, SF_DIR).collect())) == expected


# packing


def test_word_ids_equal_the_library(odd_rows):
    library = Tokenizer.from_file(WORDS)
    r = random.Random(4)
    texts = ["".join(r.choice(ALPHABET + "'sIT!?|½५İſΣ\x0b\x1c　\u0085") for _ in range(r.randrange(60))) for _ in range(800)]
    texts += [t or "" for _, t in odd_rows]
    texts += ["<|endoftext|>a <|STARTOFTEXT|>. <|startoftext|>", "Don't WE'LL Q's. 'S' a.. b.", "x" * 300 + "."]
    encoder = WordEncoder(WORDS, cached=500)
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at : at + 50], encoder.encode_all(texts[at : at + 50])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_runs_of_white_space():
    """Pieces longer than the table keeps, of white space only: they have no ids at all."""
    library = Tokenizer.from_file(WORDS)
    blanks = ["\u00a0", "\u3000", "\u2028", "\x0b", "\x0c"]
    texts = [x for b in blanks for x in (b * 100, f"a {b * 100} c", f"a{b * 100}c.", b * 65 + ".", f"{b * 99}. d")]
    encoder = WordEncoder(WORDS)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_letter_runs_need_the_merges_only(monkeypatch):
    """Words of Latin letters, with punctuation behind them or not, do not pass through the whole library."""
    library = Tokenizer.from_file(WORDS)
    letters = "".join(chr(i) for i in range(0x100) if chr(i).isalpha() and chr(i) not in "ªµº")
    marks = [chr(i) for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]
    r = random.Random(8)
    words = [*letters, *("".join(r.choices(letters, k=r.randrange(1, 90))) for _ in range(300))]
    words += [r.choice(words) + "".join(r.choices(marks, k=r.choice([1, 2, 3, 70]))) for _ in range(400)]
    asked = []
    ask = WordEncoder._library
    monkeypatch.setattr(WordEncoder, "_library", lambda self, pieces: asked.extend(pieces) or ask(self, pieces))
    encoder = WordEncoder(WORDS, cached=200)
    for at in range(0, len(words), 40):
        texts = [" ".join(words[at : at + 40]), *words[at : at + 40], ""]
        for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert asked and not [p for p in asked if any(c.isalpha() for c in p)]


def best_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [(f, k) for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits)[1]] -= n
        else:
            free.append(capacity - n)
    return sorted(free)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 10, 64, 100])
    lengths = [r.choice([r.randint(1, capacity), r.randint(1, max(1, capacity // 3))]) for _ in range(r.randrange(400))]
    steps = packing.plan(dict(Counter(lengths)), capacity)
    filled = {}
    for k, (length, rank) in enumerate(zip(steps["length"], steps["rank"])):
        later = [x for x, y in zip(steps["rank"], steps["length"]) if y == length and x > rank]
        number = (min(later) if later else lengths.count(length)) - rank
        for j in range(number):
            bin_no, place = divmod(j, steps["per_bin"][k])
            spot = (steps["first_bin"][k] + bin_no, steps["start"][k] + place * length)
            filled.setdefault(spot[0], []).append((spot[1], length))
    for own in filled.values():
        own.sort()
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    free = sorted(capacity - sum(n for _, n in own) for own in filled.values())
    assert free == best_fit_decreasing(lengths, capacity)


def check_packing(rows, docs, capacity):
    library = Tokenizer.from_file(WORDS)
    expected = Counter()
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            expected[(i, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    found = packing.pack(docs, word_tokens(WORDS), capacity).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    free = sorted(capacity - sum(n for _, n in own) for own in bins.values())
    assert free == best_fit_decreasing([r["length"] for r in found], capacity)


def test_packing_odd_rows(spark, odd_rows, odd_docs, no_docs):
    check_packing(odd_rows, odd_docs, 64)
    assert packing.pack(no_docs, word_tokens(WORDS)).collect() == []


def test_packing_documents(spark):
    rows = connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    check_packing(rows, spark.read.parquet(f"{SF_DIR}/documents.parquet"), 2048)


# sharding


@pytest.mark.parametrize("n", [1, 2, 3, 40, 1000, 1025, 65536])
def test_permutation_and_inverse(n):
    places = sharding.permute(np.arange(n), n)
    assert sorted(places) == list(range(n))
    assert (sharding.restore(places, n) == np.arange(n)).all()
    if n >= 1000:
        assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.15
        assert (sharding.permute(np.arange(n), n, seed=1) != places).mean() > 0.9


def test_sharding_odd_rows(spark, odd_rows, odd_docs, no_docs):
    found = sharding.shard(odd_docs, shards=6).collect()
    sizes = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == sizes
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
    again = sharding.shard(odd_docs.repartition(5), shards=6).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert sharding.shard(no_docs).collect() == []


def test_sharding_query_has_all_shards(spark):
    found = QUERIES["op7_sharding"](spark, SF_DIR)
    counts = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(counts) == 40 and max(counts) - min(counts) <= 1
