"""Token ids of whole texts with a word-level BPE tokenizer file.

The tokenizer drops white space and never lets a token span it, so a text is cut at ASCII white space, and the
ids of a piece are the same wherever it stands. The different pieces of some texts are looked up in a bounded table;
the library encodes those that are missing, many in one call. `tests/llm` compares whole texts with the library.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from batchlens.llm.common import hold_tables

#: Pieces kept at a time; when full the table is emptied and filled anew.
CACHED_PIECES = 1_000_000
#: Longer pieces are encoded but not kept.
LONGEST_KEPT = 64
#: Letters that are composed and have one small letter each, and ASCII punctuation behind them, apostrophes aside.
LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Texts -> ids as little-endian unsigned 32-bit bytes, without special ids added."""

    def __init__(self, tokenizer_path: str, cached: int = CACHED_PIECES):
        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._merge = self._tokenizer.model.tokenize
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._as_bytes = {i: byte_level.pre_tokenize_str(chr(i))[0][0] for i in range(0xC0, 0x100)}
        self._packed = [i.to_bytes(4, "little") for i in range(self._tokenizer.get_vocab_size())]
        self._cached = cached
        self._known: dict[str, bytes] = {}

    def _library(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, from one call: a token belongs to the piece in which it starts."""
        joined = " ".join(pieces)
        if not unicodedata.is_normalized("NFC", joined):
            return [
                np.array(self._tokenizer.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in pieces
            ]
        coded = self._tokenizer.encode(joined, add_special_tokens=False)
        ids = np.array(coded.ids, "<u4")
        ends = np.cumsum([len(p) + 1 for p in pieces])
        last = np.searchsorted([start for start, _ in coded.offsets], ends)
        first = np.concatenate([[0], last[:-1]])
        return [ids[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]

    def _run(self, letters: str) -> bytes:
        """Ids of small letters, which are one run: only the merges of the model are left to do."""
        packed = self._packed
        run = letters if letters.isascii() else letters.translate(self._as_bytes)
        return b"".join([packed[token.id] for token in self._merge(run)])

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces. Punctuation behind letters is always a token run of its own, and capitals are read as small
        letters, so most pieces share the ids of a plainer one."""
        known, found, others = self._known, {}, []
        for piece, parts in zip(pieces, map(LETTERS.fullmatch, pieces)):
            if parts is None:
                others.append(piece)
                continue
            body, mark = parts.groups()
            body = body.lower()
            ids = known.get(body)
            if ids is None:
                ids = self._run(body)
                if len(body) <= LONGEST_KEPT:
                    known[body] = ids
            if mark:
                tail = known.get(mark)
                if tail is None:
                    tail = self._library([mark])[0]
                    if len(mark) <= LONGEST_KEPT:
                        known[mark] = tail
                ids += tail
            found[piece] = ids
        if others:
            found.update(self._learn_others(others))
        known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST_KEPT)
        return found

    def _learn_others(self, pieces: list[str]) -> dict[str, bytes]:
        """The same for pieces with other characters: a last mark after a letter or digit is a run of its own."""
        known, plain, parts = self._known, set(), {}
        for piece in pieces:
            body, mark = piece, ""
            if len(piece) > 1 and piece[-1] in ".,;:!?|":
                before = piece[-2].lower()
                if len(before) == 1 and before.isalnum():
                    body, mark = piece[:-1], piece[-1]
            if body.isascii() and body.isalnum():
                body = body.lower()
            parts[piece] = body, mark
            plain.update(x for x in (body, mark) if x and x not in known)
        order = list(plain)
        found = dict(zip(order, self._library(order))) if order else {}
        for piece, (body, mark) in parts.items():
            if piece not in found:
                found[piece] = b"".join(found[x] if x in found else known[x] for x in (body, mark) if x)
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > self._cached:
            self._known.clear()
        self._known[""] = b""
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        own = list(map(self._known.get, pieces))
        new = [p for p, ids in zip(pieces, own) if ids is None]
        if new:
            found = self._learn(new)
            own = [found[p] if ids is None else ids for p, ids in zip(pieces, own)]

        # The ids of all pieces behind each other, in one step for all texts.
        table = np.frombuffer(b"".join(own), "<u4")
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
        first = np.cumsum(lengths) - lengths
        place = coded.indices.to_numpy()
        number = lengths[place]
        ends = np.concatenate([[0], np.cumsum(number)])
        ids = table[np.repeat(first[place] - ends[:-1], number) + np.arange(ends[-1])].tobytes()
        offsets = cut.offsets.to_numpy()
        at = (4 * ends[offsets - offsets[0]]).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def _encoder(tokenizer_path: str) -> WordEncoder:
    return WordEncoder(tokenizer_path)


def word_encoder(tokenizer_path: str) -> WordEncoder:
    """One per worker process, whose table later tasks use again."""
    hold_tables("word_bpe", _encoder.cache_clear)
    return _encoder(tokenizer_path)
