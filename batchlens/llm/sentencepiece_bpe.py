"""Exact SentencePiece BPE encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair of symbols until none is left. Its result is the only sequence of
pieces whose adjacent pairs all survive re-merging: merging the letters of two neighbours anew must give the same
two pieces. So a unit of text is encoded from left to right: an Aho-Corasick automaton lists the pieces at each
place, the longest that is compatible with the piece before is taken, a shorter one if it is not, and a place from
which nothing leads on is marked in a bit field and left for good. Each prefix has only one valid encoding, hence
no place is tried twice.

A text is cut into units where no piece of the vocabulary can span the cut: before a word mark that follows
another letter, around line breaks, and between letters and the punctuation that no piece joins to letters. Which
cuts are safe is read from the vocabulary; where a piece spans words or lines, the text is one unit. Units are
looked up in a bounded table.

The model must leave its input as it is (identity normalisation, dummy prefix, byte fallback); `PieceModel` compares
itself with the library on a few strings and raises if it differs. NULL text is empty and encodes to the end id
alone; an empty table gives an empty result; repeated rows are encoded as often as they come.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor

from batchlens.llm.common import chunks, id_and_text

MARK = "▁"
#: Units and pairs of pieces kept at a time; when full the table is emptied and filled anew.
CACHED_UNITS = 600_000
CACHED_PAIRS = 1_000_000
LONGEST_KEPT = 64
TEXTS_AT_ONCE = 128
_PROBES = ("", " ", "  a  b ", "Hello world\n\n\txé中\U0001f600", "1234 ab▁c", "ﬁ ½ z")


def _cut_pattern(pieces) -> str:
    """A pattern whose matches are units: no piece spans two of them."""
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
        return "(?s).+"
    sides = {pair for p in pieces for pair in zip(p, p[1:])}
    # Letters that some piece joins to punctuation.
    joined = {b if a in string.punctuation else a for a, b in sides if (a in string.punctuation) != (b in string.punctuation)}
    letter = "[^\\W_" + re.escape("".join(sorted(c for c in joined if c.isalnum()))) + "]"
    marks = re.escape(string.punctuation)
    letters_then_mark = rf"{MARK}*{letter}+(?=[{marks}{MARK}\n]|\Z)"
    marks_then_letter = rf"{MARK}*[{marks}]+(?={letter}|[{MARK}\n]|\Z)"
    return f"{letters_then_mark}|{marks_then_letter}|{MARK}*[^{MARK}\n]+|\n|{MARK}+"


class PieceModel:
    def __init__(self, model_path: str):
        library = SentencePieceProcessor(model_file=model_path)
        count = library.get_piece_size()
        self._scores: dict[str, float] = {}
        self._codes: dict[str, bytes] = {}
        self._byte_codes: dict[int, bytes] = {}
        self._surface: list[str] = []
        self._bytes: dict[int, int] = {}
        for i in range(count):
            piece, code = library.id_to_piece(i), np.array([i], "<i4").tobytes()
            if library.is_control(i):
                self._surface.append("")
            elif library.is_byte(i):
                value = int(piece[3:5], 16)
                self._byte_codes[value], self._bytes[i] = code, value
                self._surface.append(chr(value) if value < 128 else "")
            elif library.is_unknown(i):
                self._surface.append(" ⁇ ")
            else:
                self._scores[piece], self._codes[piece] = library.get_score(i), code
                self._surface.append(piece.replace(MARK, " "))
        high = [i for i, b in self._bytes.items() if b >= 128]
        self._high_bytes = (min(high), max(high)) if high else (count, count)
        self._end = np.array([library.eos_id()], "<i4").tobytes()
        self._silent = {i for i in range(count) if library.is_control(i)}
        self._automaton = ahocorasick.Automaton()
        for piece in self._scores:
            self._automaton.add_word(piece, len(piece))
        self._automaton.make_automaton()
        self._cut = re.compile(_cut_pattern(self._scores))
        self._units: dict[str, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        for probe in _PROBES:
            ids = library.encode(probe, add_eos=True)
            if self.encode(probe).tolist() != ids or self.decode(np.array(ids, "<i4")) != library.decode(ids):
                raise ValueError(f"{model_path} changes its input in a way that is not covered: {probe!r}")

    def _merged(self, text: str) -> list[str]:
        """The pieces that merging the letters of a short text gives; the leftmost of equal scores goes first."""
        parts, score = list(text), self._scores.get
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                value = score(parts[i] + parts[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._merged(left + right) == ([left, right] if left else [right])
            self._pairs[(left, right)] = known
        return known

    def pieces(self, unit: str) -> list[str]:
        """The pieces of one unit; a letter outside the vocabulary is a piece of its own."""
        n = len(unit)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for end, length in self._automaton.iter(unit):
            lengths[end - length + 1].append(length)
        for i in range(n):
            if not lengths[i] or lengths[i][0] != 1:
                lengths[i].insert(0, 1)
        failed = bytearray((n >> 3) + 1)
        path: list[tuple[int, int]] = []
        out: list[str] = []
        at, choice = 0, len(lengths[0]) - 1 if n else -1
        while at < n:
            last = out[-1] if out else ""
            while choice >= 0:
                end = at + lengths[at][choice]
                if not failed[end >> 3] >> (end & 7) & 1 and self._compatible(last, unit[at:end]):
                    break
                choice -= 1
            if choice >= 0:
                path.append((at, choice))
                out.append(unit[at:end])
                at = end
                choice = len(lengths[at]) - 1 if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at, choice = path.pop()
                out.pop()
                choice -= 1
        return out

    def _code(self, unit: str) -> bytes:
        code = []
        for piece in self.pieces(unit):
            known = self._codes.get(piece)
            code += [known] if known else [self._byte_codes[b] for b in piece.encode()]
        return b"".join(code)

    def encode_bytes(self, text: str) -> bytes:
        """Ids with the end id, as little-endian 32-bit numbers."""
        if not text:
            return self._end
        units = self._cut.findall(MARK + text.replace(" ", MARK))
        known = self._units
        if len(known) > CACHED_UNITS:
            known.clear()
        new = {u: self._code(u) for u in set(units).difference(known)}
        known.update((u, c) for u, c in new.items() if len(u) <= LONGEST_KEPT)
        if any(len(u) > LONGEST_KEPT for u in new):
            return b"".join(new[u] if u in new else known[u] for u in units) + self._end
        return b"".join(map(known.__getitem__, units)) + self._end

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        low, high = self._high_bytes
        numbers = ids.tolist()
        if len(ids) and ((ids >= low) & (ids <= high)).any():
            text = self._decode_runs(numbers)
        else:
            text = "".join(map(self._surface.__getitem__, numbers))
        # The blank of the dummy prefix goes, unless the text begins with a byte.
        first = next((i for i in numbers if i not in self._silent), None)
        if first is not None and first not in self._bytes and text.startswith(" ") and self._surface[first] != " ⁇ ":
            return text[1:]
        return text

    def _decode_runs(self, numbers: list[int]) -> str:
        """Runs of byte pieces are UTF-8; each byte that is not part of a letter becomes U+FFFD."""
        out, run = [], bytearray()
        for i in [*numbers, None]:
            value = self._bytes.get(i)
            if value is not None:
                run.append(value)
                continue
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as error:
                    out.append(run[: error.start].decode() + "�")
                    del run[: error.start + 1]
            if i is not None:
                out.append(self._surface[i])
        return "".join(out)


@lru_cache(maxsize=2)
def piece_model(model_path: str) -> PieceModel:
    """One per worker process, whose tables later tasks use again."""
    return PieceModel(model_path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the piece ids of each whole text, with the end id."""
    source = id_and_text(docs, id_col, text_col)
    out = StructType([StructField("id", source.schema["id"].dataType), StructField("ids", ArrayType(IntegerType()))])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for part in parts:
            for some in chunks(part, TEXTS_AT_ONCE):
                codes = [model.encode_bytes(t) for t in some.column("text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.frombuffer(b"".join(codes), "<i4")), type=schema.field("ids").type
                )
                yield pa.RecordBatch.from_arrays([some.column("id"), ids], schema=schema)

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded): the text of each sequence of ids; NULL ids are an empty sequence."""
    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    out = StructType([*source.schema.fields, StructField("decoded", StringType())])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for part in parts:
            for some in chunks(part, TEXTS_AT_ONCE):
                lists = some.column("ids")
                texts = [model.decode(x.values.to_numpy()) if x.is_valid else "" for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), lists, pa.array(texts, schema.field("decoded").type)], schema=schema
                )

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col).withColumnRenamed("ids", ids_col)
