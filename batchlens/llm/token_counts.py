"""Token counts that follow edits.

A document is kept as its pre-tokens (the pieces that the tokenizer's pattern cuts before byte-pair merging) in
blocks, under a segment tree whose nodes hold the characters and tokens below them. The total is the sum at the
root. An edit replaces a range of characters by a text:

1. the tree finds the block, and the block the pre-token, where the edit begins, in logarithmic time;
2. the pattern runs again from the first pre-token that may have looked at a changed character (a match looks at
   most `LOOKAHEAD` characters past its end), over the changed text, until a match begins where an old pre-token
   after the edit began: from there on nothing differs;
3. only the new pre-tokens are encoded, the blocks in between are replaced, and sums above them are updated.

`keep_trees` makes the trees of a corpus, a row per document to be written as a table; `edit_trees` takes such a table
and a round of edits and gives the table after it, without cutting or encoding what the edits leave alone: blocks that
no edit touches stay as they are stored. `count_edits` gives the counts of a round only, and `count_with_edits` those
of texts whose trees are not kept.

Defined results: NULL text is empty and has no tokens. Edits apply one after the other, each to the text that the one
before left; ranges are cut to that text, NULL parts of an edit are 0 or empty, NULL edits are none. Rows that repeat
are counted as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

# Fixed value: the pre-token pattern that belongs to the vocabulary file.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LOOKAHEAD = 2
#: Pre-tokens in a new block; a block that has grown to four times as many is split.
BLOCK = 64
#: Pre-tokens whose count a worker keeps at a time.
CACHED_PIECES = 500_000

EDITS = "array<struct<start:int,stop:int,text:string>>"


class PieceCounts(dict):
    """pre-token -> its number of tokens."""

    def __init__(self, ranks_path: str, pattern: str = PATTERN):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._single = encoding.encode_ordinary
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        count = len(self._single(piece))
        if len(piece) <= 64:
            self[piece] = count
        return count

    def counts(self, pieces: list[str]) -> list[int]:
        if len(self) > CACHED_PIECES:
            self.clear()
        return list(map(self.__getitem__, pieces))


@lru_cache(maxsize=2)
def piece_counts(ranks_path: str) -> PieceCounts:
    """One per worker process, whose table later tasks use again."""
    return PieceCounts(ranks_path)


def _packed(numbers: Iterable[np.ndarray]) -> bytes:
    """Small numbers, a byte each where they fit, else four; the first byte is that width."""
    values = np.concatenate([np.zeros(0, np.uint32), *numbers])
    width = 1 if not len(values) or values.max() < 256 else 4
    return bytes([width]) + zstandard.compress(values.astype(f"<u{width}").tobytes(), 3)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed[1:]), f"<u{packed[0]}")


class StoredBlock(NamedTuple):
    """A block of a kept tree that is not read yet: its place in the text and among the pre-tokens, and its sums."""

    start: int
    chars: int
    tokens: int
    first: int
    pieces: int


class TokenTree:
    """The pre-tokens of one text in blocks, and a segment tree of (characters, tokens) over the blocks."""

    def __init__(self, text: str, counts: PieceCounts):
        self._counts = counts
        self.encoded = 0
        self._stored: tuple[str, np.ndarray, np.ndarray] | None = None
        pieces = counts.pattern.findall(text)
        self._blocks: list = [self._block(pieces[i : i + BLOCK]) for i in range(0, len(pieces), BLOCK)]
        self._grow()

    @classmethod
    def kept(cls, row: dict, counts: PieceCounts) -> TokenTree:
        """The tree that `stored` described; nothing is cut or encoded."""
        tree = cls("", counts)
        tree._stored = row["text"], _unpacked(row["lengths"]), _unpacked(row["counts"])
        tree._chars, tree._tokens = list(row["node_chars"]), list(row["node_tokens"])
        tree._size = len(tree._chars) // 2
        start = first = 0
        for leaf, pieces in enumerate(row["block_pieces"], tree._size):
            tree._blocks.append(StoredBlock(start, tree._chars[leaf], tree._tokens[leaf], first, pieces))
            start, first = start + tree._chars[leaf], first + pieces
        return tree

    def stored(self) -> dict:
        """What KEPT says but for the id; blocks that were never read are copied as they are."""
        parts = [self._numbers(b) for b in self._blocks]
        return {
            "text": self.text(),
            "n_tokens": self.tokens,
            "n_pieces": sum(len(x) for x, _ in parts),
            "node_chars": self._chars,
            "node_tokens": self._tokens,
            "block_pieces": [len(x) for x, _ in parts],
            "lengths": _packed(x for x, _ in parts),
            "counts": _packed(x for _, x in parts),
        }

    def _numbers(self, block) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and counts of the pre-tokens of a block."""
        if isinstance(block, StoredBlock):
            held = slice(block.first, block.first + block.pieces)
            return self._stored[1][held], self._stored[2][held]
        return np.array(list(map(len, block[0])), np.uint32), np.array(block[1], np.uint32)

    def _opened(self, block: int) -> tuple[list[str], list[int]]:
        """Pre-tokens of a block and their counts, read when first asked for."""
        found = self._blocks[block]
        if isinstance(found, StoredBlock):
            lengths, counts = self._numbers(found)
            ends = (found.start + np.cumsum(lengths, dtype=np.int64)).tolist()
            text = self._stored[0]
            found = [text[a:b] for a, b in zip([found.start, *ends], ends)], counts.tolist()
            self._blocks[block] = found
        return found

    def _sums(self, block) -> tuple[int, int]:
        if isinstance(block, StoredBlock):
            return block.chars, block.tokens
        return sum(map(len, block[0])), sum(block[1])

    def _block(self, pieces: list[str]) -> tuple[list[str], list[int]]:
        self.encoded += len(pieces)
        return pieces, self._counts.counts(pieces)

    def _grow(self) -> None:
        """Builds the tree anew over the blocks; leaves start at `size`."""
        self._size = 1 << max(len(self._blocks) - 1, 0).bit_length()
        none = [0] * (self._size - len(self._blocks))
        sums = [self._sums(b) for b in self._blocks]
        self._chars = [0] * self._size + [chars for chars, _ in sums] + none
        self._tokens = [0] * self._size + [tokens for _, tokens in sums] + none
        for node in range(self._size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    def _refresh(self, block: int) -> None:
        node = block + self._size
        self._chars[node], self._tokens[node] = self._sums(self._blocks[block])
        while node > 1:
            node //= 2
            self._sum(node)

    @property
    def tokens(self) -> int:
        return self._tokens[1]

    @property
    def chars(self) -> int:
        return self._chars[1]

    def text(self) -> str:
        def part(block) -> str:
            if isinstance(block, StoredBlock):
                return self._stored[0][block.start : block.start + block.chars]
            return "".join(block[0])

        return "".join(map(part, self._blocks))

    def _find(self, char: int) -> tuple[int, int, int]:
        """(block, pre-token in it, its first character) at a character; the end of the text counts as the last."""
        node, begin = 1, 0
        while node < self._size:
            node *= 2
            if char - begin >= self._chars[node] and self._chars[node + 1]:
                begin += self._chars[node]
                node += 1
        block = node - self._size
        pieces = self._opened(block)[0]
        for i, piece in enumerate(pieces):
            if char - begin < len(piece) or i == len(pieces) - 1:
                return block, i, begin
            begin += len(piece)
        raise AssertionError("blocks are never empty")

    def _from(self, block: int, piece: int) -> Iterator[tuple[int, int, str]]:
        while block < len(self._blocks):
            pieces = self._opened(block)[0]
            for i in range(piece, len(pieces)):
                yield block, i, pieces[i]
            block, piece = block + 1, 0

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces the characters from `start` to before `stop` by `new`."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        if not self._blocks:
            encoded = self.encoded
            self.__init__(new, self._counts)
            self.encoded += encoded
            return
        block, piece, begin = self._find(max(start - LOOKAHEAD, 0))
        # The pre-token before may end within the look-ahead of the change.
        if piece:
            piece, begin = piece - 1, begin - len(self._opened(block)[0][piece - 1])
        elif block:
            block, piece = block - 1, len(self._opened(block - 1)[0]) - 1
            begin -= len(self._opened(block)[0][piece])

        # Old pre-tokens are read ahead in growing steps, until the new matches meet one of their starts.
        old = self._from(block, piece)
        read, ended, reach = [], False, 32
        shift = len(new) - (stop - start)
        while True:
            while not ended and len(read) < reach:
                item = next(old, None)
                ended = item is None
                if item is not None:
                    read.append(item)
            ahead = "".join(x[2] for x in read)
            if ended or begin + len(ahead) > stop:
                text = ahead[: start - begin] + new + ahead[stop - begin :]
                starts, at = {}, begin
                for k, (_, _, p) in enumerate(read):
                    if at >= stop:
                        starts[at + shift - begin] = k
                    at += len(p)
                # Matches near the end of what was read may look past it.
                sure = len(text) if ended else len(text) - LOOKAHEAD - 1
                found, meet = [], None
                for match in self._counts.pattern.finditer(text):
                    if match.start() in starts:
                        meet = starts[match.start()]
                        break
                    if match.end() > sure and not ended:
                        break
                    found.append(match.group())
                if meet is not None or ended:
                    break
            reach *= 4
        until = read[meet][:2] if meet is not None else (len(self._blocks), 0)
        self._replace((block, piece), until, found)

    def _replace(self, first: tuple[int, int], until: tuple[int, int], new: list[str]) -> None:
        pieces, counts = self._block(new)
        head_pieces, head_counts = self._opened(first[0])
        tail = self._opened(until[0]) if until[0] < len(self._blocks) else ([], [])
        pieces = head_pieces[: first[1]] + pieces + tail[0][until[1] :]
        counts = head_counts[: first[1]] + counts + tail[1][until[1] :]
        if first[0] == until[0] or (until[0] == len(self._blocks) and first[0] == until[0] - 1):
            if pieces and len(pieces) <= 4 * BLOCK:
                self._blocks[first[0]] = pieces, counts
                self._refresh(first[0])
                return
        cut = [(pieces[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(pieces), BLOCK)]
        self._blocks[first[0] : until[0] + 1] = cut
        self._grow()


#: A kept tree: node sums in the order of a heap, of which 1 is the root and the second half are the blocks.
KEPT = [
    StructField("text", StringType()),
    StructField("n_tokens", LongType()),
    StructField("n_pieces", LongType()),
    StructField("node_chars", ArrayType(IntegerType())),
    StructField("node_tokens", ArrayType(IntegerType())),
    StructField("block_pieces", ArrayType(IntegerType())),
    StructField("lengths", BinaryType()),
    StructField("counts", BinaryType()),
]
ROUND = [
    StructField("n_tokens_before", LongType()),
    StructField("n_pieces_before", LongType()),
    StructField("n_edits", IntegerType()),
    StructField("n_encoded", LongType()),
]
#: Rows made before they are handed on; a row holds a whole text.
ROWS_OUT = 64


def _rows_out(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows_in(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for part in parts:
        for i in range(part.num_rows):
            yield part.slice(i, 1).to_pylist()[0]


def _apply(tree: TokenTree, wanted: Iterable[dict] | None) -> tuple[int, int]:
    """(edits, pre-tokens encoded) of one round."""
    before, done = tree.encoded, 0
    for e in wanted or ():
        if e is not None:
            tree.edit(e["start"] or 0, e["stop"] or 0, e["text"] or "")
            done += 1
    return done, tree.encoded - before


def keep_trees(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and a tree (KEPT) of every row. Write it as a table, for rounds of edits to start from."""
    source = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    out = StructType([source.schema["id"], *KEPT])
    schema = to_arrow_schema(out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(ranks_path)
        trees = ({"id": r["id"], **TokenTree(r["text"], counts).stored()} for r in _rows_in(parts))
        return _rows_out(trees, schema)

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col)


def _round(trees: DataFrame, edits: Column, ranks_path: str, id_col: str, fields: list[StructField]) -> DataFrame:
    names = [f.name for f in KEPT]
    source = trees.select(trees[id_col].alias("id"), *names, edits.cast(EDITS).alias("edits"))
    out = StructType([source.schema["id"], *fields])
    schema = to_arrow_schema(out)
    whole = any(f.name == "lengths" for f in fields)

    def edited(row: dict, counts: PieceCounts) -> dict:
        before = {"id": row["id"], "n_tokens_before": row["n_tokens"], "n_pieces_before": row["n_pieces"]}
        if not any(e is not None for e in row["edits"] or ()):
            return {**before, **{n: row[n] for n in names}, "n_edits": 0, "n_encoded": 0}
        tree = TokenTree.kept(row, counts)
        done, encoded = _apply(tree, row["edits"])
        after = tree.stored() if whole else {"n_tokens": tree.tokens}
        return {**before, **after, "n_edits": done, "n_encoded": encoded}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(ranks_path)
        rows = (edited(r, counts) for r in _rows_in(parts))
        return _rows_out(({f: r[f] for f in schema.names} for r in rows), schema)

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col)


def edit_trees(trees: DataFrame, edits: Column, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """The table of kept trees after a round of edits, with what the round did (ROUND).

    `edits` is an expression over the columns of `trees` (and of what the caller joined to it) of type EDITS; a row
    without edits stays as it is. The result may go into the next round.
    """
    return _round(trees, edits, ranks_path, id_col, KEPT + ROUND)


def count_edits(trees: DataFrame, edits: Column, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens after the round, ROUND), where the trees after it are not wanted."""
    return _round(trees, edits, ranks_path, id_col, [StructField("n_tokens", LongType()), *ROUND])


def count_with_edits(
    docs: DataFrame, edits: Column, ranks_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, n_pieces, n_edits, n_tokens_edited, n_encoded, text_edited) of every document.

    `edits` is an expression over the columns of `docs` of type EDITS. n_tokens and n_pieces describe the text as it
    came, n_encoded the pre-tokens that all edits together encoded anew.
    """
    source = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), edits.cast(EDITS).alias("edits")
    )
    out = StructType(
        [
            source.schema["id"],
            StructField("n_tokens", LongType()),
            StructField("n_pieces", LongType()),
            StructField("n_edits", IntegerType()),
            StructField("n_tokens_edited", LongType()),
            StructField("n_encoded", LongType()),
            StructField("text_edited", StringType()),
        ]
    )
    schema = to_arrow_schema(out)

    def counted(i, text: str, wanted: Iterable[dict]) -> tuple:
        tree = TokenTree(text, counts_of())
        before, pieces = tree.tokens, tree.encoded
        done, encoded = _apply(tree, wanted)
        return i, before, pieces, done, tree.tokens, encoded, tree.text()

    def counts_of() -> PieceCounts:
        return piece_counts(ranks_path)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [
                counted(i, text, wanted or ())
                for i, text, wanted in zip(*(part.column(c).to_pylist() for c in ("id", "text", "edits")))
            ]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))), schema=schema)

    return source.mapInArrow(run, out).withColumnRenamed("id", id_col)


def derived_edits(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Four edits of each text, placed by a hash of its id: a word changed, a passage doubled, another cut, one moved up.

    They stand for a revision of the corpus where no table of edits is at hand.
    """
    length = F.char_length(F.coalesce(F.col(text_col), F.lit("")))

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), length + 1).cast("int")

    def passage(k: int, size: int) -> Column:
        return F.substring(F.coalesce(F.col(text_col), F.lit("")), place(k) + 1, F.lit(size))

    def edit(start: Column, stop: Column, text: Column) -> Column:
        return F.struct(start.alias("start"), stop.cast("int").alias("stop"), text.alias("text"))

    return F.array(
        edit(place(1), place(1) + 5, F.lit("revised")),
        edit(place(2), place(2), passage(3, 80)),
        edit(place(4), place(4) + 60, F.lit("")),
        edit(place(5), place(5) + 20, passage(6, 20)),
    )
