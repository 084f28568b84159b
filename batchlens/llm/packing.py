"""Best-fit-decreasing packing of token sequences into bins of fixed capacity.

1. Tasks tokenise their documents, append the end id, and cut what is longer than a bin into full pieces and a
   rest. Each piece gets its rank among the task's pieces of the same length.
2. Best fit decreasing depends on the pieces only through the number of pieces of each length, a table with at
   most `capacity` rows. `plan` runs it on that table: bins with the same free space are one group, a segment tree
   over free space finds the tightest group that still takes a length, in logarithmic time, and a whole group is
   filled in one step. The sequence of placements is that of one document after the other.
3. The plan says which ranks of a length go to which bins. Global ranks are task ranks plus the pieces of that
   length in earlier tasks, so a length that a third of all documents share is ranked by all tasks together.

The driver sees the length table and the plan, whose size depends on `capacity`, not on the corpus. NULL text is
empty: it packs its end id alone. Rows that repeat are packed as often as they come. An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from batchlens.llm.common import chunks, id_and_text
from batchlens.session import stage

CAPACITY = 2048
END_ID = 0
#: Texts tokenised together.
TEXTS_AT_ONCE = 500


class SpaceTree:
    """Segment tree over free space 0 to capacity: is any open bin there, and which is the tightest that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, space: int, bins: int) -> None:
        at = space + self.size
        while at:
            self.open[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest free space of at least `least` among open bins."""
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Placements, sorted by (length, rank): the pieces of a length from `rank` on fill bins from `first_bin` on,
    `per_bin` in each, starting at offset `start`."""
    tree = SpaceTree(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of bins (first, number)
    rows, bins = [], 0

    def put(space: int, first: int, number: int) -> None:
        if number and space:
            groups.setdefault(space, []).append((first, number))
            tree.add(space, number)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            space = tree.tightest(length)
            if space is None:
                space, per_bin = capacity, capacity // length
                number = -(-left // per_bin)
                first = bins
                bins += number
            else:
                per_bin = space // length
                first, number = groups[space].pop()
                tree.add(space, -number)
                used = min(number, -(-left // per_bin))
                put(space, first + used, number - used)
                number = used
            placed = min(left, number * per_bin)
            rows.append((length, rank, first, per_bin, capacity - space))
            full, over = divmod(placed, per_bin)
            put(space - per_bin * length, first, full)
            if over:
                put(space - over * length, first + full, 1)
            rank, left = rank + placed, left - placed
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first_bin", "per_bin", "start"), table.T))


def _pieces(tokens_of, capacity: int, schema: pa.Schema):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = tokens_of()
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([END_ID], "<u4").tobytes()
        for part in parts:
            out: list[tuple] = []
            for some in chunks(part, TEXTS_AT_ONCE):
                coded = encode_all(some.column("text").to_pylist())
                for i, ids in zip(some.column("id").to_pylist(), coded):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        length = len(own) // 4
                        out.append((i, piece, at // 4, length, zlib.crc32(own), task, seen[length]))
                        seen[length] += 1
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema=schema)

    return run


def _assign(steps: dict[str, np.ndarray], schema: pa.Schema):
    # length * 2**44 + rank orders the plan; a length has far fewer than 2**44 pieces.
    keys = (steps["length"] << 44) + steps["rank"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            length, rank = part.column("length").to_numpy(), part.column("rank").to_numpy()
            row = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            bin_no, place = np.divmod(rank - steps["rank"][row], steps["per_bin"][row])
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                    pa.array(steps["first_bin"][row] + bin_no),
                    pa.array(steps["start"][row] + place * length),
                ],
                schema=schema,
            )

    return run


def pack(
    docs: DataFrame, tokens_of, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    `tokens_of()` is called once in each task and gives a function from a list of texts to their ids as
    little-endian unsigned 32-bit bytes, without the end id.
    """
    source = id_and_text(docs, id_col, text_col)
    own = [
        StructField("id", source.schema["id"].dataType),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ]
    cut = StructType([*own, StructField("task", IntegerType()), StructField("task_rank", LongType())])
    pieces = stage(source.mapInArrow(_pieces(tokens_of, capacity, to_arrow_schema(cut)), cut), "pieces")

    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    placed = StructType([*own, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    ranked = pieces.join(first, ["length", "task"]).withColumn("rank", F.col("first") + F.col("task_rank"))
    packed = ranked.mapInArrow(_assign(plan(counts, capacity), to_arrow_schema(placed)), placed)
    return packed.withColumnRenamed("id", id_col)
