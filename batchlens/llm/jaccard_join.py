"""N-gram Jaccard join with filters under several global token orders.

Sets are the different five-word shingles of whole texts; two link when their Jaccard similarity is at least 3/4.
Documents with equal sets are one class from the start, so copies are never paired.

1. *Screen.* Linked sets share 3/4 of their tokens. Under one global order (the token hash) the lower half of each
   set then holds a known number of shared tokens. All lower halves are counted, packed as arrays and dealt out by
   token; documents with too few shared tokens have no partner but equal sets. This drops most of a corpus.
2. *Orders.* For the rest, shingles are counted exactly. Order 0 puts rare tokens first, orders 1 and 2 are two
   unrelated hashes. Under every order, linked sets share a token of their prefixes (the first n - ceil(3n/4) + 1).
3. *Bundles.* Sets that share a prefix token of order 0 form a list; its most central member (fewest tokens of its
   own) is the pivot. A bundle is a pivot with all members of its lists, so any two partners meet in some bundle.
4. *Cells.* The members of a bundle are dealt into blocks of bounded size, and each pair of blocks is a cell. A pair is
   taken in one cell only: in the first of the bundles that hold both. It must share prefix tokens under all
   three orders before it is verified exactly. A cell returns how many links each class has, and one row per class
   that connects it with those it links to; all pairs only where they are asked for.
5. These rows between classes give the components, the counts weighted with copies the numbers of links.

Defined results: text without words has an empty set, links with nothing and is its own component. Rows with NULL id
take part; a component's id is its smallest id that is not NULL. Repeated rows share class and component. An empty
table gives an empty result. Only the id and the text column are read. A document's links are all other rows it links
with, equal texts included.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from batchlens.llm.common import id_and_text
from batchlens.llm.components import components
from batchlens.llm.shingles import set_digest, shingles
from batchlens.session import stage

#: Tokens, and documents, that a task packs into one unit.
UNIT_TOKENS = 1_000_000
UNIT_DOCS = 60_000
#: Stands for no single document of a unit.
NO_DOCUMENT = 65_535
#: Bytes of text per part of the token counts.
PART_BYTES = 48 << 20
#: Members, and tokens, in a block of a cell.
BLOCK = 256
BLOCK_TOKENS = 250_000
#: Orders besides rare-first.
_ORDER_SEEDS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_COLUMNS_AT_ONCE = 20_000


def _needed(n: np.ndarray) -> np.ndarray:
    """Shared tokens that the lower half of a set of n must hold if it has a partner.

    Partners x, y have m >= ceil(3n/4) tokens each way and share at least ceil(3m/4) of them. With a lower half of
    p(m) = ceil(m/2) tokens, the first p(m) - (m - ceil(3m/4)) >= m/4 shared tokens lie in the lower half of the set
    of m tokens. The smaller partner has at least ceil(3n/4), so both lower halves share ceil(ceil(3n/4) / 4).
    """
    smaller = -(-3 * n // 4)
    return -(-smaller // 4)


def _screen_units(schema: pa.Schema, parts: int, size: int):
    """Packs documents into units: rows of tokens by part (part >= 0), and a row about the documents (part < 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        ids: list = []
        sizes: list[int] = []
        digests: list[bytes] = []
        lower: list[np.ndarray] = []
        owners: list[int] = []
        seen: dict[bytes, int] = {}
        held = 0

        def flush():
            tokens = np.concatenate(lower) if lower else np.zeros(0, np.uint64)
            docs = np.repeat(np.array(owners, np.uint16), [len(x) for x in lower])
            # A token that several documents of the unit hold is known to be shared; it is sent once, for no document.
            order = np.argsort(tokens, kind="stable")
            tokens, docs = tokens[order], docs[order]
            first = np.ones(len(tokens), bool)
            np.not_equal(tokens[1:], tokens[:-1], out=first[1:])
            last = np.append(first[1:], True)[: len(first)]
            shared = np.bincount(docs[~(first & last)], minlength=len(ids)).astype("<u4")
            docs = np.where(last, docs, np.uint16(NO_DOCUMENT))[first]
            tokens = tokens[first]
            part = (tokens % np.uint64(parts)).astype(np.uint16 if parts < 65536 else np.uint32)
            order = np.argsort(part, kind="stable")
            tokens, docs, part = tokens[order], docs[order], part[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            full = np.flatnonzero(np.diff(edges))
            rows = len(full) + 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*full.tolist(), -1 - (unit * 31 + unit // 2**32) % parts], pa.int32()),
                    pa.array([unit] * rows, pa.int64()),
                    pa.array([*(docs[edges[p] : edges[p + 1]].tobytes() for p in full), b"".join(digests)], pa.binary()),
                    pa.array(
                        [
                            *(tokens[edges[p] : edges[p + 1]].tobytes() for p in full),
                            np.array(sizes, "<u4").tobytes() + shared.tobytes(),
                        ],
                        pa.binary(),
                    ),
                    pa.array([None] * (rows - 1) + [ids], schema.field("ids").type),
                ],
                schema=schema,
            )

        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                tokens = shingles(text, size)
                digest = set_digest(tokens)
                if len(tokens) and digest not in seen:
                    seen[digest] = len(ids)
                    lower.append(tokens[: (len(tokens) + 1) // 2])
                    owners.append(len(ids))
                    held += len(lower[-1])
                ids.append(i)
                sizes.append(len(tokens))
                digests.append(digest)
                if held >= UNIT_TOKENS or len(ids) >= UNIT_DOCS:
                    yield flush()
                    unit, held = unit + 1, 0
                    for x in (ids, sizes, digests, lower, owners, seen):
                        x.clear()
        if ids:
            yield flush()

    return run


def _screen_counts(schema: pa.Schema):
    """For one part: how many tokens of each document of each unit come in another document too."""

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table["part"][0].as_py() < 0:
            return table.select(schema.names).cast(schema)
        tokens = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        shared = counts[inverse] > 1
        docs_out, counts_out, at = [], [], 0
        for docs, own in zip(table["docs"].to_pylist(), tokens):
            found = np.bincount(np.frombuffer(docs, np.uint16)[shared[at : at + len(own)]], minlength=NO_DOCUMENT + 1)
            at += len(own)
            some = np.flatnonzero(found[:NO_DOCUMENT])
            docs_out.append(some.astype(np.uint16).tobytes())
            counts_out.append(found[some].astype("<u4").tobytes())
        return pa.table(
            {
                "part": table["part"],
                "unit": table["unit"],
                "docs": docs_out,
                "tokens": counts_out,
                "ids": pa.nulls(table.num_rows, schema.field("ids").type),
            },
            schema=schema,
        )

    return run


def _screen_result(schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        about = next(r for r in rows if r["part"] < 0)
        sizes, shared = np.frombuffer(about["tokens"], "<u4").astype(np.int64).reshape(2, -1)
        for r in rows:
            if r["part"] >= 0:
                shared[np.frombuffer(r["docs"], np.uint16)] += np.frombuffer(r["tokens"], "<u4")
        digests = [about["docs"][i : i + 16] for i in range(0, len(about["docs"]), 16)]
        return pa.table(
            {
                "id": about["ids"],
                "cls": digests,
                "n": sizes,
                "screened": (shared >= _needed(sizes)) & (sizes > 0),
            },
            schema=schema,
        )

    return run


def profile(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, cls, n, screened) of every document; only classes with a screened document can have partners."""
    source = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    volume = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // PART_BYTES))
    kind = source.schema["id"].dataType
    packed = StructType(
        [
            StructField("part", IntegerType()),
            StructField("unit", LongType()),
            StructField("docs", BinaryType()),
            StructField("tokens", BinaryType()),
            StructField("ids", ArrayType(kind)),
        ]
    )
    flat = StructType(
        [
            StructField("id", kind),
            StructField("cls", BinaryType()),
            StructField("n", LongType()),
            StructField("screened", BooleanType()),
        ]
    )
    units = source.mapInArrow(_screen_units(to_arrow_schema(packed), parts, size), packed)
    counted = units.groupBy("part").applyInArrow(_screen_counts(to_arrow_schema(packed)), packed)
    return stage(counted.groupBy("unit").applyInArrow(_screen_result(to_arrow_schema(flat)), flat), "shingle-sets")


def _set_units(schema: pa.Schema, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        sets: list[np.ndarray] = []
        seen: set[bytes] = set()
        held = 0

        def flush():
            return pa.RecordBatch.from_pydict(
                {
                    "unit": [unit],
                    "sizes": [np.array([len(x) for x in sets], "<u4").tobytes()],
                    "tokens": [np.concatenate(sets).tobytes()],
                },
                schema=schema,
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = shingles(text, size)
                if set_digest(own) in seen:
                    continue
                seen.add(set_digest(own))
                sets.append(own)
                held += len(own)
                if held >= UNIT_TOKENS // 4:
                    yield flush()
                    unit, held = unit + 1, 0
                    sets.clear()
                    seen.clear()
        if sets:
            yield flush()

    return run


def _deal(schema: pa.Schema, parts: int):
    """Splits the tokens of each unit by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, packed in zip(batch.column("unit").to_pylist(), batch.column("tokens").to_pylist()):
                tokens = np.frombuffer(packed, np.uint64)
                part = (tokens % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": full,
                        "unit": [unit] * len(full),
                        "tokens": [tokens[order[edges[p] : edges[p + 1]]].tobytes() for p in full],
                    },
                    schema=schema,
                )

    return run


def _count(schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        found = np.split(counts[inverse].astype("<u4"), np.cumsum([len(x) for x in tokens])[:-1])
        return pa.table(
            {"part": table["part"], "unit": table["unit"], "tokens": [x.tobytes() for x in found]}, schema=schema
        )

    return run


def _classes(schema: pa.Schema, parts: int):
    """Sets with the counts of their tokens: what a partner could share, and the prefixes under each order."""

    def run(units: pa.Table, counts: pa.Table) -> pa.Table:
        if not units.num_rows:
            return schema.empty_table()
        tokens = np.frombuffer(units["tokens"][0].as_py(), np.uint64)
        sizes = np.frombuffer(units["sizes"][0].as_py(), "<u4").astype(np.int64)
        order = np.argsort((tokens % np.uint64(parts)).astype(np.int32), kind="stable")
        found = sorted(zip(counts["part"].to_pylist(), counts["tokens"].to_pylist()))
        df = np.empty(len(tokens), np.int64)
        df[order] = np.concatenate([np.frombuffer(x, "<u4") for _, x in found]) if found else 0
        rows = {name: [] for name in schema.names}
        at = 0
        for n in sizes.tolist():
            own, often = tokens[at : at + n], df[at : at + n]
            at += n
            prefix = n - (-(-3 * n // 4)) + 1
            flags = np.zeros(n, np.uint8)
            orders = [np.lexsort((own, often))]
            orders += [np.argsort((own ^ np.uint64(s)) * np.uint64(0x9FB21C651E98DF25), kind="stable") for s in _ORDER_SEEDS]
            for bit, ranked in enumerate(orders):
                flags[ranked[:prefix]] |= 1 << bit
            shared = often > 1
            rows["cls"].append(set_digest(own))
            rows["n"].append(n)
            rows["lonely"].append(int(n - shared.sum()))
            rows["tokens"].append(own[shared].tobytes())
            rows["flags"].append(flags[shared].tobytes())
            rows["keys"].append(own[shared & (flags & 1 > 0)].view(np.int64))
        return pa.table(rows, schema=schema)

    return run


def incidence(tokens: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """A row per set, a column per token of `columns` (sorted)."""
    flat = np.concatenate(tokens)
    owner = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
    at = np.searchsorted(columns, flat)
    hit = np.take(columns, at, mode="clip") == flat
    out = np.zeros((len(tokens), len(columns)), np.float32)
    out[owner[hit], at[hit]] = 1
    return out


def shared_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a left and a right set."""
    total = np.zeros((len(left), len(right)), np.float32)
    if left and right:
        both = np.intersect1d(np.concatenate(left), np.concatenate(right))
        for at in range(0, len(both), _COLUMNS_AT_ONCE):
            some = both[at : at + _COLUMNS_AT_ONCE]
            total += incidence(left, some) @ incidence(right, some).T
    return total.astype(np.int64)


def linked(left: list[dict], right: list[dict], own: int) -> np.ndarray:
    """Which sets of the left and the right link: a matrix of truth values. `own` is the number of their bundle.

    Pairs that also meet in a bundle of a smaller number are left to it. Prefixes must meet under every order, and
    the similarity be 3/4 or more.
    """
    earlier = [[x["pivots"][x["pivots"] < own] for x in side] for side in (left, right)]
    possible = shared_tokens(*earlier) == 0
    for bit in range(1 + len(_ORDER_SEEDS)):
        if not possible.any():
            return possible
        prefixes = [[x["tokens"][x["flags"] >> bit & 1 == 1] for x in side] for side in (left, right)]
        possible &= shared_tokens(*prefixes) > 0
    rows, columns = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
    common = shared_tokens([left[i]["tokens"] for i in rows], [right[j]["tokens"] for j in columns])
    n_left = np.array([left[i]["n"] for i in rows], np.int64)[:, None]
    n_right = np.array([right[j]["n"] for j in columns], np.int64)[None, :]
    possible[np.ix_(rows, columns)] &= 100 * common >= 75 * (n_left + n_right - common)
    return possible


def connected(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A label for each row and column of a matrix of links; those that links connect have the same."""
    n_left, n_right = links.shape
    left, right = np.arange(n_left), np.arange(n_left, n_left + n_right)
    none = n_left + n_right
    while True:
        left_now = np.minimum(left, np.where(links, right[None, :], none).min(axis=1, initial=none))
        right_now = np.minimum(right, np.where(links, left_now[:, None], none).min(axis=0, initial=none))
        if (left_now == left).all() and (right_now == right).all():
            return left, right
        left, right = left_now, right_now


def cell_links(own: int, left: list[dict], right: list[dict] | None, pairs: bool) -> list[dict]:
    """The rows of a cell: (cls, other, links). Without `right` the left side meets itself.

    Numbers of links come with `other` None; the rest connects classes, or with `pairs` is each link once.
    """
    itself = right is None
    right = left if itself else right
    links = linked(left, right, own)
    if itself:
        np.fill_diagonal(links, False)
    out = []
    if pairs:
        for i, j in zip(*np.nonzero(np.triu(links) if itself else links)):
            a, b = sorted((left[i]["cls"], right[j]["cls"]))
            out.append({"cls": a, "other": b, "links": None})
    else:
        for side, label in zip((left, right), connected(links)):
            for x, at in zip(side, label.tolist()):
                other = left[at]["cls"] if at < len(left) else right[at - len(left)]["cls"]
                if other != x["cls"]:
                    out.append({"cls": x["cls"], "other": other, "links": None})
    copies = [np.array([x["copies"] for x in side], np.int64) for side in (left, right)]
    counts = [(left, links @ copies[1])] + ([] if itself else [(right, copies[0] @ links)])
    for side, found in counts:
        out += [{"cls": x["cls"], "other": None, "links": c} for x, c in zip(side, found.tolist()) if c]
    return out


def _cells(schema: pa.Schema, pairs: bool):
    """Walks the cells of a partition, which is sorted by (pivot, low, high, cls)."""

    def rows_of(batches):
        for batch in batches:
            yield from batch.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for (_, low, high), cell in groupby(rows_of(batches), key=lambda r: (r["pivot"], r["low"], r["high"])):
            sides: tuple[list, list] = ([], [])
            # Where ids repeat, a class may come once per unit.
            own = None
            for _, same in groupby(cell, key=lambda r: r["cls"]):
                r = next(same)
                r["tokens"] = np.frombuffer(r["tokens"], np.uint64)
                r["flags"] = np.frombuffer(r["flags"], np.uint8)
                r["pivots"] = np.array(r["pivots"], np.int64)
                own = r["own"]
                sides[r["block"] != low].append(r)
            if sides[0] and (low == high or sides[1]):
                done += cell_links(own, sides[0], None if low == high else sides[1], pairs)
            while len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done[:10_000], schema=schema)
                done = done[10_000:]
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return run


def class_links(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, size: int, pairs: bool = False
) -> DataFrame:
    """(cls, other, links), written out: links between classes, enough of them to connect all that are linked.

    With `pairs` all of them, each once. Rows without `other` are numbers of links with rows of other classes, to be
    added up.
    """
    spark = docs.sparkSession
    classes = found.filter("n > 0").groupBy("cls").agg(
        F.min("id").alias("id"), F.max("screened").alias("screened"), F.count(F.lit(1)).alias("copies")
    )
    wanted = classes.filter("screened").select("id")
    source = id_and_text(docs, id_col, text_col)
    # The same plan at every size: both sides move by id, and the narrow one is hashed.
    wanted = wanted.hint("shuffle_hash")
    texts = source.join(wanted, source["id"].eqNullSafe(wanted["id"]), "left_semi").select("text")
    packed = StructType(
        [StructField("unit", LongType()), StructField("sizes", BinaryType()), StructField("tokens", BinaryType())]
    )
    units = stage(texts.mapInArrow(_set_units(to_arrow_schema(packed), size), packed), "screened-sets")
    volume = units.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // PART_BYTES))
    dealt = StructType(
        [StructField("part", IntegerType()), StructField("unit", LongType()), StructField("tokens", BinaryType())]
    )
    counts = (
        units.select("unit", "tokens")
        .mapInArrow(_deal(to_arrow_schema(dealt), parts), dealt)
        .groupBy("part")
        .applyInArrow(_count(to_arrow_schema(dealt)), dealt)
    )
    class_row = StructType(
        [
            StructField("cls", BinaryType()),
            StructField("n", LongType()),
            StructField("lonely", LongType()),
            StructField("tokens", BinaryType()),
            StructField("flags", BinaryType()),
            StructField("keys", ArrayType(LongType())),
        ]
    )
    sets = stage(
        units.groupBy("unit")
        .cogroup(counts.groupBy("unit"))
        .applyInArrow(_classes(to_arrow_schema(class_row), parts), class_row),
        "orders",
    )

    postings = sets.select(F.explode("keys").alias("token"), "lonely", "n", "cls")
    pivots = (
        postings.groupBy("token")
        .agg(F.min(F.struct("lonely", "cls"))["cls"].alias("pivot"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    bundles = stage(postings.join(pivots, "token").select("pivot", "cls", "n").distinct(), "bundles")
    # A class lies in no more bundles than its prefix has tokens; 64-bit hashes of their pivots put them in order.
    own = F.xxhash64("pivot")
    placed = bundles.groupBy("cls").agg(F.collect_list(own).alias("pivots"))
    payload = sets.select("cls", "tokens", "flags").join(classes.select("cls", "copies"), "cls").join(placed, "cls")

    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    sizes = bundles.groupBy("pivot").agg(blocks.alias("blocks"))
    members = bundles.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    keys = ["pivot", "low", "high"]
    rows = members.select("pivot", "cls", "n", "block", other).select(
        "pivot", own.alias("own"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "cls", "n",
    )
    cells = rows.join(payload, "cls").repartition(*keys).sortWithinPartitions(*keys, "cls")
    link = StructType(
        [StructField("cls", BinaryType()), StructField("other", BinaryType()), StructField("links", LongType())]
    )
    return stage(cells.mapInArrow(_cells(to_arrow_schema(link), pairs), link), "class-links")


def jaccard_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5
) -> tuple[DataFrame, DataFrame]:
    """All links as (a, b) between classes, each once with a < b, and (id, cls, n_shingles) of every document.

    Documents of one class have equal sets; those without shingles link with nothing.
    """
    found = profile(docs, id_col, text_col, shingle_words)
    links = class_links(docs, found, id_col, text_col, shingle_words, pairs=True)
    pairs = links.filter("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b"))
    return pairs, found.select(F.col("id").alias(id_col), "cls", F.col("n").alias("n_shingles"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5
) -> DataFrame:
    """(id, n_shingles, component_id, n_links) of every document."""
    found = profile(docs, id_col, text_col, shingle_words)
    links = class_links(docs, found, id_col, text_col, shingle_words)
    roots = components(links.filter("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    others = links.filter("other IS NULL").groupBy("cls").agg(F.sum("links").alias("others"))
    first = found.filter("n > 0").groupBy("cls").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    linked = first.join(roots.withColumnRenamed("node", "cls"), "cls")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = (
        first.join(linked.select("cls", "root").join(smallest, "root").select("cls", "component_id"), "cls", "left")
        .join(others, "cls", "left")
        .select(
            "cls",
            F.coalesce("component_id", "first").alias("component_id"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return found.join(by_class, "cls", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
