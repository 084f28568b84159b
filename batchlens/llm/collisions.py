"""Near-duplicate vectors of equal label by collision-counting projections.

Vectors of length 1 are projected on random directions. Two of them whose cosine is the threshold lie sqrt(2 - 2 cos)
apart, so their projections differ by a normal value of that deviation; two deviations to either side of a vector are
its window in each sorted projection. A pair is verified when one lies in the window of the other in enough
projections: `count_needed` is the largest count that pairs at the threshold reach with the wanted recall, and closer
pairs reach it more often.

A pair must also meet in one of several bundles of projections, that is, fall into the window in each projection of
the bundle. A bundle cuts space into cells four windows wide: a vector is at home in one cell and visits the
neighbours that its windows reach, at most one in each direction. The more vectors of one label, the longer the
bundles, and the more of them to keep the recall; a cell holds a bounded share. A cell with too many vectors is cut in
blocks, each against each. A pair counts in the first bundle it meets in, and there in one cell only.

Equal vectors of one label fold to one class before anything else. A cell gives one row for each class with links:
their number, and a class that it hangs together with; pairs are never listed.

Defined results: vectors that are NULL, empty or zero, hold NULL or non-finite components or have a NULL label link
with nothing; only vectors of equal length link. Ids may repeat or be NULL: every row is a vector of its own, and the
smallest id that is not NULL names a component. Only the three named columns are read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.components import components
from batchlens.session import stage

#: Projections are kept as whole numbers of this fraction.
UNIT = 1 << 16
#: Half the width of a window in deviations of a pair at the threshold.
DEVIATIONS = 2.0
#: Cells are as many half windows wide.
CELL_WIDTH = 4
#: Share of the vectors that a cell holds in one projection, and the number of vectors it should hold in all.
CELL_SHARE = 0.4
CELL_ROWS = 8192
#: A block of a cell that holds more.
BLOCK_ROWS = 8192
LEAST_PROJECTIONS = 16
#: Share of the pairs at the threshold that may be missed by the bundles, and as many again by the count.
MISSED = 1e-4
#: Pairs of a cell that are held before they fold to components.
PAIRS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Scheme:
    """How vectors of one table are projected: `bundles` of `width` projections, `projections` in all."""

    threshold: float
    width: int
    bundles: int
    projections: int
    needed: int
    window: int

    def directions(self, dims: int) -> np.ndarray:
        return np.random.default_rng([7, dims]).standard_normal((dims, self.projections))


def count_needed(projections: int, chance: float, missed: float = MISSED) -> int:
    """Largest count that a pair which collides with this chance in each projection fails with at most `missed`."""
    below = 0.0
    for k in range(projections + 1):
        below += comb(projections, k) * chance**k * (1 - chance) ** (projections - k)
        if below > missed:
            return k
    return projections


def scheme_for(largest_label: int, threshold: float) -> Scheme:
    """Bundles long enough for the largest label, and enough of them."""
    chance = erf(DEVIATIONS / sqrt(2))
    width = max(1, ceil(log(max(largest_label, 1) / CELL_ROWS) / -log(CELL_SHARE)))
    bundles = ceil(log(MISSED) / log(1 - chance**width))
    projections = max(LEAST_PROJECTIONS, width * bundles)
    window = ceil(DEVIATIONS * sqrt(2 - 2 * threshold) * UNIT)
    return Scheme(threshold, width, bundles, projections, count_needed(projections, chance), window)


def classes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, cls), and classes (cls, label, raw, n, least id) of equal vectors; cls is NULL where nothing links."""
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & (F.size("raw") > 0) & finite & F.exists("raw", lambda x: x != 0)
    lanes = F.xxhash64("label", "raw"), F.xxhash64(F.lit(1), "raw", "label")
    cls = F.concat(*[F.lpad(F.hex(lane), 16, "0") for lane in lanes])
    rows = vectors.select(
        vectors[id_col].alias("id"),
        vectors[label_col].alias("label"),
        vectors[vector_col].cast("array<double>").alias("raw"),
    ).withColumn("cls", F.when(usable, cls))
    classes = (
        rows.filter("cls is not null")
        .groupBy("cls")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("raw").alias("raw"),
            F.count(F.lit(1)).alias("n"),
            F.min("id").alias("least_id"),
        )
    )
    return rows.select("id", "cls"), classes


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component first, so that no square overflows."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cell_visits(projected: np.ndarray, scheme: Scheme) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """(bundle, at home, rows, cells): the home cell of each row, and neighbours above it that its windows reach."""
    wide = CELL_WIDTH * scheme.window
    for bundle in range(scheme.bundles):
        own = projected[:, bundle * scheme.width : (bundle + 1) * scheme.width]
        home = own // wide
        step = ((own + scheme.window) // wide - home) + ((own - scheme.window) // wide - home)
        everything = np.arange(len(own))
        yield bundle, True, everything, home
        for mask in range(1, 1 << scheme.width):
            moved = np.array([mask >> j & 1 for j in range(scheme.width)])
            first = int(np.argmax(moved))
            # The pair is found from its lower cell only.
            rows = everything[((step != 0) | (moved == 0)).all(axis=1) & (step[:, first] > 0)]
            if len(rows):
                yield bundle, False, rows, home[rows] + step[rows] * moved


def fold_pairs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A member of its component for each of n nodes, the same for all members, over links between a and b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        while True:
            shorter = after[after]
            if (shorter == after).all():
                break
            after = shorter
        if (after == root).all():
            return root
        root = after


def cell_links(
    scheme: Scheme,
    bundle: int,
    names: np.ndarray,
    weights: np.ndarray,
    at_home: np.ndarray,
    asks: np.ndarray,
    listed: np.ndarray,
    projected: np.ndarray,
    units: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each row of a cell; rows that ask look for rows that are listed."""
    n = len(names)
    rows = np.flatnonzero(listed)
    orders = np.argsort(projected[rows], axis=0, kind="stable")
    ordered = np.take_along_axis(projected[rows], orders, axis=0)
    links, root = np.zeros(n, np.int64), np.arange(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    held_pairs = 0

    def fold():
        nonlocal root, held_pairs
        a = np.concatenate([np.arange(n), *[h[0] for h in held]])
        b = np.concatenate([root, *[h[1] for h in held]])
        root = fold_pairs(n, a, b)
        held.clear()
        held_pairs = 0

    asking = np.flatnonzero(asks)
    low = np.stack(
        [np.searchsorted(ordered[:, j], projected[asking, j] - scheme.window) for j in range(scheme.projections)], 1
    )
    high = np.stack(
        [
            np.searchsorted(ordered[:, j], projected[asking, j] + scheme.window, side="right")
            for j in range(scheme.projections)
        ],
        1,
    )
    for i, q in enumerate(asking):
        counts = np.zeros(len(rows), np.uint16)
        for j in range(scheme.projections):
            counts[orders[low[i, j] : high[i, j], j]] += 1
        near = rows[counts >= scheme.needed]
        if at_home[q]:
            near = near[names[near] > names[q]]
        if not len(near):
            continue
        inside = np.abs(projected[near] - projected[q]) <= scheme.window
        bundled = inside[:, : scheme.bundles * scheme.width].reshape(len(near), scheme.bundles, scheme.width).all(axis=2)
        near = near[bundled[:, bundle] & ~bundled[:, :bundle].any(axis=1)]
        near = near[units[near] @ units[q] >= scheme.threshold]
        if len(near):
            links[q] += weights[near].sum()
            links[near] += weights[q]
            held.append((np.full(len(near), q), near))
            held_pairs += len(near)
            if held_pairs >= PAIRS_AT_ONCE:
                fold()
    if held:
        fold()
    return links, root


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: linked rows, smallest id reachable, whether it is its own."""
    rows, classes = classes_of(vectors, id_col, vector_col, label_col)
    rows, classes = stage(rows, "rows"), stage(classes, "classes")
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    scheme = scheme_for(largest, threshold)
    label_type = classes.schema["label"].dataType.simpleString()
    kept = f"cls string, label {label_type}, n long, bundle int, cell array<int>, home boolean"
    heavy = "unit array<double>, projected array<int>"

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(x) for x in batch["raw"]], int)
            for d in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == d)))
                units = unit_vectors(_matrix(part["raw"]))
                projected = np.floor(units @ scheme.directions(d) * UNIT).astype(np.int32)
                for bundle, home, at, cells in cell_visits(projected, scheme):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part[c].take(pa.array(at)) for c in ("cls", "label", "n")],
                            pa.array(np.full(len(at), bundle, np.int32)),
                            pa.array(list(cells.astype(np.int32)), pa.list_(pa.int32())),
                            pa.array(np.full(len(at), home)),
                            pa.array(list(units[at]), pa.list_(pa.float64())),
                            pa.array(list(projected[at]), pa.list_(pa.int32())),
                        ],
                        names=["cls", "label", "n", "bundle", "cell", "home", "unit", "projected"],
                    )

    visits = classes.select("cls", "label", "n", "raw").mapInArrow(visit, f"{kept}, {heavy}")
    visits = stage(visits.withColumn("dims", F.size("unit")), "visits")
    key = ["bundle", "label", "dims", "cell"]
    full = (
        visits.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("all"), F.count_if("home").alias("homes"))
        .filter((F.col("homes") > 0) & (F.col("all") > block_rows))
        .select(
            *key,
            F.ceil(F.col("all") / block_rows).cast("int").alias("asking"),
            F.ceil(F.col("homes") / block_rows).cast("int").alias("listing"),
        )
    )
    # One row per cell beyond the bound.
    cut = visits.join(stage(full, "full-cells"), key, "left").withColumns(
        {c: F.coalesce(c, F.lit(1)) for c in ("asking", "listing")}
    )
    ask = F.pmod(F.xxhash64("cls", F.lit("ask")), "asking").cast("int")
    lists = F.pmod(F.xxhash64("cls", F.lit("list")), "listing").cast("int")
    cut = cut.withColumns({"ask": ask, "lists": lists})
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    asked = F.transform(
        every("listing"),
        lambda k: F.struct(
            F.col("ask").alias("row"),
            k.alias("column"),
            F.lit(True).alias("asks"),
            (F.col("home") & (k == F.col("lists"))).alias("listed"),
        ),
    )
    listed = F.transform(
        F.filter(every("asking"), lambda k: F.col("home") & (k != F.col("ask"))),
        lambda k: F.struct(
            k.alias("row"), F.col("lists").alias("column"), F.lit(False).alias("asks"), F.lit(True).alias("listed")
        ),
    )
    placed = cut.select(
        *key, "cls", "n", "home", "unit", "projected", F.explode(F.concat(asked, listed)).alias("at")
    ).select(*key, "cls", "n", "home", "unit", "projected", "at.*")

    def solve(group: pa.Table) -> pa.Table:
        names = group["cls"].to_numpy().astype("S32")
        links, root = cell_links(
            scheme,
            group["bundle"][0].as_py(),
            names,
            group["n"].to_numpy(),
            *[group[c].to_numpy() for c in ("home", "asks", "listed")],
            _matrix(group["projected"]),
            _matrix(group["unit"]),
        )
        found = np.flatnonzero(links)
        return pa.table(
            {
                "cls": group["cls"].take(pa.array(found)),
                "root": group["cls"].take(pa.array(root[found])),
                "links": links[found],
            }
        )

    linked = stage(
        placed.groupBy(*key, "row", "column").applyInArrow(solve, "cls string, root string, links long"), "linked"
    )
    sums = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(linked.filter("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    known = stage(
        classes.select("cls", "n", "least_id")
        .join(sums, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select(
            "cls",
            "least_id",
            F.coalesce("root", "cls").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        "linked-classes",
    )
    named = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = stage(known.join(named, "root").select("cls", "n_links", "component_id"), "named-classes")
    component = F.when(F.isnull("cls"), F.col("id")).otherwise(F.col("component_id"))
    return rows.join(found, "cls", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
