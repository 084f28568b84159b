"""Hard negatives by best-first search of STR-packed R-trees.

Rows of one label are packed by sort-tile-recursive: quantiles of the first coordinate cut slabs, quantiles of the
second cut each slab in tiles, and a tile with more than `TILE_ROWS` rows, as equal vectors make it, is cut in pieces.
Inside a tile the next coordinates go on with the packing down to pages of `PAGE_ROWS` rows; a page keeps its rows and
its minimum bounding box. The box gives an interval for each coordinate, and so for the inner product with a query:

    sum of min(q * low, q * high)  <=  <q, x>  <=  sum of max(q * low, q * high)

A query searches a tile best first: a queue hands out the box with the highest bound, and a box is passed over when its
interval lies outside the score windows, or when what it could still give is strictly below the k-th score found. Equal
bounds are opened, so ties end with the smaller id.

Queries go in blocks to the tiles; a block meets a tile only if the interval between the block's own box and the box
of the tile touches the windows of the block. The positives of an anchor come first, from the tiles of its label; what
the anchor's own tile gives is the threshold for the others. Negatives come from the tiles of all other labels, with
one window per positive.

Defined results: rows with a NULL id or label, a NULL or empty vector or NULL or non-finite components take no part,
and only vectors of equal length meet. Rows with the anchor's id are its own and are left out; an id that repeats among
anchors asks once, with its smallest vector (then label). Scores must fit 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.session import stage

TILE_ROWS = 32_768
PAGE_ROWS = 64
FAN_OUT = 16
#: Anchors that search a tile together.
BLOCK_QUERIES = 1024
#: Coordinates are cut at these quantiles, so an axis has as many slabs at most.
QUANTILES = 256
#: Coordinates that tile the rows of one task, after the two of the tiles.
LOCAL_AXES = 3
#: Bounds between blocks and tiles are computed in doubles and widened by this share, and by one.
SLACK = 1e-9
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def points(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dims, v): whole-number components of the rows that take part."""
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        vectors.select(
            vectors[id_col].alias("id"),
            vectors[label_col].alias("label"),
            vectors[vector_col].cast("array<double>").alias("raw"),
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("raw") > 0) & finite)
        .select(
            "id",
            "label",
            F.size("raw").alias("dims"),
            F.transform("raw", lambda x: F.floor(x * scale).cast("long")).alias("v"),
        )
    )


def _slabs(rows: DataFrame, key: list[str], axis: int, name: str) -> DataFrame:
    """The rows with the slab of one coordinate, `per_axis` of about equal size within the key."""
    value = F.coalesce(F.try_element_at("v", F.lit(axis + 1)), F.lit(0))
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    cuts = stage(rows.groupBy(*key).agg(F.percentile_approx(value, shares).alias("cuts")), "cuts")
    below = F.size(F.filter("cuts", lambda c: c < F.col("axis_value")))
    return (
        rows.join(cuts, key)
        .withColumn("axis_value", value)
        .withColumn(name, F.floor(below * F.least("per_axis", F.lit(QUANTILES)) / QUANTILES).cast("int"))
        .drop("cuts", "axis_value")
    )


def tiled(rows: DataFrame, tile_rows: int) -> DataFrame:
    """The rows with their tile, a text; a tile has one label and length, and about `tile_rows` rows at most."""
    group = ["label", "dims"]
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    per_axis = F.ceil(F.sqrt(F.ceil(F.col("n") / tile_rows))).cast("int").alias("per_axis")
    placed = rows.join(stage(sizes.select(*group, per_axis), "sizes"), group)
    placed = _slabs(placed, group, 0, "first")
    placed = stage(_slabs(placed, [*group, "first"], 1, "second"), "slabs")
    corner = [*group, "first", "second"]
    counts = placed.groupBy(*corner).agg(F.ceil(F.count(F.lit(1)) / tile_rows).alias("pieces"))
    piece = F.pmod(F.xxhash64("id", "v"), F.col("pieces"))
    tile = F.concat_ws("/", F.hex(F.xxhash64("label")), "label", "dims", "first", "second", piece)
    return placed.join(stage(counts, "pieces"), corner).select(*rows.columns, tile.alias("tile"))


def str_order(v: np.ndarray, rows: np.ndarray, axes: list[int], page_rows: int) -> list[np.ndarray]:
    """Pages of row numbers: sorted by an axis and cut in slabs, each of them likewise by the axes left."""
    pages = -(-len(rows) // page_rows)
    ordered = rows[np.argsort(v[rows, axes[0]], kind="stable")]
    if len(axes) == 1 or pages == 1:
        return [ordered[i : i + page_rows] for i in range(0, len(ordered), page_rows)]
    slabs = int(np.ceil(pages ** (1 / len(axes))))
    slab_rows = -(-pages // slabs) * page_rows
    return [
        page
        for i in range(0, len(ordered), slab_rows)
        for page in str_order(v, ordered[i : i + slab_rows], axes[1:], page_rows)
    ]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def packed(rows: DataFrame, page_rows: int) -> DataFrame:
    """One row per page: (tile, label, dims, page, low, high, ids, flat), `flat` the vectors one after the other."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def pack(table: pa.Table) -> pa.Table:
        v = _matrix(table["v"])
        dims = v.shape[1]
        axes = [a for a in range(2, 2 + LOCAL_AXES) if a < dims] or [0]
        pages = str_order(v, np.arange(len(v)), axes, page_rows)
        ids = table["id"].combine_chunks()
        first = pa.array(np.zeros(len(pages), np.int64))
        return pa.table(
            {
                **{c: table[c].take(first) for c in ("tile", "label", "dims")},
                "page": pa.array(np.arange(len(pages), dtype=np.int32)),
                "low": pa.array([v[p].min(axis=0) for p in pages], pa.list_(pa.int64())),
                "high": pa.array([v[p].max(axis=0) for p in pages], pa.list_(pa.int64())),
                "ids": pa.array([ids.take(pa.array(p)).to_pylist() for p in pages], pa.list_(ids.type)),
                "flat": pa.array([v[p].ravel() for p in pages], pa.list_(pa.int64())),
            }
        )

    schema = (
        f"tile string, label {fields['label']}, dims int, page int, low array<long>, high array<long>, "
        f"ids array<{fields['id']}>, flat array<long>"
    )
    return rows.groupBy("tile").applyInArrow(pack, schema)


class Tree:
    """The R-tree of one tile: its pages, and boxes over `FAN_OUT` neighbours each up to one root."""

    def __init__(self, pages: pa.Table):
        pages = pages.sort_by("page")
        low, high = _matrix(pages["low"]), _matrix(pages["high"])
        self.ids = [np.asarray(i) for i in pages["ids"].to_pylist()]
        self.rows = [f.values.to_numpy().reshape(-1, low.shape[1]) for f in pages["flat"]]
        self.levels = [(low, high)]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FAN_OUT)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def search(self, query: np.ndarray, own, least: np.ndarray, most: np.ndarray, k: int):
        """Per window [least, most] the k best (ids, scores), ties to the smaller id."""
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        windows = range(len(least))
        ids = [np.empty(0, self.ids[0].dtype)] * len(least)
        scores = [np.empty(0, np.int64)] * len(least)
        # What a row must reach at least: the window, and once it is full its k-th score.
        need = least.copy()

        def bounds(level: int, at: slice):
            low, high = self.levels[level][0][at], self.levels[level][1][at]
            return low @ plus + high @ minus, high @ plus + low @ minus

        def wanted(lower, upper) -> bool:
            return bool(((upper >= need) & (lower <= most) & (need <= most)).any())

        top = len(self.levels) - 1
        lower, upper = bounds(top, slice(0, 1))
        queue = [(-int(upper[0]), top, 0, int(lower[0]))]
        while queue:
            upper, level, at, lower = heapq.heappop(queue)
            if not wanted(lower, -upper):
                continue
            if level:
                begin = at * FAN_OUT
                lows, highs = bounds(level - 1, slice(begin, begin + FAN_OUT))
                for i, (lo, hi) in enumerate(zip(lows.tolist(), highs.tolist())):
                    if wanted(lo, hi):
                        heapq.heappush(queue, (-hi, level - 1, begin + i, lo))
                continue
            found = self.rows[at] @ query
            names = self.ids[at]
            for w in windows:
                good = (found >= need[w]) & (found <= most[w]) & (names != own)
                if good.any():
                    both, values = np.concatenate([ids[w], names[good]]), np.concatenate([scores[w], found[good]])
                    best = np.lexsort((both, -values))[:k]
                    ids[w], scores[w] = both[best], values[best]
                    if len(best) == k:
                        need[w] = values[best][-1]
        return ids, scores


def _box(rows: DataFrame, key: list[str], low: str, high: str) -> DataFrame:
    """(key, low, high): the box around the boxes of the rows, computed coordinate by coordinate."""
    both = F.posexplode(F.arrays_zip(F.col(low).alias("low"), F.col(high).alias("high"))).alias("at", "box")
    ends = (
        rows.select(*key, both)
        .groupBy(*key, "at")
        .agg(F.min("box.low").alias("low"), F.max("box.high").alias("high"))
    )
    parts = ends.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "low", "high"))).alias("box"))
    take = lambda c: F.transform("box", lambda b: b[c].cast("double")).alias(c)
    return parts.select(*key, take("low"), take("high"))


def _meetings(blocks: DataFrame, tiles: DataFrame, same_label: bool) -> DataFrame:
    """(block, tile) that can hold a row inside the windows of the block: few rows, each for a block and a tile."""
    b, t = blocks.alias("b"), tiles.alias("t")
    labels = F.col("b.label") == F.col("t.label")
    met = b.join(t, (F.col("b.dims") == F.col("t.dims")) & (labels if same_label else ~labels))
    products = F.zip_with(
        F.arrays_zip(F.col("b.low").alias("a"), F.col("b.high").alias("b")),
        F.arrays_zip(F.col("t.low").alias("c"), F.col("t.high").alias("d")),
        lambda q, x: F.array(q["a"] * x["c"], q["a"] * x["d"], q["b"] * x["c"], q["b"] * x["d"]),
    )
    total = lambda pick: F.aggregate(products, F.lit(0.0), lambda s, p: s + pick(p))
    upper, lower = total(F.array_max), total(F.array_min)
    give = 1 + SLACK * F.greatest(F.abs(upper), F.abs(lower))
    return met.filter((upper + give >= F.col("least")) & (lower - give <= F.col("most"))).select("block", "tile")


def search(
    queries: DataFrame, pages: DataFrame, meetings: DataFrame | None, k: int, block: str = "block"
) -> DataFrame:
    """(query_id, tag, id, score): the k best rows of each tile for each window of each query that meets it.

    Queries are (id, v, block, windows of (tag, least, most)). Without meetings, queries meet the tile that names
    their block.
    """
    left, right = queries, pages
    if meetings is not None:
        left, right = queries.join(meetings, block), pages.join(meetings, "tile")
    keys = [block] if meetings is None else [block, "tile"]
    right_keys = ["tile"] if meetings is None else keys
    id_type = queries.schema["id"].dataType.simpleString()

    def cell(asked: pa.Table, tile: pa.Table) -> pa.Table:
        names = asked.schema.field("id").type
        columns: dict[str, list] = {c: [] for c in ("query_id", "tag", "id", "score")}
        if asked.num_rows and tile.num_rows:
            tree = Tree(tile)
            for own, v, windows in zip(*[asked[c].to_pylist() for c in ("id", "v", "windows")]):
                least, most = (np.array([w[c] for w in windows], np.int64) for c in ("least", "most"))
                ids, scores = tree.search(np.array(v, np.int64), own, least, most, k)
                for w, found, values in zip(windows, ids, scores):
                    columns["query_id"] += [own] * len(found)
                    columns["tag"] += [w["tag"]] * len(found)
                    columns["id"] += found.tolist()
                    columns["score"] += values.tolist()
        kinds = {"query_id": names, "tag": names, "id": names, "score": pa.int64()}
        return pa.table({c: pa.array(columns[c], kind) for c, kind in kinds.items()})

    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*right_keys))
        .applyInArrow(cell, f"query_id {id_type}, tag {id_type}, id {id_type}, score long")
    )


def _blocks(queries: DataFrame) -> DataFrame:
    """Box and outermost windows of each block of queries."""
    reach = queries.groupBy("block").agg(
        F.any_value("label").alias("label"),
        F.any_value("dims").alias("dims"),
        F.min(F.array_min(F.transform("windows", lambda w: w["least"]))).alias("least"),
        F.max(F.array_max(F.transform("windows", lambda w: w["most"]))).alias("most"),
    )
    box = _box(queries.select("block", F.col("v").alias("a"), F.col("v").alias("b")), ["block"], "a", "b")
    return stage(reach.join(box, "block"), "blocks")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tile_rows: int = TILE_ROWS,
    page_rows: int = PAGE_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows `is_anchor` picks.

    The positives of an anchor are its best rows of the same label. For each, the best rows of other labels are given
    whose score lies between the two percentages of the positive's. `is_anchor` is an expression over a column `id`.
    """
    rows = tiled(stage(points(vectors, scale, id_col, vector_col, label_col), "points"), tile_rows)
    rows = stage(rows, "tiled")
    pages = stage(packed(rows, page_rows), "pages")
    tiles = stage(_box(pages, ["tile", "label", "dims"], "low", "high"), "tiles")
    anchors = (
        rows.filter(is_anchor)
        .groupBy("id")
        .agg(F.min(F.struct("v", "label", "dims", "tile")).alias("a"))
        .select("id", "a.*")
    )
    id_type = rows.schema["id"].dataType
    no_tag = F.lit(None).cast(id_type).alias("tag")
    window = lambda tag, least, most: F.struct(tag, least.cast("long").alias("least"), most.cast("long").alias("most"))
    everything = F.array(window(no_tag, F.lit(LOWEST), F.lit(HIGHEST))).alias("windows")
    block = F.concat_ws(
        "/", F.hex(F.xxhash64("label")), "label", "dims", F.pmod(F.xxhash64("id"), F.col("parts"))
    ).alias("block")
    sizes = anchors.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / block_queries).alias("parts"))
    anchors = stage(anchors.join(stage(sizes, "anchor-sizes"), ["label", "dims"]).select(*anchors.columns, block), "anchors")

    # Anchors of one tile are about one in so many of its rows, as anchors are of all.
    home = search(anchors.select("id", "v", "tile", everything), pages, None, positives, block="tile")
    reached = home.groupBy(F.col("query_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("score")
    )
    threshold = F.when(F.col("n") == positives, F.col("score")).otherwise(F.lit(LOWEST))
    asked = anchors.join(reached, "id", "left").select(
        *anchors.columns,
        F.array(window(no_tag, F.coalesce(threshold, F.lit(LOWEST)), F.lit(HIGHEST))).alias("windows"),
    )
    asked = stage(asked, "asked")
    found = search(
        asked.select("id", "v", "block", "windows"), pages, stage(_meetings(_blocks(asked), tiles, True), "met"), positives
    )
    best = stage(
        _best(found, positives).select(
            F.col("query_id").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    share = lambda p, c: (p * F.col(c) - F.pmod(p * F.col(c), F.lit(100))) / 100
    least = -F.floor(share(-low_percent, "positive_score"))
    most = F.floor(share(high_percent, "positive_score"))
    windows = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(window(F.col("positive_id").alias("tag"), least, most)).alias("windows")
    )
    asked = stage(anchors.join(windows, "id"), "asked-negatives")
    found = search(
        asked.select("id", "v", "block", "windows"), pages, stage(_meetings(_blocks(asked), tiles, False), "met"), negatives
    )
    return (
        _best(found, negatives)
        .select(F.col("query_id").alias("anchor_id"), F.col("tag").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(best, ["anchor_id", "positive_id"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
