"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. Its key is the depth with two exclusive-or lanes of position-salted
turn hashes, so a key follows from its parent's and all turns get theirs by running aggregates. Every node gives an
enter arc and an exit arc; children come in the order of their smallest member. The arcs form one list,

    enter(v) -> enter(first child), or exit(v) of a leaf        exit(v) -> enter(next sibling), or exit(parent)

which is ranked by contraction: in every round an arc with coin 0 takes over its successor with coin 1, so a quarter
of the list goes. A list of `LISTED_AT_ONCE` arcs or less is walked by one task, and the rounds are undone in reverse.
With arcs at their places, what a subtree holds is a difference of two prefix sums.

No conversation, parent or member list is gathered: running aggregates cut sorted rows by range, so the rows of one
key may lie in many tasks, and digests of members are computed over a sorted stream.

Defined results: rows without conv_id take no part; NULL turns come first, and turns with equal numbers follow the
hashes of their role and text; NULL roles and texts are empty; rows that repeat count as further turns. A table
without conversations gives an empty trie, without a root. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.session import stage

#: Arcs that one task walks at the end of the contraction.
LISTED_AT_ONCE = 65_536
#: Neighbouring places of the tour that are summed by one window.
PLACES_AT_ONCE = 65_536


def numbered(rows: DataFrame, key: list[str], order: list[str], lanes: Iterable[str] = ()) -> DataFrame:
    """The rows with `pos`, their place from 1 within the key, and running exclusive-ors `x_<lane>` of the lanes.

    Rows are sorted into ranges by key and order, so a key with many rows is cut between tasks. Each piece is numbered
    by itself; a piece that continues a key adds the totals of the key's earlier pieces, of which there are fewer than
    tasks in all.
    """
    lanes = list(lanes)
    ranged = rows.repartitionByRange(*key, *order).withColumn("piece", F.spark_partition_id())
    cut = stage(ranged, "ranges")
    totals = cut.groupBy(*key, "piece").agg(
        F.count(F.lit(1)).alias("n_before"), *[F.bit_xor(x).alias(f"{x}_before") for x in lanes]
    )
    earlier = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    names = ["n_before", *[f"{x}_before" for x in lanes]]
    before = [F.sum("n_before").over(earlier).alias("n_before")]
    before += [F.bit_xor(f"{x}_before").over(earlier).alias(f"{x}_before") for x in lanes]
    offsets = stage(totals.select(*key, "piece", *before).filter(F.col("n_before").isNotNull()), "offsets")
    so_far = Window.partitionBy("piece", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(
        "*",
        F.row_number().over(so_far).cast("long").alias("pos"),
        *[F.bit_xor(x).over(so_far).alias(f"x_{x}") for x in lanes],
    )
    shift = {n: F.coalesce(n, F.lit(0)) for n in names}
    return local.join(offsets, [*key, "piece"], "left").select(
        *rows.columns,
        (F.col("pos") + shift["n_before"]).alias("pos"),
        *[F.col(f"x_{x}").bitwiseXOR(shift[f"{x}_before"]).alias(f"x_{x}") for x in lanes],
    )


def turns_of(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, a, b, n_bytes): turns in order, role and text as two hashes."""
    source = conversations
    role = F.coalesce(source[role_col].cast("string"), F.lit(""))
    text = F.coalesce(source[text_col].cast("string"), F.lit(""))
    rows = source.filter(source[conv_col].isNotNull()).select(
        source[conv_col].cast("long").alias("conv"),
        source[turn_col].alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, role, F.lit(1)).alias("b"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    return stage(numbered(rows, ["conv"], ["turn", "a", "b"]).drop("turn"), "turns")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another one: (conversations, their turns).

    Conversation c takes the first h turns of conversation c - c % group, h = crc32(c as text) % heads, and goes on
    with its own turns after its first h. A conversation may end up without turns.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base_sizes = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    head = F.crc32(F.col("conv").cast("string")) % heads
    convs = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"), head.alias("head")).join(
        base_sizes, "base", "left"
    )
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    total = taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = stage(convs.select("conv", "base", "head", taken.alias("taken"), total.alias("total")), "conversations")
    own = (
        turns.join(convs, "conv")
        .filter(F.col("pos") > F.col("head"))
        .select("conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "a", "b", "n_bytes", "total")
    )
    # At most `heads` - 1 turns of a conversation go to at most `group` conversations.
    lent = turns.filter(F.col("pos") < heads).withColumnRenamed("conv", "base")
    first = (
        lent.join(convs, "base")
        .filter(F.col("pos") <= F.col("head"))
        .select("conv", F.col("pos").alias("depth"), "a", "b", "n_bytes", "total")
    )
    return convs, own.unionByName(first)


def member_digests(ends: DataFrame, key: list[str], member: str) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the members of each key, in rising order, joined by commas.

    A task reads the members of a key as a sorted stream and keeps the state of one digest, whatever their number.
    """
    fields = [f for f in ends.select(*key).schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", ends_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state, done = None, None, []

        def flush():
            columns = [pa.array([k[i] for k, _ in done], type=types[i]) for i in range(len(key))]
            names = [*key, "ends_sha256"]
            return pa.RecordBatch.from_arrays([*columns, pa.array([h for _, h in done], pa.string())], names=names)

        for batch in batches:
            types = [batch.schema.field(k).type for k in key]
            keys = zip(*[batch[k].to_pylist() for k in key])
            for k, m in zip(keys, batch[member].to_pylist()):
                if k == open_key:
                    state.update(b",%d" % m)
                    continue
                if state is not None:
                    done.append((open_key, state.hexdigest()))
                open_key, state = k, hashlib.sha256(b"%d" % m)
            yield flush()
            done.clear()
        if state is not None:
            done.append((open_key, state.hexdigest()))
            yield flush()

    dealt = ends.select(*key, member).repartition(*key).sortWithinPartitions(*key, member)
    return dealt.mapInArrow(digest, schema)


def list_ranks(links: DataFrame, at_once: int = LISTED_AT_ONCE) -> DataFrame:
    """(arc, place) for the one list given by links (arc, next), whose last arc has no next; places count from 0.

    Each round costs a join over what is left of the list, and the whole contraction about four times the first.
    """
    current = stage(links.select("arc", "next", F.lit(1).cast("long").alias("gap")), "tour")
    rounds: list[DataFrame] = []
    while current.count() > at_once:
        salt = len(rounds)

        def coin(arc: str) -> Column:
            return F.xxhash64(arc, F.lit(salt)).bitwiseAND(F.lit(1)) == 1

        takes = F.col("next").isNotNull() & ~coin("arc") & coin("next")
        owners = current.filter(takes).select(
            F.col("arc").alias("owner"), F.col("next").alias("taken"), F.col("gap").alias("offset")
        )
        met = stage(current.join(owners, F.col("arc") == F.col("taken"), "left").drop("taken"), "contracted")
        rounds.append(met.filter("owner is not null").select("arc", "owner", "offset"))
        kept = met.filter(F.isnull("owner") & ~takes).select("arc", "next", "gap")
        longer = met.filter("owner is not null").select(
            F.col("owner").alias("arc"), "next", (F.col("offset") + F.col("gap")).alias("gap")
        )
        current = kept.unionByName(longer)

    def walk(table: pa.Table) -> pa.Table:
        arcs = [tuple(a.values()) for a in table["arc"].to_pylist()]
        following = [a and tuple(a.values()) for a in table["next"].to_pylist()]
        gaps = table["gap"].to_pylist()
        row_of = {a: i for i, a in enumerate(arcs)}
        at = row_of[next(iter(set(arcs) - set(following)))] if arcs else None
        rows, places, place = [], [], 0
        while at is not None:
            rows.append(at)
            places.append(place)
            place += gaps[at]
            at = row_of.get(following[at])
        return pa.table({"arc": table["arc"].take(pa.array(rows, pa.int64())), "place": pa.array(places, pa.int64())})

    arc_type = links.schema["arc"].dataType.simpleString()
    whole = current.withColumn("all", F.lit(0)).groupBy("all")
    ranks = stage(whole.applyInArrow(walk, f"arc {arc_type}, place long"), "walked")
    for taken in reversed(rounds):
        owners = ranks.select(F.col("arc").alias("owner"), "place")
        undone = taken.join(owners, "owner").select("arc", (F.col("place") + F.col("offset")).alias("place"))
        ranks = stage(ranks.unionByName(undone), "ranks")
    return ranks


def _arc(conv: Column, depth: Column, leaving: bool) -> Column:
    return F.struct(conv.alias("conv"), depth.alias("depth"), F.lit(leaving).alias("leaving"))


def tour(nodes: DataFrame) -> DataFrame:
    """(arc, next) over nodes (conv, depth, parent, child, n_children); `child` numbers the children of a parent."""
    conv, depth, parent = F.col("conv"), F.col("depth"), F.col("parent")
    inner = nodes.filter(depth > 0)
    first = inner.filter(F.col("child") == 1).select(
        _arc(parent, depth - 1, False).alias("arc"), _arc(conv, depth, False).alias("next")
    )
    leaves = nodes.filter(F.col("n_children") == 0).select(
        _arc(conv, depth, False).alias("arc"), _arc(conv, depth, True).alias("next")
    )
    following = inner.select("depth", "parent", (F.col("child") - 1).alias("child"), conv.alias("sibling"))
    back = inner.join(following, ["depth", "parent", "child"], "left").select(
        _arc(conv, depth, True).alias("arc"),
        F.when(F.col("sibling").isNotNull(), _arc(F.col("sibling"), depth, False))
        .otherwise(_arc(parent, depth - 1, True))
        .alias("next"),
    )
    end = nodes.filter(depth == 0).select(_arc(conv, depth, True).alias("arc"))
    last = end.withColumn("next", F.lit(None).cast(first.schema["next"].dataType))
    return first.unionByName(leaves).unionByName(back).unionByName(last)


def subtree_sums(ranks: DataFrame, nodes: DataFrame, values: list[str]) -> DataFrame:
    """(conv, depth, sums of the values over the subtree), by prefix sums at the places of the arcs."""
    placed = ranks.select("arc.*", "place").join(nodes.select("conv", "depth", *values), ["conv", "depth"])
    own = [F.when(F.col("leaving"), F.lit(0)).otherwise(F.col(v)).alias(v) for v in values]
    part = F.floor(F.col("place") / PLACES_AT_ONCE).alias("part")
    placed = stage(placed.select("conv", "depth", "leaving", "place", part, *own), "places")
    # One row per 65,536 arcs.
    parts = placed.groupBy("part").agg(*[F.sum(v).alias(f"{v}_before") for v in values])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(f"{v}_before").over(earlier), F.lit(0)).alias(f"{v}_before") for v in values]
    offsets = stage(parts.select("part", *sums), "parts")
    so_far = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select("*", *[F.sum(v).over(so_far).alias(f"{v}_to") for v in values]).join(offsets, "part")
    ends = []
    for v in values:
        to = F.col(f"{v}_to") + F.col(f"{v}_before")
        ends += [
            F.max(F.when(F.col("leaving"), to)).alias(f"{v}_out"),
            F.max(F.when(~F.col("leaving"), to - F.col(v))).alias(f"{v}_in"),
        ]
    held = running.groupBy("conv", "depth").agg(*ends)
    return held.select("conv", "depth", *[(F.col(f"{v}_out") - F.col(f"{v}_in")).alias(v) for v in values])


def prefix_trie(convs: DataFrame, turns: DataFrame, at_once: int = LISTED_AT_ONCE) -> DataFrame:
    """One row per node of the trie of conversations (conv, total) with turns (conv, depth, a, b, n_bytes, total).

    Columns: conv_id, the smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves; saved_tokens;
    ends_sha256 of the members that end at the node.
    """
    key = ["depth", "x_h1", "x_h2"]
    salted = turns.select(
        "conv",
        "depth",
        F.xxhash64("depth", "a", "b").alias("h1"),
        F.xxhash64("b", "depth", "a").alias("h2"),
        "n_bytes",
        (F.col("depth") == F.col("total")).alias("ends"),
    )
    prefixes = stage(numbered(salted, ["conv"], ["depth"], ["h1", "h2"]).drop("pos"), "prefixes")
    found = prefixes.groupBy(*key).agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("n_bytes").alias("n_bytes"),
        *[F.min(F.col(f"x_{h}").bitwiseXOR(F.col(h))).alias(f"up_{h}") for h in ("h1", "h2")],
    )
    none = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        *[none.alias(k) for k in key], "conv", "n_convs", none.alias("n_bytes"), none.alias("up_h1"), none.alias("up_h2")
    )
    nodes = stage(found.select(*root.columns).unionByName(root), "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x_h1").alias("up_h1"),
        F.col("x_h2").alias("up_h2"),
        F.col("conv").alias("parent"),
    )
    named = nodes.join(above, ["depth", "up_h1", "up_h2"], "left").drop("up_h1", "up_h2")
    children = stage(numbered(named, ["depth", "parent"], ["conv"]).withColumnRenamed("pos", "child"), "children")
    counts = children.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv"))
    counted = children.join(counts.agg(F.max("child").alias("n_children")), ["depth", "conv"], "left").select(
        *children.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    )
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    full = stage(
        counted.select("*", (F.col("n_children") == 0).cast("long").alias("leaf"), saved.alias("saved")), "trie"
    )
    ranks = list_ranks(tour(full), at_once)
    sums = subtree_sums(ranks, full, ["leaf", "saved"]).withColumnsRenamed({"leaf": "n_leaves", "saved": "saved_tokens"})
    turnless = convs.filter("total = 0").select(*[none.alias(k) for k in key], "conv")
    ends = prefixes.filter("ends").select(*key, "conv").unionByName(turnless)
    digests = member_digests(ends, key, "conv")
    return (
        full.join(sums, ["conv", "depth"])
        .join(digests, key, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
