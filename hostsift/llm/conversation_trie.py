"""Prefix trie of rebuilt conversations, rolled up over a centroid decomposition.

Turns are numbered within their conversation, conversations are rebuilt from a shared head
and their own rest, and each prefix gets a name: the sum of keyed hashes of (place, turn),
twice 60 bits, so names come from running sums and a conversation of any length is summed
in blocks.  Equal names are one node.

Totals of subtrees (leaves, saved tokens) come from the parent-edge forest.  A component is
split at its centroid, the deepest node that holds at least half of it: what hangs below
the centroid and the centroid itself is summed, and that total is added to every node on
the path from the centroid to the component's top.  The children of the centroid and the
part around the top become components of their own, each at most half as large.  All
components of a level are split in one round, so rounds grow with the logarithm of the
table; components of at most ``leaf`` nodes are split on in one task, a component at a time.
A node's path is the row list of the conversation that it is named for, so a path is found
by an equality join and no task follows edges one by one.

Nulls and odd input: rows without a conv_id belong to no conversation and are left out;
null roles and texts are empty; turns of equal number are taken in the order of their
digests; repeated rows are turns of their own; an empty table has no node; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.places import with_group_places
from .common import Scratch, joined_by_size

HEADS, GROUP = 9, 5
#: Turns that one running sum goes over; longer conversations are summed in blocks.
BLOCK = 1024
#: Components of at most so many nodes are split in one task.
LEAF = 4096
#: Ids in one piece of the list of a node's ended conversations.
ENDS = 4096
#: Name of the textless root.
ROOT = hashlib.md5(b"0:0:0").hexdigest()
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _halves(text: Column, names: tuple[str, str]) -> list[Column]:
    """Two whole numbers of 60 bits of a text's SHA-256."""
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)").alias(n) for at, n in zip((1, 16), names, strict=True)]


def numbered_turns(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv, pos (from 1), digest and bytes of each turn; texts are digested where they stand and never moved."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = with_group_places(turns, "conv", [F.col("turn").asc_nulls_first(), "digest"], scratch.save, "turns", "pos")
    return placed.select("conv", (F.col("pos") + 1).alias("pos"), "digest", "bytes")


def rebuilt(own: DataFrame, scratch: Scratch, heads: int = HEADS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv and its rebuilt length; their turns: conv, depth, digest, bytes)."""
    sizes = scratch.save(own.groupBy("conv").agg(F.max("pos").alias("n")), "sizes")
    named = sizes.select(
        "conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h")
    )
    base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = named.join(base, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
    convs = scratch.save(convs.select("conv", "n", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))).alias("length")), "convs")
    rest = joined_by_size(own, convs.select("conv", "n", "h", "k"), ["conv"], "n").filter("pos > h")
    rest = rest.select("conv", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "digest", "bytes")
    # A base has fewer than ``heads`` turns to give and fewer than twice ``group`` conversations to give them to.
    head = own.filter(F.col("pos") < heads).select(F.col("conv").alias("base"), F.col("pos").alias("depth"), "digest", "bytes")
    head = convs.filter("k > 0").select("conv", "base", "k").join(head, "base").filter("depth <= k").select("conv", "depth", "digest", "bytes")
    return convs.select("conv", "length"), rest.unionByName(head)


def paths(convs: DataFrame, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv, depth, node, parent, bytes and is_end: every prefix of every rebuilt conversation, the root included."""
    terms = turns.select("conv", "depth", "bytes", *_halves(F.concat_ws(":", "depth", "digest"), ("a", "b")), F.floor((F.col("depth") - 1) / BLOCK).alias("block"))
    upto = Window.partitionBy("conv", "block").orderBy("depth")
    inner = terms.select("*", F.sum("a").over(upto).cast("decimal(38,0)").alias("sa"), F.sum("b").over(upto).cast("decimal(38,0)").alias("sb"))
    long_convs = convs.filter(F.col("length") > BLOCK).select("conv")
    blocks = terms.join(long_convs, "conv", "left_semi").groupBy("conv", "block").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    past = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("conv", "block", *[F.sum(c).over(past).cast("decimal(38,0)").alias(c) for c in ("ta", "tb")])
    later = inner.filter("block > 0").join(before.filter("block > 0"), ["conv", "block"])
    later = later.withColumns({"sa": (F.col("sa") + F.col("ta")).cast("decimal(38,0)"), "sb": (F.col("sb") + F.col("tb")).cast("decimal(38,0)")})
    sums = inner.filter("block = 0").unionByName(later.drop("ta", "tb"))
    name = lambda depth, a, b: F.md5(F.concat_ws(":", depth, a, b).cast("binary"))
    less = lambda s, c: (F.col(s) - F.col(c)).cast("decimal(38,0)")
    ends = joined_by_size(sums, convs.filter("length > 0"), ["conv"], "length")
    inside = ends.select(
        "conv", "depth", name(F.col("depth"), F.col("sa"), F.col("sb")).alias("node"), name(F.col("depth") - 1, less("sa", "a"), less("sb", "b")).alias("parent"),
        "bytes", (F.col("depth") == F.col("length")).alias("is_end"),
    )
    zero = F.lit("0")
    top = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), name(zero, zero, zero).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("bytes"), (F.col("length") == 0).alias("is_end")
    )
    return scratch.save(inside.unionByName(top), "paths")


def _half(size: int) -> int:
    return -(-size // 2)


def split_local(parents: list[int], depths: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of one tree over its centroid decomposition; ``parents`` holds places, -1 for the top, and parents stand before their children."""
    n = len(parents)
    children: list[list[int]] = [[] for _ in range(n)]
    for v in range(1, n):
        children[parents[v]].append(v)
    size = [1] * n
    for v in range(n - 1, 0, -1):
        size[parents[v]] += size[v]
    gone = [False] * n
    out = [[0] * n for _ in values]

    def collect(top: int) -> list[int]:
        found, at = [top], 0
        while at < len(found):
            found += [c for c in children[found[at]] if not gone[c]]
            at += 1
        return found

    open_ = [0]
    while open_:
        top = open_.pop()
        half, g = _half(size[top]), top
        while (down := next((c for c in children[g] if not gone[c] and size[c] >= half), None)) is not None:
            g = down
        below = collect(g)
        totals = [sum(v[u] for u in below) for v in values]
        taken, at = size[g], g
        while True:  # from the centroid to the top of its component
            for o, t in zip(out, totals, strict=True):
                o[at] += t
            if at == top:
                break
            at = parents[at]
            size[at] -= taken
        gone[g] = True
        open_ += [c for c in children[g] if not gone[c]]
        if g != top:
            open_.append(top)
    return out


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whole components; rows come sorted by component and depth, and only one component is held at a time."""
    held: list[tuple] = []

    def solved(rows: list[tuple]):
        place = {row[1]: k for k, row in enumerate(rows)}
        sums = split_local([place.get(row[2], -1) for row in rows], [row[3] for row in rows], [[row[4] for row in rows], [row[5] for row in rows]])
        return [row[1] for row in rows], *sums

    def batch_of(done: list) -> pa.RecordBatch:
        joined = [[x for part in done for x in part[k]] for k in range(3)]
        types = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(joined, types, strict=True)], ["node", "leaves", "saved"])

    for batch in batches:
        done = []
        for row in zip(*(batch[c].to_pylist() for c in ("comp", "node", "parent", "depth", "leaf", "saved")), strict=True):
            if held and held[0][0] != row[0]:
                done.append(solved(held))
                held = []
            held.append(row)
        if done:
            yield batch_of(done)
    if held:
        yield batch_of([solved(held)])


def rolled_up(nodes: DataFrame, walks: DataFrame, scratch: Scratch, leaf: int = LEAF) -> DataFrame:
    """node, leaves and saved summed over its subtree, of nodes (node, parent, conv, depth, leaf, saved).

    ``walks`` (conv, depth, node, parent) holds the path of each node's conversation.
    """
    # Nodes below each node, to choose centroids by: a conversation names a run of nodes down to its end.
    runs = nodes.groupBy("conv").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    here = joined_by_size(walks.select("conv", "depth", "node"), runs.withColumn("rows", F.col("last") + 1), ["conv"], "rows")
    sizes = here.groupBy("node").agg(F.sum(F.col("last") - F.greatest("first", "depth") + 1).alias("size"))
    start = nodes.join(sizes, "node").withColumn("comp", F.lit(ROOT))
    state = scratch.save(start.select("node", "parent", "conv", "depth", "leaf", "saved", "size", "comp"), "level-0")
    own = ["comp", "node", "parent", "depth", "leaf", "saved"]
    added, closed, level = [], [], 0
    while True:
        tops = state.filter("node = comp").select("comp", F.col("size").alias("total"), F.col("depth").alias("top_depth"))
        large = scratch.save(tops.filter(F.col("total") > leaf), f"large-{level}")
        if large.isEmpty():
            closed.append(state.select(own))
            break
        heavy = joined_by_size(state, large, ["comp"], "total").filter(2 * F.col("size") >= F.col("total"))  # one path down from each top
        centre = heavy.groupBy("comp").agg(F.max_by(F.struct("node", "conv", "depth", "size", "total", "top_depth"), "depth").alias("g"))
        centre = scratch.save(centre.select("comp", *[F.col(f"g.{c}").alias(f"g_{c}") for c in ("node", "conv", "depth", "size", "total", "top_depth")]), f"centre-{level}")
        # The ancestor one below the centroid's depth tells whether a node hangs below the centroid, and under which child.
        step = walks.select(F.col("conv").alias("w_conv"), F.col("depth").alias("w_depth"), F.col("node").alias("child"), F.col("parent").alias("over"))
        rows = joined_by_size(state, centre, ["comp"], "g_total", "left")
        rows = rows.join(step, (F.col("conv") == F.col("w_conv")) & (F.col("g_depth") + 1 == F.col("w_depth")) & (F.col("depth") > F.col("g_depth")), "left")
        below = F.coalesce(F.col("over") == F.col("g_node"), F.lit(False))
        sides = scratch.save(rows.withColumn("below", below).drop("w_conv", "w_depth", "over"), f"sides-{level}")
        closed.append(sides.filter("g_node IS NULL").select(own))
        rows = sides.filter("g_node IS NOT NULL")
        totals = rows.filter("below OR node = g_node").groupBy("comp").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
        path = centre.join(walks.select(F.col("conv").alias("g_conv"), "depth", "node"), "g_conv").filter("depth BETWEEN g_top_depth AND g_depth")
        path = scratch.save(path.select("comp", "node", "g_size").join(totals, "comp"), f"path-{level}")
        added.append(path.select("node", "leaves", "saved"))
        rest = rows.filter("node != g_node").join(path.select("node", F.col("g_size").alias("cut")), "node", "left")
        state = scratch.save(
            rest.select(
                "node", "parent", "conv", "depth", "leaf", "saved", F.when(F.col("below"), F.col("size")).otherwise(F.col("size") - F.coalesce("cut", F.lit(0).cast("long"))).alias("size"),
                F.when(F.col("below"), F.col("child")).otherwise(F.col("comp")).alias("comp"),
            ), f"level-{level + 1}",
        )
        scratch.drop(f"level-{level}")
        level += 1
    small = closed[0]
    for part in closed[1:]:
        small = small.unionByName(part)
    sums = small.repartition("comp").sortWithinPartitions("comp", "depth").mapInArrow(_local, "node string, leaves long, saved long")
    for part in added:
        sums = sums.unionByName(part)
    return scratch.save(sums.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "sums")


def _hashed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list, piece after piece; nothing but the running hash is held."""
    node, running = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for name, piece in zip(batch["node"].to_pylist(), batch["piece"].to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = name, hashlib.sha256(piece.encode())
            else:
                running.update(b"," + piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done, strict=True)], ["node", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([running.hexdigest()])], ["node", "ends"])


def ended(walks: DataFrame) -> DataFrame:
    """node and the hash of the ids of the conversations that end there, for nodes that have any.  Ids are listed in pieces of bounded range first."""
    at = walks.filter("is_end").select("node", F.floor(F.col("conv") / ENDS).alias("at"), "conv")
    pieces = at.groupBy("node", "at").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("piece"))
    return pieces.repartition("node").sortWithinPartitions("node", "at").mapInArrow(_hashed_lists, "node string, ends string")


def conversation_trie(rows: DataFrame, heads: int = HEADS, group: int = GROUP, leaf: int = LEAF) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    scratch = Scratch(rows.sparkSession, "trie")
    own = scratch.save(numbered_turns(rows, scratch), "own")
    convs, turns = rebuilt(own, scratch, heads, group)
    walks = paths(convs, turns, scratch)
    found = walks.groupBy("node").agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes")
    )
    found = scratch.save(found, "found")
    children = found.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = found.join(children.withColumnRenamed("parent", "node"), "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = scratch.save(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")
    sums = rolled_up(nodes.select("node", "parent", "conv", "depth", "leaf", "saved"), walks.select("conv", "depth", "node", "parent"), scratch, leaf)
    # A node's children are many rows of one key, so parents are joined by their number.
    over = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("rows"))
    out = nodes.join(sums.select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), "node").join(ended(walks), "node", "left")
    out = out.select("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    inner = joined_by_size(out.filter("parent IS NOT NULL"), over, ["parent"], "rows").drop("rows")
    top = out.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return inner.unionByName(top).select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
