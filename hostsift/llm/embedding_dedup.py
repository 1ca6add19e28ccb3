"""Embedding near-duplicates by collision-counting projections.

Unit vectors are projected on many random directions.  In a table, vectors that agree in
the signs of ``bits`` projections are sorted by one more projection, and each vector is
the centre of a window in that order.  For a pair in a window, collisions are counted
over ``COUNTED`` further projections (both values within ``WIDTH`` standard deviations of
the difference that a pair at the threshold has); pairs with at least the calibrated
count are verified by their cosine in double precision.  The number of sign bits follows
the number of vectors, so that lists stay short; the number of tables and the count are
calibrated so that a pair exactly at the threshold is found with probability ``recall``
(closer pairs more often).

Equal vectors are one node that carries its number of copies.  A list of more than
``LIST`` vectors is dealt into parts, and each two parts meet in a task of their own; all
pairs that pass are counted, none is capped.  A pair is counted in its first table only,
so degrees are summed without a row for each pair, and a task reports no more links than
connect its vectors.

Nulls and odd input: vectors that are null, zero, or hold null or non-finite components
link with nothing; vectors of different lengths never link; a row with a null id counts
as a copy and has a null component; rows that share an id are one node; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, joined_by_size
from .components import connected_components

COUNTED = 32
WIDTH = 2.0
LIST = 1024
#: Vectors that a list holds on average.
TARGET = 96


def calibrate(n: int, cosine: float, recall: float) -> tuple[int, int, int]:
    """Sign bits, tables and least collisions for n vectors."""
    bits = max(3, math.ceil(math.log2(max(n, 1) / TARGET))) if n > TARGET else 1
    agree = (1 - math.acos(cosine) / math.pi) ** bits * math.erf(WIDTH * 1.25 / math.sqrt(2))
    each = math.erf(WIDTH / math.sqrt(2))
    chance, count = 0.0, COUNTED + 1
    while chance < 1 - (1 - recall) / 4:
        count -= 1
        chance += math.comb(COUNTED, count) * each**count * (1 - each) ** (COUNTED - count)
    tables = max(1, math.ceil(math.log((1 - recall) / 2) / math.log(1 - agree)))
    return bits, tables, count


@lru_cache(maxsize=16)
def directions(dim: int, number: int, seed: int) -> np.ndarray:
    a = np.random.default_rng([seed, dim]).standard_normal((dim, number))
    return a / np.linalg.norm(a, axis=0)


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the largest component is 1: squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


SIGNS, SORTS, COUNTS = 11, 12, 13
KEYED = "node long, copies long, dim int, vector array<{}>, keys array<long>"


def _keys(bits: int, tables: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                signs = _unit(part["vector"]) @ directions(int(dim), bits * tables, SIGNS) > 0
                weights = 1 << np.arange(bits, dtype=np.int64)
                keys = signs.reshape(len(part), tables, bits) @ weights
                yield part.assign(keys=list(keys))[["node", "copies", "dim", "vector", "keys"]]

    return run


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal ``by`` in sorted batches."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = batch[by].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts]), np.append(cuts, len(batch)), strict=True):
            key = tuple(values[lo])
            if last is not None and key != last:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[lo:hi])
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


FOUND = "kind string, u long, v long"


def _compare(tables: int, count: int, cosine: float):
    """Degrees (kind d: node u has v further links) and connecting links (kind l) of each list."""

    def pairs_of(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
        table, dim = int(group["table"].iloc[0]), int(group["dim"].iloc[0])
        crossed = group["low"].iloc[0] != group["high"].iloc[0]
        side = group["side"].to_numpy()
        if len(group) < 2 or (crossed and side.min() == side.max()):
            return None
        x = _unit(group["vector"])
        gap = math.sqrt((2 - 2 * cosine) / dim)
        sorts = x @ directions(dim, tables, SORTS)
        counted = x @ directions(dim, COUNTED, COUNTS)
        order = np.argsort(sorts[:, table], kind="stable")
        place = sorts[order, table]
        reach = np.searchsorted(place, place + WIDTH * 1.25 * gap, side="right")
        keys = np.stack(group["keys"].to_numpy())
        us, vs = [], []
        for at in range(len(order) - 1):  # the window of a vector: those after it; those before have it in theirs
            near = order[at + 1 : reach[at]]
            if crossed:
                near = near[side[near] != side[order[at]]]
            if not len(near):
                continue
            i = order[at]
            near = near[(np.abs(counted[near] - counted[i]) <= WIDTH * gap).sum(axis=1) >= count]
            near = near[x[near] @ x[i] >= cosine]
            if len(near) and table:
                first = ((keys[near, :table] == keys[i, :table]) & (np.abs(sorts[near, :table] - sorts[i, :table]) <= WIDTH * 1.25 * gap)).any(axis=1)
                near = near[~first]
            if len(near):
                us.append(np.full(len(near), i))
                vs.append(near)
        return (np.concatenate(us), np.concatenate(vs)) if us else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, ["table", "dim", "key", "low", "high"]):
            found = pairs_of(group)
            if found is None:
                continue
            u, v = found
            node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
            degree = np.bincount(u, copies[v], len(node)) + np.bincount(v, copies[u], len(node))
            some = np.flatnonzero(degree)
            yield pd.DataFrame({"kind": "d", "u": node[some], "v": degree[some].astype(np.int64)})
            root = np.arange(len(node))

            def top(k: int, root=root) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            links = []
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                ra, rb = top(a), top(b)
                if ra != rb:
                    root[ra] = rb
                    links.append((node[a], node[b]))
            yield pd.DataFrame({"kind": "l", "u": [a for a, _ in links], "v": [b for _, b in links]})

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, recall: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    # Components stay as wide as they come: doubles are compared as doubles.
    wide = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    value = F.col(vector_col).cast(f"array<{wide}>")
    usable = (F.size(value) > 0) & F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(value, lambda c: c != 0)
    # Adding 0 turns -0 into 0; a float's text is exact.
    digest = F.sha2(F.array_join(F.transform(value, lambda c: (c + F.lit(0.0)).cast("string")), ","), 256)
    named = scratch.save(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)), digest).alias("digest"), value.alias("vector")), "named"
    )
    nodes = scratch.save(
        named.filter("digest IS NOT NULL").groupBy("digest").agg(
            F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")
        ), "nodes",
    )
    bits, tables, count = calibrate(nodes.count(), cosine, recall)
    keyed = scratch.save(
        nodes.filter("node IS NOT NULL").select("node", "copies", F.size("vector").alias("dim"), "vector").mapInPandas(_keys(bits, tables), KEYED.format(wide)), "keyed"
    )
    rows = keyed.select("node", "copies", "dim", "vector", "keys", F.posexplode("keys").alias("table", "key"))
    sizes = rows.groupBy("table", "dim", "key").agg(F.count("*").alias("held")).filter("held > 1")
    parts = F.ceil(F.col("held") / LIST).cast("int")
    part = F.pmod(F.xxhash64("node", "table"), F.col("parts")).cast("int")
    dealt = (
        rows.join(sizes, ["table", "dim", "key"]).withColumn("parts", parts).withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "table", "dim", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "copies", "vector", "keys",
        )
    )
    by = ["table", "dim", "key", "low", "high"]
    found = scratch.save(
        dealt.repartition(*by).sortWithinPartitions(*by).mapInPandas(_compare(tables, count, cosine), FOUND), "found"
    )
    degrees = found.filter("kind = 'd'").groupBy(F.col("u").alias("node")).agg(F.sum("v").alias("degree"))
    parts_of = scratch.save(connected_components(found.filter("kind = 'l'").select("u", "v"), scratch), "parts")
    by_digest = nodes.select("digest", "node", "copies").join(degrees, "node", "left").join(parts_of, "node", "left").select(
        "digest", "copies", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "node").alias("component")
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    # Vectors that link with nothing have no digest to meet by; a vector of very many copies is joined by broadcast.
    linked = joined_by_size(named.filter("digest IS NOT NULL").select("vec_id", "digest"), by_digest, ["digest"], "copies")
    none = F.lit(None).cast("long")
    alone = named.filter("digest IS NULL").select("digest", "vec_id", none.alias("links"), none.alias("component"), none.alias("copies"))
    return linked.unionByName(alone).select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
