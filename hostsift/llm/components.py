"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; each step's edges are written to the shared folder, which cuts
lineage and survives lost executors.  The driver sees a count and a checksum a step.
A node of very many edges is one key of the join below; its rows are two numbers each, and
adaptive skew handling splits its partition where it outgrows the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours hang on the smallest of them (and itself): larger ones in a large-star step, smaller ones in a small-star step."""
    if large:
        pairs = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(low, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """node, component (smallest node reachable) for all nodes of ``links`` (u, v); nulls and loops are ignored."""
    edges = scratch.save(
        links.filter("u IS NOT NULL AND v IS NOT NULL AND u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0",
    )
    seen, step = None, 0
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (mark["n"], mark["s"]) == seen:
            break
        seen, step = (mark["n"], mark["s"]), step + 1
        edges = scratch.save(_star(_star(edges, large=True), large=False), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    # Every node but a component's smallest now hangs on that one by a single edge.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
