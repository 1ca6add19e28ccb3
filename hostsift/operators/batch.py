"""Sharding and merging: interleave, balanced assignment, uniqueness, shard merges, readiness."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .places import Keep, with_group_places


class DuplicateRows(ValueError):
    """Rows that must be unique are not."""


def _places(rows: DataFrame, server: str, order: list[Column | str], keep: Keep | None, name: str) -> DataFrame:
    """Adds ``__n``, a root's place among its server's, from 0.

    One registry may hold most roots: with ``keep`` its roots are numbered in as many range
    partitions as they fill, else in one window.
    """
    if keep:
        return with_group_places(rows, server, order, keep, name, "__n")
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(server).orderBy(*order)) - 1)


def interleaved(roots: DataFrame, server: str = "server", root: str = "root", seen: str = "first_seen", keep: Keep | None = None) -> DataFrame:
    """Round robin over servers in name order, roots of a server as first seen, roots without a server last."""
    turns = _places(roots, server, [seen, root], keep, "turns").withColumn("turn", F.col("__n") + 1).drop("__n")
    return turns.orderBy(F.col(server).isNull(), F.when(F.col(server).isNotNull(), F.col("turn")), server, "turn")


def balanced_assignment(groups: DataFrame, workers: int, server: str = "server", root: str = "root", size: str = "hosts") -> DataFrame:
    """root -> worker: of each server the largest root first, to the worker with the least of the server, then in all, then the fewest roots.

    The choice for a root depends on those before, so one plan is made from the
    (server, root, size) table; servers are taken in name order, roots without one last.
    The rows are read a partition at a time and only the loads are held.
    """
    spark = groups.sparkSession
    total, count = [0] * workers, [0] * workers
    made, current, own = [], object(), []
    ordered = groups.orderBy(F.col(server).isNull(), server, F.desc(size), root).select(server, root, size)
    for name, key, hosts in ordered.toLocalIterator():
        if name != current:
            current, own = name, [0] * workers
        k = min(range(workers), key=lambda w: (own[w], total[w], count[w], w))
        own[k] += hosts
        total[k] += hosts
        count[k] += 1
        made.append((key, f"worker-{k + 1:02d}"))
    return spark.createDataFrame(made, f"{root} string, worker string")


def spread_assignment(groups: DataFrame, workers: int, server: str = "server", root: str = "root", size: str = "hosts", keep: Keep | None = None) -> DataFrame:
    """The same aim without a driver loop, for root tables of any size: largest first in a snake over the workers of each server."""
    numbered = _places(groups, server, [F.desc(size), root], keep, "sizes")
    turn, place = F.floor(F.col("__n") / workers), F.col("__n") % workers
    # Servers begin at different workers; they are few, so their names are numbered in one task.
    begins = groups.select(server).distinct().withColumn("__start", F.row_number().over(Window.orderBy(F.col(server).asc_nulls_last())) - 1)
    rows = numbered.withColumn("__k", F.when(turn % 2 == 0, place).otherwise(workers - 1 - place)).alias("g")
    rows = rows.join(begins.alias("b"), F.col(f"g.{server}").eqNullSafe(F.col(f"b.{server}")))
    worker = F.pmod(F.col("__k") + F.col("__start"), F.lit(workers))
    return rows.select(*[f"g.{c}" for c in groups.columns], F.format_string("worker-%02d", (worker + 1).cast("int")).alias("worker"))


def greedy_loads(sizes: list[int], workers: int) -> list[int]:
    """Loads of the largest-first rule, a bound to compare an assignment with."""
    loads = [0] * workers
    heapq.heapify(loads)
    for s in sorted(sizes, reverse=True):
        heapq.heappush(loads, heapq.heappop(loads) + s)
    return sorted(loads)


def worker_count(workers: int, roots: int, suffix_entries: int) -> int:
    return min(workers, roots + suffix_entries)


def duplicates(rows: DataFrame, on: list[str]) -> DataFrame:
    return rows.groupBy(*on).agg(F.count("*").alias("n")).filter("n > 1")


def ensure_unique(rows: DataFrame, on: list[str], what: str) -> DataFrame:
    """The rows, or an error naming one duplicate; the check stops at the first that it finds."""
    found = duplicates(rows, on).limit(1).collect()
    if found:
        raise DuplicateRows(f"duplicate {what}: {[found[0][c] for c in on]}")
    return rows


def ensure_all_unique(rows: DataFrame, keys: dict[str, Column]) -> None:
    """An error naming one repeated key of any kind; a null key is none.

    All kinds are told by one shuffle of 64-bit hashes; only rows whose hash repeats are
    compared as they are.
    """
    tags = [F.when(key.isNotNull(), F.struct(F.lit(what).alias("what"), F.xxhash64(key).alias("hash"))) for what, key in keys.items()]
    found = rows.select(F.explode(F.array(*tags)).alias("t")).filter("t IS NOT NULL").groupBy("t.what", "t.hash").agg(F.count("*").alias("n")).filter("n > 1")
    for what in [r["what"] for r in found.select("what").distinct().collect()]:
        suspects = found.filter(F.col("what") == what).select(F.col("hash").alias("__h"))
        own = rows.select(keys[what].alias("key")).filter("key IS NOT NULL").withColumn("__h", F.xxhash64("key"))
        ensure_unique(own.join(suspects, "__h", "left_semi"), ["key"], what)


def merged(shards: list[DataFrame], on: list[str], what: str) -> DataFrame:
    """Union of the workers' rows; a row that two workers hold is an error."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return ensure_unique(out, on, what)


def same_members(a: DataFrame, b: DataFrame, on: str) -> bool:
    left, right = a.select(on), b.select(on)
    return left.subtract(right).isEmpty() and right.subtract(left).isEmpty()


def readiness(statuses: DataFrame, batch: str = "batch_id") -> DataFrame:
    """batch, its counts by conclusion and its state: not_ready while any worker runs, else ready_failed or ready_success."""
    n = lambda c: F.count_if(F.col("conclusion") == c).alias(c)
    out = statuses.groupBy(batch).agg(n("success"), n("failure"), F.count_if(~F.coalesce(F.col("conclusion").isin("success", "failure"), F.lit(False))).alias("open"))
    state = F.when(F.col("open") > 0, "not_ready").when(F.col("failure") > 0, "ready_failed").otherwise("ready_success")
    return out.withColumn("state", state)
