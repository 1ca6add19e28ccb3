"""Places of rows in a sorted order, and running sums in it, without a task that sees all rows.

Rows are range-partitioned and sorted once and written; each row then knows its partition
and its place there.  A table of one row a partition (or a group and partition) says how
many rows stand before, so places follow by addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]
#: ``monotonically_increasing_id`` counts within a partition below this bit.
_PART = 33


def in_order(rows: DataFrame, order: list[Column | str], keep: Keep, name: str = "ordered") -> DataFrame:
    """The rows in sorted, range-partitioned files with ``__at``, which grows with the order.

    ``keep`` writes a table and reads it again.  Rows whose ``order`` is equal share a
    partition, so the last term should tell them apart.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return keep(ranged.withColumn("__at", F.monotonically_increasing_id()), name)


def with_places(rows: DataFrame, order: list[Column | str], keep: Keep, name: str = "ordered", place: str = "place") -> DataFrame:
    """Adds each row's place in the order, from 0.  What is broadcast has one row a partition."""
    placed = in_order(rows, order, keep, name)
    parts = placed.groupBy(F.shiftright("__at", _PART).alias("__part")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    out = placed.withColumn("__part", F.shiftright("__at", _PART)).join(F.broadcast(parts), "__part")
    return out.select(*rows.columns, (F.col("__before") + F.col("__at") - F.col("__first")).alias(place))


def with_group_places(rows: DataFrame, by: str, order: list[Column | str], keep: Keep, name: str = "ordered", place: str = "place") -> DataFrame:
    """Adds each row's place in its group, from 0, however many partitions a group fills.

    A group's rows lie side by side, so a partition holds parts of at most two groups that
    are not whole; a group's place begins at its first row of the partition, and what its
    partitions before held is added.
    """
    placed = in_order(rows, [by, *order], keep, name).withColumn("__part", F.shiftright("__at", _PART))
    pieces = placed.groupBy(by, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(F.col(by).alias("__by"), F.col("__part").alias("__p"), "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    out = placed.join(pieces, placed[by].eqNullSafe(F.col("__by")) & (F.col("__part") == F.col("__p")))
    return out.select(*[placed[c] for c in rows.columns], (F.col("__before") + F.col("__at") - F.col("__first")).alias(place))
