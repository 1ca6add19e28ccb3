"""Continuous list ingest: new list files as a stream, entries upserted by host in each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import buckets
from ..operators.prepare import parse_lines
from ..sources.lists import BREAKS


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A row a line of every file that arrives; the file is the source."""
    files = spark.readStream.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("source_id"), "value")
    lines = files.select("source_id", F.posexplode(F.split("value", BREAKS)).alias("line_index", "raw_line"))
    return lines.withColumn("source_index", F.lit(0)).withColumn("source_input_label", F.col("source_id"))


def first_entries(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """Of old and new entries of a host the one of the first batch stays, then by source and line."""
    both = old.unionByName(new)
    order = F.struct("batch", "source_id", "line_index")
    return both.groupBy(*on).agg(F.min_by(F.struct(*[c for c in both.columns if c not in on]), order).alias("e")).select(*on, "e.*").select(both.columns)


def ingest(spark: SparkSession, folder: str, table: str, state: str, rules: DataFrame) -> StreamingQuery:
    """Runs until all files there are taken in; ``table`` (see ``buckets.read``) keeps the first entry of each host.

    A micro-batch rewrites the buckets of its hosts alone.  A batch that is made again after
    a failure gives the same rows, so it changes nothing.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        new = parse_lines(batch, rules).withColumn("batch", F.lit(number).cast("long"))
        buckets.write(first_entries(new.limit(0), new, ["host"]), table, ["host"], merge=first_entries)

    stream = line_stream(spark, folder)
    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", state).trigger(availableNow=True).start()


def outcome_stream(rows: DataFrame, time: str = "checked_at", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window, route and class of a stream of terminal rows."""
    return rows.withWatermark(time, late).groupBy(F.window(time, width), "route", "classification").agg(F.count("*").alias("n"))
