"""Exact deduplication by a log-structured merge index of text digests.

Writing: rows come in several flushes.  Each task fills a bounded memtable (digest ->
smallest id, count) and flushes it as a sorted run.  Runs are Parquet files whose row
groups carry min/max statistics and a Bloom filter of the digest, so a point probe opens
only the runs that may hold it.  When more runs than ``fanout`` have gathered they are
compacted: a digest's smallest id stays and counts are summed.

Reading: a filter over the index's repeated digests (one bit field of at most
``FILTER_BYTES``) tells every row that may be a copy.  A row that it excludes is the only
one of its text and meets no join; the others join the index, and only their texts are
moved to be compared byte for byte before they count as copies.  With more repeated
digests than the filter may hold, all rows go the second way.

A digest that holds more than one row in 4,096 is joined by broadcast (so there are fewer
than 4,096 of these), and texts are compared in two steps, so no group meets in one task.

Nulls and odd input: a null text counts as empty; a null id can name no group, so
it never is a ``keep_id`` unless all ids of its group are null; a repeated row is
one more copy; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, joined_by_size, squeezed

#: Entries that a task holds before it flushes a run; about 20 MB.
MEMTABLE = 100_000
#: Flushes of one table; runs that may gather before they are compacted.
FLUSHES, FANOUT = 3, 2
#: Largest filter of repeated digests, at ``FILTER_BITS`` a digest (1.3 million digests).
FILTER_BYTES, FILTER_BITS, PROBES = 2 << 20, 12, 4
RUN_SCHEMA = "digest string, keep_id long, n long"


def memtable_runs(limit: int):
    """Digest rows in, sorted runs of at most ``limit`` entries out."""

    def flush(held: dict) -> pa.RecordBatch:
        digests = sorted(held)
        low, n = zip(*(held[d] for d in digests), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(low, pa.int64()), pa.array(n, pa.int64())], ["digest", "keep_id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        for batch in batches:
            for digest, doc in zip(batch["digest"].to_pylist(), batch["doc_id"].to_pylist(), strict=True):
                low, n = held.get(digest, (None, 0))
                held[digest] = (doc if low is None else low if doc is None else min(low, doc), n + 1)
                if len(held) >= limit:
                    yield flush(held)
                    held = {}
        if held:
            yield flush(held)

    return run


class DigestIndex:
    """Runs of (digest, smallest id, count) under one folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.runs: list[str] = []
        self._made = 0

    def _write(self, df: DataFrame, level: str) -> str:
        path = f"{self.folder}/{level}-{self._made}"
        self._made += 1
        (
            df.write.option("parquet.bloom.filter.enabled#digest", "true")
            .option("parquet.bloom.filter.expected.ndv#digest", str(MEMTABLE))
            .parquet(path)
        )
        return path

    def _read(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(*self.runs)

    def flush(self, signed: DataFrame, memtable: int = MEMTABLE) -> None:
        """Adds a batch with columns digest and doc_id; compacts when ``fanout`` runs have gathered."""
        rows = signed.select("digest", F.col("doc_id").cast("long").alias("doc_id"))
        self.runs.append(self._write(rows.mapInArrow(memtable_runs(memtable), RUN_SCHEMA), "run"))
        if len(self.runs) > self.fanout:
            self.compact()

    def compact(self) -> None:
        """Merges all runs into one level, a sorted row a digest."""
        merged = self._read().groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        self.runs = [self._write(merged.sortWithinPartitions("digest"), "level")]

    def entries(self) -> DataFrame:
        """One row a digest; compacts first if several runs are open or a run may repeat a digest."""
        if len(self.runs) != 1 or "/run-" in self.runs[0]:
            self.compact()
        return self._read()

    def probe(self, digest: str) -> DataFrame:
        """The entry of one digest; row groups whose filter excludes it are skipped."""
        return (
            self._read().filter(F.col("digest") == digest).groupBy("digest")
            .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        )


    def repeated(self) -> DataFrame:
        """The entries that more than one row holds."""
        return self.entries().filter("n > 1")


def _bits(digest: Column | str, size: Column | int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(size)) for k in range(PROBES)]


def digest_filter(repeated: DataFrame, scratch: Scratch, limit: int = FILTER_BYTES):
    """A function of a digest column: false only for digests that ``repeated`` lacks; None where the filter would be too large."""
    count = repeated.count()
    if count * FILTER_BITS > limit * 8:
        return None
    words = max(1, -(-count * FILTER_BITS // 64))
    bits = repeated.select(F.explode(F.array(*_bits("digest", words * 64))).alias("bit"))
    word = F.expr("bit div 64")
    held = bits.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    field = held.unionByName(repeated.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
    field = field.groupBy("word").agg(F.bit_or("bits").alias("bits")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("f"))
    saved = scratch.save(field.select(F.col("f.bits").alias("field")), "filter")

    def may_hold(digest: str) -> Column:
        field = saved.scalar()
        test = F.lit(True)
        for bit in _bits(digest, words * 64):
            test &= F.getbit(F.get(field, (bit / 64).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1
        return test

    return may_hold


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Column | None = None,
    memtable: int = MEMTABLE,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` replaces the index key (SHA-256 of the normalised text); tests pass
    a weak one to reach the branch where verification splits a false hit.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), squeezed(F.col(text_col)).alias("norm"))
    key = F.sha2("norm", 256) if digest is None else digest
    own = [] if digest is None else [F.sha2("norm", 256).alias("text_sha256")]
    signed = scratch.save(base.select("doc_id", key.alias("digest"), *own, F.pmod(F.spark_partition_id(), F.lit(FLUSHES)).alias("flush")), "signed")
    index = DigestIndex(spark, scratch.path("index"))
    for k in range(FLUSHES):
        index.flush(signed.filter(F.col("flush") == k), memtable)
    repeated = scratch.save(index.repeated(), "repeated")
    if digest is None:
        signed = signed.withColumn("text_sha256", F.col("digest"))
    signed = signed.drop("flush")
    may_hold = digest_filter(repeated, scratch, filter_bytes) or (lambda _: F.lit(True))

    # Byte verification of the hits.  Equal texts have equal smallest and largest text; both
    # are pre-aggregated by map task, then by a few groups of tasks, then by digest.
    texts = base.withColumn("digest", key).filter(may_hold("digest"))
    part = texts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(32)))
    ends = part.groupBy("digest", "part").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    mixed = ends.groupBy("digest").agg((F.min("lo") != F.max("hi")).alias("mixed")).filter("mixed")
    mixed = scratch.save(mixed.select("digest"), "mixed")

    hits = joined_by_size(signed.filter(may_hold("digest")), repeated, ["digest"], "n", "left")
    alone = signed.filter(~may_hold("digest")).withColumns({"keep_id": F.lit(None).cast("long"), "n": F.lit(None).cast("long")})
    placed = hits.unionByName(alone).withColumns({
        "keep_id": F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")), "n": F.coalesce("n", F.lit(1)).cast("long"),
    })
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = ["doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), "text_sha256"]
    if mixed.isEmpty():
        return placed.select(*columns)
    # A digest with different texts: its rows are grouped by their bytes instead.
    false_hits = texts.join(mixed, "digest", "left_semi")
    groups = scratch.save(
        false_hits.groupBy("norm").agg(F.min("doc_id").alias("k2"), F.count("*").alias("n2"))
        .select(F.sha2("norm", 256).alias("text_sha256"), "k2", "n2"), "split",
    )
    fixed = placed.join(groups, "text_sha256", "left")
    return fixed.withColumn("keep_id", F.when(F.col("n2").isNull(), F.col("keep_id")).otherwise(F.col("k2"))).withColumn(
        "n", F.coalesce("n2", "n")
    ).select(*columns)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of equal texts: the one with the smallest id, or any one where the group has no id or repeats it.

    Rows that the filter of repeated digests excludes pass as they stand; only the others are moved.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    told = exact_dedup(docs, id_col, text_col).filter("group_size > 1")
    groups = scratch.save(
        told.groupBy(F.col("text_sha256").alias("digest")).agg(
            F.max("keep_id").alias("keep_id"), F.max("group_size").alias("n"), F.count_if("kept").alias("kept")
        ), "groups",
    )
    may_hold = digest_filter(groups, scratch) or (lambda _: F.lit(True))
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = row.withColumn("digest", F.sha2(squeezed(F.col("row")[text_col]), 256))
    maybe = scratch.save(keyed.filter(may_hold("digest")).withColumn("id", F.col("row")[id_col].cast("long")), "maybe")
    marked = joined_by_size(maybe, groups, ["digest"], "n", "left").filter(F.col("n").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    once = marked.filter("n IS NULL OR kept = 1")
    several = marked.filter("kept > 1").dropDuplicates(["id", "digest"])
    left = keyed.filter(~may_hold("digest")).select("row").unionByName(once.select("row")).unionByName(several.select("row"))
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
