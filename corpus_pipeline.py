"""Corpus pipeline: quality, exact dedup, near dedup, secret masking, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and
returns the columns of ``documents``; the last returns the packed pieces.  ``run`` writes
each stage's rows as Parquet in the shared folder and reads them again for the next.

Nulls and odd input: a null text counts as empty (its shape is scored, it is a copy of an
empty one, holds no secret and packs as its end mark); null and repeated ids are told at
each stage; ties take the smallest id; an empty table passes empty; extra columns are
carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostsift.llm.common import Scratch, release, table
from hostsift.llm.exact_dedup import without_copies
from hostsift.llm.jaccard_join import jaccard_components
from hostsift.llm.packing import pack_documents
from hostsift.llm.quality import quality_filter
from hostsift.llm.queries import word_tokenizer
from hostsift.llm.secret_scan import redact_secrets


def settled(spark: SparkSession) -> None:
    """Executors give back the heap that the stage before has grown, so that a stage's Python workers find room beside it.

    A JVM keeps such heap until it collects its garbage as a whole; tasks of a tiny job ask
    for that, two a core, so that each executor gets some.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more)."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the smallest id, or any one where the group has no id or repeats it."""
    settled(spark)
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets at Jaccard 0.8 or more, the one with the smallest id.

    Rows that share an id stay or go together; rows without one cannot be told apart and stay.
    """
    settled(spark)
    groups = jaccard_components(docs, width=5, percent=80)
    gone = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("gone")).distinct()
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    left = row.join(gone, F.col("row.doc_id") == F.col("gone"), "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each reported secret replaced by a mark; n_chars follows the text."""
    settled(spark)
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 4096."""
    settled(spark)
    return pack_documents(docs, word_tokenizer())


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The classifier and the packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = Scratch.opened[:]
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        release(but=tuple(made))  # what the stage's operators wrote on their way
    return docs
