"""Mixing sources to target weights, in DataFrame functions alone.

Tokens (words) are summed for each source.  The sources' weights share all words; no source
is repeated more than ``most`` times, and what a source cannot take is shared again by
weight among the others.  The target over the source's own words is its repetition rate:
each document is emitted floor(rate) times, and once more where a draw by the keyed hash of
its id falls below the fraction.  So a draw depends on nothing but the document and the
seed: reruns, lost executors and other partitions give the same mix.

A source's words in the mix have its target as their mean; the draws are independent, so
they stray by about sqrt(f (1 - f) * sum of squared sizes), f being the fraction.

Nulls and odd input: a null text counts no word; a null source is a source of its own,
behind all others; rows that share an id are drawn alike; rows without an id are drawn by
their text; a source without words has target and rate 0; an empty table gives an empty
mix; extra columns are carried by ``mixed_documents``, whatever their names, and ignored by
``mix_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.places import with_places
from .common import SPACE, Scratch, joined_by_size

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 11
#: Bits of a draw: a double holds them exactly.
_BITS = 52


def word_count(text: Column) -> Column:
    """Runs of anything but white space; null as 0.  Each run with the white space around it becomes one letter."""
    letters = F.regexp_replace(text, rf"{SPACE}*[^\x20\x09-\x0D]+{SPACE}*", "x")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.length(letters)).otherwise(0).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 up to 1 of the seed and the id, or the text where there is no id."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, _BITS // 4)
    return F.conv(head, 16, 10).cast("long") / F.lit(float(1 << _BITS))


def source_targets(sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row a source: key, n_docs, source_size, weight, target, rate, from (key, source, size).

    The level (words a unit of weight) rises with each round that finds further sources at
    their bound; a round returns two sums.  Comparisons are made in whole numbers.
    """
    sums = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    placed = with_places(sums, [F.col("source").asc_nulls_last()], scratch.save, "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    sources = placed.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    total, weighed, held = sources.agg(F.sum("source_size"), F.sum("weight"), F.count("*")).first()
    total, weighed, at_bound = int(total or 0), int(weighed or 0), 0
    rest, shared = total, weighed
    wide = lambda c: c.cast("decimal(19,0)")
    number = lambda n: wide(F.lit(str(n)))
    while True:
        full = wide(F.col("bound")) * number(shared) < number(rest) * wide(F.col("weight"))
        n, bounds, open_weight = sources.agg(F.count_if(full), F.sum(F.when(full, F.col("bound"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == at_bound or n == held:
            break
        at_bound, rest, shared = n, total - int(bounds), int(open_weight)
    part = (number(rest) * wide(F.col("weight"))).cast("double") / F.lit(float(max(shared, 1)))
    target = F.when(full, F.col("bound").cast("double")).otherwise(part)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return scratch.save(sources.select("key", "n_docs", "source_size", "weight", target.alias("target"), rate.alias("rate")), "targets")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    source = docs[source_col]
    return [
        docs[id_col].alias("doc_id"), source.alias("source"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
        word_count(docs[text_col]).alias("size"), draw(docs[id_col], docs[text_col], seed).alias("u"),
    ]


def _copies() -> Column:
    whole = F.floor("rate")
    return (whole + F.when(F.col("u") < F.col("rate") - whole, 1).otherwise(0)).cast("long")


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken and copies.  Texts are read once and never moved."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(docs.select(*_sized(docs, id_col, text_col, source_col, seed)), "sized")
    joined = joined_by_size(sized, source_targets(sized, scratch, weights, most), ["key"], "n_docs")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"), _copies().alias("copies"))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: struct ``row`` (all columns of a document) and ``copy``, from 0, one row for each copy."""
    scratch = Scratch(docs.sparkSession, "mixing")
    made = docs.select(*_sized(docs, id_col, text_col, source_col, seed), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    targets = source_targets(made.select("key", "source", "size"), scratch, weights, most)
    joined = joined_by_size(made.select("key", "u", "row"), targets, ["key"], "n_docs")
    counted = joined.withColumn("n", _copies()).filter("n > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
