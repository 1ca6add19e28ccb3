"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every candidate string is reduced to a hash; over the whole corpus each hash is
counted by distinct repositories and distinct owners.  A candidate that several
owners hold is a widely copied example; one that stays with a single owner looks
live.  The base kinds (assign, access, hex) are reported whatever their class;
vendor-format tokens are added as spans only where they look live.

Documents carry no repository name, so the query takes the document as the
repository and ``source`` as the owner.

Nulls and odd input: a null text counts as empty and has no spans; a null owner is
one owner of its own; a repeated row gets the same spans as its twin and counts
once in the frequencies; rows that share an id, or have none, count for each of their
owners; an empty table gives an empty result; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

# The contract's patterns, kinds in the order listed there.
# "+" is kept where a failing match must still use up its text.
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: A run shorter than the limit can hold no passing match, so the limit stands in the pattern.
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
#: Token formats that their vendors publish.
VENDOR = (
    r"(gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
)
KINDS = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("vendor", VENDOR)]
BASE = 3


def _matches(text: Column, number: int, pattern: str) -> Column:
    """Array of (kind, place in order, code points before it, its code points, hash of the value, length of the value)."""
    return F.when(
        text.rlike(pattern),
        F.transform(
            F.arrays_zip(
                F.split(text, pattern, -1).alias("before"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("value"),
            ),
            lambda x, i: F.struct(
                F.lit(number).alias("kind"), i.alias("place"), F.length(x["before"]).alias("gap"),
                F.length(x["whole"]).alias("size"), F.sha2(x["value"], 256).alias("hash"),
                F.length(x["value"]).alias("value_size"),
            ),
        ),
    )


def candidate_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, owner, kind, start, end, hash of all candidates that pass their kind's length."""
    text = F.col("text")
    found = reduce(
        lambda a, b: F.concat(a, b),
        [F.coalesce(_matches(text, k, p), F.array()) for k, (_, p) in enumerate(KINDS)],
    )
    rows = (
        docs.filter(reduce(lambda a, b: a | b, [text.rlike(p) for _, p in KINDS]))
        .select("doc_id", "owner", "repo", "text_key", found.alias("found"))
        .dropDuplicates(["doc_id", "text_key", "owner", "repo"])
        .select("doc_id", "owner", "repo", "text_key", F.inline("found"))
        .filter(F.col("size").isNotNull())
    )
    # One document's matches of one kind, in order: what stands before a match is all earlier gaps and matches.
    so_far = Window.partitionBy("doc_id", "text_key", "owner", "repo", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("size"))
        .filter((F.col("kind") != 0) | (F.col("value_size") >= 6))
        .select("doc_id", "text_key", "owner", "repo", "kind", "start", "end", "hash")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """hash, owners, repositories: distinct holders over the corpus, counted in steps that pre-aggregate."""
    held = spans.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str | None = None,
    shared_owners: int = 3,
) -> DataFrame:
    """All spans with their class: doc_id, text_key, kind, start, end, owners, repositories, live.

    ``shared_owners`` is the number of distinct owners from which a value counts as
    a widely copied example.  ``repo_col`` None takes the document as the repository.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.lit("") if owner_col is None else F.col(owner_col).cast("string")).alias("owner"),
        F.col(id_col if repo_col is None else repo_col).cast("string").alias("repo"),
    ).withColumn("text_key", F.xxhash64("text"))
    spans = scratch.save(candidate_spans(base), "spans")
    # Rows that share id and text share their spans, whatever owners hold them.
    one = spans.select("doc_id", "text_key", "kind", "start", "end", "hash").distinct()
    joined = one.join(ownership(spans), "hash")
    live = F.col("owners") < shared_owners
    return joined.filter((F.col("kind") < BASE) | live).select(
        "doc_id", "text_key", "kind", "start", "end", "owners", "repositories", live.alias("live")
    )


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k, _ in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """One row a document with the counts, the digest of the base spans, all spans, and how many look live or copied."""
    spans = scan_secrets(docs, **options)
    one = F.struct("start", "kind", "end")
    per_doc = spans.groupBy("doc_id", "text_key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.collect_list(F.when(F.col("kind") < BASE, one)).alias("base"),
        F.collect_list(one).alias("all"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_copied"),
    )
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    keys = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    joined = keys.alias("d").join(
        per_doc.alias("p"),
        F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_key") == F.col("p.text_key")),
        "left",
    )
    empty = F.lit("")
    return joined.select(
        "d.doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k, _ in KINDS[:BASE]],
        F.sha2(F.coalesce(_listed(F.col("base")), empty), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("all")), empty).alias("spans"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_live", "n_copied")],
    )


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """The documents with every reported span replaced by ``mask``; other columns as they were.

    Overlapping spans (a hex run inside an assignment) are masked once.  The pieces
    between spans are cut from the text by code point.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    spans = scan_secrets(docs, **options)
    per_doc = spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    # Kept pieces run from the furthest end so far to the next start.
    merged = F.aggregate(
        "cuts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("gaps")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] > acc["at"]) | (F.size(acc["gaps"]) == 0),
                F.array_append(acc["gaps"], F.struct(acc["at"].alias("a"), F.greatest(s["start"], acc["at"]).alias("b"))),
            ).otherwise(acc["gaps"]).alias("gaps"),
        ),
    )
    plan = per_doc.select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), merged.alias("__m")
    )
    # The row goes whole in one column, so no name of its own can clash.
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col]
    keyed = row.select("row", F.col("row")[id_col].alias("k_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k_text"))
    joined = keyed.join(plan, F.col("k_id").eqNullSafe(F.col("__id")) & (F.col("k_text") == F.col("__key")), "left")
    pieces = F.transform(F.col("__m.gaps"), lambda g: F.substring(text, (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")))
    masked = F.concat(F.array_join(pieces, mask), F.lit(mask), F.substring(text, (F.col("__m.at") + 1).cast("int"), F.length(text)))
    out = F.when(F.col("__m").isNull(), text).otherwise(masked)
    return joined.select(*[out.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
