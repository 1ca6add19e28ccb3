"""From raw lines to one row a host: format detection, parsing, dedupe, overrides, collapse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V
from .places import Keep, with_places
from .suffixes import with_public_suffix


class PreparationError(ValueError):
    """The inputs contradict each other."""


def _normalised(rows: DataFrame, name: str, out: str) -> DataFrame:
    """ASCII names by built-in functions; of the others alone the IDNA codec gets a value, so one scan serves both."""
    column = F.col(name)
    other = X.idna_host(F.when(~X.is_ascii(column), column))
    return rows.withColumn("__idna", other).withColumn(out, F.coalesce("__idna", X.ascii_host(column))).drop("__idna")


def with_line_format(lines: DataFrame) -> DataFrame:
    """Adds content and line_format to raw lines; lines without content are dropped."""
    content = lines.withColumn("content", X.without_comments(F.col("raw_line"))).filter("content != ''")
    first = F.split("content", rf"{X.BLANK}+")[0]
    # Only tokens that could be an address go to Python.
    address_like = first.rlike(r"^[0-9A-Fa-f:.]+(%.*)?\z") & (F.size(F.split("content", rf"{X.BLANK}+")) >= 2)
    named = content.withColumn("__address", F.coalesce(X.is_address(F.when(address_like, first)), F.lit(False)))
    named = _normalised(named, "content", "__plain")
    return named.withColumn("line_format", X.line_format(F.col("content"), F.col("__address"), F.col("__plain"))).drop("__address", "__plain")


def source_formats(typed: DataFrame) -> DataFrame:
    """source_id, source_format: unknown, mixed or the one format; the first such event in line order decides."""
    known = F.col("line_format") != "unknown"
    firsts = typed.groupBy("source_id", "line_format").agg(F.min("line_index").alias("at"))
    return firsts.groupBy("source_id").agg(
        F.min(F.when(~known, F.col("at"))).alias("unknown_at"),
        F.get(F.array_sort(F.collect_list(F.when(known, F.col("at")))), F.lit(1)).alias("mixed_at"),
        F.min_by("line_format", F.when(known, F.col("at"))).alias("first"),
    ).select(
        "source_id",
        F.when(F.col("unknown_at").isNotNull() & (F.col("mixed_at").isNull() | (F.col("unknown_at") < F.col("mixed_at"))), "unknown")
        .when(F.col("mixed_at").isNotNull(), "mixed").otherwise(F.coalesce("first", F.lit("unknown"))).alias("source_format"),
    )


def parse_lines(lines: DataFrame, rules: DataFrame, forced_format: str | None = None) -> DataFrame:
    """Parsed entries of raw lines (source_id, source_index, line_index, raw_line, and label columns passed through).

    Sources of unknown or mixed format are left out whole; with a forced format bad lines are left out one by one.
    """
    if forced_format in (None, "auto"):
        typed = with_line_format(lines)
        formats = source_formats(typed).filter(~F.col("source_format").isin("unknown", "mixed"))
        rows = typed.drop("line_format").join(formats, "source_id")
    else:
        rows = lines.withColumn("content", X.without_comments(F.col("raw_line"))).filter("content != ''").withColumn("source_format", F.lit(forced_format))
    rows = rows.withColumn("__s", X.rule_scope(X.rule_name(F.col("content"), F.col("source_format")), F.col("source_format")))
    rows = rows.select("*", "__s.*").drop("__s", "content")
    hosts = _normalised(rows, "input_name", "host").filter(X.valid_host(F.col("host")))
    return first_entries(with_public_suffix(hosts, rules))


def first_entries(entries: DataFrame) -> DataFrame:
    """Of entries of a source with equal host, kind and scope the first line stays."""
    order = Window.partitionBy("source_id", "host", "input_kind", "apex_scope").orderBy("line_index")
    return entries.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def first_roots(entries: DataFrame) -> DataFrame:
    """Distinct roots (the host itself where it is a public suffix) with the place where each is first seen."""
    root = F.when(F.col("registrable_domain") != "", F.col("registrable_domain")).otherwise(F.col("host"))
    return entries.groupBy(root.alias("root")).agg(F.min(F.struct("source_index", "line_index")).alias("first_seen"))


def overlap_errors(passes: DataFrame, outs: DataFrame, adds: DataFrame) -> list[str]:
    """For each two override lists that share hosts a text naming the lexically first."""
    named = [("manual_filter_pass", passes), ("manual_filter_out", outs), ("manual_add", adds)]
    found = []
    for i, (a, left) in enumerate(named):
        for b, right in named[i + 1 :]:
            low = left.select("host").intersect(right.select("host")).agg(F.min("host")).first()[0]
            if low is not None:
                found.append(f"{low} is in both {a} and {b}")
    return found


def profile_conflicts(entries: DataFrame, key: str = "host", profile: str = "fingerprint") -> DataFrame:
    """Hosts whose sources differ in profile, with the first source and the first that differs from it."""
    first = entries.groupBy(key).agg(
        F.min(F.struct("source_index", "line_index", F.col(profile).alias("p"), "source_id")).alias("f"),
        F.min(profile).alias("lo"), F.max(profile).alias("hi"),
    ).filter("lo != hi").select(key, F.col("f.p").alias("__p"), F.col("f.source_id").alias("first_source"))
    return entries.join(first, key).filter(F.col(profile) != F.col("__p")).groupBy(key, "first_source").agg(
        F.min_by("source_id", F.struct("source_index", "line_index")).alias("second_source")
    )


def collapse_hosts(entries: DataFrame) -> DataFrame:
    """One row a host: the first entry by source and line, source ids and labels in that order, whether any was passed."""
    own = [c for c in entries.columns if c not in ("host", "manual_filter_pass")]
    ordered = F.array_sort(F.collect_list(F.struct("source_index", "line_index", "source_id", "source_input_label")))
    grouped = entries.groupBy("host").agg(
        F.min_by(F.struct(*own), F.struct("source_index", "line_index")).alias("__e"), ordered.alias("__o"),
        F.max("manual_filter_pass").alias("manual_filter_pass"),
    )
    return grouped.select(
        "host", "manual_filter_pass", "__e.*", F.col("__o.source_id").alias("source_ids"), F.col("__o.source_input_label").alias("source_input_labels")
    )


def apply_overrides(entries: DataFrame, passes: DataFrame, outs: DataFrame, adds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prepared, removed, unmatched): rows to go on, rows taken out by hand, override hosts that no source has."""
    removed = collapse_hosts(entries.join(outs.select("host"), "host", "left_semi").withColumn("manual_filter_pass", F.lit(False)))
    rest = entries.join(outs.select("host"), "host", "left_anti")
    mark = passes.select("host").distinct().withColumn("__pass", F.lit(True))
    flagged = rest.join(mark, "host", "left").withColumn("manual_filter_pass", F.col("__pass").isNotNull()).drop("__pass")
    collapsed = collapse_hosts(flagged).withColumn("manual_add", F.lit(False))
    # The override's entry takes the place of the sources'; their ids are kept where there are any.
    entry = [c for c in adds.columns if c not in ("source_id", "source_index", "source_input_label")]
    provenance = collapsed.select("host", *[F.col(c).alias(f"__{c}") for c in ("source_ids", "source_input_labels", "source_id", "source_input_label", "source_index")])
    added = adds.select("source_id", "source_index", "source_input_label", *entry).join(provenance, "host", "left")
    added = added.select(
        *[c for c in entry],
        *[F.coalesce(f"__{c}", c).alias(c) for c in ("source_id", "source_input_label", "source_index")],
        F.coalesce("__source_ids", F.array("source_id")).alias("source_ids"),
        F.coalesce("__source_input_labels", F.array("source_input_label")).alias("source_input_labels"),
        F.lit(False).alias("manual_filter_pass"), F.lit(True).alias("manual_add"),
    )
    prepared = collapsed.join(adds.select("host"), "host", "left_anti").unionByName(added, allowMissingColumns=True)
    known = entries.select("host").distinct()
    unmatched = passes.select("host").distinct().join(known, "host", "left_anti").withColumn("classification", F.lit(V.PASS_NOT_IN_SOURCES)).unionByName(
        outs.select("host").distinct().join(known, "host", "left_anti").withColumn("classification", F.lit(V.OUT_NOT_IN_SOURCES))
    )
    return prepared, removed, unmatched


def root_groups(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host count a root, public-suffix entries)."""
    inner = entries.filter(~F.col("is_public_suffix_input"))
    return inner.groupBy("registrable_domain").agg(F.count("*").alias("hosts")), entries.filter("is_public_suffix_input")


def in_source_order(entries: DataFrame) -> DataFrame:
    return entries.orderBy("source_index", "source_id", "line_index", "host")


def with_source_places(entries: DataFrame, keep: Keep) -> DataFrame:
    """Adds each entry's place, from 0, in the order of ``in_source_order``."""
    return with_places(entries, ["source_index", "source_id", "line_index", "host"], keep, "entries")


def checked(problems: list[str]) -> None:
    if problems:
        raise PreparationError(reduce(lambda a, b: f"{a}; {b}", problems))
