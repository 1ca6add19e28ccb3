"""Longest-suffix matching as an equality join: public suffixes and registry servers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES_SCHEMA = "suffix string, kind string"


def public_suffix_rules(spark: SparkSession, lines: list[str] | None = None) -> DataFrame:
    """suffix, kind (exact, wildcard, exception); by default the public list that Spark's HTTP client carries on its class path."""
    if lines is None:
        jvm = spark.sparkContext._jvm
        stream = jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream("mozilla/public-suffix-list.txt")
        if stream is None:
            raise FileNotFoundError("no public suffix list on the class path; pass its lines")
        try:
            lines = bytes(stream.readAllBytes()).decode("utf-8").splitlines()
        finally:
            stream.close()
    rules = set()
    for line in lines:
        rule = line.split()[0] if line.split() else ""
        if not rule or rule.startswith("//"):
            continue
        kind = "exception" if rule.startswith("!") else "wildcard" if rule.startswith("*.") else "exact"
        name = rule.lstrip("!").removeprefix("*.")
        try:
            rules.add((name.encode("idna").decode("ascii").lower(), kind))
        except UnicodeError:
            continue
    return spark.createDataFrame(sorted(rules), RULES_SCHEMA)


def suffix_candidates(host: Column) -> Column:
    """Array of (start, suffix): every run of labels that ends the host; start counts labels from 1."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(i.alias("start"), F.array_join(F.slice(labels, i, n), ".").alias("suffix")))


def with_public_suffix(rows: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """Adds public_suffix, registrable_domain, is_public_suffix_input; hosts that no rule covers are dropped.

    The rule table is a fixed list of some ten thousand rows, so it is broadcast.  Rows
    are matched once a distinct host.
    """
    hosts = rows.select(F.col(host).alias("__h")).filter(F.col(host) != "").distinct()
    found = (
        hosts.select("__h", F.inline(suffix_candidates(F.col("__h")))).join(F.broadcast(rules), "suffix")
        # A wildcard takes one more label, an exception one less.
        .withColumn("from", F.col("start") + F.when(F.col("kind") == "wildcard", -1).when(F.col("kind") == "exception", 1).otherwise(0))
        .filter(F.col("from") >= 1)
        .groupBy("__h").agg(F.min(F.struct((F.col("kind") != "exception").alias("later"), F.col("from").alias("from"))).alias("best"))
    )
    labels = F.split("__h", r"\.")
    n = F.size(labels)
    start = F.col("best")["from"]
    named = found.select(
        "__h", F.array_join(F.slice(labels, start, n), ".").alias("public_suffix"),
        F.when(start > 1, F.array_join(F.slice(labels, F.greatest(start - 1, F.lit(1)), n), ".")).otherwise("").alias("registrable_domain"),
        (start == 1).alias("is_public_suffix_input"),
    )
    return rows.join(named, rows[host] == named["__h"]).drop("__h")


def bootstrap_services(payload: DataFrame, column: str = "body") -> DataFrame:
    """suffix, urls of a bootstrap document: https first, then by text; of a repeated suffix the last entry holds."""
    schema = "struct<services: array<array<array<string>>>>"
    entries = payload.select(F.posexplode(F.from_json(column, schema)["services"]).alias("at", "entry"))
    urls = F.array_sort(
        F.filter(F.col("entry")[1], lambda u: u.endswith("/")),
        lambda a, b: F.when(a.startswith("https://") & ~b.startswith("https://"), -1)
        .when(~a.startswith("https://") & b.startswith("https://"), 1).when(a < b, -1).when(a > b, 1).otherwise(0),
    )
    rows = entries.select("at", urls.alias("urls"), F.posexplode(F.col("entry")[0]).alias("in_entry", "suffix")).filter("size(urls) > 0")
    return rows.groupBy(F.lower("suffix").alias("suffix")).agg(F.max_by("urls", F.struct("at", "in_entry")).alias("urls"))


def cached_services(spark: SparkSession, path: str, fetch: Callable[[], tuple[dict[str, str], str]], now: float) -> DataFrame:
    """Services of the bootstrap document that ``path`` keeps with its expiry; fetched again when that has passed or is unknown.

    ``fetch`` gives (headers, body); where it fails with an OSError the document kept holds on,
    and without one there is no service.  The document lists registries, not roots, so its
    size does not depend on the run's.
    """
    from .lookup import bootstrap_expiry
    from .sinks import read_text, switch_pointer

    held = json.loads(read_text(spark, path) or "{}")
    if not held or held["expires"] is None or held["expires"] <= now:
        try:
            headers, body = fetch()
        except OSError:
            body = held.get("body", "")
        else:
            switch_pointer(spark, path, json.dumps({"body": body, "expires": bootstrap_expiry(headers, now)}))
    else:
        body = held["body"]
    return bootstrap_services(spark.createDataFrame([(body,)], "body string"))


def with_server(roots: DataFrame, services: DataFrame, root: str = "registrable_domain") -> DataFrame:
    """Adds authoritative_base_url: first URL of the longest suffix that has a service, or null."""
    named = (
        roots.select(F.col(root).alias("__r")).distinct().select("__r", F.inline(suffix_candidates(F.col("__r")))).join(services, "suffix")
        .groupBy("__r").agg(F.min_by(F.col("urls")[0], "start").alias("authoritative_base_url"))
    )
    return roots.join(named, roots[root] == named["__r"], "left").drop("__r")
