"""The decision chain: one ordered precedence from entry, registry verdict, DNS and geo to class and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import verdicts as D
from ..functions import vocab as V


def before_dns(rows: DataFrame) -> DataFrame:
    """Adds early_class and early_reason: the first rule that ends a row before DNS, in order of precedence.

    Expects is_public_suffix_input, rdap (null: unavailable), manual_add, manual_filter_pass, dns_enabled.
    """
    registered, known = F.coalesce(F.col("rdap.exists"), F.lit(False)), F.col("rdap").isNotNull()
    rules: list[tuple[Column, Column | str, str]] = [
        (F.col("is_public_suffix_input"), V.PUBLIC_SUFFIX, "public_suffix_guard"),
        (F.col("manual_add") & registered, V.ADD_REGISTERED, "manual_add_registered"),
        (F.col("manual_add") & known, V.ADD_UNREGISTERED, "manual_add_unregistered"),
        (F.col("manual_add"), V.ADD_UNAVAILABLE, "manual_add_unavailable"),
        (known & ~registered, V.UNREGISTERED, "dead_root"),
        (F.col("manual_filter_pass"), V.PASSED, "manual_filter_pass"),
        (~F.col("dns_enabled") & registered, V.REGISTERED_NO_DNS, "dns_disabled"),
        (~F.col("dns_enabled"), V.UNAVAILABLE_NO_DNS, "dns_disabled"),
    ]
    klass = why = None
    for when, name, text in rules:
        klass = F.when(when, name) if klass is None else klass.when(when, name)
        why = F.when(when, text) if why is None else why.when(when, text)
    return rows.withColumn("early_class", klass).withColumn("early_reason", why)


def classified(rows: DataFrame, hold: list[str] = (), deletion: list[str] = ()) -> DataFrame:
    """Adds dns_status, resolved_ips, classification and, for rows that end before geo, geo_reason.

    ``dns`` is null for rows that ended before DNS.
    """
    early, dns = F.col("early_class"), F.col("dns")
    full = D.host_class(F.col("host"), F.col("registrable_domain"), F.col("rdap"), dns, hold, deletion)
    none = F.array().cast("array<string>")
    ips = F.when(early.isNull(), F.coalesce(D.resolved_ips(dns), none)).otherwise(none)
    out = rows.withColumn("resolved_ips", ips).withColumn("dns_status", F.when(early.isNull(), D.dns_status(dns)).otherwise("skipped"))
    empty = F.size("resolved_ips") == 0
    klass = F.when(early.isNotNull(), early).when(empty & (full == V.RESOLVES), V.NO_ADDRESSES).otherwise(full)
    out = out.withColumn("classification", klass)
    why = (
        F.when(early.isNotNull(), F.col("early_reason")).when(empty, "no_resolved_ips")
        .when(F.col("classification").isin(V.PRE_GEO), "classification_precludes_geo_lookup").when(~F.col("geo_enabled"), "geo_disabled")
    )
    return out.withColumn("geo_reason", why)


def with_geo(rows: DataFrame, policy: G.Policy | Column) -> DataFrame:
    """Adds geo and policy columns; ``policy`` is one for all or a column; ``results`` is the array of per-address answers in the order of resolved_ips."""
    made = G.decision(policy, F.col("results"))
    ended = F.col("geo_reason").isNotNull()
    none = F.array().cast("array<string>")
    skipped = F.struct(
        F.lit("skipped").alias("geo_status"), F.col("geo_reason").alias("geo_reason"), F.lit("skipped").alias("geo_policy_status"),
        F.col("geo_reason").alias("geo_policy_reason"), none.alias("matched_ips"), none.alias("rejected_ips"),
    )
    out = rows.withColumn("__g", F.when(ended, skipped).otherwise(made))
    out = out.withColumn("classification", F.when(ended, F.col("classification")).otherwise(G.overlaid_class(F.col("classification"), F.col("__g"))))
    return out.drop("geo_reason").select("*", "__g.*").drop("__g")


def terminal_rows(rows: DataFrame, geo_provider: str | Column = "") -> DataFrame:
    """Audit rows: identity, class, statuses, sorted geo sets, route."""
    results = F.coalesce(F.col("results"), F.array().cast(rows.schema["results"].dataType))
    asked = (F.col("geo_status") == "review") | F.col("geo_policy_status").isin("accepted", "rejected") | (F.col("geo_reason") == "lookup_succeeded")
    return rows.select(
        *[c for c in V.IDENTITY_COLUMNS if c in rows.columns and c != "input_name"],
        (F.when(F.col("input_name") != "", F.col("input_name")).otherwise(F.col("host")) if "input_name" in rows.columns else F.col("host")).alias("input_name"),
        "classification", D.registration_status(F.col("rdap")).alias("rdap_registration_status"), "dns_status",
        F.coalesce(F.col("dns.canonical_name"), F.lit("")).alias("canonical_name"), "resolved_ips",
        "geo_status", "geo_reason", "geo_policy_status", "geo_policy_reason",
        F.when(asked, geo_provider).otherwise("").alias("geo_provider"),
        D.sorted_distinct(F.transform(results, lambda r: r["country_code"])).alias("geo_countries"),
        D.sorted_distinct(F.transform(results, lambda r: r["region_code"])).alias("geo_region_codes"),
        D.sorted_distinct(F.transform(results, lambda r: F.trim(r["region_name"]))).alias("geo_region_names"),
        D.route(F.col("classification"), F.col("geo_policy_status"), F.col("geo_reason")).alias("route"),
    )


def outcome_counts(rows: DataFrame) -> DataFrame:
    """Rows by route and class, with the totals of each route."""
    return rows.rollup("route", "classification").agg(F.count("*").alias("n")).filter("route IS NOT NULL")
