"""Column functions from lookup results to class, route and reviewer texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def dns_status(dns: Column) -> Column:
    """timeout before servfail before nx before noerror before nodata."""
    return (
        F.when(dns["a_timeout"], "timeout").when(dns["a_servfail"], "servfail").when(dns["a_nxdomain"], "nx")
        .when(dns["a_exists"], "noerror").when(dns["a_nodata"], "nodata").otherwise("error")
    )


def resolved_ips(dns: Column) -> Column:
    return F.concat(dns["ipv4_addresses"], dns["ipv6_addresses"])


def record_outcome(kind: str, outcome: Column, values: Column) -> Column:
    """One record type's struct for ``combined_answer``.

    ``outcome`` is answer, no_answer, nxdomain, exhausted (retries used up), timeout or
    anything else for a failure; ``values`` are the answer's texts, null where there is no
    record set.  Texts that are no address are passed over in A and AAAA answers; of a
    CNAME answer the first target is the alias.
    """
    none, address = F.array().cast("array<string>"), r"^(\d{1,3}(\.\d{1,3}){3}|[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*)$"
    answered, alias = outcome == "answer", kind == "CNAME"
    found = F.when(answered & F.lit(not alias), F.filter(F.coalesce(values, none), lambda v: v.rlike(address))).otherwise(none)
    exists = (answered & values.isNotNull()) if alias else F.size(found) > 0
    late = (outcome == "timeout") | ((outcome == "exhausted") & F.lit(not alias))
    known = outcome.isin("answer", "no_answer", "nxdomain")
    return F.struct(
        exists.alias("exists"), ((outcome == "no_answer") | (answered & values.isNull())).alias("nodata"), (outcome == "nxdomain").alias("nxdomain"),
        late.alias("timeout"), (~late & ~known).alias("servfail"),
        F.when(answered & F.lit(alias), F.get(values, F.lit(0))).alias("cname"), found.alias("addresses"),
    )


def combined_answer(a: Column, aaaa: Column, cname: Column) -> Column:
    """One DNS result of the three record types.

    Each is a struct (exists, nodata, nxdomain, timeout, servfail, cname, addresses).
    AAAA counts unless A said NXDOMAIN; its existence, absence and alias count only where
    A found nothing.  CNAME counts while nothing exists, nothing said NXDOMAIN and no
    alias is known.  Existence clears the absences; a timeout stands only alone, a
    SERVFAIL always.
    """
    off, none = F.lit(False), F.array().cast("array<string>")
    six, alone = ~a["nxdomain"], ~a["exists"] & ~a["nxdomain"]
    exists_ip = a["exists"] | (alone & aaaa["exists"])
    nx_ip = F.when(alone, aaaa["nxdomain"]).otherwise(a["nxdomain"])
    alias = F.coalesce(a["cname"], F.when(alone, aaaa["cname"]))
    named = ~exists_ip & ~nx_ip & alias.isNull()
    exists = exists_ip | (named & cname["exists"])
    nx = nx_ip & ~exists
    nodata = F.when(alone, a["nodata"] & aaaa["nodata"] & ~aaaa["nxdomain"]).otherwise(a["nodata"]) & ~exists & ~nx
    seen = lambda name: a[name] | F.when(six, aaaa[name]).otherwise(off) | F.when(named, cname[name]).otherwise(off)
    servfail = seen("servfail")
    return F.struct(
        exists.alias("a_exists"), nodata.alias("a_nodata"), nx.alias("a_nxdomain"),
        (seen("timeout") & ~exists & ~nx & ~nodata & ~servfail).alias("a_timeout"), servfail.alias("a_servfail"),
        F.coalesce(alias, F.when(named & cname["exists"], cname["cname"])).alias("canonical_name"),
        F.coalesce(a["addresses"], none).alias("ipv4_addresses"),
        F.when(six, F.coalesce(aaaa["addresses"], none)).otherwise(none).alias("ipv6_addresses"),
    )


def host_class(host: Column, root: Column, rdap: Column, dns: Column, hold: list[str] = (), deletion: list[str] = ()) -> Column:
    """Class of a host from the registry verdict (null: unavailable) and the DNS result."""
    status = dns_status(dns)
    apex = host == root
    low = F.transform(F.coalesce(rdap["statuses"], F.array().cast("array<string>")), F.lower)
    chain = (
        F.when(rdap.isNotNull() & ~rdap["exists"], V.UNREGISTERED)
        .when(status == "timeout", V.TIMEOUT).when(status == "servfail", V.SERVFAIL)
        .when(dns["a_nxdomain"], F.when(apex, V.APEX_NXDOMAIN).otherwise(V.SUB_NXDOMAIN))
        .when(dns["a_nodata"], F.when(apex, V.APEX_NODATA).otherwise(V.SUB_NODATA))
    )
    chain = reduce(lambda c, e: c.when(F.array_contains(low, e[0]), e[1]), V.EPP, chain)
    for names, other in ((hold, V.HOLD_OTHER), (deletion, V.DELETION_OTHER)):
        if names:
            chain = chain.when(F.arrays_overlap(low, F.array(*[F.lit(n.lower()) for n in names])), other)
    return chain.otherwise(V.RESOLVES)


def route(klass: Column, policy_status: Column, geo_reason: Column) -> Column:
    held_back = (F.coalesce(geo_reason, F.lit("")) == "no_resolved_ips") | (F.coalesce(policy_status, F.lit("")) == "rejected")
    return F.when(klass.isin(V.DEAD), "dead").when(klass.isin(V.FILTERED) & ~held_back, "filtered").otherwise("review")


def public_class(klass: Column, policy_status: Column) -> Column:
    """Class shown in the review file."""
    same = [V.PUBLIC_SUFFIX, V.PASS_NOT_IN_SOURCES, "dns_filtered_out", "geo_filtered_out", "manual_filtered_out", "rdap_filtered_out"]
    return (
        F.when(klass.isin(same), klass)
        .when(klass.isin(V.FILTER_OUT, V.OUT_NOT_IN_SOURCES, V.ADD_UNREGISTERED, V.ADD_UNAVAILABLE), "manual_filtered_out")
        .when(klass.isin([V.UNAVAILABLE_NO_DNS, *V.RDAP_REVIEW]), "rdap_filtered_out")
        .when(klass.isin(V.GEO_REVIEW) | (policy_status == "rejected"), "geo_filtered_out")
        .otherwise("dns_filtered_out")
    )


def reason(klass: Column, policy_status: Column, policy_reason: Column, input_kind: Column, host: Column, root: Column) -> Column:
    """Text for the reviewer."""
    subject = (
        F.when(input_kind == "suffix_rule", "registered suffix-rule domain").when(host == root, "registered apex domain")
        .otherwise("registered subdomain")
    )
    rejected = F.lit("geo policy rejected resolved IPs")
    texts = F.create_map(*[F.lit(x) for pair in V.REASONS.items() for x in pair])
    known = F.replace(F.try_element_at(texts, F.coalesce(klass, F.lit(""))), F.lit("{subject}"), subject)
    return (
        F.when(
            (klass == V.GEO_REJECTED) | (policy_status == "rejected"),
            F.when(F.coalesce(policy_reason, F.lit("")) != "", F.concat(rejected, F.lit(": "), policy_reason)).otherwise(rejected),
        )
        .when(known.isNotNull(), known).when(F.coalesce(klass, F.lit("")) != "", klass)
        .otherwise("review routing triggered without a recorded classification")
    )


def registration_status(rdap: Column) -> Column:
    return F.when(rdap.isNull(), "unavailable").when(rdap["exists"], "registered").otherwise("unregistered")


def sorted_distinct(values: Column) -> Column:
    """Distinct values without empty ones, in code point order."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))))


def review_columns(columns: list[str]) -> list[Column]:
    """The review file's columns, in order, from a terminal row; arrays as compact JSON."""
    empty = F.lit("")
    value = lambda n: F.coalesce(F.col(n).cast("string"), empty) if n in columns else empty
    policy, policy_reason = value("geo_policy_status"), value("geo_policy_reason")
    made = {
        "classification": public_class(F.col("classification"), policy),
        "classification_reason": reason(F.col("classification"), policy, policy_reason, value("input_kind"), F.col("host"), F.col("registrable_domain")),
        **{n: F.to_json(F.coalesce(F.col(n), F.array().cast("array<string>"))) for n in ("source_ids", "source_input_labels") if n in columns},
    }
    return [made.get(n, value(n)).alias(n) for n in V.REVIEW_COLUMNS]


def signature(columns: list[str]) -> Column:
    """Digest of a row whatever the order of its columns."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)
