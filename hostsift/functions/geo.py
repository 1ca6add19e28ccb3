"""Column functions of the geo policy over an array of per-address results."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import region_name


@dataclass(frozen=True)
class Rules:
    """One side of a policy; an empty list matches nothing."""

    countries: list[str] = field(default_factory=list)
    region_codes: list[str] = field(default_factory=list)
    region_names: list[str] = field(default_factory=list)

    def any(self) -> bool:
        return any([*self.countries, *self.region_codes, *self.region_names])

    def column(self) -> Column:
        return F.struct(*[
            F.array(*[F.lit(v) for v in values]).cast("array<string>").alias(name)
            for name, values in (("countries", self.countries), ("region_codes", self.region_codes), ("region_names", self.region_names))
        ])


@dataclass(frozen=True)
class Policy:
    enabled: bool = True
    match: str = "all_ips"
    include: Rules = field(default_factory=Rules)
    exclude: Rules = field(default_factory=Rules)

    def column(self) -> Column:
        return F.struct(
            F.lit(self.enabled).alias("enabled"), F.lit(self.match).alias("match"), self.include.column().alias("include"), self.exclude.column().alias("exclude")
        )


_SIDE = "struct<countries array<string>, region_codes array<string>, region_names array<string>>"
#: A policy as a column: rows may each have their own.
POLICY_TYPE = f"struct<enabled boolean, match string, include {_SIDE}, exclude {_SIDE}>"


def _any(side: Column) -> Column:
    return F.size(side["countries"]) + F.size(side["region_codes"]) + F.size(side["region_names"]) > 0


def matches(side: Column, geo: Column) -> Column:
    """Whether an address is named by one side of a policy; an empty list names nothing."""
    among = lambda value, names: F.coalesce(F.array_contains(names, value), F.lit(False))
    return (
        among(geo["country_code"], side["countries"]) | among(geo["region_code"], side["region_codes"])
        | among(region_name(geo["region_name"]), side["region_names"])
    )


def usable(results: Column) -> Column:
    return F.filter(results, lambda r: r["status"].isin("ok", "cache_hit"))


def accepts(policy: Column, geo: Column) -> Column:
    """Exclusion wins; without include rules every address is included."""
    return (~_any(policy["include"]) | matches(policy["include"], geo)) & ~matches(policy["exclude"], geo)


def decision(policy: Policy | Column, results: Column) -> Column:
    """Struct geo_status, geo_reason, geo_policy_status, geo_policy_reason, matched_ips, rejected_ips.

    ``policy`` is one for all rows, or a column of ``POLICY_TYPE``.
    """
    rule = policy.column() if isinstance(policy, Policy) else policy
    good = usable(results)
    none = F.array().cast("array<string>")
    matched = F.transform(F.filter(good, lambda r: accepts(rule, r)), lambda r: r["ip"])
    rejected = F.transform(F.filter(good, lambda r: ~accepts(rule, r)), lambda r: r["ip"])

    def out(status, why, policy_status, policy_why, hit: Column = none, miss: Column = none) -> Column:
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(
            lit(status).alias("geo_status"), lit(why).alias("geo_reason"), lit(policy_status).alias("geo_policy_status"),
            lit(policy_why).alias("geo_policy_reason"), hit.alias("matched_ips"), miss.alias("rejected_ips"),
        )

    named = F.size(rule["include"]["region_names"]) + F.size(rule["exclude"]["region_names"]) > 0
    blank = F.forall(good, lambda r: region_name(F.coalesce(r["region_name"], F.lit(""))) == "")
    every = rule["match"] == "all_ips"
    fine = F.when(every, F.size(rejected) == 0).otherwise(F.size(matched) > 0)
    why = (
        F.when(every & fine, "all_ips_matched").when(every, "one_or_more_ips_rejected").when(fine, "at_least_one_ip_matched").otherwise("no_ips_matched")
    )
    return (
        F.when(F.size(good) == 0, out("review", "geo_lookup_failed", "skipped", "geo_lookup_failed"))
        .when(named & blank, out("review", "region_name_unavailable", "skipped", "region_name_unavailable"))
        .when(~rule["enabled"], out("ok", "lookup_succeeded", "skipped", "policy_disabled"))
        .when(~(_any(rule["include"]) | _any(rule["exclude"])), out("ok", "lookup_succeeded", "skipped", "policy_has_no_rules"))
        .otherwise(out("ok", "lookup_succeeded", F.when(fine, "accepted").otherwise("rejected"), why, matched, rejected))
    )


def overlaid_class(klass: Column, made: Column) -> Column:
    """Class after geo: failures and rejections take its place."""
    return (
        F.when(made["geo_reason"] == "geo_lookup_failed", "geo_lookup_failed")
        .when(made["geo_reason"] == "region_name_unavailable", "geo_region_name_unavailable")
        .when(made["geo_policy_status"] == "rejected", "geo_policy_rejected").otherwise(klass)
    )
