"""One run of host lists: from raw lines to terminal rows, and the cache rows that its lookups made.

Each lookup is a relation: distinct keys meet the cache layers, what they lack (or must
refresh) goes to a provider once, and the answers are joined back.  Keys that a stage's
rules have ended never reach the next lookup.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import vocab as V
from . import cache as C
from . import lookup as L
from . import prepare as P
from . import screening as R
from .sinks import read_text, switch_pointer
from .suffixes import with_server

Layers = tuple[DataFrame | None, DataFrame | None]
Keep = Callable[[DataFrame, str], DataFrame]
NO_LAYERS: Layers = (None, None)


@dataclass(frozen=True)
class SourceSettings:
    """What the rows of one source need of the configuration.

    Sources that share a host must share ``execution_profile``, or ``rdap_profile`` where the
    host is added by hand.
    """

    dns_enabled: bool = True
    geo_enabled: bool = True
    resolver_key: str = "system|ecs=off"
    geo_provider: str = "ipinfo_lite"
    geo_days: int = 7
    policy: G.Policy = field(default_factory=lambda: G.Policy(enabled=False))
    execution_profile: str = ""
    rdap_profile: str = ""


#: Each row's settings while it is screened.
CFG_TYPE = f"struct<dns_enabled boolean, geo_enabled boolean, resolver_key string, geo_provider string, geo_days int, policy {G.POLICY_TYPE}>"


@dataclass(frozen=True)
class Settings:
    """Settings of a run: by source, for rows of no named source, and those that hold for all rows."""

    sources: Mapping[str, SourceSettings] = field(default_factory=dict)
    other: SourceSettings = field(default_factory=SourceSettings)
    hold: tuple[str, ...] = ()
    deletion: tuple[str, ...] = ()
    registered_days: int = 7
    unregistered_days: int = 7
    unavailable_days: int = 7
    dns_days: int = 1


def _cfg(s: SourceSettings) -> tuple:
    side = lambda r: (r.countries, r.region_codes, r.region_names)
    policy = (s.policy.enabled, s.policy.match, side(s.policy.include), side(s.policy.exclude))
    return (s.dns_enabled, s.geo_enabled, s.resolver_key, s.geo_provider, s.geo_days, policy)


def with_settings(rows: DataFrame, settings: Settings) -> DataFrame:
    """Adds struct ``cfg`` of each row's source.  The relation has one row a source of the configuration file, so it is broadcast."""
    spark = rows.sparkSession
    schema = f"source_id string, __cfg {CFG_TYPE}"
    known = spark.createDataFrame([(name, _cfg(s)) for name, s in settings.sources.items()], schema)
    other = spark.createDataFrame([(_cfg(settings.other),)], f"__other {CFG_TYPE}").first()["__other"]
    fallback = F.from_json(F.lit(json.dumps(other.asDict(recursive=True))), CFG_TYPE)
    return rows.join(F.broadcast(known), "source_id", "left").withColumn("cfg", F.coalesce("__cfg", fallback)).drop("__cfg")


@dataclass(frozen=True)
class Lookups:
    """Providers of the three lookups and the (overlay, baseline) layers of their caches."""

    rdap: L.Provider
    dns: L.Provider
    geo: L.Provider
    root_cache: Layers = NO_LAYERS
    dns_cache: Layers = NO_LAYERS
    geo_cache: Layers = NO_LAYERS
    #: Registry servers by suffix (see ``suffixes.bootstrap_services``), for roots that no plan names.
    services: DataFrame | None = None


def conflict_errors(entries: DataFrame, outs: DataFrame, adds: DataFrame, sources: Mapping[str, SourceSettings]) -> list[str]:
    """Texts naming the first host whose sources must agree and do not, for each kind of conflict.

    Hosts taken out by hand are not asked about; those added by hand need the same registry settings only.
    """
    if len({s.execution_profile for s in sources.values()}) < 2:  # all sources agree
        return []
    spark = entries.sparkSession
    profiles = spark.createDataFrame([(n, s.execution_profile, s.rdap_profile) for n, s in sources.items()], "source_id string, execution string, registry string")
    rows = entries.select("host", "source_id", "source_index", "line_index").join(outs.select("host"), "host", "left_anti").join(F.broadcast(profiles), "source_id")
    by_hand = adds.select("host").distinct()
    kinds = (
        (rows.join(by_hand, "host", "left_anti"), "execution", "different runtime behaviour"),
        (rows.join(by_hand, "host", "left_semi"), "registry", "different registry behaviour while it is added by hand"),
    )
    found = []
    for own, profile, text in kinds:
        first = P.profile_conflicts(own, "host", profile).orderBy("host").limit(1).collect()
        found += [f"{r['host']} is in sources of {text}: {r['first_source']} and {r['second_source']}" for r in first]
    return found


def override_errors(passes: DataFrame, adds: DataFrame, sources: Mapping[str, SourceSettings]) -> list[str]:
    """What the override lists demand of the configuration as a whole, and names that cannot be added by hand."""
    found, on = [], list(sources.values())
    suffix = adds.filter("is_public_suffix_input").agg(F.min("host")).first()[0]
    if suffix is not None:
        found.append(f"manual_add names the public suffix {suffix}")
    if on and len({s.dns_enabled for s in on} | {True}) > 1 and not passes.isEmpty():
        found.append("manual_filter_pass needs dns.enabled in all sources")
    if len({s.rdap_profile for s in on}) > 1 and not adds.isEmpty():
        found.append("manual_add needs the same rdap settings in all sources")
    return found


def prepared(
    lines: DataFrame, overrides: Mapping[str, DataFrame], rules: DataFrame, formats: Mapping[str, str] = {}, sources: Mapping[str, SourceSettings] = {},
) -> tuple[DataFrame, DataFrame]:
    """(entries to screen, rows that end in preparation) of raw source lines and the lines of the three override lists.

    ``formats`` holds the sources whose format is given; the others are told by their lines.
    ``sources`` holds the settings whose conflicts are errors.
    """
    free = lines.filter(~F.col("source_id").isin(list(formats))) if formats else lines
    entries = P.parse_lines(free, rules)
    for form in sorted(set(formats.values())):
        own = [s for s, f in formats.items() if f == form]
        entries = entries.unionByName(P.parse_lines(lines.filter(F.col("source_id").isin(own)), rules, form))
    passes, outs, adds = (P.parse_lines(overrides[k], rules, "plain") for k in ("manual_filter_pass", "manual_filter_out", "manual_add"))
    P.checked(P.overlap_errors(passes, outs, adds) + override_errors(passes, adds, sources))
    P.checked(conflict_errors(entries, outs, adds, sources))
    kept, removed, unmatched = P.apply_overrides(entries, passes, outs, adds)
    return kept, preparation_rows(removed, unmatched)


def preparation_rows(removed: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Terminal rows of hosts taken out by hand and of override hosts that no source has."""
    names = F.concat(F.regexp_replace("classification", "_not_in_sources$", ""), F.lit("_unmatched"))
    absent = unmatched.select(
        names.alias("source_id"), names.alias("source_input_label"), F.array(names).alias("source_ids"), F.array(names).alias("source_input_labels"),
        F.col("host").alias("input_name"), "host", F.col("host").alias("registrable_domain"), F.lit("").alias("public_suffix"),
        F.lit(False).alias("is_public_suffix_input"), F.lit("exact_host").alias("input_kind"), F.lit("exact_only").alias("apex_scope"),
        F.lit("plain").alias("source_format"), "classification", F.col("classification").alias("why"),
    )
    out = removed.withColumns({"classification": F.lit(V.FILTER_OUT), "why": F.lit(V.FILTER_OUT)}).select(absent.columns).unionByName(absent)
    none = F.array().cast("array<string>")
    return out.select(
        *V.IDENTITY_COLUMNS, "classification", F.lit("unavailable").alias("rdap_registration_status"), F.lit("skipped").alias("dns_status"),
        F.lit("").alias("canonical_name"), none.alias("resolved_ips"), F.lit("skipped").alias("geo_status"), F.col("why").alias("geo_reason"),
        F.lit("skipped").alias("geo_policy_status"), F.col("why").alias("geo_policy_reason"), F.lit("").alias("geo_provider"),
        none.alias("geo_countries"), none.alias("geo_region_codes"), none.alias("geo_region_names"), F.lit("review").alias("route"),
    )


def registry_answers(roots: DataFrame, plan: DataFrame | None, lookups: Lookups, settings: Settings, now: Column, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """(registrable_domain, rdap, rdap_source; rows for the root cache).

    A root whose server the plan calls unavailable is not asked at all.  A cached verdict
    holds, but for a registered root whose statuses are not complete, which is asked again.
    The cache keeps roots under ``domain``, as its files do.
    """
    on = ["registrable_domain"]
    layers = [None if c is None else c.withColumnRenamed("domain", "registrable_domain") for c in lookups.root_cache]
    if plan is None:
        served = lookups.services is not None
        asked = with_server(roots, lookups.services) if served else roots.withColumn("authoritative_base_url", F.lit(None).cast("string"))
        bypassed = None
    else:
        planned = roots.join(plan.select(*on, "status", "authoritative_base_url"), on, "left")
        off = F.coalesce(F.col("status") == "unavailable", F.lit(False))
        asked, bypassed = planned.filter(~off).drop("status"), planned.filter(off).select(*on)
    cached = C.layered(asked, *layers, on, now)
    verdict = F.struct(F.col("exists"), F.col("statuses"))
    if all(c is None for c in layers):
        again, out = cached, None
    else:
        again = cached.filter(C.needs_refresh(cached))
        held = cached.filter(~C.needs_refresh(cached)).select(*on, "hit.classification", "hit.statuses", "hit_source")
        held = held.withColumns({
            "exists": F.when(F.col("classification") == V.REGISTERED, True).when(F.col("classification") == V.UNREGISTERED, False),
            "statuses": F.when(F.col("classification") == V.REGISTERED, F.col("statuses")).otherwise(F.array().cast("array<string>")),
        })
        out = held.select(*on, F.when(F.col("exists").isNotNull(), verdict).alias("rdap"), F.col("hit_source").alias("rdap_source"))
    live = keep(lookups.rdap(again.select(*on, "authoritative_base_url")).select(*on, "exists", "statuses", "cacheable"), "rdap")
    fresh = live.select(*on, F.when(F.col("exists").isNotNull(), verdict).alias("rdap"), F.lit("live").alias("rdap_source"))
    out = fresh if out is None else out.unionByName(fresh)
    if bypassed is not None:
        out = out.unionByName(bypassed.select(*on, F.lit(None).cast(out.schema["rdap"].dataType).alias("rdap"), F.lit("prepared").alias("rdap_source")))
    klass = F.when(F.col("exists").isNull(), V.UNAVAILABLE).when(F.col("exists"), V.REGISTERED).otherwise(V.UNREGISTERED)
    writes = live.filter("exists IS NOT NULL OR cacheable").select(
        F.col("registrable_domain").alias("domain"), klass.alias("classification"), "statuses", F.col("exists").isNotNull().alias("statuses_complete")
    )
    days = C.root_ttl(F.col("classification"), settings.registered_days, settings.unregistered_days, settings.unavailable_days)
    return out, C.stamped(writes, now, days)


DNS_FIELDS = ["a_exists", "a_nodata", "a_nxdomain", "a_timeout", "a_servfail", "canonical_name", "ipv4_addresses", "ipv6_addresses"]


def dns_answers(hosts: DataFrame, lookups: Lookups, settings: Settings, now: Column, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """(host, resolver_key, dns; rows for the DNS cache) of hosts and their resolver keys.  Every answer is cached, timeouts included."""
    answers, live = L.looked_up(
        hosts, ["host", "resolver_key"], now, lambda df: lookups.dns(df).select("host", "resolver_key", *DNS_FIELDS), *lookups.dns_cache, lambda df: keep(df, "dns")
    )
    return answers.select("host", "resolver_key", F.struct(*DNS_FIELDS).alias("dns")), C.stamped(live, now, F.lit(settings.dns_days))


GEO_FIELDS = ["country_code", "region_code", "region_name", "status"]


def geo_answers(hosts: DataFrame, lookups: Lookups, now: Column, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """(provider, ip and its answer; rows for the geo cache) of the distinct addresses of (resolved_ips, provider, geo_days).

    Only usable answers are cached, for the shortest time that a source which asked allows.
    """
    keys = keep(hosts.select("provider", "geo_days", F.explode("resolved_ips").alias("ip")).groupBy("provider", "ip").agg(F.min("geo_days").alias("geo_days")), "geo-keys")
    # A cached row has no status of its own.
    layers = [None if c is None else c.withColumn("status", F.lit("cache_hit")) for c in lookups.geo_cache]
    answers, live = L.looked_up(
        keys, ["provider", "ip"], now, lambda df: lookups.geo(df).select("provider", "ip", *GEO_FIELDS), *layers, lambda df: keep(df, "geo")
    )
    writes = C.stamped(live.filter(F.col("status") == "ok").drop("status").join(keys, ["provider", "ip"]), now, F.col("geo_days")).drop("geo_days")
    return answers.select("provider", "ip", *GEO_FIELDS), writes


def screened(
    entries: DataFrame, lookups: Lookups, settings: Settings, now: Column, plan: DataFrame | None = None, keep: Keep = lambda df, name: df,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(terminal rows of prepared entries, new rows of the caches ``root``, ``dns`` and ``geo``).

    ``keep`` writes a table and reads it again; live answers pass through it, so that no
    provider is asked twice, and so does what one stage leaves for the next.  Resolver, geo
    provider, policy and geo lifetime are each row's own.
    """
    rows = with_settings(entries, settings).withColumns({"dns_enabled": F.col("cfg.dns_enabled"), "geo_enabled": F.col("cfg.geo_enabled")})
    roots = rows.filter(~F.col("is_public_suffix_input")).select("registrable_domain").distinct()
    rdap, root_rows = registry_answers(roots, plan, lookups, settings, now, keep)
    rows = keep(R.before_dns(rows.join(rdap.drop("rdap_source"), "registrable_domain", "left")), "after-rdap")
    asked = rows.filter("early_class IS NULL").select("host", F.col("cfg.resolver_key").alias("resolver_key"))
    dns, dns_rows = dns_answers(asked, lookups, settings, now, keep)
    rows = rows.withColumn("resolver_key", F.col("cfg.resolver_key")).join(dns, ["host", "resolver_key"], "left").drop("resolver_key")
    rows = keep(R.classified(rows, list(settings.hold), list(settings.deletion)), "after-dns")
    asked = rows.filter("geo_reason IS NULL").select("host", "resolved_ips", F.col("cfg.geo_provider").alias("provider"), F.col("cfg.geo_days").alias("geo_days"))
    geo, geo_rows = geo_answers(asked, lookups, now, keep)
    rows = rows.join(L.rejoined(asked.drop("geo_days"), geo, "host", "resolved_ips", also=("provider",)), "host", "left")
    return R.terminal_rows(R.with_geo(rows, F.col("cfg.policy")), F.col("cfg.geo_provider")), {"root": root_rows, "dns": dns_rows, "geo": geo_rows}


def screened_within(entries: DataFrame, seconds: float, parts: int, screen: Callable[[DataFrame, int], None], clock: Callable[[], float] = time.monotonic) -> bool:
    """Screens the entries in ``parts`` parts by root until the time is used up; true if all parts were done.

    The budget is looked at before each part, so a part that has begun is finished.
    """
    began = clock()
    for k in range(parts):
        if clock() - began >= seconds:
            return False
        screen(entries.filter(F.pmod(F.xxhash64("registrable_domain"), F.lit(parts)) == k), k)
    return True


def screened_in_parts(
    spark: SparkSession, folder: str, entries: DataFrame, parts: int, screen: Callable[[DataFrame, int], DataFrame], seconds: float = float("inf"),
    clock: Callable[[], float] = time.monotonic,
) -> tuple[DataFrame | None, list[int]]:
    """(rows of the parts that are done, parts that are left), resumable: a part's rows are in ``folder`` and a small file says that they are whole.

    Parts are dealt by root, so hosts of a root share its answer.  A run that is started
    again on the folder leaves done parts as they are; a part that was cut off is made again.
    The entries and ``parts`` must be those of the first start, which are kept beside them.
    """
    frozen = f"{folder}/entries"
    if read_text(spark, f"{folder}/entries.json") is None:
        entries.withColumn("__part", F.pmod(F.xxhash64("registrable_domain"), F.lit(parts)).cast("int")).write.mode("overwrite").parquet(frozen)
        switch_pointer(spark, f"{folder}/entries.json", json.dumps({"parts": parts}))
    if json.loads(read_text(spark, f"{folder}/entries.json"))["parts"] != parts:
        raise ValueError(f"{folder} was begun with another number of parts")
    began, held = clock(), spark.read.parquet(frozen)
    mark = lambda k: f"{folder}/done/{k}.json"
    left = [k for k in range(parts) if read_text(spark, mark(k)) is None]
    while left and clock() - began < seconds:
        k = left[0]
        screen(held.filter(F.col("__part") == k).drop("__part"), k).write.mode("overwrite").parquet(f"{folder}/rows/{k}")
        switch_pointer(spark, mark(k), json.dumps({"part": k}))
        left = left[1:]
    done = [f"{folder}/rows/{k}" for k in range(parts) if k not in left]
    return (spark.read.parquet(*done) if done else None), left
