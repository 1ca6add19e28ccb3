"""Queries of caches in buckets, runs by source, repeated runs, bulk requests and the line scan, and SQL that gives the same rows.

What is written on the way is derived from the test tables and goes to the shared folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import batch as B
from ..operators import buckets as U
from ..operators import cache as C
from ..operators import lookup as L
from ..operators import prepare as P
from ..operators import run as R
from ..operators import sinks as K
from ..operators import suffixes as S
from ..operators.csvfile import write_csv_file
from ..operators.scratch import kept, shared_folder
from ..sources import lists
from .catalog import _t, query

_BUCKET_SQL = "('0x' || substr(md5({}), 1, 8))::BIGINT % 32"


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _cache_writes(spark, sf) -> tuple[str, list[dict]]:
    """Three writes: all customers; every 50th with its order total; one."""
    path = _folder(spark, "buckets")
    rows = _t(spark, sf, "customer").select(F.concat(F.lit("r"), F.col("c_custkey").cast("string")).alias("domain"), F.col("c_nationkey").cast("long").alias("value"), F.lit(1).alias("writer"))
    changed = rows.filter(F.substring("domain", 2, 20).cast("long") % 50 == 0).withColumns({"value": -F.col("value"), "writer": F.lit(2)})
    one = rows.filter("domain = 'r7'").withColumns({"value": F.lit(700).cast("long"), "writer": F.lit(3)})
    return path, [U.write(new, path, ["domain"], buckets=32) for new in (rows, changed, one)]


@query("""
    SELECT 'r' || c_custkey AS domain, CASE WHEN c_custkey = 7 THEN 700 WHEN c_custkey % 50 = 0 THEN -c_nationkey ELSE c_nationkey END AS value,
           CASE WHEN c_custkey = 7 THEN 3 WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END AS writer
    FROM customer
""")
def bucket_rows(spark, sf):
    return U.read(spark, _cache_writes(spark, sf)[0])


@query(f"""
    WITH b AS (SELECT c_custkey AS k, {_BUCKET_SQL.format("'r' || c_custkey")} AS b FROM customer),
    w AS (SELECT 1 AS number, b FROM b UNION SELECT 2, b FROM b WHERE k % 50 = 0 UNION SELECT 3, b FROM b WHERE k = 7)
    SELECT number, count(*) AS buckets, (SELECT count(*) FROM b WHERE b.b IN (SELECT w2.b FROM w w2 WHERE w2.number = w.number)) AS rewritten FROM w GROUP BY number
""")
def bucket_commits(spark, sf):
    """Buckets that each write wrote anew, and the rows in them."""
    path, commits = _cache_writes(spark, sf)
    in_bucket = U.read(spark, path).groupBy(U.bucket_of(["domain"], 32).alias("b")).agg(F.count("*").alias("n"))
    named = spark.createDataFrame([(c["number"], c["rewritten"]) for c in commits], "number int, b array<int>").select("number", F.explode("b").alias("b"))
    return named.join(in_bucket, "b").groupBy("number").agg(F.count("*").alias("buckets"), F.sum("n").alias("rewritten"))


@query(f"""
    WITH b AS (SELECT c_custkey AS k, {_BUCKET_SQL.format("'r' || c_custkey")} AS b FROM customer)
    SELECT 'r' || k AS domain FROM b WHERE b IN (SELECT b FROM b WHERE k IN (3, 8))
""")
def bucket_lookup(spark, sf):
    """Rows that a look-up of two keys reads: those of their buckets."""
    path, _ = _cache_writes(spark, sf)
    return U.read(spark, path, spark.createDataFrame([("r3",), ("r8",)], "domain string")).select("domain")


# Bulk requests: addresses of suppliers at two services.  A service leaves every 5th address out, has no country for every
# 7th, fails each request of 3 modulo 4 addresses at first, and never answers requests that hold no even address.
def fixture_service():
    failed: set = set()

    def client(provider: str, ips: list[str]) -> tuple[int, str, float | None]:
        numbers = [int(ip.rpartition(".")[2]) for ip in ips]
        if provider == "geojs" and ips[0] not in failed and numbers[0] % 2:
            failed.add(ips[0])
            return 503, "", None
        told = [(ip, "" if n % 7 == 0 else "cn ") for ip, n in zip(ips, numbers, strict=True) if n % 5]
        if provider == "geojs":
            return 200, json.dumps([{"ip": ip, "country_code": code, "region": f" R{code}"} for ip, code in told]), None
        return 200, json.dumps({ip: {"country_code": code} for ip, code in told}), None

    return client


_SIZES = {"geojs": 10, "ipinfo_lite": 25}


def _addresses(spark, sf) -> DataFrame:
    k = F.col("l_suppkey")
    provider = F.when(F.col("l_orderkey") % 3 == 0, "geojs").otherwise("ipinfo_lite")
    return _t(spark, sf, "lineitem").select(provider.alias("provider"), F.concat(F.lit("10.0.0."), k.cast("string")).alias("ip")).distinct()


_ADDRESS_SQL = "a AS (SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN 'geojs' ELSE 'ipinfo_lite' END AS provider, '10.0.0.' || l_suppkey AS ip, l_suppkey AS k FROM lineitem)"


@query(f"""
    WITH {_ADDRESS_SQL} SELECT provider, ip, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN '' ELSE 'CN' END AS country_code,
        CASE WHEN provider <> 'geojs' OR k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'R' ELSE 'Rcn' END AS region_name, CASE WHEN k % 5 = 0 THEN 'invalid_payload' ELSE 'ok' END AS status FROM a
""")
def geo_bulk(spark, sf):
    provider = L.bulk_geo(fixture_service, kept(spark, "geo"), sizes=_SIZES)
    return provider(_addresses(spark, sf)).select("provider", "ip", "country_code", "region_name", "status")


@query(f"""
    WITH {_ADDRESS_SQL},
    n AS (SELECT *, (row_number() OVER (PARTITION BY provider ORDER BY ip) - 1) // CASE provider WHEN 'geojs' THEN 10 ELSE 25 END AS chunk FROM a),
    r AS (SELECT provider, chunk, count(*) AS ips, arg_min(k, ip) AS first FROM n GROUP BY ALL)
    SELECT provider, count(*) AS requests, sum(ips)::BIGINT AS addresses, sum(CASE WHEN provider = 'geojs' AND first % 2 = 1 THEN 2 ELSE 1 END)::BIGINT AS calls FROM r GROUP BY provider
""")
def geo_requests(spark, sf):
    """Requests made of each service, addresses in them and calls with repetitions."""
    keep = kept(spark, "requests")
    asked = keep(L.bulk_asked(L.bulk_requests(_addresses(spark, sf), keep, _SIZES), fixture_service), "asked")
    return asked.groupBy("provider").agg(F.count("*").alias("requests"), F.sum(F.size("ips")).alias("addresses"), F.sum("tries").alias("calls"))


@query("""
    SELECT 'r' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.co.uk' ELSE '.nowhere' END AS registrable_domain,
           CASE c_custkey % 3 WHEN 0 THEN 'https://com.example/' WHEN 1 THEN 'https://old.example/' END AS asked FROM customer
""")
def registry_servers_asked(spark, sf):
    """The server that each root's live registry question goes to, without a plan: by the longest suffix of the bootstrap document."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("r"), k.cast("string"), F.when(k % 3 == 0, ".com").when(k % 3 == 1, ".co.uk").otherwise(".nowhere"))
    body = json.dumps({"services": [[["com"], ["https://com.example/"]], [["uk"], ["https://uk.example/"]], [["co.uk"], ["https://old.example/"]]]})
    path = _folder(spark, "bootstrap") + ".json"
    services = S.cached_services(spark, path, lambda: ({"Cache-Control": "max-age=60"}, body), 0.0)
    rdap = lambda keys: keys.select("registrable_domain", F.lit(True).alias("exists"), F.array("authoritative_base_url").alias("statuses"), F.lit(True).alias("cacheable"))
    lookups = R.Lookups(rdap, None, None, services=services)
    now = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    found, _ = R.registry_answers(_t(spark, sf, "customer").select(name.alias("registrable_domain")), None, lookups, R.Settings(), now, kept(spark, "servers"))
    return found.select("registrable_domain", F.col("rdap.statuses")[0].alias("asked"))


# Runs by source: three sources with two resolvers, two geo services and three policies.
def _entries(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    host = F.concat(F.lit("h"), k.cast("string"), F.lit(".com"))
    return _t(spark, sf, "customer").select(
        host.alias("host"), host.alias("registrable_domain"), F.lit("com").alias("public_suffix"), F.lit(False).alias("is_public_suffix_input"), F.lit("exact_host").alias("input_kind"),
        F.lit("exact_only").alias("apex_scope"), F.lit("plain").alias("source_format"), F.lit("").alias("input_name"), F.when(k % 4 < 3, F.concat(F.lit("s"), (k % 4).cast("string"))).alias("source_id"),
        F.lit("list").alias("source_input_label"), F.array(F.lit("s")).alias("source_ids"), F.array(F.lit("list")).alias("source_input_labels"), F.lit(False).alias("manual_filter_pass"), F.lit(False).alias("manual_add"),
    )


_FAR, _NEAR = "9.9.9.9|ecs=off", "system|ecs=off"
_SETTINGS = R.Settings(
    {
        "s0": R.SourceSettings(resolver_key=_FAR, geo_provider="geojs", geo_days=3, policy=G.Policy(True, "all_ips", G.Rules([], [], ["r1"]))),
        "s1": R.SourceSettings(resolver_key=_NEAR, geo_provider="ipinfo_lite", geo_days=5, policy=G.Policy(True, "any_ip", G.Rules(["C1", "C2"]), G.Rules(["C2"]))),
        "s2": R.SourceSettings(resolver_key=_FAR, geo_provider="ipinfo_lite", geo_days=2),
    },
    R.SourceSettings(geo_enabled=False), dns_days=2,
)


def region_service():
    """Country C<n mod 3>, region r<n mod 3>; every 11th address is left out."""

    def client(provider: str, ips: list[str]) -> tuple[int, str, float | None]:
        told = [(ip, int(ip.rpartition(".")[2])) for ip in ips]
        told = [(ip, n % 3) for ip, n in told if n % 11]
        if provider == "geojs":
            return 200, json.dumps([{"ip": ip, "country_code": f"C{n}", "region": f"r{n}"} for ip, n in told]), None
        return 200, json.dumps({ip: {"country_code": f"C{n}"} for ip, n in told}), None

    return client


def _first_lookups(spark, keep) -> R.Lookups:
    number = F.regexp_extract("host", r"(\d+)", 1).cast("long")
    flags = [F.lit(True).alias("a_exists"), *[F.lit(False).alias(c) for c in ("a_nodata", "a_nxdomain", "a_timeout", "a_servfail")], F.lit(None).cast("string").alias("canonical_name")]
    base = F.when(F.col("resolver_key") == _FAR, number % 60).otherwise(number % 60 + 60)
    address = lambda n: F.concat(F.lit("10.0.0."), n.cast("string"))
    dns = lambda keys: keys.select("host", "resolver_key", *flags, F.array(address(base), address(base + 1)).alias("ipv4_addresses"), F.array().cast("array<string>").alias("ipv6_addresses"))
    gone = F.regexp_extract("registrable_domain", r"(\d+)", 1).cast("long") % 10 == 3
    rdap = lambda keys: keys.select("registrable_domain", (~gone).alias("exists"), F.array().cast("array<string>").alias("statuses"), F.lit(True).alias("cacheable"))
    return R.Lookups(rdap, dns, L.bulk_geo(region_service, keep))


def _first_run(spark, sf, keep):
    return R.screened(_entries(spark, sf), _first_lookups(spark, keep), _SETTINGS, F.to_timestamp(F.lit("2024-03-01 00:00:00")), keep=keep)


_BY_SOURCE_SQL = """
    k AS (SELECT c_custkey AS k, 'h' || c_custkey || '.com' AS host, c_custkey % 4 AS s, c_custkey % 60 + CASE WHEN c_custkey % 4 IN (0, 2) THEN 0 ELSE 60 END AS n FROM customer),
    r AS (SELECT *, n % 11 <> 0 AS ok1, (n + 1) % 11 <> 0 AS ok2, n % 3 AS r1, (n + 1) % 3 AS r2 FROM k),
    c AS (SELECT *, CASE WHEN k % 10 = 3 THEN 'rdap_registrable_domain_unregistered' WHEN s = 3 OR s = 2 THEN 'dns_resolves'
                    WHEN s = 0 THEN CASE WHEN (r1 = 1 OR NOT ok1) AND (r2 = 1 OR NOT ok2) THEN 'dns_resolves' ELSE 'geo_policy_rejected' END
                    ELSE CASE WHEN (ok1 AND r1 = 1) OR (ok2 AND r2 = 1) THEN 'dns_resolves' ELSE 'geo_policy_rejected' END END AS classification,
                 CASE WHEN k % 10 = 3 OR s = 3 THEN '' WHEN s = 0 THEN 'geojs' ELSE 'ipinfo_lite' END AS geo_provider FROM r)"""


@query(f"WITH {_BY_SOURCE_SQL} SELECT host, classification, geo_provider, CASE WHEN k % 10 = 3 THEN '' ELSE '10.0.0.' || n || ',10.0.0.' || n + 1 END AS ips FROM c")
def run_by_source(spark, sf):
    rows, _ = _first_run(spark, sf, kept(spark, "by-source"))
    return rows.select("host", "classification", "geo_provider", F.array_join("resolved_ips", ",").alias("ips"))


@query(f"""
    WITH {_BY_SOURCE_SQL},
    t AS (SELECT s, unnest([n, n + 1]) AS n FROM c WHERE geo_provider <> '')
    SELECT CASE s WHEN 0 THEN 'geojs' ELSE 'ipinfo_lite' END AS provider, '10.0.0.' || n AS ip, min(CASE s WHEN 0 THEN 3 WHEN 1 THEN 5 ELSE 2 END)::INTEGER AS days FROM t WHERE n % 11 <> 0 GROUP BY ALL
""")
def run_geo_lifetimes(spark, sf):
    rows = _first_run(spark, sf, kept(spark, "lifetimes"))[1]["geo"]
    return rows.select("provider", "ip", F.datediff("expires_at", "checked_at").alias("days"))


@query(f"""
    WITH {_BY_SOURCE_SQL},
    d AS (SELECT *, CASE WHEN s = 0 THEN NOT ok1 OR NOT ok2 WHEN s = 1 THEN NOT ok1 OR NOT ok2 ELSE false END AS asks_again FROM c)
    SELECT host, CASE WHEN classification <> 'geo_policy_rejected' AND classification <> 'dns_resolves' THEN classification WHEN s >= 2 THEN classification
        WHEN s = 0 AND asks_again THEN 'geo_policy_rejected' ELSE classification END AS classification FROM d
""")
def run_again(spark, sf):
    """Classes of a second run an hour later on the caches that the first wrote.

    Its providers answer otherwise (no root is registered, no host resolves, every address is
    in XX), so what the caches hold is told from what is asked again: the addresses that had
    no usable answer.
    """
    keep = kept(spark, "again")
    _, made = _first_run(spark, sf, keep)
    root = _folder(spark, "caches")
    paths = {k: f"{root}/{k}" for k in made}
    K.write_caches(spark, paths, made)
    none = F.array().cast("array<string>")
    rdap = lambda keys: keys.select("registrable_domain", F.lit(False).alias("exists"), none.alias("statuses"), F.lit(True).alias("cacheable"))
    dns = lambda keys: keys.select("host", "resolver_key", *[F.lit(False).alias(c) for c in R.DNS_FIELDS[:5]], F.lit(None).cast("string").alias("canonical_name"), none.alias("ipv4_addresses"), none.alias("ipv6_addresses"))
    geo = lambda keys: keys.select("provider", "ip", F.lit("XX").alias("country_code"), F.lit("").alias("region_code"), F.lit("x").alias("region_name"), F.lit("ok").alias("status"))
    layer = lambda name: (U.read(spark, paths[name]), None)
    lookups = R.Lookups(rdap, dns, geo, layer("root"), layer("dns"), layer("geo"))
    rows, _ = R.screened(_entries(spark, sf), lookups, _SETTINGS, F.to_timestamp(F.lit("2024-03-01 01:00:00")), keep=keep)
    return rows.select("host", "classification")


@query("""
    SELECT CASE c_custkey % 2 WHEN 0 THEN 'overlay' ELSE 'baseline' END AS hit_source, count(*) AS n FROM customer WHERE c_custkey % 10 <> 3 AND c_custkey % 4 < 3 GROUP BY 1
    UNION ALL SELECT NULL, count(*) FROM customer WHERE c_custkey % 10 = 3 AND c_custkey % 4 < 3
""")
def dns_cache_hits(spark, sf):
    """Hosts by the layer of the DNS cache that answers for host and resolver key; stale rows and rows of other resolvers do not."""
    now = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    k = F.regexp_extract("host", r"(\d+)", 1).cast("long")
    hosts = _entries(spark, sf).filter("source_id IS NOT NULL").select("host", F.lit(_NEAR).alias("resolver_key"))
    end = F.when(k % 10 == 3, "2024-02-29 00:00:00").otherwise("2024-03-02 00:00:00").cast("timestamp")
    rows = hosts.select("host", "resolver_key", F.lit(True).alias("a_exists"), end.alias("expires_at"))
    found = C.layered(hosts, rows.filter(k % 2 == 0), rows.unionByName(rows.withColumn("resolver_key", F.lit(_FAR))), ["host", "resolver_key"], now)
    return found.groupBy("hit_source").agg(F.count("*").alias("n"))


@query(r"""
    WITH l AS (SELECT c_custkey AS k, unnest(CASE WHEN c_custkey % 9 = 0 THEN ['v' || c_custkey, 'w'] WHEN c_custkey % 9 = 1 THEN ['', 'x' || c_custkey] ELSE ['l' || c_custkey] END) AS raw_line,
                      unnest(CASE WHEN c_custkey % 9 < 2 THEN [0, 1] ELSE [0] END) AS part FROM customer)
    SELECT (row_number() OVER (ORDER BY k, part) - 1)::INTEGER AS line_index, raw_line FROM l
""")
def scanned_lines(spark, sf):
    """Lines of files that hold a row for each customer, some with other breaks inside, read back with their numbers."""
    folder = _folder(spark, "lists")
    k = F.col("c_custkey")
    row = F.when(k % 9 == 0, F.concat(F.lit("v"), k.cast("string"), F.lit("\x0bw"))).when(k % 9 == 1, F.concat(F.lit("\rx"), k.cast("string"), F.lit("\r"))).otherwise(F.concat(F.lit("l"), k.cast("string")))
    _t(spark, sf, "customer").repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey").select(row.alias("value")).write.text(folder)
    return lists.text_lines(spark, lists.matching_paths(spark, f"{folder}/part-*"), "s").select("line_index", "raw_line")


@query(f"""
    WITH {_BY_SOURCE_SQL},
    g AS (SELECT *, CASE WHEN geo_provider = '' THEN NULL WHEN s = 0 THEN (r1 = 1 OR NOT ok1) AND (r2 = 1 OR NOT ok2) WHEN s = 1 THEN (ok1 AND r1 = 1) OR (ok2 AND r2 = 1) END AS fine,
                 k % 10 = 3 AS dead FROM c),
    t AS (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN ok1 THEN r1 END, CASE WHEN ok2 THEN r2 END], lambda x: x IS NOT NULL))) AS seen FROM g)
    SELECT host, coalesce(CASE WHEN s < 3 THEN 's' || s END, '') AS source_id, 'list' AS source_input_label, 's' AS source_ids, 'list' AS source_input_labels, host AS input_name, host AS registrable_domain, 'com' AS public_suffix,
           false AS is_public_suffix_input, 'exact_host' AS input_kind, 'exact_only' AS apex_scope, 'plain' AS source_format, classification,
           CASE WHEN dead THEN 'unregistered' ELSE 'registered' END AS rdap_registration_status, CASE WHEN dead THEN 'skipped' ELSE 'noerror' END AS dns_status, '' AS canonical_name,
           CASE WHEN dead THEN '' ELSE '10.0.0.' || n || ',10.0.0.' || n + 1 END AS resolved_ips,
           CASE WHEN dead OR s = 3 THEN 'skipped' ELSE 'ok' END AS geo_status, CASE WHEN dead THEN 'dead_root' WHEN s = 3 THEN 'geo_disabled' ELSE 'lookup_succeeded' END AS geo_reason,
           CASE WHEN dead OR s >= 2 THEN 'skipped' WHEN fine THEN 'accepted' ELSE 'rejected' END AS geo_policy_status,
           CASE WHEN dead THEN 'dead_root' WHEN s = 3 THEN 'geo_disabled' WHEN s = 2 THEN 'policy_disabled' WHEN s = 0 THEN CASE WHEN fine THEN 'all_ips_matched' ELSE 'one_or_more_ips_rejected' END
                WHEN fine THEN 'at_least_one_ip_matched' ELSE 'no_ips_matched' END AS geo_policy_reason,
           geo_provider, CASE WHEN geo_provider = '' THEN '' ELSE array_to_string(list_transform(seen, lambda x: 'C' || x), ',') END AS geo_countries, '' AS geo_region_codes,
           CASE WHEN s = 0 AND NOT dead THEN array_to_string(list_transform(seen, lambda x: 'r' || x), ',') ELSE '' END AS geo_region_names,
           CASE WHEN dead THEN 'dead' WHEN classification = 'dns_resolves' THEN 'filtered' ELSE 'review' END AS route
    FROM t
""")
def run_terminal_rows(spark, sf):
    """Terminal rows with all their columns; lists joined by commas."""
    rows, _ = _first_run(spark, sf, kept(spark, "terminal"))
    return rows.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])


@query("""
    SELECT c_custkey AS k, row_number() OVER (ORDER BY c_nationkey, c_mktsegment, c_custkey % 100, 'h' || c_custkey) - 1 AS place FROM customer
""")
def entry_places(spark, sf):
    """Places of entries in the order of sources and lines."""
    k = F.col("c_custkey")
    rows = _t(spark, sf, "customer").select(
        k.alias("k"), F.col("c_nationkey").alias("source_index"), F.col("c_mktsegment").alias("source_id"), (k % 100).alias("line_index"), F.concat(F.lit("h"), k.cast("string")).alias("host")
    )
    return P.with_source_places(rows, kept(spark, "entries")).select("k", "place")


@query("""
    SELECT n_nationkey AS nation, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_nationkey = n_nationkey) = (SELECT count(DISTINCT c_mktsegment) FROM customer) AS whole FROM nation WHERE n_nationkey < 3
""")
def member_equality(spark, sf):
    """Whether a nation's segments are all segments."""
    rows = _t(spark, sf, "customer")
    found = [(k, B.same_members(rows.filter(F.col("c_nationkey") == k), rows, "c_mktsegment")) for k in range(3)]
    return spark.createDataFrame(found, "nation long, whole boolean").withColumn("nation", F.col("nation").cast(_t(spark, sf, "nation").schema["n_nationkey"].dataType))


_NOTE_SQL = "CASE c_custkey % 4 WHEN 0 THEN 'says \"' || c_name || '\"' WHEN 1 THEN 'a,b' WHEN 2 THEN NULL ELSE 'two' || chr(10) || 'lines' END"


@query(f"""
    WITH r AS (SELECT 'h' || c_custkey AS host, {_NOTE_SQL} AS note FROM customer),
    l AS (SELECT host, host || ',' || CASE WHEN note IS NULL THEN '' WHEN regexp_matches(note, '[",\r\n]') THEN '"' || replace(note, '"', '""') || '"' ELSE note END || chr(13) || chr(10) AS line FROM r),
    t AS (SELECT 'host,note' || chr(13) || chr(10) || string_agg(line, '' ORDER BY host) || (SELECT string_agg(line, '' ORDER BY host) FROM l WHERE host LIKE 'h1%') AS text FROM l)
    SELECT strlen(text)::BIGINT AS bytes, sha256(text) AS sha256 FROM t
""")
def review_bytes(spark, sf):
    """Length and digest of one CSV file: all rows, and then some of them appended."""
    k = F.col("c_custkey")
    note = F.when(k % 4 == 0, F.concat(F.lit('says "'), "c_name", F.lit('"'))).when(k % 4 == 1, "a,b").when(k % 4 == 3, "two\nlines")
    rows = _t(spark, sf, "customer").select(F.concat(F.lit("h"), k.cast("string")).alias("host"), note.alias("note"))
    path = _folder(spark, "review") + ".csv"
    write_csv_file(rows, path, ["host"])
    write_csv_file(rows.filter("host LIKE 'h1%'"), path, ["host"], append=True)
    content = spark.read.format("binaryFile").load(path)
    return content.select(F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


@query(f"""
    WITH {_BY_SOURCE_SQL} SELECT 'h' || k || '.com' AS host, classification, false AS asked_again FROM c
""")
def run_resumed(spark, sf):
    """Classes of a run that stops for want of time and is started again: parts that were done are not screened twice."""
    keep = kept(spark, "resumed")
    folder, screened = _folder(spark, "parts"), []
    clock = iter([0.0, 1.0, 2.0, 9.0]).__next__

    def screen(part: DataFrame, k: int) -> DataFrame:
        screened.append(k)
        rows, _ = R.screened(part, _first_lookups(spark, keep), _SETTINGS, F.to_timestamp(F.lit("2024-03-01 00:00:00")), keep=keep)
        return rows.withColumn("asked_again", F.lit(screened.count(k) > 1)).select("host", "classification", "asked_again")

    R.screened_in_parts(spark, folder, _entries(spark, sf), 3, screen, 5.0, clock)
    rows, _ = R.screened_in_parts(spark, folder, _entries(spark, sf), 3, screen)
    return rows
