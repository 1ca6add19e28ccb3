"""Queries of list parsing, overrides, lookups and the whole run, over the test tables, and SQL that gives the same rows.

Customers stand for hosts: their keys give names, formats of lines, registry answers,
DNS answers and addresses by remainders, so that SQL can say what each should become.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import text as X
from ..functions import verdicts as D
from ..operators import batch as B
from ..operators import cache as C
from ..operators import lookup as L
from ..operators import prepare as P
from ..operators import run as R
from ..operators import screening as Z
from ..operators import sinks as K
from ..operators import suffixes as S
from ..operators.scratch import kept
from .catalog import _t, query

#: Rules of the queries, in the list's own words; SQL reads the same.
RULES = ["com", "org", "uk", "co.uk", "ck", "*.ck", "!www.ck"]
_RULES_SQL = "r(suffix, kind) AS (VALUES ('com', 'exact'), ('org', 'exact'), ('uk', 'exact'), ('co.uk', 'exact'), ('ck', 'exact'), ('ck', 'wildcard'), ('www.ck', 'exception'))"


def _name(k):
    """Hosts of every kind of rule by the key's remainder."""
    text = k.cast("string")
    return (
        F.when(k % 7 == 0, F.concat(F.lit("a"), text, F.lit(".com"))).when(k % 7 == 1, F.concat(F.lit("www.b"), text, F.lit(".co.uk")))
        .when(k % 7 == 2, F.concat(F.lit("x.y"), text, F.lit(".city.ck"))).when(k % 7 == 3, F.lit("m.www.ck")).when(k % 7 == 4, F.lit("co.uk"))
        .when(k % 7 == 5, F.concat(F.lit("z"), text, F.lit(".unlisted"))).otherwise(F.concat(F.lit("e.d.c"), text, F.lit(".uk")))
    )


_NAME_SQL = """CASE c_custkey % 7 WHEN 0 THEN 'a' || c_custkey || '.com' WHEN 1 THEN 'www.b' || c_custkey || '.co.uk' WHEN 2 THEN 'x.y' || c_custkey || '.city.ck'
    WHEN 3 THEN 'm.www.ck' WHEN 4 THEN 'co.uk' WHEN 5 THEN 'z' || c_custkey || '.unlisted' ELSE 'e.d.c' || c_custkey || '.uk' END"""
_SUFFIXED_SQL = f"""
    h AS (SELECT c_custkey, {_NAME_SQL} AS host FROM customer), {_RULES_SQL},
    l AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM h),
    m AS (SELECT host, l, kind, i + CASE kind WHEN 'wildcard' THEN -1 WHEN 'exception' THEN 1 ELSE 0 END AS i
          FROM (SELECT host, l, unnest(range(1, len(l) + 1)) AS i FROM l) c JOIN r ON array_to_string(c.l[c.i:], '.') = r.suffix),
    b AS (SELECT host, l, arg_min(i, (kind <> 'exception', i)) AS i FROM m WHERE i >= 1 GROUP BY host, l),
    s AS (SELECT host, array_to_string(l[i:], '.') AS public_suffix, CASE WHEN i > 1 THEN array_to_string(l[i - 1:], '.') ELSE '' END AS registrable_domain, i = 1 AS is_public_suffix_input FROM b)"""


def _named(spark, sf) -> DataFrame:
    return _t(spark, sf, "customer").select("c_custkey", _name(F.col("c_custkey")).alias("host"))


@query(f"WITH {_SUFFIXED_SQL} SELECT c_custkey, host, public_suffix, registrable_domain, is_public_suffix_input FROM h JOIN s USING (host)")
def suffix_rules(spark, sf):
    return S.with_public_suffix(_named(spark, sf), S.public_suffix_rules(spark, RULES)).select("c_custkey", "host", "public_suffix", "registrable_domain", "is_public_suffix_input")


@query(f"""
    WITH {_SUFFIXED_SQL} SELECT registrable_domain, count(*) AS hosts, bool_or(false) AS suffix FROM s WHERE NOT is_public_suffix_input GROUP BY ALL
    UNION ALL SELECT host, 1, true FROM s WHERE is_public_suffix_input
""")
def suffix_groups(spark, sf):
    found = S.with_public_suffix(_named(spark, sf).select("host").distinct(), S.public_suffix_rules(spark, RULES))
    groups, suffixes = P.root_groups(found)
    return groups.withColumn("suffix", F.lit(False)).unionByName(suffixes.select(F.col("host").alias("registrable_domain"), F.lit(1).cast("long").alias("hosts"), F.lit(True).alias("suffix")))


# Lines: source k % 6 of key k, line k, one format a source; source 4 is mixed, source 5 holds a line of no format.
def _lines(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat(F.lit("H"), (k % 40).cast("string"), F.when(k % 4 == 0, ".Com.").otherwise(".co.uk"))
    host = X.lowered_host(name)
    raw = (
        F.when(k % 11 == 0, F.lit(" # a note"))
        .when(k % 6 == 0, F.concat(F.lit("  "), name, F.lit("  ! seen"))).when(k % 6 == 1, F.concat(F.lit("0.0.0.0\t"), host, F.lit(" # x")))
        .when(k % 6 == 2, F.concat(F.lit("||"), F.when(k % 9 == 2, "*.").otherwise(""), host, F.lit("^")))
        .when(k % 6 == 3, F.concat(F.lit("server=/"), host, F.lit("/1.1.1.1")))
        .when(k % 6 == 4, F.when(k % 5 == 0, F.concat(F.lit("::1 "), host)).otherwise(host)).when(k == 5, F.lit("one two three")).otherwise(host)
    )
    return _t(spark, sf, "customer").select(
        F.concat(F.lit("s"), (k % 6).cast("string")).alias("source_id"), (k % 6).cast("int").alias("source_index"), F.concat(F.lit("list "), (k % 6).cast("string")).alias("source_input_label"),
        k.cast("int").alias("line_index"), raw.alias("raw_line"),
    )


_LINES_SQL = """
    k AS (SELECT c_custkey AS k, 's' || c_custkey % 6 AS source_id, 'h' || c_custkey % 40 || CASE WHEN c_custkey % 4 = 0 THEN '.com' ELSE '.co.uk' END AS host FROM customer WHERE c_custkey % 11 <> 0),
    f AS (SELECT k, source_id, host, CASE k % 6 WHEN 0 THEN 'plain' WHEN 1 THEN 'hosts' WHEN 2 THEN 'adblock' WHEN 3 THEN 'dnsmasq' WHEN 4 THEN CASE WHEN k % 5 = 0 THEN 'hosts' ELSE 'plain' END
                 ELSE CASE WHEN k = 5 THEN 'unknown' ELSE 'plain' END END AS line_format FROM k),
    p AS (SELECT source_id, host, CASE WHEN k % 6 IN (2, 3) THEN 'suffix_rule' ELSE 'exact_host' END AS input_kind,
                 CASE WHEN k % 6 NOT IN (2, 3) THEN 'exact_only' WHEN k % 6 = 2 AND k % 9 = 2 THEN 'exclude_apex' ELSE 'include_apex' END AS apex_scope, line_format AS source_format, min(k) AS line_index
          FROM f WHERE k % 6 < 4 GROUP BY ALL)"""


@query(f"WITH {_LINES_SQL} SELECT k AS line_index, line_format FROM f")
def line_formats(spark, sf):
    return P.with_line_format(_lines(spark, sf)).select("line_index", "line_format")


@query(f"""
    WITH {_LINES_SQL} SELECT source_id, CASE WHEN bool_or(line_format = 'unknown') THEN 'unknown' WHEN count(DISTINCT line_format) > 1 THEN 'mixed' ELSE min(line_format) END AS source_format
    FROM f GROUP BY source_id
""")
def source_formats(spark, sf):
    return P.source_formats(P.with_line_format(_lines(spark, sf)))


_ROOT_SQL = "CASE WHEN host LIKE '%.com' THEN 'com' ELSE 'co.uk' END AS public_suffix"


@query(f"WITH {_LINES_SQL} SELECT *, {_ROOT_SQL} FROM p")
def parsed_lines(spark, sf):
    found = P.parse_lines(_lines(spark, sf), S.public_suffix_rules(spark, RULES))
    return found.select("source_id", "host", "input_kind", "apex_scope", "source_format", F.col("line_index").cast("long").alias("line_index"), "public_suffix")


@query(f"""
    WITH {_LINES_SQL} SELECT source_id, host, min(k) AS line_index FROM f WHERE source_id IN ('s0', 's4', 's5') AND line_format = 'plain' GROUP BY ALL
""")
def forced_format(spark, sf):
    lines = _lines(spark, sf).filter("source_id IN ('s0', 's4', 's5')")
    found = P.parse_lines(lines, S.public_suffix_rules(spark, RULES), "plain")
    return found.select("source_id", "host", F.col("line_index").cast("long").alias("line_index"))


@query(f"""
    WITH {_LINES_SQL} SELECT root, arg_min(source_id, (source_id, line_index)) AS source_id, arg_min(line_index, (source_id, line_index)) AS line_index
    FROM (SELECT host AS root, source_id, line_index FROM p) GROUP BY root
""")
def first_roots(spark, sf):
    found = P.first_roots(P.parse_lines(_lines(spark, sf), S.public_suffix_rules(spark, RULES)))
    return found.select("root", F.concat(F.lit("s"), F.col("first_seen.source_index").cast("string")).alias("source_id"), F.col("first_seen.line_index").cast("long").alias("line_index"))


# Overrides: hosts c<k> in two sources; 0 of 10 taken out, 1 passed, 2 added by hand; u<k> are in no source.
def _overridden(spark, sf):
    k = F.col("c_custkey")
    rows = _t(spark, sf, "customer").select(F.concat(F.lit("c"), (k % 500).cast("string")).alias("host"), (k % 2).cast("int").alias("source_index"), k.cast("int").alias("line_index"), (k % 500).alias("n"))
    entries = rows.withColumn("source_id", F.concat(F.lit("s"), F.col("source_index").cast("string"))).withColumn("source_input_label", F.col("source_id"))
    listed = lambda digit, name: _t(spark, sf, "supplier").select((F.col("s_suppkey") % 500).alias("n")).distinct().filter(F.col("n") % 10 == digit).select(
        F.explode(F.array(F.concat(F.lit("c"), F.col("n").cast("string")), F.concat(F.lit("u"), F.col("n").cast("string")))).alias("host"), F.lit(9).alias("source_index"),
        F.col("n").cast("int").alias("line_index"), "n", F.lit(name).alias("source_id"), F.lit(name).alias("source_input_label"),
    )
    return P.apply_overrides(entries, listed(1, "manual_filter_pass"), listed(0, "manual_filter_out"), listed(2, "manual_add"))


_OVER_SQL = """
    n AS (SELECT DISTINCT s_suppkey % 500 AS n FROM supplier),
    o AS (SELECT a || n AS host, n % 10 AS d FROM n, (VALUES ('c'), ('u')) t(a) WHERE n % 10 < 3),
    e AS (SELECT 'c' || c_custkey % 500 AS host, 's' || c_custkey % 2 AS source_id, c_custkey % 2 AS i, c_custkey AS k FROM customer),
    c AS (SELECT host, string_agg(source_id, ',' ORDER BY i, k) AS source_ids FROM e GROUP BY host)"""


@query(f"""
    WITH {_OVER_SQL} SELECT host, source_ids, coalesce(d = 1, false) AS passed, coalesce(d = 2, false) AS added FROM c LEFT JOIN o USING (host) WHERE coalesce(d, 9) <> 0
    UNION ALL SELECT host, 'manual_add', false, true FROM o WHERE d = 2 AND host NOT IN (SELECT host FROM c)
""")
def override_prepared(spark, sf):
    kept = _overridden(spark, sf)[0]
    return kept.select("host", F.array_join("source_ids", ",").alias("source_ids"), F.col("manual_filter_pass").alias("passed"), F.col("manual_add").alias("added"))


@query(f"WITH {_OVER_SQL} SELECT host, source_ids FROM c JOIN o USING (host) WHERE d = 0")
def override_removed(spark, sf):
    return _overridden(spark, sf)[1].select("host", F.array_join("source_ids", ",").alias("source_ids"))


@query(f"""
    WITH {_OVER_SQL} SELECT host, CASE d WHEN 1 THEN 'manual_filter_pass_not_in_sources' ELSE 'manual_filter_out_not_in_sources' END AS classification
    FROM o WHERE d < 2 AND host NOT IN (SELECT host FROM c)
""")
def override_unmatched(spark, sf):
    return _overridden(spark, sf)[2]


@query("""
    WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 0), c AS (SELECT n_nationkey AS k FROM nation)
    SELECT 'n' || min(k) || ' is in both manual_filter_pass and manual_filter_out' AS problem FROM (SELECT 'n' || k AS h, k FROM a INTERSECT SELECT 'n' || k, k FROM b) WHERE h = (SELECT min('n' || k) FROM (SELECT k FROM a INTERSECT SELECT k FROM b))
    UNION ALL SELECT (SELECT min('n' || k) FROM (SELECT k FROM a INTERSECT SELECT k FROM c)) || ' is in both manual_filter_pass and manual_add'
    UNION ALL SELECT (SELECT min('n' || k) FROM (SELECT k FROM b INTERSECT SELECT k FROM c)) || ' is in both manual_filter_out and manual_add'
""")
def override_overlaps(spark, sf):
    hosts = lambda df, c: df.select(F.concat(F.lit("n"), F.col(c).cast("string")).alias("host"))
    found = P.overlap_errors(
        hosts(_t(spark, sf, "customer").filter("c_acctbal > 0"), "c_nationkey"), hosts(_t(spark, sf, "supplier").filter("s_acctbal > 0"), "s_nationkey"), hosts(_t(spark, sf, "nation"), "n_nationkey")
    )
    return spark.createDataFrame([(p,) for p in found], "problem string")


@query("SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS keys, true AS whole, true AS fits")
def bulk_requests(spark, sf):
    keys = L.unique_keys(_t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("ips")), "ips")
    chunks = L.bulk_chunks(keys, "ip", 3).groupBy("chunk").agg(F.count("*").alias("n"), F.collect_set("ip").alias("ips"))
    return chunks.agg(
        F.sum("n").alias("keys"), (F.sum("n") == F.size(F.array_distinct(F.flatten(F.collect_list("ips"))))).alias("whole"), (F.max("n") <= 3).alias("fits")
    )


@query("""
    SELECT l_orderkey AS host, string_agg(l_suppkey || ':' || CASE WHEN l_suppkey % 5 = 0 THEN 'invalid_payload' ELSE 'ok' END, ',' ORDER BY l_linenumber, l_suppkey) AS answers FROM lineitem GROUP BY 1
""")
def geo_rejoined(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("host")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("ips")
    )
    answers = _t(spark, sf, "supplier").filter("s_suppkey % 5 != 0").select(F.col("s_suppkey").alias("ip"), F.lit("ok").alias("status"))
    found = L.rejoined(rows, answers, "host", "ips")
    return found.select("host", F.array_join(F.transform("results", lambda r: F.concat_ws(":", r["ip"].cast("string"), r["status"])), ",").alias("answers"))


@query("""
    SELECT event_id, upper(trim(coalesce(props ->> '$.country', ''))) AS country_code, trim(coalesce(props ->> '$.region', '')) AS region_name, '' AS region_code,
           CASE WHEN trim(coalesce(props ->> '$.country', '')) = '' THEN 'invalid_payload' ELSE 'ok' END AS status
    FROM events
""")
def geo_payloads(spark, sf):
    return L.decoded_geo(_t(spark, sf, "events").select("event_id", F.col("props").alias("body")), "ipinfo").select("event_id", "country_code", "region_name", "region_code", "status")


@query("""
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS exists, c_custkey % 5 <> 3 AS cacheable,
           CASE c_custkey % 5 WHEN 0 THEN 'active,clientHold' WHEN 1 THEN '' ELSE '' END AS statuses
    FROM customer
""")
def rdap_answers(spark, sf):
    k = F.col("c_custkey")
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 200, 404, 503, 400)]), (k % 5 + 1).cast("int"))
    body = F.when(k % 5 == 0, '{"status": ["clientHold"], "entities": [{"status": ["active", "active", 3]}]}').otherwise('{"status": [')
    found = L.parsed_rdap(_t(spark, sf, "customer").select("c_custkey", status.alias("http_status"), body.alias("body")))
    return found.select("c_custkey", "exists", "cacheable", F.array_join("statuses", ",").alias("statuses"))


# DNS: outcomes of A, AAAA and CNAME by the key's remainders.
_A, _AAAA, _CNAME = ["answer", "no_answer", "nxdomain", "exhausted", "refused"], ["answer", "no_answer", "timeout"], ["answer", "no_answer"]


def _dns_flags(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda names, by: F.element_at(F.array(*[F.lit(n) for n in names]), (F.floor(k / by) % len(names) + 1).cast("int"))
    a = D.record_outcome("A", pick(_A, 1), F.array(F.concat(F.lit("10.0.0."), (k % 200).cast("string")), F.lit("alias.example")))
    six = D.record_outcome("AAAA", pick(_AAAA, 5), F.array(F.lit("2001:db8::1")))
    name = D.record_outcome("CNAME", pick(_CNAME, 15), F.array(F.lit("target.example.")))
    rows = _t(spark, sf, "customer").select("c_custkey", a.alias("a"), six.alias("six"), name.alias("name"))
    return rows.select("c_custkey", D.combined_answer(F.col("a"), F.col("six"), F.col("name")).alias("dns"))


_DNS_SQL = """
    q AS (SELECT c_custkey, c_custkey % 5 AS a, (c_custkey // 5) % 3 AS b, (c_custkey // 15) % 2 AS c FROM customer),
    x AS (SELECT *, a = 0 OR (a <> 2 AND b = 0) AS ip FROM q),
    y AS (SELECT *, NOT ip AND a <> 2 AND c = 0 AS alias, ip OR (a <> 2 AND c = 0) AS ex, a = 2 AS nx, a = 1 AND b = 1 AND NOT (c = 0) AS nd, a = 4 AS sf FROM x),
    d AS (SELECT *, (a = 3 OR (b = 2 AND a <> 2)) AND NOT ex AND NOT nx AND NOT nd AND NOT sf AS late FROM y)"""


@query(f"""
    WITH {_DNS_SQL} SELECT c_custkey, CASE WHEN late THEN 'timeout' WHEN sf THEN 'servfail' WHEN nx THEN 'nx' WHEN ex THEN 'noerror' WHEN nd THEN 'nodata' ELSE 'error' END AS dns_status,
        CASE WHEN alias THEN 'target.example.' END AS canonical_name,
        concat_ws(',', CASE WHEN a = 0 THEN '10.0.0.' || c_custkey % 200 END, CASE WHEN a <> 2 AND b = 0 THEN '2001:db8::1' END) AS ips
    FROM d
""")
def dns_outcomes(spark, sf):
    rows = _dns_flags(spark, sf)
    return rows.select("c_custkey", D.dns_status(F.col("dns")).alias("dns_status"), F.col("dns.canonical_name").alias("canonical_name"), F.array_join(D.resolved_ips(F.col("dns")), ",").alias("ips"))


# Registry: plan, cache layers and live answers by remainders of the key.
NOW = "2024-03-01 00:00:00"


def _now():
    return F.to_timestamp(F.lit(NOW))


def _roots(spark, sf) -> DataFrame:
    return _t(spark, sf, "customer").select("c_custkey", F.concat(F.lit("r"), F.col("c_custkey").cast("string"), F.lit(".com")).alias("registrable_domain"))


def _root_cache(spark, sf, condition: str) -> DataFrame:
    k = F.col("c_custkey")
    klass = F.element_at(F.array(*[F.lit(c) for c in ("rdap_registrable_domain_registered", "rdap_registrable_domain_unregistered", "rdap_lookup_unavailable")]), (k % 3 + 1).cast("int"))
    rows = _roots(spark, sf).filter(condition).select(
        F.col("registrable_domain").alias("domain"), klass.alias("classification"), F.array(F.lit("cached")).alias("statuses"), (k % 4 != 0).alias("statuses_complete"),
        F.lit("2024-02-20 00:00:00").cast("timestamp").alias("checked_at"), F.when(k % 13 == 0, "2024-02-29 00:00:00").otherwise("2024-03-09 00:00:00").cast("timestamp").alias("expires_at"),
    )
    return rows


def _live_roots(spark, sf):
    k = F.col("c_custkey")
    return L.fixture(
        _roots(spark, sf).select(
            "registrable_domain", F.when(k % 6 < 4, True).when(k % 6 == 4, False).alias("exists"),
            F.when(k % 6 == 3, F.array(F.lit("clientHold"))).otherwise(F.array().cast("array<string>")).alias("statuses"), (k % 12 != 5).alias("cacheable"),
        ), ["registrable_domain"],
    )


def _plan(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    return _roots(spark, sf).filter("c_custkey % 2 = 0").select("registrable_domain", F.when(k % 10 == 0, "unavailable").otherwise("resolved").alias("status"), F.lit("https://rdap.example/").alias("authoritative_base_url"))


def _lookups(spark, sf, **more) -> R.Lookups:
    given = {"rdap": _live_roots(spark, sf), "dns": None, "geo": None, "root_cache": (_root_cache(spark, sf, "c_custkey % 5 = 1"), _root_cache(spark, sf, "c_custkey % 5 IN (1, 2)"))} | more
    return R.Lookups(**given)


_REGISTRY_SQL = """
    g AS (SELECT c_custkey AS k, 'r' || c_custkey || '.com' AS registrable_domain, c_custkey % 5 IN (1, 2) AND c_custkey % 13 <> 0 AS cached FROM customer),
    v AS (SELECT *, CASE WHEN k % 10 = 0 THEN 'prepared' WHEN NOT cached OR (k % 3 = 0 AND k % 4 = 0) THEN 'live' WHEN k % 5 = 1 THEN 'overlay' ELSE 'baseline' END AS rdap_source FROM g),
    w AS (SELECT *, CASE rdap_source WHEN 'prepared' THEN NULL WHEN 'live' THEN CASE WHEN k % 6 < 4 THEN true WHEN k % 6 = 4 THEN false END
                 ELSE CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END END AS found,
              CASE WHEN rdap_source = 'live' AND k % 6 = 3 THEN 'clientHold' WHEN rdap_source IN ('overlay', 'baseline') AND k % 3 = 0 THEN 'cached' ELSE '' END AS statuses FROM v)"""


@query(f"WITH {_REGISTRY_SQL} SELECT registrable_domain, rdap_source, found, CASE WHEN found IS NOT NULL THEN statuses END AS statuses FROM w")
def registry_verdicts(spark, sf):
    roots = _roots(spark, sf).select("registrable_domain")
    found, _ = R.registry_answers(roots, _plan(spark, sf), _lookups(spark, sf), R.Settings(), _now(), lambda df, name: df)
    return found.select("registrable_domain", "rdap_source", F.col("rdap.exists").alias("found"), F.array_join("rdap.statuses", ",").alias("statuses"))


@query(f"""
    WITH {_REGISTRY_SQL} SELECT registrable_domain AS domain, CASE WHEN found IS NULL THEN 'rdap_lookup_unavailable' WHEN found THEN 'rdap_registrable_domain_registered' ELSE 'rdap_registrable_domain_unregistered' END AS classification,
        found IS NOT NULL AS statuses_complete, CASE WHEN found IS NULL THEN 3 WHEN found THEN 30 ELSE 9 END AS days
    FROM w WHERE rdap_source = 'live' AND (found IS NOT NULL OR k % 12 <> 5)
""")
def registry_writes(spark, sf):
    settings = R.Settings(registered_days=30, unregistered_days=9, unavailable_days=3)
    roots = _roots(spark, sf).select("registrable_domain")
    _, rows = R.registry_answers(roots, _plan(spark, sf), _lookups(spark, sf), settings, _now(), lambda df, name: df)
    return rows.select("domain", "classification", "statuses_complete", F.datediff("expires_at", "checked_at").alias("days"))


# The whole run: hosts h<k>.<root> of customers with registry, DNS and geo answers.
def _screened(spark, sf):
    k = F.col("c_custkey")
    roots = _roots(spark, sf)
    apex = k % 2 == 0
    entries = roots.select(
        F.when(apex, F.col("registrable_domain")).otherwise(F.concat(F.lit("www."), F.col("registrable_domain"))).alias("host"), "registrable_domain",
        F.lit("com").alias("public_suffix"), (k % 97 == 0).alias("is_public_suffix_input"), F.lit("exact_host").alias("input_kind"), F.lit("exact_only").alias("apex_scope"), F.lit("plain").alias("source_format"),
        F.lit("").alias("input_name"), F.when(k % 8 == 0, "nodns").when(k % 8 == 1, "nogeo").otherwise("all").alias("source_id"), F.lit("list").alias("source_input_label"),
        F.array(F.lit("s")).alias("source_ids"), F.array(F.lit("list")).alias("source_input_labels"), (k % 23 == 0).alias("manual_filter_pass"), (k % 29 == 0).alias("manual_add"),
    )
    flags = _dns_flags(spark, sf).join(roots, "c_custkey").select(
        F.when(apex, F.col("registrable_domain")).otherwise(F.concat(F.lit("www."), F.col("registrable_domain"))).alias("host"), F.lit("system|ecs=off").alias("resolver_key"), "dns.*"
    )
    answered = F.when(F.col("ip") == "2001:db8::1", F.lit("DE")).otherwise(F.lit("CN"))
    geo = lambda keys: keys.select("provider", "ip", answered.alias("country_code"), F.lit("").alias("region_code"), F.lit("").alias("region_name"), F.when(F.col("ip").endswith("7"), "timeout").otherwise("ok").alias("status"))
    lookups = _lookups(spark, sf, dns=L.fixture(flags, ["host", "resolver_key"]), geo=geo)
    policy = G.Policy(True, "any_ip", G.Rules(["CN"]))
    settings = R.Settings({"all": R.SourceSettings(policy=policy), "nogeo": R.SourceSettings(geo_enabled=False), "nodns": R.SourceSettings(dns_enabled=False)})
    return R.screened(entries, lookups, settings, _now(), _plan(spark, sf), kept(spark, "run"))


_SCREEN_SQL = f"""
    {_REGISTRY_SQL}, {_DNS_SQL},
    j AS (SELECT *, CASE WHEN k % 2 = 0 THEN registrable_domain ELSE 'www.' || registrable_domain END AS host, k % 2 = 0 AS apex,
              CASE WHEN k % 97 = 0 THEN 'input_public_suffix' WHEN k % 29 = 0 THEN CASE WHEN found THEN 'manual_add_registered' WHEN found IS NULL THEN 'manual_add_unavailable' ELSE 'manual_add_unregistered' END
                   WHEN NOT found THEN 'rdap_registrable_domain_unregistered' WHEN k % 23 = 0 THEN 'manual_filter_passed'
                   WHEN k % 8 = 0 THEN CASE WHEN found THEN 'rdap_registrable_domain_registered_dns_disabled' ELSE 'rdap_lookup_unavailable_dns_disabled' END END AS early
          FROM (SELECT * REPLACE (CASE WHEN k % 97 = 0 THEN NULL ELSE found END AS found) FROM w) JOIN d ON k = c_custkey),
    i AS (SELECT *, a = 0 AS has4, a <> 2 AND b = 0 AS has6, a = 0 AND k % 10 <> 7 AS ok4 FROM j),
    z AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN late THEN 'dns_lookup_timeout' WHEN sf THEN 'dns_lookup_servfail'
                 WHEN nx THEN CASE WHEN apex THEN 'dns_registered_apex_nxdomain' ELSE 'dns_registered_subdomain_nxdomain' END
                 WHEN nd THEN CASE WHEN apex THEN 'dns_registered_apex_nodata' ELSE 'dns_registered_subdomain_nodata' END
                 WHEN statuses = 'clientHold' THEN 'rdap_registered_domain_status_client_hold' WHEN NOT has4 AND NOT has6 THEN 'dns_resolved_without_ip_addresses' ELSE 'dns_resolves' END AS base FROM i),
    y2 AS (SELECT *, CASE WHEN base <> 'dns_resolves' OR k % 8 = 1 THEN base WHEN NOT ok4 AND NOT has6 THEN 'geo_lookup_failed' WHEN NOT ok4 THEN 'geo_policy_rejected' ELSE base END AS classification FROM z)"""


@query(f"WITH {_SCREEN_SQL} SELECT host, classification FROM y2")
def run_classes(spark, sf):
    return _screened(spark, sf)[0].select("host", "classification")


@query(f"""
    WITH {_SCREEN_SQL} SELECT CASE WHEN classification = 'rdap_registrable_domain_unregistered' THEN 'dead'
        WHEN classification IN ('manual_filter_passed', 'manual_add_registered', 'rdap_registrable_domain_registered_dns_disabled', 'dns_resolves') THEN 'filtered' ELSE 'review' END AS route, classification, count(*) AS n
    FROM y2 GROUP BY ROLLUP (route, classification) HAVING route IS NOT NULL
""")
def run_counts(spark, sf):
    return Z.outcome_counts(_screened(spark, sf)[0])


@query(f"WITH {_SCREEN_SQL} SELECT host, 'system|ecs=off' AS resolver_key, ex AS a_exists FROM y2 WHERE early IS NULL")
def run_dns_writes(spark, sf):
    return _screened(spark, sf)[1]["dns"].select("host", "resolver_key", "a_exists")


@query(f"""
    WITH {_SCREEN_SQL}, t AS (SELECT unnest([CASE WHEN has4 THEN '10.0.0.' || k % 200 END, CASE WHEN has6 THEN '2001:db8::1' END]) AS ip FROM y2 WHERE base = 'dns_resolves' AND k % 8 <> 1)
    SELECT DISTINCT 'ipinfo_lite' AS provider, ip, CASE WHEN ip = '2001:db8::1' THEN 'DE' ELSE 'CN' END AS country_code FROM t WHERE ip IS NOT NULL AND ip NOT LIKE '%7'
""")
def run_geo_writes(spark, sf):
    return _screened(spark, sf)[1]["geo"].select("provider", "ip", "country_code")


@query(f"""
    WITH {_SCREEN_SQL} SELECT host, row_number() OVER (ORDER BY host) AS place FROM y2
    WHERE classification IN ('manual_filter_passed', 'manual_add_registered', 'rdap_registrable_domain_registered_dns_disabled', 'dns_resolves')
""")
def filtered_list(spark, sf):
    rows = K.numbered_hosts(_screened(spark, sf)[0], "filtered", kept(spark, "list"))
    return rows.select("host", (F.col("place") + 1).alias("place"))


@query("""SELECT '{"host":"' || n_name || '","n":' || n_nationkey || ',"note":null}' AS value FROM nation""")
def audit_json(spark, sf):
    return K.audit_lines(_t(spark, sf, "nation").select(F.col("n_nationkey").alias("n"), F.lit(None).cast("string").alias("note"), F.col("n_name").alias("host")), sort_keys=True)


@query("SELECT sha256('{\"a\":' || c_custkey || ',\"b\":\"' || c_mktsegment || '\"}') AS signature FROM customer")
def row_signatures(spark, sf):
    rows = _t(spark, sf, "customer").select(F.col("c_mktsegment").alias("b"), F.col("c_custkey").alias("a"))
    return rows.select(D.signature(rows.columns).alias("signature"))


@query("""
    WITH u AS (SELECT l_orderkey AS host, bool_or(l_linenumber % 4 <> 0) AS any_ok, bool_or(l_linenumber % 4 <> 0 AND trim(CASE WHEN l_suppkey % 3 = 0 THEN ' Ab  c' ELSE '' END) <> '') AS any_name,
                      bool_or(l_linenumber % 4 <> 0 AND l_suppkey % 3 = 0) AS any_match FROM lineitem GROUP BY 1)
    SELECT host, CASE WHEN NOT any_ok OR NOT any_name THEN 'review' ELSE 'ok' END AS geo_status,
           CASE WHEN NOT any_ok THEN 'geo_lookup_failed' WHEN NOT any_name THEN 'geo_region_name_unavailable' ELSE 'dns_resolves' END AS classification
    FROM u
""")
def geo_usable(spark, sf):
    one = F.struct(
        "l_linenumber", F.col("l_suppkey").cast("string").alias("ip"), F.lit("US").alias("country_code"), F.lit("").alias("region_code"),
        F.when(F.col("l_suppkey") % 3 == 0, " Ab  c").otherwise("").alias("region_name"), F.when(F.col("l_linenumber") % 4 != 0, "ok").otherwise("timeout").alias("status"),
    )
    rows = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("host")).agg(F.array_sort(F.collect_list(one)).alias("results"))
    made = rows.withColumn("g", G.decision(G.Policy(True, "any_ip", G.Rules([], [], ["ab c"])), F.col("results")))
    return made.select("host", F.col("g.geo_status").alias("geo_status"), G.overlaid_class(F.lit("dns_resolves"), F.col("g")).alias("classification"))


@query("""
    SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'rdap_registrable_domain_registered' WHEN 1 THEN 'rdap_registrable_domain_unregistered' WHEN 2 THEN 'rdap_lookup_unavailable' ELSE n_name END AS classification FROM nation
""")
def legacy_classes(spark, sf):
    old = F.when(F.col("n_nationkey") % 4 == 0, "alive").when(F.col("n_nationkey") % 4 == 1, "dead").when(F.col("n_nationkey") % 4 == 2, C.LEGACY_UNAVAILABLE).otherwise(F.col("n_name"))
    return C.modern_classes(_t(spark, sf, "nation").select("n_nationkey", old.alias("classification"))).select("n_nationkey", "classification")


@query("""SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'a,' || n_name ELSE '' END AS items FROM nation""")
def json_lists(spark, sf):
    k, name = F.col("n_nationkey"), F.col("n_name")
    text = F.when(k % 3 == 0, F.concat(F.lit('["a", 1, "'), name, F.lit('", null]'))).when(k % 3 == 1, F.concat(F.lit("[broken "), name)).otherwise(F.concat(F.lit('{"a": "'), name, F.lit('"}')))
    return _t(spark, sf, "nation").select("n_nationkey", F.array_join(C.json_list(text), ",").alias("items"))


@query(f"""
    WITH {_SUFFIXED_SQL}, t(suffix, url) AS (VALUES ('com', 'https://a.example/'), ('uk', 'https://n.example/'), ('co.uk', 'http://old.example/'))
    SELECT registrable_domain, (SELECT arg_max(url, length(suffix)) FROM t WHERE registrable_domain = suffix OR registrable_domain LIKE '%.' || suffix) AS authoritative_base_url
    FROM (SELECT DISTINCT registrable_domain FROM s WHERE NOT is_public_suffix_input)
""")
def registry_servers(spark, sf):
    body = '{"services": [[["COM"], ["http://z.example/", "https://b.example/", "https://a.example/", "https://no-slash"]], [["co.uk"], ["http://old.example/"]], [["uk"], ["https://first.example/"]], [["uk"], ["https://n.example/"]]]}'
    services = S.bootstrap_services(spark.createDataFrame([(body,)], "body string"))
    roots = S.with_public_suffix(_named(spark, sf).select("host").distinct(), S.public_suffix_rules(spark, RULES)).filter("NOT is_public_suffix_input")
    return S.with_server(roots.select("registrable_domain").distinct(), services).select("registrable_domain", "authoritative_base_url")


@query("""
    WITH b AS (SELECT s_suppkey AS ip, l_orderkey AS host, row_number() OVER (PARTITION BY s_suppkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
    SELECT ip, n AS pos, CASE WHEN n <= ip % 4 THEN 'ok' ELSE 'invalid_payload' END AS status FROM b
""")
def bulk_rows(spark, sf):
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber"))
    asked = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ip"), pos.cast("long").alias("pos"))
    told = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("ip"), F.explode(F.sequence(F.lit(0), (F.col("s_suppkey") % 4).cast("int"))).alias("row")).filter("row > 0").withColumn("status", F.lit("ok"))
    return L.matched_bulk(asked, told).select("ip", "pos", "status")


@query("SELECT s_suppkey AS ip, CASE WHEN s_suppkey % 3 = 0 THEN 'ok' ELSE 'invalid_payload' END AS status FROM supplier")
def bulk_maps(spark, sf):
    k = F.col("s_suppkey")
    payload = F.create_map(F.when(k % 3 == 0, k).otherwise(-k - 1), F.struct(F.lit("CN").alias("country_code")))
    return L.map_answers(_t(spark, sf, "supplier").select(k.alias("ip"), payload.alias("payload")), F.col("payload")).select("ip", "status")


_SPREAD_SQL = """
    WITH g AS (SELECT c_nationkey || '-' || c_mktsegment AS root, c_mktsegment AS server, count(*) AS hosts FROM customer GROUP BY c_nationkey, c_mktsegment),
    n AS (SELECT *, row_number() OVER (PARTITION BY server ORDER BY hosts DESC, root) - 1 AS n, dense_rank() OVER (ORDER BY server) - 1 AS start FROM g)
    SELECT root, 'worker-0' || (CASE WHEN (n // 5) % 2 = 0 THEN n % 5 ELSE 4 - n % 5 END + start) % 5 + 1 AS worker FROM n
"""


@query(_SPREAD_SQL.replace("'worker-0' || (CASE", "'worker-0' || ((CASE").replace("% 5 + 1 AS worker", "% 5 + 1) AS worker"))
def spread_assignment(spark, sf):
    groups = _t(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("hosts"))
    roots = groups.select(F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("root"), F.col("c_mktsegment").alias("server"), "hosts")
    return B.spread_assignment(roots, 5, keep=kept(spark, "assignment")).select("root", "worker")


@query("""
    SELECT s_suppkey % 7 AS shard, s_suppkey AS host, 'whole' AS state FROM supplier
    UNION ALL SELECT NULL, NULL, 'a host is in two shards' WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier))
""")
def merged_shards(spark, sf):
    """The union of shards that share no host, and a row that tells of shards that do."""
    rows = _t(spark, sf, "supplier").select((F.col("s_suppkey") % 7).alias("shard"), F.col("s_suppkey").alias("host"))
    whole = B.merged([rows.filter(F.col("shard") == k) for k in range(7)], ["host"], "host").withColumn("state", F.lit("whole"))
    try:
        B.merged([rows.select("host"), _t(spark, sf, "customer").select(F.col("c_custkey").alias("host"))], ["host"], "host")
    except B.DuplicateRows:
        told = spark.createDataFrame([("a host is in two shards",)], "state string")
        return whole.unionByName(told, allowMissingColumns=True)
    return whole
