"""Queries of the reference operators over the test tables, and the SQL that gives the same rows.

``pages`` give hosts; ``events`` stand for cache rows and DNS results; orders, lineitem,
supplier and nation stand for hosts, addresses and their countries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import text as X
from ..functions import verdicts as D
from ..operators import batch as B
from ..operators import cache as C
from ..operators import lookup as L
from ..operators import prepare as P
from ..operators import suffixes as S
from ..operators.scratch import kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _hosts(spark: SparkSession, sf: str) -> DataFrame:
    host = X.lowered_host(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1))
    return _t(spark, sf, "pages").select("page_id", host.alias("host"))


_HOSTS_SQL = r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), '\.+$', '') AS host FROM pages"
_LABEL = "[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"


def _valid_sql(column: str) -> str:
    return rf"length({column}) BETWEEN 1 AND 253 AND regexp_full_match({column}, '{_LABEL}(\.{_LABEL})*')"


@query(_HOSTS_SQL)
def host_extract(spark, sf):
    return _hosts(spark, sf)


@query(f"""
    SELECT 'page' AS kind, page_id AS id, {_valid_sql("host")} AS valid FROM ({_HOSTS_SQL})
    UNION ALL SELECT 'part', p_partkey, {_valid_sql("p_name")} FROM part
""")
def host_syntax(spark, sf):
    pages = _hosts(spark, sf).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), X.valid_host(F.col("host")).alias("valid"))
    parts = _t(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), X.valid_host(F.col("p_name")).alias("valid"))
    return pages.unionByName(parts)


@query(f"""
    WITH h AS ({_HOSTS_SQL}), s AS (SELECT page_id, host, string_split(host, '.') AS l FROM h)
    SELECT page_id, host, l[-1] AS public_suffix, array_to_string(l[-2:], '.') AS registrable_domain, false AS is_public_suffix_input FROM s
""")
def registrable_domain(spark, sf):
    found = S.with_public_suffix(_hosts(spark, sf), S.public_suffix_rules(spark))
    return found.select("page_id", "host", "public_suffix", "registrable_domain", "is_public_suffix_input")


@query(f"""
    WITH h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM ({_HOSTS_SQL}))
    SELECT host, i AS start, array_to_string(l[i:], '.') AS suffix FROM h, unnest(range(1, len(l) + 1)) AS r(i)
""")
def suffix_candidates(spark, sf):
    hosts = _hosts(spark, sf).select("host").distinct()
    return hosts.select("host", F.inline(S.suffix_candidates(F.col("host")))).withColumn("start", F.col("start").cast("long"))


def _entries(spark, sf) -> DataFrame:
    return _hosts(spark, sf).select(
        F.lit("pages").alias("source_id"), F.col("page_id").alias("line_index"), "host", F.lit("exact_host").alias("input_kind"), F.lit("exact_only").alias("apex_scope")
    )


@query(f"SELECT host, min(page_id) AS line_index FROM ({_HOSTS_SQL}) GROUP BY host")
def dedupe_first(spark, sf):
    return P.first_entries(_entries(spark, sf)).select("host", "line_index")


@query("""
    SELECT user_id AS host, arg_min(event_type, event_id) AS first_type, string_agg(event_type, ',' ORDER BY event_id) AS source_ids,
           max(value) >= 50 AS passed
    FROM events GROUP BY user_id
""")
def collapse_provenance(spark, sf):
    rows = _t(spark, sf, "events").select(
        F.col("user_id").alias("host"), F.col("event_id").alias("line_index"), F.lit(0).alias("source_index"), F.col("event_type").alias("source_id"),
        F.col("event_type").alias("source_input_label"), (F.col("value") >= 50).alias("manual_filter_pass"),
    )
    return P.collapse_hosts(rows).select(
        "host", F.col("source_id").alias("first_type"), F.array_join("source_ids", ",").alias("source_ids"), F.col("manual_filter_pass").alias("passed")
    )


@query("""
    WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS first_source FROM events GROUP BY user_id)
    SELECT user_id AS host, first_source, arg_min(event_type, event_id) AS second_source
    FROM events JOIN f USING (user_id) WHERE event_type <> first_source GROUP BY ALL
""")
def conflict_check(spark, sf):
    rows = _t(spark, sf, "events").select(
        F.col("user_id").alias("host"), F.lit(0).alias("source_index"), F.col("event_id").alias("line_index"), F.col("event_type").alias("source_id"),
        F.col("event_type").alias("fingerprint"),
    )
    return P.profile_conflicts(rows)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def override_anti(spark, sf):
    return _t(spark, sf, "customer").join(_t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def override_semi(spark, sf):
    return _t(spark, sf, "customer").join(_t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("""
    WITH b AS (SELECT s_suppkey AS host, 'source' AS entry FROM supplier), o AS (SELECT DISTINCT c_custkey AS host, 'override' AS entry FROM customer WHERE c_nationkey = 3)
    SELECT host, coalesce(o.entry, b.entry) AS entry FROM b FULL OUTER JOIN o USING (host)
""")
def override_outer(spark, sf):
    base = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("host"), F.lit("source").alias("b"))
    over = _t(spark, sf, "customer").filter("c_nationkey = 3").select(F.col("c_custkey").alias("host"), F.lit("override").alias("o")).distinct()
    return base.join(over, "host", "full_outer").select("host", F.coalesce("o", "b").alias("entry"))


@query("SELECT c_nationkey AS host FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf):
    return _t(spark, sf, "customer").select(F.col("c_nationkey").alias("host")).intersect(_t(spark, sf, "supplier").select("s_nationkey"))


@query("SELECT n_nationkey AS host FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_except(spark, sf):
    return _t(spark, sf, "nation").select(F.col("n_nationkey").alias("host")).subtract(_t(spark, sf, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@query("""
    SELECT k AS host, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY k HAVING count(*) > 1
""")
def union_duplicates(spark, sf):
    both = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("host")).unionByName(_t(spark, sf, "supplier").select(F.col("s_nationkey").alias("host")))
    return B.duplicates(both, ["host"])


#: Fixed "now" of the cache queries; the tables' events lie around it.
NOW = "2024-03-01 00:00:00"
_TTL = "CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 30 ELSE 60 END"


def _now():
    return F.to_timestamp(F.lit(NOW))


def _cache(spark, sf) -> DataFrame:
    """Events as cache rows: key (user_id, event_type), one row an event."""
    days = F.expr(_TTL)
    rows = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").alias("checked_at"))
    return rows.withColumn("expires_at", F.col("checked_at") + F.make_dt_interval(days.cast("int")))


_CACHE_SQL = f"SELECT event_id, user_id, event_type, value, ts AS checked_at, ts + to_days({_TTL}) AS expires_at FROM events"
_LATEST_SQL = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY checked_at DESC, event_id DESC) AS rn FROM c{0}) WHERE rn = 1"""


@query(f"WITH c AS ({_CACHE_SQL}) SELECT event_id, user_id, event_type FROM c WHERE expires_at > TIMESTAMP '{NOW}'")
def cache_fresh(spark, sf):
    return C.fresh(_cache(spark, sf), _now()).select("event_id", "user_id", "event_type")


def _layer(rows: DataFrame, condition: str) -> DataFrame:
    latest = rows.filter(condition).groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value", "checked_at", "expires_at"), F.struct("checked_at", "event_id")).alias("r"))
    return latest.select("user_id", "event_type", "r.*")


def _looked_up(spark, sf) -> DataFrame:
    rows = _cache(spark, sf)
    keys = rows.select("user_id", "event_type").distinct()
    return C.layered(keys, _layer(rows, "event_id % 2 = 0"), _layer(rows, "event_id % 2 = 1"), ["user_id", "event_type"], _now())


_LOOKED_SQL = f"""
    WITH c AS ({_CACHE_SQL}), k AS (SELECT DISTINCT user_id, event_type FROM c),
    o AS (SELECT * FROM ({_LATEST_SQL.format(" WHERE event_id % 2 = 0")}) WHERE expires_at > TIMESTAMP '{NOW}'),
    b AS (SELECT * FROM ({_LATEST_SQL.format(" WHERE event_id % 2 = 1")}) WHERE expires_at > TIMESTAMP '{NOW}'),
    l AS (SELECT user_id, event_type, coalesce(o.event_id, b.event_id) AS event_id,
                 CASE WHEN o.event_id IS NOT NULL THEN 'overlay' WHEN b.event_id IS NOT NULL THEN 'baseline' END AS hit_source
          FROM k LEFT JOIN o USING (user_id, event_type) LEFT JOIN b USING (user_id, event_type))
"""


@query(_LOOKED_SQL + "SELECT user_id, event_type, event_id, hit_source FROM l")
def cache_layered(spark, sf):
    return _looked_up(spark, sf).select("user_id", "event_type", F.col("hit.event_id").alias("event_id"), "hit_source")


@query(_LOOKED_SQL + """
    SELECT event_type, count(hit_source) AS hits, count(*) - count(hit_source) AS misses,
           count(*) FILTER (hit_source = 'overlay') AS overlay_hits, count(*) FILTER (hit_source = 'baseline') AS baseline_hits FROM l GROUP BY event_type
""")
def cache_counters(spark, sf):
    return C.counters(_looked_up(spark, sf), ["event_type"])


@query(f"""
    WITH c AS ({_CACHE_SQL}), o AS ({_LATEST_SQL.format(" WHERE event_id % 2 = 0")}), b AS ({_LATEST_SQL.format(" WHERE event_id % 2 = 1")})
    SELECT user_id, event_type, event_id FROM b WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM o)
    UNION ALL SELECT user_id, event_type, event_id FROM o
""")
def cache_upsert(spark, sf):
    rows = _cache(spark, sf)
    return C.upsert(_layer(rows, "event_id % 2 = 1"), _layer(rows, "event_id % 2 = 0"), ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


@query("SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)")
def cache_delete(spark, sf):
    gone = _t(spark, sf, "customer").filter("c_acctbal < 1000").select(F.col("c_custkey").alias("user_id"))
    return C.delete(_t(spark, sf, "events"), gone, ["user_id"]).select("event_id")


@query(f"WITH c AS ({_CACHE_SQL}) SELECT user_id, event_type, event_id, checked_at FROM ({_LATEST_SQL.format('')})")
def cache_merge_latest(spark, sf):
    rows = _cache(spark, sf).select("event_id", "user_id", "event_type", "checked_at", "expires_at")
    shards = rows.filter("event_id % 2 = 0").unionByName(rows.filter("event_id % 2 = 1"))
    return C.merge_latest(shards, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "checked_at")


def _dns_rows(spark, sf) -> DataFrame:
    """Events as screened hosts: kind and value give the flags, the parity of the user gives apex or subdomain."""
    v, k = F.col("value"), F.col("event_id")
    flags = F.struct(
        (k % 7 > 1).alias("a_exists"), (k % 7 == 1).alias("a_nodata"), (k % 7 == 0).alias("a_nxdomain"), (k % 31 == 0).alias("a_timeout"), (k % 29 == 0).alias("a_servfail"),
        F.lit(None).cast("string").alias("canonical_name"), F.array(F.lit("192.0.2.1")).alias("ipv4_addresses"), F.array().cast("array<string>").alias("ipv6_addresses"),
    )
    statuses = F.when(k % 11 == 0, F.array(F.lit("pendingDelete"), F.lit("serverHold"))).when(k % 13 == 0, F.array(F.lit("client hold"))).otherwise(F.array().cast("array<string>"))
    rdap = F.when(k % 17 != 0, F.struct((k % 19 != 0).alias("exists"), statuses.alias("statuses")))
    return _t(spark, sf, "events").select(
        "event_id", F.concat(F.when(F.col("user_id") % 2 == 0, "").otherwise("www."), F.lit("u"), F.col("user_id").cast("string"), F.lit(".com")).alias("host"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".com")).alias("registrable_domain"), flags.alias("dns"), rdap.alias("rdap"),
        F.when(v > 90, "rejected").otherwise("accepted").alias("geo_policy_status"), F.when(v > 90, "no_ips_matched").otherwise("").alias("geo_policy_reason"),
        F.when(k % 37 == 0, "suffix_rule").otherwise("exact_host").alias("input_kind"),
    )


def _judged(spark, sf) -> DataFrame:
    rows = _dns_rows(spark, sf)
    klass = D.host_class(F.col("host"), F.col("registrable_domain"), F.col("rdap"), F.col("dns"))
    out = rows.withColumn("dns_status", D.dns_status(F.col("dns"))).withColumn("classification", klass)
    return out.withColumn("route", D.route(F.col("classification"), F.col("geo_policy_status"), F.lit("")))


_JUDGED_SQL = """
    WITH e AS (
        SELECT event_id, user_id % 2 = 0 AS apex, 'u' || user_id || '.com' AS registrable_domain,
               CASE WHEN value > 90 THEN 'rejected' ELSE 'accepted' END AS geo_policy_status,
               CASE WHEN event_id % 31 = 0 THEN 'timeout' WHEN event_id % 29 = 0 THEN 'servfail' WHEN event_id % 7 = 0 THEN 'nx'
                    WHEN event_id % 7 > 1 THEN 'noerror' ELSE 'nodata' END AS dns_status
        FROM events),
    c AS (
        SELECT *, CASE WHEN apex THEN '' ELSE 'www.' END || registrable_domain AS host,
            CASE WHEN event_id % 17 <> 0 AND event_id % 19 = 0 THEN 'rdap_registrable_domain_unregistered'
                 WHEN dns_status = 'timeout' THEN 'dns_lookup_timeout' WHEN dns_status = 'servfail' THEN 'dns_lookup_servfail'
                 WHEN dns_status = 'nx' THEN CASE WHEN apex THEN 'dns_registered_apex_nxdomain' ELSE 'dns_registered_subdomain_nxdomain' END
                 WHEN dns_status = 'nodata' THEN CASE WHEN apex THEN 'dns_registered_apex_nodata' ELSE 'dns_registered_subdomain_nodata' END
                 WHEN event_id % 17 <> 0 AND event_id % 11 = 0 THEN 'rdap_registered_domain_status_server_hold'
                 ELSE 'dns_resolves' END AS classification
        FROM e),
    j AS (
        SELECT *, CASE WHEN classification = 'rdap_registrable_domain_unregistered' THEN 'dead'
                       WHEN classification = 'dns_resolves' AND geo_policy_status <> 'rejected' THEN 'filtered' ELSE 'review' END AS route
        FROM c)
"""


@query(_JUDGED_SQL + "SELECT event_id, dns_status, classification FROM j")
def classify_cascade(spark, sf):
    return _judged(spark, sf).select("event_id", "dns_status", "classification")


@query(_JUDGED_SQL + "SELECT event_id, host, route FROM j")
def route_rows(spark, sf):
    return _judged(spark, sf).select("event_id", "host", "route")


@query(_JUDGED_SQL + """
    SELECT event_id, host, registrable_domain, dns_status, geo_policy_status,
        CASE WHEN classification = 'rdap_registered_domain_status_server_hold' THEN 'rdap_filtered_out'
             WHEN geo_policy_status = 'rejected' THEN 'geo_filtered_out' ELSE 'dns_filtered_out' END AS classification,
        CASE WHEN geo_policy_status = 'rejected' THEN 'geo policy rejected resolved IPs: no_ips_matched'
             WHEN classification LIKE '%timeout' THEN 'DNS lookup returned timeout'
             WHEN classification LIKE '%servfail' THEN 'DNS lookup returned servfail'
             WHEN classification LIKE '%server_hold' THEN 'RDAP status serverHold indicates the domain should not resolve'
             ELSE CASE WHEN event_id % 37 = 0 THEN 'registered suffix-rule domain' WHEN apex THEN 'registered apex domain' ELSE 'registered subdomain' END
                  || CASE WHEN classification LIKE '%nxdomain' THEN ' returned NXDOMAIN' ELSE ' has no A/AAAA answers' END END AS classification_reason
    FROM j WHERE route = 'review'
""")
def review_projection(spark, sf):
    rows = _judged(spark, sf).filter("route = 'review'")
    made = D.review_columns(rows.columns)
    wanted = ("host", "registrable_domain", "classification", "classification_reason", "dns_status", "geo_policy_status")
    return rows.select("event_id", F.struct(*made).alias("r")).select("event_id", *[f"r.{n}" for n in wanted])


@query(_JUDGED_SQL + "SELECT route, classification, count(*) AS n FROM j GROUP BY ROLLUP (route, classification) HAVING route IS NOT NULL")
def route_counts(spark, sf):
    from ..operators.screening import outcome_counts

    return outcome_counts(_judged(spark, sf))


def _addresses(spark, sf) -> DataFrame:
    """Each lineitem as an address of its order, with the supplier's nation."""
    lines = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("host"), "l_linenumber", F.col("l_suppkey").alias("ip"))
    named = _t(spark, sf, "supplier").join(_t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("ip"), F.col("n_name").alias("country_code"))
    return lines.join(named, "ip")


_ADDRESSES_SQL = """a AS (SELECT l_orderkey AS host, l_linenumber, l_suppkey AS ip, n_name AS country_code
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def _results(spark, sf) -> DataFrame:
    one = F.struct(F.col("l_linenumber"), F.col("ip").cast("string").alias("ip"), F.col("country_code"), F.lit("").alias("region_code"), F.lit("").alias("region_name"), F.lit("ok").alias("status"))
    return _addresses(spark, sf).groupBy("host").agg(F.array_sort(F.collect_list(one)).alias("results"))


@query(f"WITH {_ADDRESSES_SQL} SELECT host, string_agg(ip || ':' || country_code, ',' ORDER BY l_linenumber, ip::VARCHAR) AS answers FROM a GROUP BY host")
def geo_fanout(spark, sf):
    return _results(spark, sf).select("host", F.array_join(F.transform("results", lambda r: F.concat_ws(":", r["ip"], r["country_code"])), ",").alias("answers"))


# Names of nations follow a numbered form in the test tables; sets are picked by the first and last of them.
_INCLUDE, _EXCLUDE = "n_nationkey % 5 <> 0", "n_nationkey % 7 = 3"


def _policy(spark, sf, match: str) -> G.Policy:
    names = lambda where: [r[0] for r in _t(spark, sf, "nation").filter(where).select("n_name").orderBy("n_name").collect()]
    return G.Policy(True, match, G.Rules(names(_INCLUDE)), G.Rules(names(_EXCLUDE)))


_POLICY_SQL = f"""WITH {_ADDRESSES_SQL}, n AS (SELECT n_name, ({_INCLUDE}) AND NOT ({_EXCLUDE}) AS fine FROM nation)
    SELECT host, CASE WHEN {{0}} THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN {{0}} THEN '{{1}}' ELSE '{{2}}' END AS reason
    FROM a JOIN n ON country_code = n_name GROUP BY host"""


def _decided(spark, sf, match: str) -> DataFrame:
    made = _results(spark, sf).withColumn("g", G.decision(_policy(spark, sf, match), F.col("results")))
    return made.select("host", F.col("g.geo_policy_status").alias("status"), F.col("g.geo_policy_reason").alias("reason"))


@query(_POLICY_SQL.format("bool_and(fine)", "all_ips_matched", "one_or_more_ips_rejected"))
def geo_policy_all(spark, sf):
    return _decided(spark, sf, "all_ips")


@query(_POLICY_SQL.format("bool_or(fine)", "at_least_one_ip_matched", "no_ips_matched"))
def geo_policy_any(spark, sf):
    return _decided(spark, sf, "any_ip")


@query(f"WITH {_ADDRESSES_SQL} SELECT host, string_agg(DISTINCT country_code, ',' ORDER BY country_code) AS countries FROM a GROUP BY host")
def geo_sets(spark, sf):
    return _results(spark, sf).select("host", F.array_join(D.sorted_distinct(F.transform("results", lambda r: r["country_code"])), ",").alias("countries"))


@query("SELECT s_suppkey, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 3 AS chunk FROM supplier")
def bulk_chunks(spark, sf):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    return _t(spark, sf, "supplier").select("s_suppkey", F.floor((n - 1) / 3).alias("chunk"))


@query("SELECT DISTINCT l_suppkey AS ip FROM lineitem")
def unique_ip_coalesce(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("ips"))
    return L.unique_keys(rows, "ips")


@query("SELECT s_suppkey AS root, s_nationkey AS server, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS turn FROM supplier")
def round_robin(spark, sf):
    rows = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("root"), F.col("s_nationkey").alias("server"), F.col("s_suppkey").alias("first_seen"))
    return B.interleaved(rows, keep=kept(spark, "turns")).select("root", "server", F.col("turn").cast("long").alias("turn"))


@query()
def balanced_assignment(spark, sf):
    groups = _t(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("hosts"))
    roots = groups.select(F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("root"), F.col("c_mktsegment").alias("server"), "hosts")
    return B.balanced_assignment(roots, 5)


@query()
def idna_normalise(spark, sf):
    words = _t(spark, sf, "documents").select(F.explode(F.split("text", r"[^\p{L}]+")).alias("word")).distinct()
    foreign = words.filter(~X.is_ascii(F.col("word")))
    return foreign.select("word", X.idna_host(F.col("word")).alias("host"))


@query("SELECT event_id, coalesce(props ->> '$.country', '') AS country, coalesce(props ->> '$.page', '') AS page FROM events")
def props_json(spark, sf):
    get = lambda k: F.coalesce(F.get_json_object("props", f"$.{k}"), F.lit("")).alias(k)
    return _t(spark, sf, "events").select("event_id", get("country"), get("page"))


@query("""
    WITH s AS (SELECT user_id AS batch_id, CASE event_id % 9 WHEN 0 THEN 'in_progress' WHEN 1 THEN 'failure' ELSE 'success' END AS conclusion FROM events)
    SELECT batch_id, count(*) FILTER (conclusion = 'success') AS success, count(*) FILTER (conclusion = 'failure') AS failure, count(*) FILTER (conclusion = 'in_progress') AS open,
           CASE WHEN count(*) FILTER (conclusion = 'in_progress') > 0 THEN 'not_ready' WHEN count(*) FILTER (conclusion = 'failure') > 0 THEN 'ready_failed' ELSE 'ready_success' END AS state
    FROM s GROUP BY batch_id
""")
def readiness(spark, sf):
    conclusion = F.when(F.col("event_id") % 9 == 0, "in_progress").when(F.col("event_id") % 9 == 1, "failure").otherwise("success")
    return B.readiness(_t(spark, sf, "events").select(F.col("user_id").alias("batch_id"), conclusion.alias("conclusion")))


@query(f"""
    WITH h AS (SELECT page_id, host, string_split(host, '.') AS l FROM ({_HOSTS_SQL}))
    SELECT array_to_string(l[-2:], '.') AS registrable_domain, count(DISTINCT host) AS hosts FROM h GROUP BY 1
""")
def root_groups(spark, sf):
    found = S.with_public_suffix(_hosts(spark, sf).select("host").distinct(), S.public_suffix_rules(spark))
    return P.root_groups(found)[0]
