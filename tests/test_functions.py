"""Column functions against tables of cases."""

import pytest
from pyspark.sql import functions as F

from hostsift.functions import geo as G
from hostsift.functions import text as X
from hostsift.functions import verdicts as D
from hostsift.operators import prepare as P


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.select("k", make(F.col("v")).alias("o")).orderBy("k").select("o").collect()]


def test_comments(spark):
    lines = ["example.com", "# note", "! note", "example.com##.ad", "", "a.com # x", "a.com ! y # z", "　a.com ", "a#@#b"]
    assert column(spark, lines, X.without_comments) == ["example.com", "", "", "", "", "a.com", "a.com", "a.com", ""]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("example.com", "plain"), ("0.0.0.0 example.com", "hosts"), ("127.1 example.com", "unknown"), ("||example.com^", "adblock"), ("@@||example.com^", "adblock"),
        ("||example.com^$third-party", "unknown"), ("server=/example.com/8.8.8.8", "dnsmasq"), ("fe80::1%lo0 a.com", "hosts"), ("münchen.de", "plain"), ("010.0.0.1 a.com", "unknown"),
    ],
)
def test_line_format(spark, raw, want):
    lines = spark.createDataFrame([("s", 0, 0, raw)], "source_id string, source_index int, line_index int, raw_line string")
    assert P.with_line_format(lines).first()["line_format"] == want


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        (["a.com", "b.com"], "plain"), (["a.com", "0.0.0.0 b.com", "||x^$y"], "mixed"), (["a.com", "||x^$y", "0.0.0.0 b.com"], "unknown"),
        (["0.0.0.0 a.com"], "hosts"), (["||x^$y"], "unknown"),
    ],
)
def test_file_format(spark, lines, want):
    rows = spark.createDataFrame([("s", 0, k, v) for k, v in enumerate(lines)], "source_id string, source_index int, line_index int, raw_line string")
    assert [r["source_format"] for r in P.source_formats(P.with_line_format(rows)).collect()] == [want]


def test_rules(spark):
    rows = [("0.0.0.0 a.com b.com", "hosts"), ("||*.a.com^", "adblock"), ("server=/.a.com/1.1.1.1", "dnsmasq"), ("||a.com^", "adblock"), ("a.com", "plain")]
    df = spark.createDataFrame(rows, "c string, f string")
    got = df.select(X.rule_scope(X.rule_name(F.col("c"), F.col("f")), F.col("f")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [
        ("a.com", "exact_host", "exact_only"), ("a.com", "suffix_rule", "exclude_apex"), ("a.com", "suffix_rule", "exclude_apex"),
        ("a.com", "suffix_rule", "include_apex"), ("a.com", "exact_host", "exact_only"),
    ]


def test_names(spark):
    names = ["Example.COM.", "a..b", ".foo", "x" * 64 + ".com", "a_b.com", "-a.com", "com", ""]
    assert column(spark, names, X.ascii_host) == ["example.com", "", "", "", "a_b.com", "-a.com", "com", ""]
    assert column(spark, ["münchen.de", "straße.de", "a..ü", None], X.idna_host) == ["xn--mnchen-3ya.de", "strasse.de", "", None]
    assert column(spark, ["a.com", "a_b.com", "-a.com", "a-.com", "com", "", "a" * 63 + ".x", "a" * 64, "a.com "], X.valid_host) == [True, False, False, False, True, False, True, False, False]


DNS = "a_exists boolean, a_nodata boolean, a_nxdomain boolean, a_timeout boolean, a_servfail boolean, canonical_name string, ipv4_addresses array<string>, ipv6_addresses array<string>"


@pytest.mark.parametrize(
    ("host", "flags", "rdap", "status", "klass"),
    [
        ("a.com", "t", (True, []), "timeout", "dns_lookup_timeout"), ("a.com", "es", (True, []), "servfail", "dns_lookup_servfail"),
        ("a.com", "x", (True, []), "nx", "dns_registered_apex_nxdomain"), ("x.a.com", "x", (True, []), "nx", "dns_registered_subdomain_nxdomain"),
        ("a.com", "d", (True, []), "nodata", "dns_registered_apex_nodata"), ("a.com", "e", (True, []), "noerror", "dns_resolves"),
        ("a.com", "", None, "error", "dns_resolves"), ("a.com", "e", (True, ["clientHold"]), "noerror", "rdap_registered_domain_status_client_hold"),
        ("a.com", "e", (True, ["client hold"]), "noerror", "dns_resolves"), ("a.com", "e", (True, ["pendingDelete", "serverHold"]), "noerror", "rdap_registered_domain_status_server_hold"),
        ("a.com", "t", (False, []), "timeout", "rdap_registrable_domain_unregistered"),
    ],
)
def test_classes(spark, host, flags, rdap, status, klass):
    dns = (*[c in flags for c in "edxts"], None, ["192.0.2.1"], [])
    row = spark.createDataFrame([(host, "a.com", rdap, dns)], f"host string, root string, rdap struct<exists boolean, statuses array<string>>, dns struct<{DNS}>")
    got = row.select(D.dns_status(F.col("dns")).alias("s"), D.host_class(F.col("host"), F.col("root"), F.col("rdap"), F.col("dns")).alias("c")).first()
    assert tuple(got) == (status, klass)


ANSWER = "struct<exists boolean, nodata boolean, nxdomain boolean, timeout boolean, servfail boolean, cname string, addresses array<string>>"


def answer(flags="", cname=None, *addresses):
    return (*[c in flags for c in "edxts"], cname, list(addresses))


@pytest.mark.parametrize(
    ("a", "aaaa", "cname", "want"),
    [
        (answer("e", None, "1.1.1.1"), answer("s"), answer(), "es"),
        (answer("e", None, "1.1.1.1"), answer("t"), answer(), "e"),
        (answer("d"), answer("x"), answer(), "x"),
        (answer("d"), answer("d"), answer("e", "c.com"), "e"),
        (answer("d"), answer("d"), answer("d"), "d"),
        (answer("t"), answer("t"), answer("s"), "s"),
        (answer("t"), answer(), answer(), "t"),
        (answer("x"), answer("e", None, "::1"), answer("e", "c"), "x"),
    ],
)
def test_record_types_combine(spark, a, aaaa, cname, want):
    row = spark.createDataFrame([(a, aaaa, cname)], f"a {ANSWER}, b {ANSWER}, c {ANSWER}")
    got = row.select(D.combined_answer(F.col("a"), F.col("b"), F.col("c")).alias("r")).first()["r"]
    assert "".join(k for k, n in zip("edxts", ("a_exists", "a_nodata", "a_nxdomain", "a_timeout", "a_servfail"), strict=True) if got[n]) == want


@pytest.mark.parametrize(
    ("countries", "match", "include", "exclude", "want"),
    [
        ("CN CN", "all_ips", "CN", "", ("accepted", "all_ips_matched")), ("CN CN", "any_ip", "CN", "", ("accepted", "at_least_one_ip_matched")),
        ("CN US", "all_ips", "CN", "", ("rejected", "one_or_more_ips_rejected")), ("CN US", "any_ip", "CN", "", ("accepted", "at_least_one_ip_matched")),
        ("US", "any_ip", "CN", "", ("rejected", "no_ips_matched")), ("CN !", "all_ips", "CN", "", ("accepted", "all_ips_matched")),
        ("!", "all_ips", "CN", "", ("skipped", "geo_lookup_failed")), ("CN", "any_ip", "CN", "CN", ("rejected", "no_ips_matched")),
        ("CN", "any_ip", "", "", ("skipped", "policy_has_no_rules")),
    ],
)
def test_geo_policy(spark, countries, match, include, exclude, want):
    results = [(str(k), c, "", "", "request_failed" if c == "!" else "ok") for k, c in enumerate(countries.split())]
    df = spark.createDataFrame([(results,)], "r array<struct<ip string, country_code string, region_code string, region_name string, status string>>")
    policy = G.Policy(True, match, G.Rules(include.split()), G.Rules(exclude.split()))
    got = df.select(G.decision(policy, F.col("r")).alias("g")).first()["g"]
    assert (got["geo_policy_status"], got["geo_policy_reason"]) == want
