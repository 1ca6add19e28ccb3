"""Operators on small relations."""

import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from hostsift.functions import geo as G
from hostsift.operators import batch as B
from hostsift.operators import buckets as U
from hostsift.operators import cache as C
from hostsift.operators import lifecycle as Y
from hostsift.operators import lookup as L
from hostsift.operators import prepare as P
from hostsift.operators import screening as R
from hostsift.operators import sinks as K
from hostsift.operators import suffixes as S
from hostsift.sources import config as N
from hostsift.sources import lists, tables
from hostsift.streaming import ingest

def now():
    return F.to_timestamp(F.lit("2024-01-10 00:00:00"))


@pytest.fixture(scope="module")
def rules(spark):
    return S.public_suffix_rules(spark).cache()


def test_public_suffixes(spark, rules):
    hosts = ["a.b.co.uk", "x.foo.eu.org", "www.city.kawasaki.jp", "a.b.c.kawasaki.jp", "com", "a.unknowntld", "", "example.com"]
    got = {r["host"]: r for r in S.with_public_suffix(spark.createDataFrame([(h,) for h in hosts], "host string"), rules).collect()}
    assert {h: (r["public_suffix"], r["registrable_domain"], r["is_public_suffix_input"]) for h, r in got.items()} == {
        "a.b.co.uk": ("co.uk", "b.co.uk", False), "x.foo.eu.org": ("eu.org", "foo.eu.org", False), "www.city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp", False),
        "a.b.c.kawasaki.jp": ("c.kawasaki.jp", "b.c.kawasaki.jp", False), "com": ("com", "", True), "example.com": ("com", "example.com", False),
    }


def test_bootstrap(spark):
    body = '{"services": [[["COM", "net"], ["http://b/", "https://z/", "https://a/", "https://no"]], [["co.uk"], ["https://uk/"]], [["net"], ["https://n/"]]]}'
    services = S.bootstrap_services(spark.createDataFrame([(body,)], "body string"))
    assert {r["suffix"]: r["urls"] for r in services.collect()} == {"com": ["https://a/", "https://z/", "http://b/"], "net": ["https://n/"], "co.uk": ["https://uk/"]}
    roots = spark.createDataFrame([("x.com",), ("y.co.uk",), ("z.zz",)], "registrable_domain string")
    assert {r[0]: r[1] for r in S.with_server(roots, services).collect()} == {"x.com": "https://a/", "y.co.uk": "https://uk/", "z.zz": None}


def lines_of(spark, sources):
    rows = [(s, k, s, n, line) for k, (s, lines) in enumerate(sources.items()) for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, lists.LINES_SCHEMA)


def test_parsing(spark, rules):
    raw = {"plain": ["# c", "A.com", "a.com", "b.a.com."], "rules": ["||x.com^", "||*.x.com^", "||x.com^"], "bad": ["a.com", "0.0.0.0 b.com"], "empty": ["! x"]}
    got = {(r["source_id"], r["host"], r["apex_scope"], r["line_index"]) for r in P.parse_lines(lines_of(spark, raw), rules).collect()}
    assert got == {("plain", "a.com", "exact_only", 1), ("plain", "b.a.com", "exact_only", 3), ("rules", "x.com", "include_apex", 0), ("rules", "x.com", "exclude_apex", 1)}
    forced = P.parse_lines(lines_of(spark, {"m": ["ok.com", "0.0.0.0 b.com", "not a host"]}), rules, "plain")
    assert [r["host"] for r in forced.collect()] == ["ok.com"]


def test_overrides_and_collapse(spark, rules):
    entries = P.parse_lines(lines_of(spark, {"s1": ["a.com", "b.com", "c.com"], "s2": ["a.com", "d.com"]}), rules)
    parse = lambda kind, names: P.parse_lines(lines_of(spark, {kind: names}), rules, "plain")
    passes, outs, adds = parse("manual_filter_pass", ["b.com", "no.com"]), parse("manual_filter_out", ["a.com", "gone.com"]), parse("manual_add", ["d.com", "new.com"])
    prepared, removed, unmatched = P.apply_overrides(entries, passes, outs, adds)
    assert {r["host"]: (r["source_ids"], r["manual_filter_pass"], r["manual_add"]) for r in prepared.collect()} == {
        "b.com": (["s1"], True, False), "c.com": (["s1"], False, False), "d.com": (["s2"], False, True), "new.com": (["manual_add"], False, True),
    }
    assert [(r["host"], r["source_ids"]) for r in removed.collect()] == [("a.com", ["s1", "s2"])]
    assert {tuple(r) for r in unmatched.collect()} == {("no.com", "manual_filter_pass_not_in_sources"), ("gone.com", "manual_filter_out_not_in_sources")}
    assert P.overlap_errors(passes, outs, passes.unionByName(outs))[0].startswith("b.com is in both manual_filter_pass")
    with pytest.raises(P.PreparationError):
        P.checked(["x"])


def test_conflicts(spark):
    rows = [("h", 0, 0, "s1", "p"), ("h", 1, 0, "s2", "q"), ("h", 2, 0, "s3", "r"), ("k", 0, 1, "s1", "p"), ("k", 1, 1, "s2", "p")]
    df = spark.createDataFrame(rows, "host string, source_index int, line_index int, source_id string, fingerprint string")
    assert [tuple(r) for r in P.profile_conflicts(df).collect()] == [("h", "s1", "s2")]


def test_cache(spark):
    row = "k string, v string, checked_at timestamp, expires_at timestamp"
    table = lambda *rows: spark.createDataFrame([(k, v, c, e) for k, v, c, e in rows], "k string, v string, c string, e string").select("k", "v", F.to_timestamp("c").alias("checked_at"), F.to_timestamp("e").alias("expires_at"))
    over = table(("a", "over", "2024-01-01", "2024-02-01"), ("b", "over", "2024-01-01", "2024-01-09"))
    base = table(("a", "base", "2024-01-05", "2024-03-01"), ("b", "base", "2024-01-01", "2024-02-01"), ("c", "base", "2024-01-01", "2024-01-10"))
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    found = C.layered(keys, over, base, ["k"], now())
    assert {r["k"]: (r["hit"]["v"] if r["hit"] else None, r["hit_source"]) for r in found.collect()} == {"a": ("over", "overlay"), "b": ("base", "baseline"), "c": (None, None)}
    assert C.counters(found).first().asDict() == {"hits": 2, "misses": 1, "overlay_hits": 1, "baseline_hits": 1}
    assert [r["k"] for r in C.misses(found).collect()] == ["c"]
    assert sorted(r["v"] for r in C.upsert(base, over, ["k"]).collect()) == ["base", "over", "over"] and row
    assert [r["k"] for r in C.delete(over, keys.filter("k = 'a'"), ["k"]).collect()] == ["b"]
    assert {r["k"]: r["v"] for r in C.merge_latest(over.unionByName(base), ["k"]).collect()} == {"a": "base", "b": "base", "c": "base"}
    stamped = C.stamped(keys, now(), F.lit(7)).first()
    assert (stamped["expires_at"] - stamped["checked_at"]).days == 7
    lists_ = spark.createDataFrame([('["a","b"]',), ("[1,\"x\"]",), ("bad",), ('{"a":1}',), (None,)], "j string")
    assert [r[0] for r in lists_.select(C.json_list(F.col("j"))).collect()] == [["a", "b"], ["x"], [], [], []]


def test_lookups(spark):
    answers = spark.createDataFrame([("a.com", 200, '{"status": ["ok"], "x": [{"status": "clientHold"}]}'), ("b.com", 404, ""), ("c.com", 500, ""), ("d.com", 501, "")], "registrable_domain string, http_status int, body string")
    asked = []
    keys = spark.createDataFrame([("a.com",), ("a.com",), ("b.com",)], "registrable_domain string")

    def provider(df):
        asked.append(df.count())
        return L.fixture(answers, ["registrable_domain"])(df)

    all_, live = L.looked_up(keys, ["registrable_domain"], now(), provider)
    assert asked == [2] and all_.count() == live.count() == 2
    parsed = {r["registrable_domain"]: (r["exists"], r["statuses"], r["cacheable"]) for r in L.parsed_rdap(answers).collect()}
    assert parsed == {"a.com": (True, ["clientHold", "ok"], True), "b.com": (False, [], True), "c.com": (None, [], False), "d.com": (None, [], True)}
    verdicts = L.rdap_verdicts(keys, L.parsed_rdap(answers)).collect()
    assert [r["rdap"]["exists"] for r in verdicts if r[0] == "a.com"] == [True, True]
    hosts = spark.createDataFrame([("h", ["2", "1", "2"]), ("g", ["9"])], "host string, ips array<string>")
    geo = spark.createDataFrame([("1", "CN", "ok"), ("2", "US", "ok")], "ip string, country_code string, status string")
    joined = {r["host"]: [(x["ip"], x["country_code"], x["status"]) for x in r["results"]] for r in L.rejoined(hosts, geo, "host", "ips").collect()}
    assert joined == {"h": [("2", "US", "ok"), ("1", "CN", "ok"), ("2", "US", "ok")], "g": [("9", None, "invalid_payload")]}
    assert L.unique_keys(hosts, "ips").count() == 3
    assert L.bulk_chunks(geo, "ip", 1).select("chunk").distinct().count() == 2
    replies = iter([(503, "", None), (429, "", 500.0), (200, "fine", None)])
    waits = []
    assert L.with_retries(lambda: next(replies), sleep=waits.append) == (200, "fine") and len(waits) == 2 and waits[1] == 120.0
    ask = L.per_partition(lambda: lambda key: {"n": len(key["registrable_domain"])}, "registrable_domain string, n long")
    assert {r["n"] for r in ask(keys).collect()} == {5}


def test_bulk_rows_match_in_order(spark):
    asked = spark.createDataFrame([("1", 0), ("1", 1), ("1", 2), ("2", 3)], "ip string, pos int")
    back = spark.createDataFrame([("1", 0, "x", "ok"), ("2", 1, "y", "ok"), ("1", 2, "z", "ok")], "ip string, row int, country_code string, status string")
    got = {r["pos"]: (r["country_code"], r["status"]) for r in L.matched_bulk(asked, back).collect()}
    assert got == {0: ("x", "ok"), 1: ("z", "ok"), 2: (None, "invalid_payload"), 3: ("y", "ok")}


CASES = [
    # suffix, rdap, add, pass, dns_enabled, ips -> class, route
    (True, (True, []), False, True, True, ["1"], "input_public_suffix", "review"),
    (False, (False, []), True, False, True, ["1"], "manual_add_unregistered", "review"),
    (False, (True, []), True, False, True, ["1"], "manual_add_registered", "filtered"),
    (False, (False, []), False, True, True, ["1"], "rdap_registrable_domain_unregistered", "dead"),
    (False, None, False, True, True, ["1"], "manual_filter_passed", "filtered"),
    (False, (True, []), False, False, False, ["1"], "rdap_registrable_domain_registered_dns_disabled", "filtered"),
    (False, None, False, False, False, ["1"], "rdap_lookup_unavailable_dns_disabled", "review"),
    (False, (True, []), False, False, True, [], "dns_resolved_without_ip_addresses", "review"),
    (False, (True, []), False, False, True, ["1"], "dns_resolves", "filtered"),
    (False, (True, []), False, False, True, ["9"], "geo_policy_rejected", "review"),
]


def test_decision_chain(spark, tmp_path):
    dns = lambda ips: (True, False, False, False, False, None, ips, [])
    geo = lambda ips: [(i, "US" if i == "9" else "CN", "", "", "ok") for i in ips]
    rows = [(f"h{k}.com", f"h{k}.com", s, r, a, p, d, True, dns(ips), geo(ips), "exact_host", ["s"], ["s"]) for k, (s, r, a, p, d, ips, _, _) in enumerate(CASES)]
    schema = """host string, registrable_domain string, is_public_suffix_input boolean, rdap struct<exists boolean, statuses array<string>>, manual_add boolean, manual_filter_pass boolean,
        dns_enabled boolean, geo_enabled boolean, dns struct<a_exists boolean, a_nodata boolean, a_nxdomain boolean, a_timeout boolean, a_servfail boolean, canonical_name string, ipv4_addresses array<string>,
        ipv6_addresses array<string>>, results array<struct<ip string, country_code string, region_code string, region_name string, status string>>, input_kind string, source_ids array<string>, source_input_labels array<string>"""
    df = spark.createDataFrame(rows, schema)
    out = R.terminal_rows(R.with_geo(R.classified(R.before_dns(df)), G.Policy(True, "any_ip", G.Rules(["CN"]))), "ipinfo_lite")
    got = {r["host"]: (r["classification"], r["route"]) for r in out.collect()}
    assert got == {f"h{k}.com": c[6:] for k, c in enumerate(CASES)}
    manifest = K.publish(out, f"{tmp_path}/out", "direct")
    assert manifest["counts"] == {"filtered": 4, "dead": 1, "review": 5}
    out_of = lambda: K.published(spark, f"{tmp_path}/out", "direct")
    hosts = [r[0] for r in spark.read.text(out_of()["filtered"]).collect()]
    assert hosts == sorted(hosts) and len(hosts) == 4
    review = tables.review_csv(spark, out_of()["review"])
    assert review.count() == 5 and review.filter("classification_reason like 'geo policy rejected%'").count() == 1
    assert spark.read.text(out_of()["audit"]).count() == len(CASES)
    part = K.publish(out, f"{tmp_path}/out", "direct", complete=False, snapshot_root=f"{tmp_path}/snap")
    assert not part["complete"] and spark.read.text(out_of()["filtered"]).count() == 4 and spark.read.text(part["outputs"]["filtered"]).count() == 4
    first = out_of()["filtered"]
    K.publish(out.filter("route = 'dead'"), f"{tmp_path}/out", "direct")
    assert spark.read.text(out_of()["filtered"]).count() == 0 and set(out_of()) == {"filtered", "dead", "audit"} and spark.read.text(first).count() == 4
    K.publish(out, f"{tmp_path}/out", "direct")
    assert spark.read.text(out_of()["filtered"]).count() == 4 and not os.path.exists(first.removeprefix("file:"))
    with pytest.raises(B.DuplicateRows):
        K.host_list(out.unionByName(out), "dead")


def test_batches(spark):
    roots = spark.createDataFrame([("r1", "s1", 1), ("r2", "s1", 3), ("r5", "s1", 4), ("r3", "s2", 2), ("r4", None, 0)], "root string, server string, first_seen int")
    assert [r["root"] for r in B.interleaved(roots).collect()] == ["r1", "r3", "r2", "r5", "r4"]
    groups = spark.createDataFrame([(f"r{k}", f"s{k % 3}", k + 1) for k in range(30)], "root string, server string, hosts int")
    for made in (B.balanced_assignment(groups, 4), B.spread_assignment(groups, 4)):
        assert made.join(groups.select("root", F.col("hosts").alias("n")), "root").groupBy("worker").agg(F.sum("n").alias("n")).count() == 4 and made.count() == 30
    loads = sorted(r["n"] for r in B.balanced_assignment(groups, 4).join(groups, "root").groupBy("worker").agg(F.sum("hosts").alias("n")).collect())
    assert loads[-1] - loads[0] <= 30 and sum(loads) == sum(B.greedy_loads(list(range(1, 31)), 4))
    statuses = spark.createDataFrame([("a", "success"), ("a", None), ("b", "success"), ("b", "failure"), ("c", "success")], "batch_id string, conclusion string")
    assert {r["batch_id"]: r["state"] for r in B.readiness(statuses).collect()} == {"a": "not_ready", "b": "ready_failed", "c": "ready_success"}
    assert B.same_members(groups, groups, "root") and not B.same_members(groups, groups.filter("hosts > 1"), "root")
    with pytest.raises(B.DuplicateRows):
        B.merged([groups, groups.limit(1)], ["root"], "root")
    assert B.worker_count(18, 2, 1) == 3


def test_sharded_merge_equals_whole(spark):
    whole = spark.createDataFrame([(f"h{k}", k) for k in range(50)], "host string, n int")
    shards = [whole.filter(F.col("n") % 4 == k) for k in range(4)]
    assert sorted(map(tuple, B.merged(shards, ["host"], "host").collect())) == sorted(map(tuple, whole.collect()))


def test_config():
    raw = {"version": 2, "defaults": {"geo": {"token": "t"}}, "sources": [
        {"id": "a", "input": {"type": "file", "location": "x/*.txt"}, "dns": {"nameservers": ["1.1.1.1"], "ecs": {"enabled": True, "subnet": "10.1.2.3/24"}}},
        {"id": "b", "input": {"type": "url", "location": "http://x", "label": "L"}, "geo": {"enabled": True, "policy": {"enabled": True, "include": {"regions": [" New  York "]}}}},
    ]}
    (a, b), cache = N.parse_config(raw)
    assert a.resolver_key() == "8.8.8.8,8.8.4.4,2001:4860:4860::8888,2001:4860:4860::8844|ecs=10.1.2.0/24@0" and b.resolver_key() == "system|ecs=off"
    assert (a.label, b.label) == ("x/*.txt", "L") and cache["dns_ttl_days"] == 1
    assert N.geo_provider(b.settings["geo"]) == "geojs" and b.policy().include.region_names == ["new york"]
    assert a.execution_profile() != b.execution_profile() and a.rdap_profile() == b.rdap_profile()
    for bad in (
        {"version": 1, "sources": raw["sources"]}, {"version": 2, "sources": []}, {**raw, "extra": 1}, {"version": 2, "sources": [{"id": "a", "input": {"type": "ftp", "location": "x"}}]},
        {"version": 2, "sources": [{"id": "a", "input": raw["sources"][0]["input"], "dns": {"enabled": False}, "geo": {"enabled": True}}]},
        {"version": 2, "sources": [{"id": "a", "input": raw["sources"][0]["input"], "geo": {"enabled": True, "policy": {"include": {"regions": ["US-NY"]}}}}]},
    ):
        with pytest.raises(N.ConfigError):
            N.parse_config(bad)


def test_sources(spark, tmp_path, rules):
    (tmp_path / "a.txt").write_bytes("one.com\r\ntwo.com\x0bthree.com four.com\n".encode())
    (tmp_path / "b.txt").write_text("five.com")
    paths = lists.matching_paths(spark, f"{tmp_path}/*.txt")
    rows = lists.text_lines(spark, paths, "s").orderBy("line_index").collect()
    assert [(r["line_index"], r["raw_line"]) for r in rows] == list(enumerate(["one.com", "two.com", "three.com", "four.com", "five.com"]))
    assert lists.matching_paths(spark, f"{tmp_path}/none*") == []
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "sub" / "deep" / "c.txt").write_text("six.com")
    assert [os.path.basename(p) for p in lists.matching_paths(spark, f"{tmp_path}/**/*.txt")] == ["a.txt", "b.txt", "c.txt"]
    assert lists.matching_paths(spark, f"{tmp_path}/nowhere/**/*.txt") == []
    (source,), _ = N.parse_config({"version": 2, "sources": [{"id": "u", "input": {"type": "url", "location": "mem:"}}]})
    assert [r["raw_line"] for r in lists.source_lines(spark, [source], lambda url, timeout: "x.com\ny.com").collect()] == ["x.com", "y.com"]

    def failing(url, timeout):
        raise OSError

    assert lists.source_lines(spark, [source], failing).count() == 0
    assert lists.override_lines(spark, str(tmp_path), "direct")["manual_add"].count() == 0


def test_sqlite(spark, tmp_path):
    path = f"{tmp_path}/c.sqlite3"
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE geo_history (provider TEXT, ip TEXT, country_code TEXT, region_code TEXT, region_name TEXT, checked_at TEXT, expires_at TEXT, PRIMARY KEY (provider, ip))")
        c.executemany("INSERT INTO geo_history VALUES ('p', ?, 'CN', '', '', 'x', 'y')", [(str(k),) for k in range(100)])
    df = tables.sqlite_table(spark, path, "geo_history", partitions=4)
    assert df.count() == 100 and df.select("ip").distinct().count() == 100


def test_stream(spark, tmp_path, rules):
    (tmp_path / "in").mkdir()
    for k, text in enumerate(["a.com\nb.com\n", "b.com\nc.com\n"]):
        (tmp_path / "in" / f"{k}.txt").write_text(text)
        ingest.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/state", rules).awaitTermination(120)
    got = {r["host"]: r["batch"] for r in U.read(spark, f"{tmp_path}/table").collect()}
    assert set(got) == {"a.com", "b.com", "c.com"} and got["b.com"] < got["c.com"]


def test_run_from_files_to_caches(spark, tmp_path):
    """A configuration from its sources to published lists; the second run asks no provider."""
    pytest.importorskip("yaml")
    from hostsift import cli
    from hostsift.operators import run

    (tmp_path / "a.txt").write_text("a.com\nwww.b.com\ndead.com\ngone.com\n")
    (tmp_path / "b.txt").write_text("||a.com^\n||c.org^\n")
    for kind, text in (("manual_filter_out", "gone.com\nabsent.com"), ("manual_add", "mine.com")):
        (tmp_path / "over" / kind).mkdir(parents=True)
        (tmp_path / "over" / kind / "direct.txt").write_text(text)
    (tmp_path / "direct.yaml").write_text(f"""
version: 2
defaults: {{geo: {{token: t}}}}
sources:
  - {{id: one, input: {{type: file, location: {tmp_path}/a.txt}}, geo: {{enabled: true, policy: {{enabled: true, include: {{countries: [CN]}}}}}}}}
  - {{id: two, input: {{type: file, location: {tmp_path}/b.txt, format: adblock}}, geo: {{enabled: true, policy: {{enabled: true, include: {{countries: [CN]}}}}}}}}
""")
    asked = {"rdap": 0, "dns": 0, "geo": 0}

    def counted(name, provider):
        def ask(keys):
            asked[name] += keys.count()
            return provider(keys)
        return ask

    none = F.array().cast("array<string>")
    host = F.col("host")
    dns = lambda keys: keys.select(
        "host", "resolver_key", F.lit(True).alias("a_exists"), *[F.lit(False).alias(c) for c in ("a_nodata", "a_nxdomain", "a_timeout", "a_servfail")],
        F.lit(None).cast("string").alias("canonical_name"), F.array(F.when(host == "c.org", "9").otherwise("1")).alias("ipv4_addresses"), none.alias("ipv6_addresses"),
    )
    providers = {
        "rdap": counted("rdap", lambda keys: keys.select("registrable_domain", (F.col("registrable_domain") != "dead.com").alias("exists"), none.alias("statuses"), F.lit(True).alias("cacheable"))),
        "dns": counted("dns", dns),
        "geo": counted("geo", lambda keys: keys.select("provider", "ip", F.when(F.col("ip") == "9", "US").otherwise("CN").alias("country_code"), F.lit("").alias("region_code"), F.lit("").alias("region_name"), F.lit("ok").alias("status"))),
    }
    for again in range(2):
        manifest = cli.run_config(spark, f"{tmp_path}/direct.yaml", f"{tmp_path}/root", providers, f"{tmp_path}/over", f"2024-01-0{again + 1} 00:00:00")
        assert manifest["counts"] == {"filtered": 3, "dead": 1, "review": 3}
        files = K.published(spark, f"{tmp_path}/root/output", "direct")
        assert [r[0] for r in spark.read.text(files["filtered"]).collect()] == ["a.com", "mine.com", "www.b.com"]
        classes = {r["host"]: r["classification_reason"] for r in tables.review_csv(spark, files["review"]).collect()}
        assert set(classes) == {"absent.com", "gone.com", "c.org"} and classes["gone.com"] == "manual filter-out host was explicitly rejected"
        assert asked == ({"rdap": 5, "dns": 3, "geo": 2} if not again else {"rdap": 5, "dns": 6, "geo": 2})  # DNS rows live one day
    done = []
    entries = spark.createDataFrame([(f"r{k}.com",) for k in range(20)], "registrable_domain string")
    clock = iter([0, 1, 2, 9]).__next__
    assert not run.screened_within(entries, 5, 4, lambda df, k: done.append((k, df.count())), clock) and [k for k, _ in done] == [0, 1]
    done.clear()
    assert run.screened_within(entries, 5, 4, lambda df, k: done.append(df.count())) and sum(done) == 20


def test_life_cycle(spark, tmp_path):
    root, workers = f"{tmp_path}/state", ["w1", "w2"]
    state = lambda: Y.finish(spark, root, "b1", workers, "2024-01-01T00:00:00Z")
    Y.set_status(spark, root, "b1", "w1")
    assert state() == "not_ready" and Y.current_batch(spark, root) is None
    for w in workers:
        Y.set_status(spark, root, "b1", w, "success")
    assert state() == "ready_success" and Y.current_batch(spark, root) == "b1" and K.read_text(spark, f"{root}/done/b1.json")
    Y.set_status(spark, root, "b1", "w2", "failure", "x")
    assert state() == "ready_failed" and K.read_text(spark, f"{root}/failed/b1.json")
    assert K.merged_log([" a\n", "", "b"]) == "a\n\nb\n"
    rows = spark.createDataFrame([("h.com", "h.com", "review")], "host string, input_name string, classification string")
    assert K.merged_review([rows, rows.limit(0)]).count() == 1 and K.merged_review([rows.limit(0)]) is None
    assert L.bootstrap_expiry({"Cache-Control": "public, max-age=60"}, 100.0) == 160 and L.bootstrap_expiry({"expires": "Thu, 01 Jan 1970 00:01:00 GMT"}, 0) == 60
    assert L.bootstrap_expiry({"cache-control": "max-age=x"}, 0) is None and L.bootstrap_expiry({}, 0) is None
