"""Bucketed tables and their writers, concurrent and bulk requests, conflicts of settings, list files in blocks."""

import random
import sqlite3
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringContains

from hostsift.functions import geo as G
from hostsift.operators import batch as B
from hostsift.operators import buckets as U
from hostsift.operators import csvfile
from hostsift.operators import lookup as L
from hostsift.operators import places
from hostsift.operators import prepare as P
from hostsift.operators import run as R
from hostsift.operators import scratch
from hostsift.operators import suffixes
from hostsift.operators.suffixes import public_suffix_rules
from hostsift.sources import lists, tables

ROW = "k string, v long"


def held(spark, path):
    return {r["k"]: r["v"] for r in U.read(spark, path).collect()}


def test_writes_touch_their_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert U.read(spark, path) is None
    first = U.write(spark.createDataFrame([(f"k{n}", n) for n in range(200)], ROW), path, ["k"], buckets=16)
    second = U.write(spark.createDataFrame([("k3", -3), ("new", 9)], ROW), path, ["k"])
    assert first["number"] == 1 and len(first["rewritten"]) == 16 and len(second["rewritten"]) <= 2
    same = [b for b in first["files"] if first["files"][b] == second["files"][b]]
    assert len(same) == 16 - len(second["rewritten"])
    assert held(spark, path) == {f"k{n}": n for n in range(200)} | {"k3": -3, "new": 9}
    assert U.read(spark, path, spark.createDataFrame([("k3",)], "k string")).count() < 60
    assert U.write(spark.createDataFrame([], ROW), path, ["k"])["rewritten"] == [] and len(held(spark, path)) == 201
    U.write(spark.createDataFrame([("k4", -4)], ROW), path, ["k"])  # old commits go, what is read stays
    assert len(held(spark, path)) == 201 and not (tmp_path / "t" / "_log" / "000000000001.json").exists()


def test_interleaved_writers_keep_both_rows(spark, tmp_path):
    """Another writer commits between a writer's read and its commit, in the same bucket and in another."""
    path = f"{tmp_path}/t"
    U.write(spark.createDataFrame([("a", 1), ("b", 2)], ROW), path, ["k"], buckets=1)
    attempts = []

    def meanwhile(attempt):
        attempts.append(attempt)
        if attempt < 2:
            U.write(spark.createDataFrame([(f"other{attempt}", attempt), ("a", 100 + attempt)], ROW), path, ["k"])

    U.write(spark.createDataFrame([("mine", 7), ("b", 20)], ROW), path, ["k"], before_commit=meanwhile)
    assert attempts == [0, 1, 2] and held(spark, path) == {"a": 101, "b": 20, "mine": 7, "other0": 0, "other1": 1}
    with pytest.raises(U.Conflict):
        U.write(spark.createDataFrame([("x", 1)], ROW), path, ["k"], attempts=1, before_commit=lambda attempt: U.write(spark.createDataFrame([("y", 1)], ROW), path, ["k"]))
    assert "x" not in held(spark, path)


def test_both_first_writers_of_a_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    other = lambda attempt: None if attempt else U.write(spark.createDataFrame([("other", 1)], ROW), path, ["k"], buckets=4)
    U.write(spark.createDataFrame([("mine", 2)], ROW), path, ["k"], buckets=4, before_commit=other)
    assert held(spark, path) == {"other": 1, "mine": 2}


def test_null_keys_and_repeated_reads(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(None, 1), ("", 2)], ROW)
    U.write(rows, path, ["k"], buckets=4)
    assert held(spark, path) == {None: 1, "": 2}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_folder(Session())


# --- requests


def test_window_bounds_what_is_in_flight():
    now, most, lock = [0], [0], threading.Lock()

    def ask(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return k * 2

    assert list(L.windowed(range(50), ask, 5)) == [2 * k for k in range(50)]
    assert 1 < most[0] <= 5


def test_concurrent_keys(spark):
    def make_client():
        seen = []

        def client(key):
            seen.append(key["k"])
            time.sleep(0.02)
            return {"n": key["k"] * 2, "calls": seen.count(key["k"])}

        return client

    began = time.time()
    got = L.per_partition(make_client, "k long, n long, calls int", in_flight=16, batch=7)(spark.range(160).select(F.col("id").alias("k")).coalesce(1)).collect()
    assert sorted((r["k"], r["n"], r["calls"]) for r in got) == [(k, 2 * k, 1) for k in range(160)]
    assert time.time() - began < 160 * 0.02


def test_bulk_requests_and_failures(spark):
    """Statuses of whole requests reach each address; retries are counted; odd payloads are invalid."""
    def make_client():
        def client(provider, ips):
            kind = ips[0][0]
            if kind == "e":
                raise OSError
            return {"a": (200, '{"a1": {"country_code": " us"}, "a2": 7, "a3": {}}'), "b": (429, ""), "c": (500, ""), "d": (200, "[broken")}[kind] + (None,)

        return client

    keys = spark.createDataFrame([("ipinfo_lite", f"{c}{n}") for c in "abcde" for n in range(1, 5)], "provider string, ip string")
    keep = scratch.kept(spark, "test")
    asked = keep(L.bulk_asked(L.bulk_requests(keys, keep, {"ipinfo_lite": 4}), make_client, attempts=2), "asked")
    tries = {r["ips"][0][0]: r["tries"] for r in asked.collect()}
    assert tries == {"a": 1, "b": 2, "c": 2, "d": 1, "e": 2} and asked.count() == 5
    got = {r["ip"]: (r["status"], r["country_code"]) for r in L.decoded_bulk(asked).collect()}
    assert got["a1"] == ("ok", "US") and got["a3"] == ("ok", "") and got["a4"] == ("invalid_payload", "")
    assert {got[f"{c}1"][0] for c in "bcde"} == {"rate_limited", "request_failed", "invalid_payload"} and got["b3"][0] == "rate_limited" and got["e2"][0] == "request_failed"
    again = spark.createDataFrame([("geojs", "1"), ("geojs", "2"), ("geojs", "3")], "provider string, ip string")
    body = '[{"ip": "2", "country_code": "de", "region": " X "}, {"ip": "2", "country_code": "fr"}, {"ip": "3"}]'
    provider = L.bulk_geo(lambda: lambda name, ips: (200, body, None), keep)
    assert {r["ip"]: (r["status"], r["country_code"], r["region_name"]) for r in provider(again).collect()} == {"1": ("invalid_payload", "", ""), "2": ("ok", "DE", "X"), "3": ("ok", "", "")}


# --- settings


@pytest.fixture(scope="module")
def rules(spark):
    return public_suffix_rules(spark, ["com", "uk", "co.uk"])


def prepared(spark, rules, sources, **over):
    lines = spark.createDataFrame(
        [("a", 0, "a", 0, "one.com"), ("a", 0, "a", 1, "both.com"), ("b", 1, "b", 0, "both.com"), ("b", 1, "b", 1, "two.com")], lists.LINES_SCHEMA
    )
    lists_ = {k: spark.createDataFrame([(k, 0, k, n, h) for n, h in enumerate(over.get(k, []))], lists.LINES_SCHEMA) for k in ("manual_filter_pass", "manual_filter_out", "manual_add")}
    return R.prepared(lines, lists_, rules, {"a": "plain", "b": "plain"}, sources)


def test_conflicts_of_profiles(spark, rules):
    alike = {s: R.SourceSettings(execution_profile="x", rdap_profile="r") for s in "ab"}
    assert prepared(spark, rules, alike)[0].count() == 3
    differ = alike | {"b": R.SourceSettings(execution_profile="y", rdap_profile="r")}
    with pytest.raises(P.PreparationError, match="both.com is in sources of different runtime behaviour: a and b"):
        prepared(spark, rules, differ)
    assert prepared(spark, rules, differ, manual_filter_out=["both.com"])[0].count() == 2
    assert prepared(spark, rules, differ, manual_add=["both.com"])[0].count() == 3
    registry = {"a": R.SourceSettings(execution_profile="x", rdap_profile="r"), "b": R.SourceSettings(execution_profile="y", rdap_profile="q")}
    with pytest.raises(P.PreparationError, match="manual_add needs the same rdap settings"):
        prepared(spark, rules, registry, manual_add=["both.com"])


def test_override_demands(spark, rules):
    alike = {s: R.SourceSettings(execution_profile="x", rdap_profile="r") for s in "ab"}
    with pytest.raises(P.PreparationError, match="manual_add names the public suffix co.uk"):
        prepared(spark, rules, alike, manual_add=["co.uk"])
    mute = {s: R.SourceSettings(dns_enabled=s == "a", execution_profile="x") for s in "ab"}
    with pytest.raises(P.PreparationError, match="manual_filter_pass needs dns.enabled"):
        prepared(spark, rules, mute, manual_filter_pass=["one.com"])


def test_settings_by_row(spark):
    own = R.SourceSettings(True, False, "r1", "geojs", 3, G.Policy(True, "any_ip", G.Rules(["CN"])))
    rows = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "source_id string, n int")
    got = {r["n"]: r["cfg"] for r in R.with_settings(rows, R.Settings({"a": own}, R.SourceSettings(geo_days=9))).collect()}
    assert (got[1]["resolver_key"], got[1]["geo_provider"], got[1]["geo_days"], got[1]["policy"]["include"]["countries"]) == ("r1", "geojs", 3, ["CN"])
    assert [got[k]["geo_days"] for k in (2, 3)] == [9, 9] and got[3]["policy"]["enabled"] is False


# --- list files


@pytest.mark.parametrize("size", ["300", "128m"])
def test_lines_of_files_in_blocks(spark, tmp_path, size):
    rng = random.Random(size)
    breaks = ["\n", "\n", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " ", "\n\n", "\r\r\n"]
    texts = ["", "\n", "last\r", "last\x0b", "last\n", "a ", "\x0b", "end"]
    texts += ["".join("é" * rng.randint(0, 3) + f"x{k}" * rng.randint(0, 9) + rng.choice(breaks) for k in range(rng.randint(1, 150))) + rng.choice(["", "tail", "\x0c"]) for _ in range(6)]
    for k, text in enumerate(texts):
        (tmp_path / f"{k:03d}.txt").write_bytes(text.encode())
    want = [line for text in texts for line in text.splitlines()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = lists.text_lines(spark, lists.matching_paths(spark, f"{tmp_path}/*.txt"), "s")
        got = sorted((r["line_index"], r["raw_line"]) for r in rows.collect())
        if size == "300":
            assert spark.read.text(str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(want))


def test_places_with_equal_rows(spark):
    keep = scratch.kept(spark, "places")
    got = places.with_places(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "h string"), ["h"], keep)
    assert sorted((r["place"], r["h"]) for r in got.collect()) == [(0, None), (1, "a"), (2, "b"), (3, "b")]


# --- one CSV file


def test_csv_file_equals_the_csv_module(spark, tmp_path):
    import csv
    import io

    rows = [("b", 'q"uote'), ("a", "x,y"), ("é", None), ("c", "two\r\nlines"), ("d", " pad "), ("e", "")]
    df = spark.createDataFrame(rows, "host string, note string").repartition(3)

    def want(*groups):
        out = io.StringIO(newline="")
        writer = csv.writer(out)
        writer.writerow(["host", "note"])
        for group in groups:
            writer.writerows(sorted(group, key=lambda r: r[0]))
        return out.getvalue().encode()

    path = f"{tmp_path}/out/review.csv"
    assert csvfile.write_csv_file(df.limit(0), path, ["host"], append=True) == 0 and not (tmp_path / "out" / "review.csv").exists()
    csvfile.write_csv_file(df, path, ["host"], append=True)
    assert (tmp_path / "out" / "review.csv").read_bytes() == want(rows)
    assert csvfile.write_csv_file(df.filter("host < 'c'"), path, ["host"], append=True) == 2
    assert (tmp_path / "out" / "review.csv").read_bytes() == want(rows, rows[:2])
    failing = df.withColumn("note", F.when(F.col("host") == "c", F.raise_error(F.lit("no"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="no"):
        csvfile.write_csv_file(failing, path, ["host"])
    assert (tmp_path / "out" / "review.csv").read_bytes() == want(rows, rows[:2]) and [p.name for p in (tmp_path / "out").iterdir() if "." in p.name and not p.name.startswith(".")] == ["review.csv"]
    csvfile.write_csv_file(df, path, ["host"])
    assert (tmp_path / "out" / "review.csv").read_bytes() == want(rows)
    one = spark.createDataFrame([("",), ("z",)], "only string")
    csvfile.write_csv_file(one, f"{tmp_path}/one.csv", ["only"])
    assert (tmp_path / "one.csv").read_bytes() == b'only\r\n""\r\nz\r\n'


# --- SQLite


def test_sqlite_filters_and_ranges(spark, tmp_path):
    path = f"{tmp_path}/c.sqlite3"
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE geo_history (provider TEXT, ip TEXT, country_code TEXT, region_code TEXT, region_name TEXT, checked_at TEXT, expires_at TEXT, PRIMARY KEY (provider, ip)) WITHOUT ROWID")
        c.executemany("INSERT INTO geo_history VALUES (?, ?, 'CN', '', '', 'x', 'y')", [(f"p{k % 7}", str(k)) for k in range(500)])
    whole = tables.sqlite_table(spark, path, "geo_history", partitions=4)
    assert whole.count() == 500 and whole.select(F.spark_partition_id()).distinct().count() > 1
    assert whole.filter("provider = 'p3' AND ip IN ('3', '10', '17')").count() == 3
    assert tables.cached_row(spark, path, "geo_history", {"provider": "p3", "ip": "10"}).first()["ip"] == "10"
    reader = tables.SqliteReader(whole.schema, {"path": path, "table": "geo_history", "partitions": "4"})
    odd = StringContains(("ip",), "1")
    assert list(reader.pushFilters([EqualTo(("provider",), "p3"), EqualTo(("ip",), "10"), odd])) == [odd]
    read = [row for part in reader.partitions() for row in reader.read(part)]
    assert len(read) == 1  # nothing but the row of the key leaves SQLite
    ordered = [r["domain"] for r in tables.ordered_roots(spark.createDataFrame([("b",), ("a",)], "domain string")).collect()]
    assert ordered == ["a", "b"]


# --- a run in parts


def test_parts_go_on_where_they_stopped(spark, tmp_path):
    entries = spark.createDataFrame([(f"r{k}.com",) for k in range(40)], "registrable_domain string")
    made = []

    def screen(part, k):
        made.append(k)
        if k == 2 and made.count(2) == 1:
            raise RuntimeError("lost")
        return part.withColumn("part", F.lit(k))

    folder, clock = f"{tmp_path}/run", iter([0, 0, 9]).__next__
    rows, left = R.screened_in_parts(spark, folder, entries, 4, screen, 5, clock)
    assert left == [1, 2, 3] and {r["part"] for r in rows.collect()} == {0}
    with pytest.raises(RuntimeError):
        R.screened_in_parts(spark, folder, entries, 4, screen)
    rows, left = R.screened_in_parts(spark, folder, entries.limit(0), 4, screen)  # the entries of the first start hold
    assert left == [] and made == [0, 1, 2, 2, 3] and rows.count() == rows.select("registrable_domain").distinct().count() == 40
    with pytest.raises(ValueError):
        R.screened_in_parts(spark, folder, entries, 5, screen)


def test_all_kinds_of_repeats_are_told(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", None)], "k string, v string")
    B.ensure_all_unique(rows, {"key": F.col("k"), "pair": F.concat("k", "v")})
    with pytest.raises(B.DuplicateRows, match="duplicate value: .*x"):
        B.ensure_all_unique(rows, {"key": F.col("k"), "value": F.col("v")})


def test_bootstrap_is_fetched_again_when_it_expires(spark, tmp_path):
    asked = []

    def fetch(suffix, age="max-age=60"):
        def get():
            asked.append(suffix)
            return {"Cache-Control": age}, '{"services": [[["%s"], ["https://a.example/"]]]}' % suffix
        return get

    def failing():
        raise OSError

    path = f"{tmp_path}/dns.json"
    names = lambda get, now: [r["suffix"] for r in suffixes.cached_services(spark, path, get, now).collect()]
    assert names(failing, 0) == []
    assert names(fetch("one"), 0) == ["one"] and names(fetch("two"), 59) == ["one"] and asked == ["one"]
    assert names(failing, 61) == ["one"] and names(fetch("two", "private"), 61) == ["two"]
    assert names(fetch("three"), 62) == ["three"]  # an unknown expiry is none


def test_prepared_sources_are_not_read(spark, tmp_path):
    from hostsift.sources import config

    (tmp_path / "a.txt").write_text("a.com\n")
    found, _ = config.parse_config({"version": 2, "sources": [{"id": k, "input": {"type": "file", "location": f"{tmp_path}/a.txt"}} for k in "ab"]})
    assert [r["source_id"] for r in lists.source_lines(spark, found, prepared=frozenset("a")).collect()] == ["b"]


def test_a_server_of_most_roots(spark):
    """Numbering by range partitions equals the window's, and no partition holds the large server's roots alone."""
    rng = random.Random(3)
    rows = [(f"r{k}", rng.choice(["big"] * 6 + ["a", "b", None]), rng.randint(0, 9), rng.randint(1, 50)) for k in range(2000)]
    df = spark.createDataFrame(rows, "root string, server string, first_seen int, hosts int").repartition(5)
    keep, sizes = scratch.kept(spark, "servers"), []

    def counted(part, name):
        made = keep(part, name)
        sizes.append(max(r["n"] for r in made.groupBy(F.shiftright("__at", 33).alias("p")).agg(F.count("*").alias("n")).collect()))
        return made

    turns = lambda found: {(r["root"], r["turn"]) for r in found.collect()}
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the small partitions of a test would be joined
    try:
        assert turns(B.interleaved(df, keep=counted)) == turns(B.interleaved(df))
        worker = lambda found: {(r["root"], r["worker"]) for r in found.collect()}
        assert worker(B.spread_assignment(df, 7, keep=counted)) == worker(B.spread_assignment(df, 7))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert max(sizes) < 4 * 2000 / 4 * 0.5 and len(sizes) == 2
