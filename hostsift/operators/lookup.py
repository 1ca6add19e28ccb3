"""Lookups as relations: distinct keys, cached answers, misses to a provider, answers joined back.

A provider is a function from a DataFrame of keys to a DataFrame of answers.  The
fixture provider is a join; a live provider wraps ``per_partition`` around a client.
Misses are filtered before the provider, never gated inside an expression, and its
answers are written before they are used again, so a retry does not ask twice.
"""

from __future__ import annotations

import email.utils
import random
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cache as C
from .places import Keep, with_group_places

Provider = Callable[[DataFrame], DataFrame]

# Addresses in one bulk request of each geo service.
BULK_SIZES = {"geojs": 100, "ipinfo_lite": 1000}
RETRY_HTTP = frozenset({408, 429, 502, 503, 504})
#: Of geo services; 0 stands for a request that got no answer.
RETRY_GEO = frozenset({0, 429, 500, 502, 503, 504})


def fixture(answers: DataFrame, on: list[str]) -> Provider:
    return lambda keys: keys.join(answers, on)


def windowed(items: Iterable, ask: Callable, in_flight: int) -> Iterator:
    """ask(item) for each item, at most ``in_flight`` at a time, in the order of the items."""
    with ThreadPoolExecutor(in_flight) as pool:
        window: deque = deque()
        for item in items:
            if len(window) >= in_flight:
                yield window.popleft().result()
            window.append(pool.submit(ask, item))
        while window:
            yield window.popleft().result()


def _in_batches(rows: Iterator, columns: list[str], size: int) -> Iterator[pd.DataFrame]:
    while held := list(islice(rows, size)):
        yield pd.DataFrame(held, columns=columns)


def per_partition(make_client: Callable[[], Callable[[dict], dict]], schema: str, in_flight: int = 8, batch: int = 256) -> Provider:
    """A provider that makes one client a partition and asks it a key at a time, ``in_flight`` keys at once.

    The client is called by several threads.  A partition holds the keys of a batch and the
    answers of as many; keys come distinct, so none is asked twice.
    """

    def provider(keys: DataFrame) -> DataFrame:
        names = keys.columns
        columns = T._parse_datatype_string(schema).names

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client = make_client()
            asked = (dict(zip(names, key, strict=True)) for b in batches for key in b[names].itertuples(index=False))
            yield from _in_batches(windowed(asked, lambda key: {**key, **client(key)}, in_flight), columns, batch)

        return keys.mapInPandas(run, schema)

    return provider


def with_retries(
    ask: Callable[[], tuple[int, str, float | None]], attempts: int = 4, low: float = 0.5, high: float = 30.0, cap: float = 120.0,
    sleep: Callable[[float], None] = time.sleep, retry: frozenset[int] = RETRY_HTTP,
) -> tuple[int, str]:
    """Asks until the answer's status needs no retry; waits as the server says (capped) or twice as long each time."""
    status, body = 0, ""
    for attempt in range(attempts):
        status, body, after = ask()
        if status not in retry:
            break
        if attempt + 1 < attempts:
            sleep(min(after, cap) if after is not None else min(high, low * 2**attempt) * random.uniform(0.5, 1.0))
    return status, body


def bootstrap_expiry(headers: dict[str, str], now: float) -> float | None:
    """When a fetched bootstrap document must be fetched again: now plus max-age, else the Expires date, else unknown."""
    named = {k.lower(): v for k, v in headers.items()}
    for part in named.get("cache-control", "").split(","):
        name, _, value = part.strip().lower().partition("=")
        if name == "max-age":
            if not value.lstrip("-").isdigit():
                break
            return now + max(0, int(value))
    try:
        return email.utils.parsedate_to_datetime(named["expires"]).timestamp()
    except (KeyError, TypeError, ValueError, IndexError):
        return None


def looked_up(
    keys: DataFrame, on: list[str], now: Column, provider: Provider, overlay: DataFrame | None = None, baseline: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """(answers of all distinct keys, live answers alone): cache first, the provider for what it lacks.

    ``keep`` materialises the live answers, e.g. by a written table.
    """
    distinct = keys.select(*on).distinct()
    cached = C.layered(distinct, overlay, baseline, on, now)
    live = keep(provider(C.misses(cached).select(*on)))
    if overlay is None and baseline is None:
        return live.withColumn("hit_source", F.lit("live")), live
    rest = [c for c in live.columns if c not in on]
    hits = cached.filter("hit_source IS NOT NULL").select(*on, *[F.col("hit")[c].alias(c) for c in rest], "hit_source")
    return hits.unionByName(live.select(*on, *rest).withColumn("hit_source", F.lit("live"))), live


@F.pandas_udf(T.ArrayType(T.StringType()))
def rdap_statuses(bodies: pd.Series) -> pd.Series:
    """Sorted distinct strings under any "status" key, however deep."""
    import json

    def walk(value, found: set) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                if k == "status":
                    found.update(s for s in (v if isinstance(v, list) else [v]) if isinstance(s, str))
                walk(v, found)
        elif isinstance(value, list):
            for v in value:
                walk(v, found)

    def one(body):
        found: set[str] = set()
        try:
            walk(json.loads(body or ""), found)
        except ValueError:
            pass
        return sorted(found)

    return bodies.map(one)


def parsed_rdap(answers: DataFrame) -> DataFrame:
    """Adds exists (null: unavailable), statuses and cacheable to (…, http_status, body)."""
    status = F.col("http_status")
    out = answers.withColumn("statuses", rdap_statuses("body"))
    return out.withColumn("exists", F.when(status == 200, True).when(status == 404, False)).withColumn(
        "statuses", F.when(status == 200, F.col("statuses")).otherwise(F.array().cast("array<string>"))
    ).withColumn("cacheable", status.isin(200, 404, 400, 501))


def rdap_verdicts(entries: DataFrame, answers: DataFrame, root: str = "registrable_domain") -> DataFrame:
    """Entries with struct rdap (exists, statuses); null where unavailable.  Hosts of a root share its one answer."""
    verdict = answers.select(F.col(root), F.when(F.col("exists").isNotNull(), F.struct("exists", "statuses")).alias("rdap"))
    return entries.join(verdict, root, "left")


def unique_keys(rows: DataFrame, array: str, key: str = "ip") -> DataFrame:
    """Distinct members of an array column: each is asked once whatever number of rows hold it."""
    return rows.select(F.explode(array).alias(key)).distinct()


def bulk_chunks(keys: DataFrame, order: str, size: int) -> DataFrame:
    """Adds chunk, the number of the request that a key goes in.  The keys are dealt by hash first, so no single task numbers them all."""
    lanes = keys.withColumn("lane", F.pmod(F.xxhash64(order), F.lit(256)))
    n = F.row_number().over(Window.partitionBy("lane").orderBy(order))
    return lanes.withColumn("chunk", F.concat_ws("-", "lane", F.floor((n - 1) / size)))


def bulk_requests(keys: DataFrame, keep: Keep, sizes: dict[str, int] = BULK_SIZES) -> DataFrame:
    """provider, chunk and ips: the fewest requests that hold all (provider, ip), each of at most its service's size.

    Addresses are numbered by range partitions, so a service that holds them all is not one task.
    """
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("provider"))
    placed = with_group_places(keys.select("provider", "ip"), "provider", ["ip"], keep, "bulk")
    chunks = placed.withColumn("chunk", F.floor(F.col("place") / size))
    return chunks.groupBy("provider", "chunk").agg(F.sort_array(F.collect_list("ip")).alias("ips"))


Client = Callable[[str, list[str]], tuple[int, str, float | None]]


def bulk_asked(requests: DataFrame, make_client: Callable[[], Client], in_flight: int = 8, attempts: int = 3, tasks: int | None = None) -> DataFrame:
    """Requests with http_status (0: no answer), body and tries.

    A client takes (provider, ips) and gives (status, body, seconds that the service asks to
    wait or None); an OSError counts as no answer.  A task has at most ``in_flight``
    requests under way, so all tasks together have at most ``tasks`` times as many.
    """
    columns = ["provider", "chunk", "ips", "http_status", "body", "tries"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def one(row: tuple) -> tuple:
            provider, chunk, ips = row
            tries = 0

            def ask() -> tuple[int, str, float | None]:
                nonlocal tries
                tries += 1
                try:
                    status, body, after = client(provider, list(ips))
                except OSError:
                    return 0, "", None
                return status, body, after if status == 429 else None

            status, body = with_retries(ask, attempts, 0.1, 1.0, retry=RETRY_GEO)
            return provider, chunk, ips, status, body, tries

        rows = (row for b in batches for row in b[columns[:3]].itertuples(index=False, name=None))
        yield from _in_batches(windowed(rows, one, in_flight), columns, in_flight)

    dealt = requests.repartition(tasks) if tasks else requests
    return dealt.mapInPandas(run, "provider string, chunk long, ips array<string>, http_status int, body string, tries int")


def decoded_bulk(asked: DataFrame) -> DataFrame:
    """provider, ip, country_code, region_code, region_name, status of each address of each request.

    One service answers with a list of rows, of which the first of an address holds, the
    other with a map.  What a request does not answer for is an invalid payload.
    """
    # Items stay JSON texts, so one odd item does not spoil its request.
    listed, mapped = F.from_json("body", "array<string>"), F.from_json("body", "map<string, string>")
    of = lambda ip: F.when(
        F.col("provider") == "geojs", F.get(F.filter("listed", lambda r: F.get_json_object(r, "$.ip") == ip), F.lit(0))
    ).otherwise(F.try_element_at("mapped", ip))
    found = F.transform("ips", lambda ip: F.struct(ip.alias("ip"), of(ip).alias("item")))
    rows = asked.select("provider", "http_status", "ips", F.when(F.col("provider") == "geojs", listed).alias("listed"), F.when(F.col("provider") != "geojs", mapped).alias("mapped"))
    rows = rows.select("provider", "http_status", F.explode(found).alias("r")).select("provider", "http_status", "r.ip", "r.item")
    good = (F.col("http_status") == 200) & F.coalesce(F.col("item").startswith("{"), F.lit(False))
    text = lambda c: F.when(good, F.trim(F.coalesce(F.get_json_object("item", f"$.{c}"), F.lit("")))).otherwise("")
    status = (
        F.when(F.col("http_status") == 429, "rate_limited").when(F.col("http_status") != 200, "request_failed").when(good, "ok").otherwise("invalid_payload")
    )
    return rows.select("provider", "ip", F.upper(text("country_code")).alias("country_code"), F.lit("").alias("region_code"), F.when(F.col("provider") == "geojs", text("region")).otherwise("").alias("region_name"), status.alias("status"))


def bulk_geo(make_client: Callable[[], Client], keep: Keep, in_flight: int = 8, attempts: int = 3, tasks: int | None = None, sizes: dict[str, int] = BULK_SIZES) -> Provider:
    """A geo provider over bulk requests; what was asked is written before it is decoded."""
    return lambda keys: decoded_bulk(keep(bulk_asked(bulk_requests(keys, keep, sizes), make_client, in_flight, attempts, tasks), "asked"))


def rejoined(rows: DataFrame, answers: DataFrame, id_col: str, array: str, key: str = "ip", also: tuple[str, ...] = ()) -> DataFrame:
    """id with results, the answers of its array's members in the array's order; members without an answer are invalid.

    ``also`` names columns of both sides that belong to the key.
    """
    rest = [c for c in answers.columns if c not in (key, *also)]
    members = rows.select(id_col, *also, F.posexplode(array).alias("pos", key))
    joined = members.join(answers, [*also, key], "left")
    results = F.transform(F.array_sort(F.collect_list(F.struct("pos", key, *rest))), lambda r: F.struct(r[key].alias(key), *[r[c].alias(c) for c in rest]))
    return joined.withColumn("status", F.coalesce("status", F.lit("invalid_payload"))).groupBy(id_col).agg(results.alias("results"))


def matched_bulk(requested: DataFrame, returned: DataFrame, key: str = "ip") -> DataFrame:
    """The n-th request of an address takes the n-th row returned for it; a request without one is an invalid payload."""
    number = lambda df, order: df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    left, right = number(requested, "pos"), number(returned, "row").drop("row")
    out = left.join(right, [key, "__n"], "left").drop("__n")
    return out.withColumn("status", F.coalesce("status", F.lit("invalid_payload")))


def map_answers(requested: DataFrame, payload: Column, key: str = "ip") -> DataFrame:
    """Answers from a map of address to struct that came with the request."""
    found = F.try_element_at(payload, F.col(key))
    return requested.withColumn("answer", found).withColumn("status", F.when(found.isNull(), "invalid_payload").otherwise("ok"))


#: Where each geo service's JSON holds country code, region code and region name.
GEO_FIELDS = {
    "geojs": ("country_code", None, "region"),
    "ipinfo_lite": ("country_code", None, None),
    "ipinfo": ("country", None, "region"),
    "ip_api": ("countryCode", "region", "regionName"),
    "ipwhois": ("country_code", "region_code", "region"),
}


def decoded_geo(answers: DataFrame, service: str, body: str = "body") -> DataFrame:
    """country_code, region_code, region_name, status of a service's JSON rows; without a country the payload is invalid."""
    country, region, name = GEO_FIELDS[service]
    get = lambda f: F.coalesce(F.get_json_object(body, f"$.{f}"), F.lit("")) if f else F.lit("")
    code = F.upper(F.trim(get(country)))
    return answers.withColumns({
        "country_code": code, "region_code": F.upper(F.trim(get(region))), "region_name": F.trim(get(name)),
        "status": F.when(code == "", "invalid_payload").otherwise("ok"),
    })
