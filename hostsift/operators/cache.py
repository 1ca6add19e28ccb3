"""Cache tables as relations: freshness, layers, upsert, delete, latest-row merge, counters.

``now`` is one literal of the run.  A row is fresh while expires_at > now.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V

#: Classes that early cache files used.  Fixed values.
LEGACY_CLASSES = {"alive": V.REGISTERED, "dead": V.UNREGISTERED}
LEGACY_UNAVAILABLE = "__rdap_unavailable__"


def fresh(cache: DataFrame, now: Column, expires: str = "expires_at") -> DataFrame:
    return cache.filter(F.col(expires) > now)


def layered(keys: DataFrame, overlay: DataFrame | None, baseline: DataFrame | None, on: list[str], now: Column) -> DataFrame:
    """Keys with the fresh row of the overlay, else of the baseline, as struct ``hit``, and ``hit_source``.

    A layer that cannot be read is passed as None.
    """
    out = keys
    for name, layer in (("overlay", overlay), ("baseline", baseline)):
        if layer is None:
            continue
        rest = [c for c in layer.columns if c not in on]
        out = out.join(fresh(layer, now).select(*on, F.struct(*rest).alias(name)), on, "left")
    layers = [n for n, layer in (("overlay", overlay), ("baseline", baseline)) if layer is not None]
    if not layers:
        return out.withColumn("hit", F.lit(None)).withColumn("hit_source", F.lit(None).cast("string"))
    source = F.coalesce(*[F.when(F.col(n).isNotNull(), n) for n in layers])
    return out.withColumn("hit", F.coalesce(*layers)).withColumn("hit_source", source).drop(*layers)


def counters(looked_up: DataFrame, by: list[str] = ()) -> DataFrame:
    """hits, misses, hits of each layer."""
    source = F.col("hit_source")
    return looked_up.groupBy(*by).agg(
        F.count_if(source.isNotNull()).alias("hits"), F.count_if(source.isNull()).alias("misses"),
        F.count_if(source == "overlay").alias("overlay_hits"), F.count_if(source == "baseline").alias("baseline_hits"),
    )


def misses(looked_up: DataFrame) -> DataFrame:
    return looked_up.filter("hit_source IS NULL").drop("hit", "hit_source")


def needs_refresh(looked_up: DataFrame) -> Column:
    """A miss, or a registered row whose statuses are not complete (counted as a hit, looked up all the same)."""
    hit = F.col("hit")
    return F.col("hit_source").isNull() | ((hit["classification"] == V.REGISTERED) & ~F.coalesce(hit["statuses_complete"].cast("boolean"), F.lit(False)))


def stamped(rows: DataFrame, now: Column, ttl_days: Column) -> DataFrame:
    """Adds checked_at and expires_at."""
    return rows.withColumn("checked_at", now).withColumn("expires_at", now + F.make_dt_interval(ttl_days.cast("int")))


def root_ttl(klass: Column, registered: int, unregistered: int, unavailable: int) -> Column:
    return F.when(klass == V.UNREGISTERED, unregistered).when(klass == V.REGISTERED, registered).otherwise(unavailable)


def upsert(cache: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """New rows in place of old ones of their key."""
    return cache.join(rows.select(*on), on, "left_anti").unionByName(rows.select(*cache.columns))


def delete(cache: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return cache.join(keys.select(*on), on, "left_anti")


def merge_latest(candidates: DataFrame, on: list[str], order: str | None = None) -> DataFrame:
    """One row a key: the latest checked_at, then expires_at (as text), then row text, then place in order."""
    rest = [c for c in candidates.columns if c != order]
    rank = [F.col("checked_at").cast("string"), F.col("expires_at").cast("string"), F.to_json(F.struct(*rest))]
    if order:
        rank.append(F.col(order))
    return candidates.groupBy(*on).agg(F.max_by(F.struct(*rest), F.struct(*rank)).alias("r")).select("r.*")


def modern_classes(cache: DataFrame) -> DataFrame:
    """Early class names in today's words."""
    klass = F.col("classification")
    named = F.when(klass == LEGACY_UNAVAILABLE, V.UNAVAILABLE)
    for old, new in LEGACY_CLASSES.items():
        named = named.when(klass == old, new)
    return cache.withColumn("classification", named.otherwise(klass))


def json_list(c: Column) -> Column:
    """Strings of a JSON list; anything else gives an empty list, items that are not strings are dropped."""
    items = F.from_json(c, "array<string>")
    raw = F.from_json(c, "array<variant>")
    typed = F.transform(F.filter(raw, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.variant_get(v, "$", "string"))
    return F.coalesce(F.when(items.isNotNull(), typed), F.array().cast("array<string>"))
