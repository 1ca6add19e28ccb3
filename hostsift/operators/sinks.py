"""Outputs: host lists, audit JSON lines, review CSV, cache tables; published whole or kept aside.

Each output is written by Spark in sorted, range-partitioned files under a folder of its
version.  Readers follow a small pointer file, which one atomic rename switches when all
of a version is there, so a driver that dies leaves the version before in place.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import verdicts as D
from .batch import ensure_all_unique, ensure_unique
from .places import Keep, with_places


def host_list(rows: DataFrame, route: str, checked: bool = False) -> DataFrame:
    """Hosts of a route in order; a host twice is an error, unless that was ``checked`` before."""
    hosts = rows.filter(F.col("route") == route).select("host")
    return (hosts if checked else ensure_unique(hosts, ["host"], f"{route} host")).orderBy("host")


def numbered_hosts(rows: DataFrame, route: str, keep: Keep) -> DataFrame:
    """host and its place, from 0, in the route's sorted list.  The sort runs once, and equal hosts would be neighbours in it."""
    placed = with_places(rows.filter(F.col("route") == route).select("host"), ["host"], keep, f"{route}-hosts")
    return ensure_unique(placed, ["host"], f"{route} host")


def _audit(rows: DataFrame, sort_keys: bool = False) -> Column:
    return F.to_json(F.struct(*(sorted(rows.columns) if sort_keys else rows.columns)), {"ignoreNullFields": "false"})


def audit_lines(rows: DataFrame, sort_keys: bool = False, checked: bool = False) -> DataFrame:
    """JSON of every terminal row, by host and then row text; equal rows are an error.  Merged audits have their keys in name order."""
    lines = rows.select("host", _audit(rows, sort_keys).alias("value"))
    return (lines if checked else ensure_unique(lines, ["value"], "audit row")).orderBy("host", "value").select("value")


def review_table(rows: DataFrame, checked: bool = False) -> DataFrame:
    made = rows.filter("route = 'review'").select(*D.review_columns(rows.columns))
    name = F.when(F.col("input_name") != "", F.col("input_name")).otherwise(F.col("host"))
    return (made if checked else ensure_unique(made, made.columns, "review row")).orderBy(name, "host")


def ensure_terminal(rows: DataFrame) -> None:
    """Hosts of each list, audit rows and review rows must each differ; one pass decides all."""
    on = lambda route, key: F.when(F.col("route") == route, key)
    ensure_all_unique(rows, {
        "filtered host": on("filtered", F.col("host")), "dead host": on("dead", F.col("host")), "audit row": _audit(rows),
        "review row": on("review", F.to_json(F.struct(*D.review_columns(rows.columns)))),
    })


def review_file(rows: DataFrame, path: str, append: bool = True) -> int:
    """Review rows as one CSV file, behind what it holds already; returns how many were written."""
    from .csvfile import write_csv_file

    made = rows.filter("route = 'review'").select(*D.review_columns(rows.columns))
    name = F.when(F.col("input_name") != "", F.col("input_name")).otherwise(F.col("host"))
    return write_csv_file(made, path, [name, "host"], append)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def switch_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file by one rename; readers see the old text or the new one."""
    fs, target = _fs(spark, path)
    made = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, made, text)
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    source, target = fs.makeQualified(hadoop.Path(made)), fs.makeQualified(target)
    how = sc._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, how)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def publish(rows: DataFrame, folder: str, config: str, complete: bool = True, snapshot_root: str | None = None) -> dict:
    """Writes all outputs of a run and returns its manifest.

    A complete run becomes what is published, and the version before the last is deleted;
    an incomplete one goes to a snapshot folder with a manifest and leaves the published
    outputs alone.  The filtered list is always there; the others only if they have rows.
    """
    spark = rows.sparkSession
    root = folder if complete else f"{snapshot_root or folder + '-incomplete'}/{int(time.time())}"
    version = f"{root}/versions/{config}/{uuid.uuid4().hex}"
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        counts = {r["route"]: r["n"] for r in rows.groupBy("route").agg(F.count("*").alias("n")).collect()}
        ensure_terminal(rows)
        host_list(rows, "filtered", checked=True).write.text(f"{version}/filtered")
        if counts.get("dead"):
            host_list(rows, "dead", checked=True).write.text(f"{version}/dead")
        if counts.get("review"):
            review_table(rows, checked=True).write.csv(f"{version}/review", header=True, quote='"', escape='"', lineSep="\n")
        audit_lines(rows, checked=True).write.text(f"{version}/audit")
    finally:
        rows.unpersist()
    names = ["filtered", "audit", *(n for n in ("dead", "review") if counts.get(n))]
    manifest = {"config": config, "complete": complete, "counts": counts, "folder": root, "outputs": {n: f"{version}/{n}" for n in sorted(names)}}
    if not complete:
        write_text(spark, f"{root}/manifest.json", json.dumps(manifest, sort_keys=True))
        return manifest
    before = read_text(spark, _pointer(folder, config))
    last = json.loads(before) if before else {}
    switch_pointer(spark, _pointer(folder, config), json.dumps(manifest | {"version": version, "before": last.get("version")}, sort_keys=True))
    if last.get("before"):
        _delete(spark, last["before"])
    return manifest


def _pointer(folder: str, config: str) -> str:
    return f"{folder}/current/{config}.json"


def published(spark: SparkSession, folder: str, config: str) -> dict[str, str]:
    """Folders of the published outputs by name; empty where nothing is published."""
    text = read_text(spark, _pointer(folder, config))
    return json.loads(text)["outputs"] if text else {}


def replace_table(rows: DataFrame, path: str) -> None:
    """Makes ``rows`` the table at ``path``; they may be computed from its own old files, which stay for one version more."""
    spark = rows.sparkSession
    version = f"{path}/v-{uuid.uuid4().hex}"
    rows.write.parquet(version)
    last = json.loads(read_text(spark, f"{path}/_current.json") or "{}")
    switch_pointer(spark, f"{path}/_current.json", json.dumps({"version": version, "before": last.get("version")}))
    if last.get("before"):
        _delete(spark, last["before"])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that ``replace_table`` wrote last, or None."""
    text = read_text(spark, f"{path}/_current.json")
    return spark.read.parquet(json.loads(text)["version"]) if text else None


def write_caches(spark: SparkSession, paths: dict[str, str], new: dict[str, DataFrame]) -> dict[str, dict]:
    """New rows of each cache in place of the old ones of their key; only the buckets of these keys are rewritten.  Returns the commits."""
    from . import buckets

    keys = {"root": ["domain"], "dns": ["host", "resolver_key"], "geo": ["provider", "ip"]}
    return {name: buckets.write(rows, paths[name], keys[name]) for name, rows in new.items()}


def merged_review(parts: list[DataFrame]) -> DataFrame | None:
    """Review rows of all workers, values as they stand; None where there are none, for the caller to delete the target."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if rows.isEmpty():
        return None
    name = F.when(F.col("input_name") != "", F.col("input_name")).otherwise(F.col("host"))
    return ensure_unique(rows, rows.columns, "review row").orderBy(name, "host")


def merged_log(texts: list[str]) -> str:
    """Workers' logs one after another, an empty line between them."""
    held = [t.strip() for t in texts if t.strip()]
    return "\n\n".join(held) + "\n" if held else ""


def write_partials(review: DataFrame, terminal: DataFrame, folder: str) -> None:
    """What preparation leaves for the merge; both files are there even without rows."""
    review.select(*D.review_columns(review.columns)).coalesce(1).write.mode("overwrite").csv(f"{folder}/review", header=True, quote='"', escape='"')
    audit_lines(terminal).write.mode("overwrite").text(f"{folder}/terminal")


def output_paths(root: str, config: str) -> dict[str, str]:
    """Folders of a config's outputs and state."""
    return {
        **{k: f"{root}/output/{k}/{config}" for k in ("filtered", "dead", "review")}, "audit": f"{root}/debug/audit/{config}",
        **{k: f"{root}/state/cache/{k}" for k in ("root", "dns", "geo")}, "incomplete": f"{root}/state/incomplete/{config}",
    }
