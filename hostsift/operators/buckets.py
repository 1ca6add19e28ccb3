"""Keyed tables in buckets: a write rewrites the buckets of its keys alone, and writers commit one after another.

A table is a folder of bucket folders and a log of numbered commits, each a small file that
names the folder of every bucket.  A writer reads the last commit, merges its rows with
the buckets they fall in, writes those buckets anew and commits under the next number.  The
number's file is made by a rename that fails where it exists, so of two writers one comes
second; it looks at what changed meanwhile, merges the buckets that both touched again and
commits behind the other.  No row of either is lost, and readers see whole commits only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cache import upsert
from .scratch import delete
from .sinks import _fs, read_text, write_text

BUCKETS = 64
#: Commits whose files stay for readers that have begun.
KEPT = 2


class Conflict(RuntimeError):
    """Other writers kept coming first."""


def bucket_of(on: list[str], buckets: int) -> Column:
    """A row's bucket by the MD5 of its key's texts."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in on])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def _number(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, f"{path}/_log")
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max([int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit()], default=0)


def state(spark: SparkSession, path: str) -> dict | None:
    """The last commit: number, buckets, on, schema, files (bucket -> folder) and the rows that its write touched."""
    number = _number(spark, path)
    return json.loads(read_text(spark, f"{path}/_log/{number:012d}.json")) if number else None


def _commit(spark: SparkSession, path: str, number: int, made: dict) -> bool:
    """True if the commit is the one of its number."""
    whole = f"{path}/_log/_{uuid.uuid4().hex}"
    write_text(spark, whole, json.dumps(made, sort_keys=True))
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    fs, source = _fs(spark, whole)
    source, target = fs.makeQualified(source), fs.makeQualified(hadoop.Path(f"{path}/_log/{number:012d}.json"))
    plain = sc._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, plain)
        return True
    except Exception as e:  # noqa: BLE001  whatever the store says: it is there, or it is an error
        delete(spark, whole)
        if _number(spark, path) >= number:
            return False
        raise e


def read(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame | None:
    """The table, or of it the buckets that ``keys`` fall in; None where nothing was ever written."""
    now = state(spark, path)
    if now is None:
        return None
    schema, files = T.StructType.fromJson(json.loads(now["schema"])), now["files"]
    if keys is not None:
        wanted = {str(r[0]) for r in keys.select(bucket_of(now["on"], now["buckets"])).distinct().collect()}
        files = {b: f for b, f in files.items() if b in wanted}
    return _folders(spark, files, schema)


def _folders(spark: SparkSession, files: dict[str, str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*files.values()) if files else spark.createDataFrame([], schema)


def write(
    rows: DataFrame, path: str, on: list[str], buckets: int = BUCKETS, merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert, attempts: int = 20,
    before_commit: Callable[[int], None] = lambda attempt: None,
) -> dict:
    """Merges rows (one a key) into the table and returns the commit; ``rewritten`` names the buckets it wrote.

    ``merge`` gets the old rows of the touched buckets, the new ones and the key.  The number
    of buckets is fixed by the first write.  The driver holds bucket numbers and folders only.
    """
    spark = rows.sparkSession
    began = state(spark, path)
    count = began["buckets"] if began else buckets
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    rows.withColumn("__bucket", bucket_of(on, count)).write.parquet(staged)
    new = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("__bucket", T.IntegerType())])).parquet(staged)
    touched = sorted(r[0] for r in new.select("__bucket").distinct().collect())
    base, done, todo = began, {}, touched
    try:
        for attempt in range(attempts):
            fresh = new.filter(F.col("__bucket").isin(todo)).drop("__bucket")
            old = {str(b): base["files"][str(b)] for b in todo if base and str(b) in base["files"]}
            whole = merge(_folders(spark, old, rows.schema), fresh, on) if old else fresh
            version = f"{path}/data/{uuid.uuid4().hex}"
            if todo:
                placed = whole.withColumn("__bucket", bucket_of(on, count))
                placed.repartition(min(len(todo), count), "__bucket").write.partitionBy("__bucket").parquet(version)
                done |= {str(b): f"{version}/__bucket={b}" for b in todo}
            number = base["number"] + 1 if base else 1
            made = {
                "number": number, "buckets": count, "on": on, "schema": rows.schema.json(), "rewritten": touched,
                "files": (base["files"] if base else {}) | done,
            }
            before_commit(attempt)
            if _commit(spark, path, number, made):
                _vacuum(spark, path, number)
                return made
            after = state(spark, path)
            if after["buckets"] != count:
                raise Conflict(f"{path} was made anew with {after['buckets']} buckets")
            before = base["files"] if base else {}
            todo = [b for b in touched if after["files"].get(str(b)) != before.get(str(b))]  # what another writer wrote too
            base = after
        raise Conflict(f"{path}: {attempts} commits of other writers came first")
    finally:
        delete(spark, staged)


def _vacuum(spark: SparkSession, path: str, number: int) -> None:
    """Deletes the commit that fell out of the last ones, and the bucket folders that it alone named."""
    gone = f"{path}/_log/{number - KEPT:012d}.json"
    text = read_text(spark, gone)
    if text is None:
        return
    following = read_text(spark, f"{path}/_log/{number - KEPT + 1:012d}.json")
    live = set(json.loads(following)["files"].values()) if following else None
    if live is not None:
        for folder in set(json.loads(text)["files"].values()) - live:
            delete(spark, folder)
        delete(spark, gone)
