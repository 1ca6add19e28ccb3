"""Host lists as rows of raw lines: files, folders by pattern, URLs, override lists."""

from __future__ import annotations

import re
import urllib.request
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import Source

LINES_SCHEMA = "source_id string, source_index int, source_input_label string, line_index int, raw_line string"
#: Where Python's splitlines breaks a text; Spark's line mode knows only the first three.
BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of text blocks as lines with their places in the block; a task reads a block's rows in order, one block after another."""
    block, place = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = pc.split_pattern_regex(pc.replace_substring_regex(batch["value"], r"\r\z", ""), BREAKS)
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        keys = list(zip(batch["file_path"].to_pylist(), batch["file_block_start"].to_pylist(), strict=True))
        changes = [k for k, key in enumerate(keys) if k == 0 or key != keys[k - 1]]
        places = []
        for at, end in zip(changes, [*changes[1:], len(keys)], strict=True):
            if keys[at] != block:
                block, place = keys[at], 0
            n = int(sizes[at:end].sum())
            places.append(np.arange(place, place + n))
            place += n
        of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        yield pa.RecordBatch.from_arrays([batch["file_path"].take(of), batch["file_block_start"].take(of), pa.array(np.concatenate(places)), pieces.flatten()], ["path", "start", "at", "raw_line"])


def text_lines(spark: SparkSession, paths: list[str], source_id: str, index: int = 0, label: str = "") -> DataFrame:
    """Lines of one source's files, numbered through all files in path order, as Python's splitlines breaks them.

    Spark cuts files into blocks at line feeds, so a file of any size is several tasks; a row
    is then cut at the other breaks where it stands.  A table of one row a block says how
    many lines are before it.  Whether a file ends in a line feed is told by its length: if
    not, nothing stands behind another break at its end.
    """
    meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_size")]
    rows = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(paths).select("value", *meta)
    pieces = F.split(F.regexp_replace("value", r"\r\z", ""), BREAKS, -1)
    counted = rows.select("*", F.size(pieces).alias("n"), F.element_at(pieces, -1).alias("tail"), F.monotonically_increasing_id().alias("id"))
    blocks = counted.groupBy("file_path", "file_block_start").agg(
        F.sum("n").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.first("file_size").alias("size"), F.max_by(F.struct("n", "tail"), "id").alias("last")
    )
    whole, so_far = Window.partitionBy("file_path"), Window.orderBy("file_path", "file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    ends_file = F.col("file_block_start") == F.max("file_block_start").over(whole)
    loose = ends_file & (F.sum("bytes").over(whole) > F.col("size")) & (F.col("last.n") > 1) & (F.col("last.tail") == "")
    blocks = blocks.withColumn("lines", F.col("lines") - F.when(loose, 1).otherwise(0))
    blocks = blocks.select(F.col("file_path").alias("path"), F.col("file_block_start").alias("start"), "lines", F.coalesce(F.sum("lines").over(so_far), F.lit(0)).alias("before"))
    cut = rows.select("value", "file_path", "file_block_start").mapInArrow(_cut_rows, "path string, start long, at long, raw_line string")
    return cut.join(blocks, ["path", "start"]).filter("at < lines").select(
        F.lit(source_id).alias("source_id"), F.lit(index).alias("source_index"), F.lit(label or source_id).alias("source_input_label"),
        (F.col("before") + F.col("at")).cast("int").alias("line_index"), "raw_line",
    )


def matching_paths(spark: SparkSession, location: str) -> list[str]:
    """Paths of a location, in order; ``**`` stands for folders of any depth.  No match gives none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if "**" not in location:
        return sorted(s.getPath().toString() for s in fs.globStatus(path) or [])
    base = jvm.org.apache.hadoop.fs.Path(re.split(r"/[^/]*[*?\[]", location, maxsplit=1)[0] or "/")
    if not fs.exists(base):
        return []
    marks = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    wanted = "".join(marks.get(part, re.escape(part)) for part in re.split(r"(\*\*/|\*\*|\*|\?)", fs.makeQualified(path).toUri().getPath()))
    out, files = [], fs.listFiles(base, True)
    while files.hasNext():
        found = files.next().getPath()
        if re.fullmatch(wanted, found.toUri().getPath()):
            out.append(found.toString())
    return sorted(out)


def fetched_lines(spark: SparkSession, sources: list[Source], fetch: Callable[[str, float], str] | None = None) -> DataFrame:
    """Lines of URL sources, fetched on the executors, one source a task; a source that fails gives no lines."""
    rows = [(s.id, s.index, s.label, s.input["location"], float(s.settings["fetch"]["request_timeout"])) for s in sources]
    if not rows:
        return spark.createDataFrame([], LINES_SCHEMA)

    def default(url: str, timeout: float) -> str:
        with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
            return answer.read().decode("utf-8")

    get = fetch or default

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source_id, index, label, url, timeout in batch.itertuples(index=False):
                try:
                    lines = get(url, timeout).splitlines()
                except (OSError, ValueError):
                    continue
                yield pd.DataFrame({"source_id": source_id, "source_index": index, "source_input_label": label, "line_index": range(len(lines)), "raw_line": lines})

    table = spark.createDataFrame(rows, "source_id string, source_index int, source_input_label string, url string, timeout double")
    return table.repartition(len(rows)).mapInPandas(run, LINES_SCHEMA)


def source_lines(spark: SparkSession, sources: list[Source], fetch: Callable[[str, float], str] | None = None, prepared: frozenset[str] = frozenset()) -> DataFrame:
    """Raw lines of all enabled sources but those ``prepared`` elsewhere, which are neither fetched nor read."""
    on = [s for s in sources if s.enabled and s.id not in prepared]
    out = fetched_lines(spark, [s for s in on if s.input["type"] == "url"], fetch)
    for s in on:
        if s.input["type"] == "file" and (paths := matching_paths(spark, s.input["location"])):
            out = out.unionByName(text_lines(spark, paths, s.id, s.index, s.label))
    return out


def override_lines(spark: SparkSession, folder: str, config_name: str) -> dict[str, DataFrame]:
    """Lines of the three override lists; a list that is not there is empty."""
    out = {}
    for kind in ("manual_filter_pass", "manual_filter_out", "manual_add"):
        paths = matching_paths(spark, f"{folder}/{kind}/{config_name}.txt")
        out[kind] = text_lines(spark, paths, kind) if paths else spark.createDataFrame([], LINES_SCHEMA)
    return out
