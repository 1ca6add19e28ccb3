"""Thin command line over the run: ``python -m hostsift.cli run|status ...``."""

from __future__ import annotations

import argparse
import datetime
import importlib
import json
import os
import sys
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import buckets, lifecycle, run, sinks
from .operators.suffixes import public_suffix_rules
from .sources import lists
from .sources.config import load_config, run_settings


def run_config(
    spark: SparkSession, path: str, root: str, providers: dict, overrides: str, now: str, complete: bool = True, parts: int = 1, seconds: float = float("inf"),
    clock: Callable[[], float] = time.monotonic,
) -> dict:
    """Runs a configuration file: sources to published outputs and written caches; returns the manifest.

    ``providers`` holds the three lookups (rdap, dns, geo) as functions of key frames, and
    may hold ``services``, the registry servers by suffix.  With several parts and a time
    budget, a run that does not end leaves a snapshot of what is done, and the next call goes
    on with the parts that are left; the budget is looked at before each part.
    """
    name = os.path.splitext(os.path.basename(path))[0]
    sources, cache = load_config(path)
    on = [s for s in sources if s.enabled]
    settings = run_settings(on, cache)
    paths = sinks.output_paths(root, name)
    work = f"{root}/work/{name}"
    begun = sinks.read_text(spark, f"{work}/entries.json") is not None
    if not begun:
        lines = lists.source_lines(spark, on)
        formats = {s.id: s.input["format"] for s in on if s.input["format"] != "auto"}
        entries, ended = run.prepared(lines, lists.override_lines(spark, overrides, name), public_suffix_rules(spark), formats, settings.sources)
        ended.write.mode("overwrite").parquet(f"{work}/ended")
    else:
        entries = None
    ended = spark.read.parquet(f"{work}/ended")

    def screen(part, k):
        made_in = f"{work}/tables/{k}-{uuid.uuid4().hex}"

        def keep(df, what):
            df.write.parquet(f"{made_in}/{what}")
            return spark.read.parquet(f"{made_in}/{what}")

        layers = {f"{c}_cache": (buckets.read(spark, paths[c]), None) for c in ("root", "dns", "geo")}
        rows, made = run.screened(part, run.Lookups(**providers, **layers), settings, F.to_timestamp(F.lit(now)), keep=keep)
        # The part's rows are written from these caches' old files, so the new rows follow.
        kept = keep(rows, "terminal")
        sinks.write_caches(spark, paths, made)
        return kept

    rows, left = run.screened_in_parts(spark, work, entries, parts, screen, seconds, clock)
    whole = ended if rows is None else rows.unionByName(ended, allowMissingColumns=True)
    manifest = sinks.publish(whole, f"{root}/output", name, complete and not left) | {"parts_left": left}
    if not left:
        sinks._delete(spark, work)
    return manifest


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="hostsift")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run", help="screen the sources of a configuration and publish")
    for flag in ("--config", "--root", "--overrides", "--providers"):
        one.add_argument(flag, required=True, help="module:function that gives the lookups" if flag == "--providers" else None)
    one.add_argument("--parts", type=int, default=1)
    one.add_argument("--seconds", type=float, default=float("inf"), help="time after which no further part is begun")
    one.add_argument("--now", default=f"{datetime.datetime.now(datetime.UTC):%Y-%m-%d %H:%M:%S}")
    state = commands.add_parser("status", help="state of a batch")
    for flag in ("--root", "--batch"):
        state.add_argument(flag, required=True)
    state.add_argument("--workers", required=True, help="names, joined by commas")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("hostsift").getOrCreate()
    if given.command == "status":
        print(lifecycle.finish(spark, given.root, given.batch, given.workers.split(","), f"{datetime.datetime.now(datetime.UTC):%Y-%m-%dT%H:%M:%SZ}"))
        return 0
    module, _, function = given.providers.partition(":")
    providers = getattr(importlib.import_module(module), function)(spark)
    print(json.dumps(run_config(spark, given.config, given.root, providers, given.overrides, given.now, parts=given.parts, seconds=given.seconds), sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
