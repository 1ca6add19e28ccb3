"""Licence scan: Dice coefficient over word bigrams against licence templates, in DataFrame functions only.

A document's segments are its lines, where its size may match a template the whole text
and, with ``runs``, every run of consecutive lines.  A segment is normalised (lower case, runs of other than letters and digits as one
space).  Dice = 2 |A and B| / (|A| + |B|) over distinct word bigrams; to reach ``least`` a
segment must have between least / (2 - least) and (2 - least) / least times a template's
bigrams, so segments outside every template's bounds are dropped before they are compared, and each
template meets only segments within its own bounds.  A document without any of a set of telling
words, one of which every match must hold, is dropped in one scan, and what is left is written once.
Bigrams join the templates' bigrams by equality; the template table is fixed, so it is
broadcast.

Runs are not listed one by one.  A run can match a template only in a document that holds
least / (2 - least) of the template's bigrams, and the best runs start and end on lines
that hold one.  For each such first line the distinct bigrams of all runs from it are
running sums over their last lines, since a bigram counts where it first occurs from that
line on.  A run ends where the bigrams new to the document alone exceed the template's bound, so a
long document costs its length times a template's size.  Matching runs of one template that overlap count as one match, with the best
Dice; its segment is the negative number of its earliest line.

Nulls and odd input: a null text counts as empty and has no match; a segment of fewer
than two words has no bigram; a repeated row or id is reported once for each row, with
the same result; ties take the template listed first (the list stands in name order); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

# Public licence notices and texts, under their SPDX names.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: The full texts and the notices, for scans of runs of lines; a full text may quote a notice, so it stands first.
FULL_TEMPLATES = [(f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))] + TEMPLATES
#: Dice from which a segment counts as a match.
LEAST = 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(templates: list[tuple[str, str]]) -> list[tuple[int, str, int, str]]:
    """(template number, licence, bigrams of the template, bigram)."""
    rows = []
    for number, (name, text) in enumerate(templates):
        words = words_of(text)
        grams = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
        rows += [(number, name, len(grams), g) for g in sorted(grams)]
    return rows


def telling_words(templates: list[tuple[str, str]], least: float) -> list[str]:
    """Words of which every matching segment holds one, long ones first.

    A match shares at least least / (2 - least) of a template's bigrams, so of any set of
    bigrams larger than the rest it holds one, and with it that bigram's words.  Words are
    added until those of each template stand in that many of its bigrams.
    """
    by_template: dict[int, list[str]] = {}
    for number, _, _, gram in template_bigrams(templates):
        by_template.setdefault(number, []).append(gram)
    chosen: set[str] = set()
    for grams in sorted(by_template.values(), key=len):
        wanted = len(grams) - math.ceil(len(grams) * least / (2 - least) - 1e-9) + 1
        open_ = [g for g in grams if chosen.isdisjoint(g.split())]
        while len(grams) - len(open_) < wanted:
            words = Counter(w for g in open_ for w in set(g.split()))
            best = max(words, key=lambda w: (len(w) > 4, words[w] * min(len(w), 8), len(w), w))
            chosen.add(best)
            open_ = [g for g in open_ if best not in g.split()]
    return sorted(chosen)


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(template_bigrams(templates), "template int, license string, template_size int, gram string")


def suspects(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """doc_id, text_key and text in lower case of the documents that hold a telling word; one scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    telling = F.array(*[F.lit(w) for w in telling_words(templates, least)])
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.lower(text).alias("low"))
    return base.filter(F.arrays_overlap(F.split("low", NOT_WORD), telling))


def license_matches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST,
    few: DataFrame | None = None,
) -> DataFrame:
    """All matches: doc_id, text_key, segment (0: whole text, else line number), license, template, dice.

    ``few`` is the table that ``suspects`` gives, where it is written already.
    """
    spark = docs.sparkSession
    sizes = [r[2] for r in template_bigrams(templates)]
    fewest, most = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    telling = F.array(*[F.lit(w) for w in telling_words(templates, least)])
    few = suspects(docs, id_col, text_col, templates, least) if few is None else few
    # A segment of b distinct bigrams has more than b words; repeats can only add words, so only the
    # lower bound can be told from the count of words.  The upper bound is told from the bigrams.
    segments = few.select(
        "doc_id", "text_key", F.posexplode(F.concat(F.array("low"), F.split("low", "\n"))).alias("segment", "line")
    ).filter((F.length("line") > 2 * fewest) & F.arrays_overlap(F.split("line", NOT_WORD), telling))
    words = F.filter(F.split("line", NOT_WORD), lambda w: w != "")
    last = F.greatest(F.size("words") - 1, F.lit(0))  # Spark may test the bigrams before the word count
    grams = F.array_distinct(
        F.zip_with(F.slice("words", 1, last), F.slice("words", 2, last), lambda a, b: F.concat_ws(" ", a, b))
    )
    rows = (
        segments.withColumn("words", words).filter(F.size("words") > fewest)
        .withColumn("grams", grams).withColumn("size", F.size("grams"))
        .filter((F.col("size") >= fewest) & (F.col("size") <= most))
        .select("doc_id", "text_key", "segment", "size", F.explode("grams").alias("gram"))
    )
    bounds = (F.col("size") >= F.col("template_size") * (least / (2 - least)) - 1e-9) & (
        F.col("size") <= F.col("template_size") * ((2 - least) / least) + 1e-9
    )
    shared = rows.join(F.broadcast(template_table(spark, templates)), "gram").filter(bounds)
    # Grouped with the text's key: twins of a repeated row would double the count of shared bigrams.
    counted = shared.groupBy("doc_id", "text_key", "segment", "template", "license", "size", "template_size").agg(
        F.count_distinct("gram").alias("common")
    )
    dice = 2.0 * F.col("common") / (F.col("size") + F.col("template_size"))
    return counted.select("doc_id", "text_key", "segment", "license", "template", dice.alias("dice")).filter(F.col("dice") >= least)


def _pairs(tokens: Column | str, join) -> Column:
    """``join`` of each token with the next."""
    last = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, 1, last), F.slice(tokens, 2, last), join)


def _words(text: Column | str) -> Column:
    return F.filter(F.split(text, NOT_WORD), lambda w: w != "")


def run_matches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST,
    few: DataFrame | None = None,
) -> DataFrame:
    """Matches of runs of two lines and more, in the columns of ``license_matches``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "license")
    share = least / (2 - least)
    fewest = min(r[2] for r in template_bigrams(templates)) * share
    table = F.broadcast(template_table(spark, templates))
    base = suspects(docs, id_col, text_col, templates, least) if few is None else few
    base = base.filter(F.col("low").contains("\n"))
    own = ["doc_id", "text_key"]
    held = base.withColumn("words", _words("low")).filter(F.size("words") > fewest).select(
        *own, F.explode(F.array_distinct(_pairs("words", lambda a, b: F.concat_ws(" ", a, b)))).alias("gram")
    )
    able = held.join(table, "gram").groupBy(*own, "template", "license", "template_size").agg(
        F.count_distinct("gram").alias("held")
    ).filter(F.col("held") >= F.col("template_size") * share - 1e-9).drop("held")
    able = scratch.save(able, "able")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))
    few = base.alias("a").join(able.select(*own).distinct().alias("b"), same("a", "b"), "left_semi").dropDuplicates(own)
    tokens = F.flatten(F.transform(F.split("low", "\n"), lambda line, k: F.transform(_words(line), lambda w: F.struct(w.alias("w"), (k + 1).alias("k")))))
    grams = _pairs("tokens", lambda a, b: F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("gram"), a["k"].alias("first"), b["k"].alias("last")))
    placed = few.withColumn("tokens", tokens).select(*own, F.posexplode(grams).alias("at", "g")).select(*own, "at", "g.*")
    placed = placed.withColumn("before", F.coalesce(F.lag("first").over(Window.partitionBy(*own, "gram").orderBy("at")), F.lit(0)))
    # Bigrams new to the document up to this one: between two places they are distinct, so they bound a run's size from below.
    new = (F.col("before") == 0).cast("long")
    placed = placed.withColumn("new", F.sum(new).over(Window.partitionBy(*own).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    kind = [*own, "template", "license", "template_size"]
    hit = table.select("template", "gram", F.lit(1).alias("hit"))
    marked = placed.alias("a").join(able.alias("b"), same("a", "b")).select("a.*", "b.template", "b.license", "b.template_size").join(
        hit, ["template", "gram"], "left"
    )
    marked = scratch.save(marked, "marked")
    starts = marked.filter("hit = 1").groupBy(*own, "template", "first").agg(F.min("new").alias("new")).groupBy(*own, "template").agg(
        F.collect_list(F.struct("first", "new")).alias("starts")
    )
    room = F.col("template_size") * ((2 - least) / least) + 1
    counted = F.filter(
        "starts", lambda s: (s["first"] > F.col("before")) & (s["first"] <= F.col("first")) & (F.col("new") - s["new"] <= room)
    )
    from_start = marked.alias("a").join(
        starts.alias("b"), same("a", "b") & (F.col("a.template") == F.col("b.template"))
    ).select("a.*", F.explode(F.transform(counted, lambda s: s["first"])).alias("start"))
    so_far = Window.partitionBy(*kind, "start").orderBy("last")
    sums = from_start.groupBy(*kind, "start", "last").agg(F.count("*").alias("size"), F.sum("hit").alias("common"))
    dice = 2.0 * F.sum("common").over(so_far) / (F.sum("size").over(so_far) + F.col("template_size"))
    found = sums.withColumn("dice", dice).filter((F.col("dice") >= least) & (F.col("last") > F.col("start")))
    runs = found.groupBy(*kind, "start").agg(F.max("last").alias("last"), F.max("dice").alias("dice"))
    order = Window.partitionBy(*kind).orderBy("start")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("opens", F.when(F.col("start") <= reached, 0).otherwise(1)).withColumn("island", F.sum("opens").over(order))
    return runs.groupBy(*kind, "island").agg(F.min("start").alias("start"), F.max("dice").alias("dice")).select(
        *own, (-F.col("start")).alias("segment"), "license", "template", "dice"
    )


def license_report(docs: DataFrame, runs: bool = False, **options) -> DataFrame:
    """One row a document: doc_id, license (of the best match, null for none), dice, n_matches (segments with a match).

    Runs of lines are segments only with ``runs``, as the query asks for.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    few = suspects(docs, id_col, text_col, options.get("templates", TEMPLATES), options.get("least", LEAST))
    if runs:
        few = Scratch(docs.sparkSession, "license-few").save(few, "few")
    matches = license_matches(docs, few=few, **options)
    if runs:
        matches = matches.unionByName(run_matches(docs, few=few, **options))
    best = matches.groupBy("doc_id", "text_key").agg(
        F.max_by("license", F.struct("dice", -F.col("template"))).alias("license"),
        F.max("dice").alias("dice"),
        F.count_distinct("segment").alias("n_matches"),
    )
    keys = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    joined = keys.alias("d").join(
        best.alias("b"),
        F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_key") == F.col("b.text_key")),
        "left",
    )
    return joined.select(
        "d.doc_id", "b.license", F.round("b.dice", 6).alias("dice"), F.coalesce("b.n_matches", F.lit(0)).cast("long").alias("n_matches")
    )
