"""Mixing, collocations and the conversation trie against brute force, and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hostsift.llm import collocations as collocations_
from hostsift.llm import conversation_trie as trie_
from hostsift.llm import mixing
from hostsift.llm.common import Scratch
from hostsift.operators import places

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# --- places


def test_places_and_group_places(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, None]), rng.random(), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g long, x double, k long").repartition(7)
    scratch = Scratch(spark, "places")
    got = {r["k"]: r["place"] for r in rows_of(places.with_places(df, ["x", "k"], scratch.save))}
    assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    want, seen = {}, Counter()
    for g, _, k in sorted(rows, key=lambda r: (r[1], r[2])):
        want[k] = seen[g]
        seen[g] += 1
    assert {r["k"]: r["place"] for r in rows_of(places.with_group_places(df, "g", ["x", "k"], scratch.save, "grouped"))} == want


# --- 11


def brute_mix(rows, weights=(5, 2, 1), most=3):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    by = defaultdict(int)
    for n, (_, _, s) in zip(size, rows, strict=True):
        by[s] += n
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest, shared = sum(by.values()) - sum(most * by[s] for s in full), sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and most * by[s] * shared < rest * weight[s]}
        if not more:
            break
        full |= more
    target = {s: float(most * by[s]) if s in full else rest * weight[s] / shared for s in order}
    out = []
    for n, (k, t, s) in zip(size, rows, strict=True):
        key = str(k) if k is not None else "text:" + hashlib.md5((t or "").encode()).hexdigest()
        u = int(hashlib.md5(f"11:{key}".encode()).hexdigest()[:13], 16) / 2**52
        rate = target[s] / by[s] if by[s] else 0.0
        out.append((k, n, by[s], target[s], n * (math.floor(rate) + (u < rate - math.floor(rate)))))
    return out


def mix_rows(rng, n=400):
    sources = ["big"] * 12 + ["a", "é", "", None, "tiny", "none"]
    rows = []
    for k in range(n):
        s = rng.choice(sources)
        text = "" if s == "none" else " \t".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 3 if s == "tiny" else 40)))
        rows.append((k, None if k % 37 == 0 else f" {text}\n" if k % 5 else text, s))
    return rows + [(7, "x y", "a"), (None, "p q", "big"), (None, "p q", "big"), (None, None, None)]


def test_mixing(spark):
    rows = mix_rows(random.Random(2))
    docs = spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in rows], DOCS)
    got = sorted((tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in rows_of(mixing.mix_plan(docs))), key=str)
    want = brute_mix(rows)
    assert got == sorted(want, key=str)
    assert any(t == 3.0 * n and n for _, _, n, t, _ in want), "no source at its bound"
    assert all(taken <= 3 * size for _, size, _, _, taken in want)


def test_mixed_documents_are_the_plan(spark):
    rows = mix_rows(random.Random(3), 200)
    docs = spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in rows], DOCS).withColumns({c: F.lit(1) for c in ("key", "size", "u", "row", "n", "copy", "rate")})
    made = mixing.mixed_documents(docs).groupBy("row.doc_id", "row.text").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("m"), F.max("copy").alias("last"))
    got = {(r["doc_id"], r["text"]): r["n"] for r in rows_of(made)}
    want = Counter()
    for r in rows_of(mixing.mix_plan(docs.select("doc_id", "text", "source")).join(docs.select("doc_id", "text"), "doc_id")):
        want[(r["doc_id"], r["text"])] += r["copies"]
    own = {key: n for key, n in want.items() if n and key[0] not in (None, 7)}  # repeated ids meet in the join above
    assert own == {key: n for key, n in got.items() if key[0] not in (None, 7)}


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 10).cast("string"))).alias("source")
    )
    made = mixing.mix_plan(docs).join(docs.select("doc_id", "source"), "doc_id")
    sums = made.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in rows_of(sums))


# --- 12


def brute_phrases(rows, least, top=2000, longest=5, percent=100):
    counts: dict = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        kept = []
        for p, a in found.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, _, left, right = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows(rng, n=150):
    words = ["New", "york", "CITY", "é", "ß.x", "a\x1cb", "l'été", "the", "of", "İ", "no break", "k "]
    rows = [(rng.choice(["en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "!"]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), ("en", " ,. "), ("fr", "one two three four five six " * 40), (None, "one two three. " * 9)]


@pytest.mark.parametrize("least,percent,stretch,size", [(3, 100, 4_000_000, 1 << 20), (8, 60, 50, 7), (2, 100, 200, 1)])
def test_collocations(spark, monkeypatch, least, percent, stretch, size):
    """Small stretches and slices must not lose a phrase."""
    monkeypatch.setattr(collocations_, "SLICE", size)
    rows = phrase_rows(random.Random(least))
    docs = spark.createDataFrame([(k, t, lang, "s", 0) for k, (lang, t) in enumerate(rows)], DOCS).repartition(3)
    got = collocations_.collocations(docs, least=least, percent=percent, stretch=stretch)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in names) for r in rows_of(got)) == brute_phrases(rows, least, percent=percent)


def test_words_are_cut_alike_in_slices_of_any_size(monkeypatch):
    text = ("Alpha\tbeta, gamma" + "x" * 50 + ". é end").encode()
    whole = [w for part in collocations_.words_of(text) for w in part]
    for size in range(1, 40):
        monkeypatch.setattr(collocations_, "SLICE", size)
        assert [w for part in collocations_.words_of(text) for w in part] == whole


def test_full_fields_lose_no_phrase(spark, monkeypatch):
    """A bit field far too small lets everything pass, and the counts decide."""
    monkeypatch.setattr(collocations_, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations_, "MOST_BITS", 6)
    rows = phrase_rows(random.Random(9), 60)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations_.collocations(docs, least=3)
    assert sorted((r["lang"], r["rank"], r["phrase"], r["score"]) for r in rows_of(got)) == [(x[0], x[1], x[2], x[7]) for x in brute_phrases(rows, 3)]


# --- 13


def brute_trie(rows, heads=9, group=5):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in convs.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(math.fmod(c, group))
        made[c] = own.get(base, [])[:h] + ts[h:]
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(made):
        seq = tuple(made[c])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(saved[k] for k in kids[node])
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def trie_rows(rng, convs=120):
    rows = []
    for c in range(-7, convs):
        if c % 11 == 4:
            continue
        n = 60 if c == 10 else rng.randint(1, 8)
        for k in range(n):
            rows.append((c, None if rng.random() < 0.1 else k, rng.choice(["user", "bot", None]), rng.choice(["hi", "hi", "", None, "ça va", f"t{rng.randint(0, 9)}"])))
    return rows + [(None, 1, "user", "lost"), (3, 1, "user", "hi"), (3, 1, "user", "hi")]


@pytest.mark.parametrize("leaf", [1, 5, 4096])
def test_trie(spark, monkeypatch, leaf):
    """Blocks of few turns and lists of few ids; components are split down to ``leaf`` by rounds."""
    if leaf < 100:
        monkeypatch.setattr(trie_, "BLOCK", 4)
        monkeypatch.setattr(trie_, "ENDS", 3)
    rows = trie_rows(random.Random(leaf), 25 if leaf == 1 else 120)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(tuple(r[c] for c in names) for r in rows_of(trie_.conversation_trie(df, leaf=leaf))) == brute_trie(rows)


def test_local_split_sums_subtrees():
    rng = random.Random(4)
    for n in (1, 2, 3, 50, 400):
        for kind in ("random", "chain", "star"):
            parents = [-1] + [rng.randrange(k) if kind == "random" else k - 1 if kind == "chain" else 0 for k in range(1, n)]
            values = [rng.randint(0, 9) for _ in range(n)]
            want = values[:]
            for v in range(n - 1, 0, -1):
                want[parents[v]] += want[v]
            assert trie_.split_local(parents, list(range(n)), [values])[0] == want


# --- odd input


def test_empty_tables(spark):
    docs, turns = spark.createDataFrame([], DOCS), spark.createDataFrame([], TURNS)
    assert mixing.mix_plan(docs).count() == mixing.mixed_documents(docs).count() == 0
    assert collocations_.collocations(docs).count() == 0
    assert trie_.conversation_trie(turns).count() == 0


def test_clashing_columns_and_long_texts(spark):
    clash = "n f l r words back phrase key size u rate row copy conv pos digest bytes depth node parent comp leaf saved rank score place".split()
    rows = [(k, "long words " * 40_000 if k == 1 else "é" * 300_000 if k == 2 else "a b", "en", "s", 0) for k in range(4)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in clash})
    assert {(r["doc_id"], r["size"]) for r in rows_of(mixing.mix_plan(docs))} == {(0, 2), (1, 80_000), (2, 1), (3, 2)}
    found = rows_of(collocations_.collocations(docs))
    assert {(r["phrase"], r["a"]) for r in found} == {x[2:4] for x in brute_phrases([(r[2], r[1]) for r in rows], 100)}
    turns = [(1, k, "user", r[1]) for k, r in enumerate(rows)]
    made = spark.createDataFrame(turns, TURNS).withColumns({c: F.lit(1) for c in clash})
    assert len(rows_of(trie_.conversation_trie(made))) == len(brute_trie(turns))
