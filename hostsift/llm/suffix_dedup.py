"""Removal of repeated byte strings by a depth-limited most-significant-digit radix sort.

Suffixes are ordered only through their first ``length`` bytes, and a suffix leaves the
sort as soon as its group has one member.  The digits are taken from content, so that
equal strings meet whatever their places:

1. A window of ``length`` bytes is filed under its anchor, the leftmost smallest hash among
   its 40-byte grams.  Equal windows have equal anchors at equal distances.  An anchor gram
   that occurs once ends the sort for all windows filed under it (about 180 at a time).
2. Windows of one anchor go in blocks of 32 neighbours.  The bytes common to a block's
   windows are the next digit: unless they repeat, no window of the block does.  The bytes
   that the block spans are the last digit taken for all 32 together: if they repeat, all do.
3. Windows of the blocks still open are sorted by all their bytes.  Groups of two or more
   are exactly the repeated strings.

Each pass groups by digest and keeps smallest and largest occurrence, which Spark
pre-aggregates, so a passage that a third of the rows share arrives as one row a task.
Only what occurs once is sent back to its document; the rest is repeated.  Rows of equal
texts are one text here: with two rows or more every byte of it is repeated.

Anchors use 64-bit rolling hashes (an accident only costs work); blocks and windows use
128 bits of BLAKE2b.  A text is named by 128 bits of its SHA-256.

Bytes say nothing of repeated passages shorter than ``length``, so a further column tells
those of 50 words: ``n_shared`` counts a text's word anchors (the smallest hash among each
26 neighbouring runs of 25 words) that another text holds too.  Two texts that share 50
words in a row always share an anchor, and a shared anchor is 25 shared words.

Nulls and odd input: a null text is empty; rows with a null id take part, and such a row
is reported with a null id; a repeated row counts as one more copy; texts shorter than
``length`` lose nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, joined_by_size

#: Words in a run that may be an anchor, and runs of which the smallest is one.
RUN, RUNS = 25, 26
GRAM = 40
BLOCK = 32
#: Bytes that numpy handles at once; a longer text is a block of its own.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(20_240_607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k < n."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[size] = tuple(made)
    return _powers[size]


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place."""
    n = len(data)
    up, down = _power(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[: n - width + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of aligned blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors_of(texts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its anchors: packed (place, smallest and largest distance of windows filed there) and gram hash."""
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(data) < length:
        return [none] * len(texts)
    grams = gram_hashes(data, GRAM)
    bits = np.uint64(max(20, len(data).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(keyed, length - GRAM + 1) & low).astype(np.int64)
    out = []
    for end, text in zip(ends.tolist(), texts, strict=True):
        start, last = end - len(text), end - length
        if last < start:
            out.append(none)
            continue
        run = anchor[start : last + 1]
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        to = np.append(first[1:], len(run)) - 1
        at = run[first] - start
        out.append((at << 20 | (at - to) << 10 | (at - first), grams[run[first]].view(np.int64)))
    return out


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_anchors(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the distinct hashes of its word anchors: every ``RUN + RUNS - 1`` words in a row hold one, however they are spaced."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[: len(data)], out=sums[1:])
    words = (sums[stops] - sums[starts]) * down[starts]
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xD6E8FEB86659FD93)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    runs = (total[RUN:] - total[:-RUN]) * down[: max(0, len(words) - RUN + 1)] if len(words) >= RUN else np.zeros(0, np.uint64)
    runs ^= runs >> np.uint64(32)
    runs *= np.uint64(0x9FB21C651E98DF25)
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    out = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = runs[low : max(low, high - RUN + 1)]
        out.append(np.unique(sliding_min(own, min(RUNS, len(own)))).view(np.int64) if len(own) else np.zeros(0, np.int64))
    return out


def _batched(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    held, size, at = [], 0, 0
    for k, t in enumerate(texts):
        if held and size + len(t) > CHUNK:
            yield at, held
            held, size, at = [], 0, k
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def _text_bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


#: The two halves of a text's name.
NAME = ["key", "key2"]
SIGNED = "doc_id long, key long, key2 long, n_bytes long, sha256 string, packed array<long>, grams array<long>, runs array<long>"


def _signed(length: int):
    """Digest and size of every row; anchors once a task and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted: set[bytes] = set()
        for batch in batches:
            for at, held in _batched(_text_bytes(batch["text"])):
                digests = [sha256(t).digest() for t in held]
                new = []
                for k, d in enumerate(digests):
                    if d not in emitted:
                        if len(emitted) >= 200_000:
                            emitted.clear()
                        emitted.add(d)
                        new.append(k)
                first = [held[k] for k in new]
                found = dict(zip(new, zip(anchors_of(first, length), word_anchors(first), strict=True), strict=True))
                packed, grams, runs = [], [], []
                for k in range(len(held)):
                    (p, g), r = found.get(k, ((None, None), None))
                    packed.append(p)
                    grams.append(g)
                    runs.append(r)
                names = np.frombuffer(b"".join(d[:16] for d in digests), "<i8").reshape(-1, 2)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, len(held)), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([len(t) for t in held], pa.int64()),
                        pa.array([d.hex() for d in digests]), pa.array(packed, longs), pa.array(grams, longs), pa.array(runs, longs),
                    ],
                    ["doc_id", *NAME, "n_bytes", "sha256", "packed", "grams", "runs"],
                )

    return run


def _name_of(text: bytes) -> tuple[int, int]:
    d = sha256(text).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:16], "little", signed=True)


def _name(key: int, place: int) -> int:
    """64-bit name of an occurrence."""
    x = (key ^ (place * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 31) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 29) - (1 << 63)


def _digest(*parts: bytes) -> int:
    h = blake2b(digest_size=8)
    for p in parts:
        h.update(p)
    return int.from_bytes(h.digest(), "little", signed=True)


BLOCKS = "key long, key2 long, place long, block int, occ long, core long, span long"


def _blocks(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, key2, text, open_ in zip(batch["key"], batch["key2"], batch["text"], batch["open"], strict=True):
                data, rows = text, []
                for packed in open_:
                    place, least, most = int(packed) >> 20, int(packed) >> 10 & 1023, int(packed) & 1023
                    for j in range(least // BLOCK, most // BLOCK + 1):
                        start = place - BLOCK * j
                        end = start + length
                        occ = _name(key, place * 64 + j)
                        tag = bytes([j])
                        core = _digest(tag, data[start : end - BLOCK + 1])
                        first = start - BLOCK + 1
                        span = _digest(b"s", tag, data[first:end]) if first >= 0 and end <= len(data) else occ
                        rows.append((key, key2, place, j, occ, core, span))
                yield pd.DataFrame(rows, columns=[*NAME, "place", "block", "occ", "core", "span"])

    return run


WINDOWS = "key long, key2 long, at long, guest boolean, occ long, w1 long, w2 long"


def _windows(length: int):
    """Windows of open blocks; those of guests stand for a block whose windows all repeat."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, key2, text, open_, wanted in zip(batch["key"], batch["key2"], batch["text"], batch["open"], batch["wanted"], strict=True):
                reach = {int(p) >> 20: (int(p) >> 10 & 1023, int(p) & 1023) for p in open_}
                rows = []
                for w in wanted:
                    w = int(w)
                    place, j, guest = w >> 7, w >> 1 & 63, bool(w & 1)
                    least, most = reach[place]
                    for i in range(max(least, j * BLOCK), min(most, j * BLOCK + BLOCK - 1) + 1):
                        at = place - i
                        d = blake2b(text[at : at + length], digest_size=16).digest()
                        rows.append((key, key2, at, guest, _name(key, at), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
                yield pd.DataFrame(rows, columns=[*NAME, "at", "guest", "occ", "w1", "w2"])

    return run


CUT = "key long, key2 long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def _cut(length: int):
    """Takes off all windows of open anchors but those of blocks and places that occur once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, key2, text, open_, dead, single in zip(batch["key"], batch["key2"], batch["text"], batch["open"], batch["dead"], batch["single"], strict=True):
                n = len(text)
                starts = np.zeros(n + 1, bool)
                reach = {}
                for p in open_:
                    place, least, most = int(p) >> 20, int(p) >> 10 & 1023, int(p) & 1023
                    reach[place] = (least, most)
                    starts[place - most : place - least + 1] = True
                for w in [] if dead is None else dead:
                    place, j = int(w) >> 6, int(w) & 63
                    least, most = reach[place]
                    starts[place - min(most, j * BLOCK + BLOCK - 1) : place - max(least, j * BLOCK) + 1] = False
                if single is not None and len(single):
                    starts[np.asarray(single, np.int64)] = False
                at = np.flatnonzero(starts)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge[:n]) > 0
                bounds = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((key, key2, int(gone.sum()), len(bounds) // 2, sha256(kept).hexdigest(), bounds.astype(np.int64)))
            yield pd.DataFrame(rows, columns=[*NAME, "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end of each removed run, in turn), n_shared."""
    if not GRAM < length <= 1023:
        raise ValueError(f"length must be over {GRAM} and at most 1023")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = scratch.save(base.mapInArrow(_signed(length), SIGNED), "signed")
    # Of a text's rows those with the smallest id own it; a row of that id with another text is told by its name.
    texts = scratch.save(signed.groupBy(*NAME).agg(F.min("doc_id").alias("owner"), F.count("*").alias("rows"), F.max(F.size("runs")).alias("n_runs")), "texts")

    # Pass 1: anchors whose gram occurs once, by text; a text with others goes on.  Word anchors that two texts hold ride along.
    longs = F.array().cast("array<long>")
    told = F.concat(
        F.transform(F.arrays_zip("packed", "grams"), lambda x: F.struct(x["packed"].alias("packed"), x["grams"].alias("gram"))),
        F.transform("runs", lambda r: F.struct(F.lit(-1).cast("long").alias("packed"), r.alias("gram"))),
    )
    anchors = signed.filter("size(packed) > 0 OR size(runs) > 0").select(*NAME, F.inline(told))
    occurrence = F.when(F.col("packed") < 0, F.xxhash64("key2", "key")).otherwise(F.xxhash64("key", F.shiftright("packed", 20)))
    once = anchors.groupBy("gram").agg(
        F.min(occurrence).alias("lo"), F.max(occurrence).alias("hi"), F.min("key").alias("key"), F.min("key2").alias("key2"), F.min("packed").alias("packed")
    ).filter("lo = hi").groupBy(*NAME).agg(
        F.collect_list(F.when(F.col("packed") >= 0, F.col("packed"))).alias("once"), F.count_if(F.col("packed") < 0).alias("own_runs")
    )
    kept = signed.filter("size(packed) > 0 OR size(runs) > 0").select(*NAME, "packed", F.size("runs").alias("runs")).dropDuplicates(NAME)
    judged = kept.join(once, NAME, "left").select(
        *NAME, F.array_except("packed", F.coalesce("once", longs)).alias("open"), (F.col("runs") - F.coalesce("own_runs", F.lit(0))).alias("n_shared"), "runs"
    ).filter("size(open) > 0 OR n_shared > 0")
    going = scratch.save(judged.join(texts.select(*NAME, "owner"), NAME), "going")
    wanted_texts = going.filter("size(open) > 0").select(*NAME, "open", "owner")
    # Rows of one id without a text of its own to own are few; null ids have none to join by, so they are sought by text.
    named = base.join(wanted_texts.filter("owner IS NOT NULL"), F.col("doc_id") == F.col("owner")).select(*NAME, "open", "text")
    nameless = base.filter("doc_id IS NULL").withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    # The name as the signing task reads it: the digest's bytes, little-endian.
    half = lambda at: F.conv(F.array_join(F.transform(F.sequence(F.lit(14), F.lit(0), F.lit(-2)), lambda k: F.substring(F.col("sha"), k + 1 + at, F.lit(2))), ""), 16, -10).cast("long")
    nameless = nameless.withColumns({"key": half(0), "key2": half(16)}).drop("doc_id", "sha")
    nameless = nameless.join(wanted_texts.filter("owner IS NULL"), NAME).select(*NAME, "open", "text")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _text_bytes(batch["text"])
            right = [_name_of(t) == n for t, n in zip(texts, zip(batch["key"].to_pylist(), batch["key2"].to_pylist(), strict=True), strict=True)]
            made = pa.RecordBatch.from_arrays([batch["key"], batch["key2"], batch["open"], pa.array(texts, pa.binary())], [*NAME, "open", "text"])
            yield made.filter(pa.array(right))

    open_texts = scratch.save(named.unionByName(nameless).mapInArrow(checked, "key long, key2 long, open array<long>, text binary"), "open")

    # Pass 2: blocks.
    blocks = open_texts.mapInPandas(_blocks(length), BLOCKS)
    spans = blocks.groupBy("core", "span").agg(
        F.min(F.struct("occ", *NAME, "place", "block")).alias("lo"), F.max("occ").alias("hi")
    ).select("core", F.col("lo.occ").alias("occ"), "hi", "lo.key", "lo.key2", "lo.place", "lo.block")
    spans = scratch.save(spans, "spans")
    cores = spans.groupBy("core").agg(
        F.min("occ").alias("c_lo"), F.max("hi").alias("c_hi"), F.count_if(F.col("occ") == F.col("hi")).alias("singles")
    ).filter("singles > 0")
    told_apart = spans.join(cores, "core")
    dead = told_apart.filter("c_lo = c_hi").groupBy(*NAME).agg(F.collect_list(F.shiftleft("place", 6) + F.col("block")).alias("dead"))
    guest = (F.col("occ") != F.col("hi")).cast("long")
    wanted = told_apart.filter("c_lo != c_hi").groupBy(*NAME).agg(
        F.collect_list(F.shiftleft("place", 7) + F.col("block") * 2 + guest).alias("wanted")
    )

    # Pass 3: windows.
    windows = open_texts.join(wanted, NAME).dropDuplicates(NAME).mapInPandas(_windows(length), WINDOWS)
    single = windows.groupBy("w1", "w2").agg(
        F.min(F.struct("occ", *NAME, "at", "guest")).alias("lo"), F.max("occ").alias("hi")
    ).filter("lo.occ = hi AND NOT lo.guest").groupBy("lo.key", "lo.key2").agg(F.collect_list("lo.at").alias("single"))
    cut = open_texts.dropDuplicates(NAME).join(dead, NAME, "left").join(single, NAME, "left").mapInPandas(_cut(length), CUT)
    cut = scratch.save(cut, "cut")

    # A text of several rows is removed whole, so only texts of one row meet their cuts, and large groups meet nothing.
    zero = F.lit(0).cast("long")
    rows = joined_by_size(signed.select("doc_id", *NAME, "n_bytes", "sha256"), texts.select(*NAME, "rows", "n_runs"), NAME, "rows")
    many = (F.col("rows") > 1) & (F.col("n_bytes") >= length)
    several = rows.filter("rows > 1").select(
        "doc_id", "n_bytes",
        F.when(many, F.col("n_bytes")).otherwise(zero).alias("n_removed"), F.when(many, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(many, sha256(b"").hexdigest()).otherwise(F.col("sha256")).alias("kept_sha256"),
        F.when(many, F.array(zero, F.col("n_bytes"))).otherwise(longs).alias("spans"), F.col("n_runs").cast("long").alias("n_shared"), *NAME,
    )
    alone = rows.filter("rows = 1").join(cut, NAME, "left").join(going.select(*NAME, "n_shared"), NAME, "left")
    alone = alone.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), F.coalesce("spans", longs).alias("spans"), F.coalesce("n_shared", zero).alias("n_shared"), *NAME,
    )
    return several.unionByName(alone).drop(*NAME)
