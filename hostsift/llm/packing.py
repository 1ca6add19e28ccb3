"""Best-fit packing by a grouping genetic algorithm, run as islands with elite migration.

A document is tokenised and only a document longer than a sequence is cut.  Pieces of
full length are sequences as they are; the others are dealt by hash into shards of
bounded size.  A shard is packed by several islands (tasks); each evolves a few
solutions.  Crossover injects whole well-filled bins of one parent into another, drops
the bins that repeat their pieces, and best-fits the displaced pieces, longest first.
Between epochs each island sends its elite to the next island of the shard.  A shard
whose elite reaches the proven bound, ceil(sum / capacity), stops.  In the end the
least-filled sequence of each shard is opened and its pieces are packed across shards.

Nulls and odd input: a null text counts as empty and is one piece holding the end id; a
repeated row or id is packed once for each row; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain, pairwise
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, Scratch

CAPACITY = 4096
SHARD = 8192
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 3, 2, 4, 6
#: Tails of so many shards are packed together in the last step.
TAIL_SHARDS = 256
PIECES = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]

#: Letters that the tokenizer's normaliser only puts in lower case: no marks to compose, no letter whose lower case is two.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f"
#: Most chunks: such letters, and ASCII marks behind them.
_PLAIN = f"^(?P<word>[{_LETTERS}]+)(?P<tail>[!-/:-@\\[-`{{-~]*)$"
_SIMPLE = regex.compile(r"[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")
#: How the tokenizer cuts a white-space token.  Fixed value of the vocabulary file.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Bytes of text encoded together (one longer text may come on top), and tokens whose ids are put side by side at a time.
AT_ONCE, TOKENS = 8_000_000, 1 << 18


class _Pieces(RecentCache):
    """Piece in lower case -> its ids as bytes, by the tokenizer's model alone."""

    limit = 400_000

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize = tokenize
        # The model's letters for bytes: printable ones are themselves, the others follow from 256 on.
        same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        other = iter(range(256, 512))
        self.letters = "".join(chr(b if b in same else next(other)) for b in range(256))

    def make(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = charmap_decode(piece.encode(), "strict", self.letters)[0]
        ids = [t.id for t in self.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)


class _Chunks(RecentCache):
    """White-space token -> its ids as bytes: cut as the tokenizer does where that is known, else through the whole tokenizer."""

    limit = 100_000

    def __init__(self, tokenizer, pieces: _Pieces, known: bool, added: list[str]):
        super().__init__()
        self.tokenizer, self.pieces, self.known, self.added = tokenizer, pieces, known, added

    def make(self, chunk: str) -> bytes:
        if self.known and _SIMPLE.fullmatch(chunk) and not any(a in chunk for a in self.added):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(chunk.lower())))
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()


def runs(pool: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of ``pool``, of these sizes, that ``which`` names, one after another."""
    first, made = np.cumsum(sizes) - sizes, [pool[:0]]
    for low in range(0, len(which), TOKENS):
        own = which[low : low + TOKENS]
        size = sizes[own]
        ends = np.cumsum(size)
        made.append(pool[np.repeat(first[own] - (ends - size), size) + np.arange(ends[-1])])
    return np.concatenate(made)


class TextIds:
    """Ids of many texts at once.

    The tokenizer drops white space and no id spans it, so the ids of a text are those
    of its white-space tokens, one after another.  Each distinct token of the texts is
    encoded once: one of plain letters and marks as two pieces by the tokenizer's model,
    any other by itself.  Pieces and tokens are kept in bounded caches.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        form = json.loads(tokenizer.to_str())
        cuts = [c.get("pattern", {}).get("Regex") for c in (form["pre_tokenizer"] or {}).get("pretokenizers", [])]
        known = cuts[:1] == [_PIECE.pattern] and "Lowercase" in str(form["normalizer"])
        self.pieces = _Pieces(tokenizer.model.tokenize)
        self.chunks = _Chunks(tokenizer, self.pieces, known, added)
        # An added token within letters and marks would be of that form itself, or of marks alone.
        self.plain = known and not any(re.match(_PLAIN.replace("+", "*", 1), a) for a in added)

    def shrink(self) -> None:
        """For the end of a task: an idle worker keeps the young generations only."""
        self.chunks.old, self.pieces.old = {}, {}

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct tokens, one after another, and how many each has."""
        if self.plain:
            word, tail = pc.extract_regex(chunks, _PLAIN).flatten()
        else:
            word = tail = pa.nulls(len(chunks), pa.string())
        # Units: no ids, the distinct words and tails, and the tokens of other forms.
        units, named = [b""], np.zeros((len(chunks), 2), np.int64)
        for k, part in enumerate((pc.utf8_lower(word), tail)):
            part = part.dictionary_encode()
            named[:, k] = part.indices.fill_null(-len(units)).to_numpy() + len(units)
            units += map(self.pieces.__getitem__, part.dictionary.to_pylist())
        others = np.flatnonzero(word.is_null())
        named[others, 0] = len(units) + np.arange(len(others))
        units += map(self.chunks.__getitem__, chunks.take(pa.array(others)).to_pylist())
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        return runs(np.frombuffer(b"".join(units), "<u4"), sizes, named.ravel()), sizes[named].sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls, one after another, and how many each has."""
        # The wider cut is also at 1C to 1F, which the tokenizer keeps.
        kept = pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py()
        cut = pc.ascii_split_whitespace(texts) if kept else pc.utf8_split_whitespace(texts)
        tokens, offsets = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
        del cut  # a copy of the texts
        pool, sizes = self.chunk_ids(tokens.dictionary)
        which = tokens.indices.to_numpy()
        before = np.concatenate([[0], np.cumsum(sizes[which])])
        return runs(pool, sizes, which), np.diff(before[offsets])


_encoders: dict[str, TextIds] = {}


def encoder(path: str) -> TextIds:
    if path not in _encoders:
        _encoders[path] = TextIds(path)
    return _encoders[path]


def stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begins and ends of rows that are encoded together."""
    group = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // AT_ONCE
    return pairwise([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)])


def cut_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """One row a piece; uid numbers the rows and is fixed once the table is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        uid = (context.partitionId() if context else 0) << 40
        encode = encoder(tokenizer).encode
        for batch in batches:
            texts = batch["text"].fill_null("")
            for low, high in stretches(texts):
                ids, sizes = encode(texts[low:high])
                data, ends = np.insert(ids, np.cumsum(sizes), end_id), np.cumsum(sizes + 1).tolist()
                rows = []
                for k, (begin, end) in enumerate(pairwise([0, *ends]), low):
                    for piece, at in enumerate(range(begin, end, capacity)):
                        part = data[at : min(at + capacity, end)]
                        rows.append((k, uid, piece, at - begin, len(part), zlib.crc32(part)))
                        uid += 1
                of, *made = np.array(rows, np.int64).reshape(-1, 6).T
                yield pa.RecordBatch.from_arrays([made[0], batch["doc_id"].take(pa.array(of)), *made[1:]], PIECES)
        encoder(tokenizer).shrink()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in PIECES))


def best_fit(items, sizes, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Adds items, longest first, each to the open bin with the least room that holds it."""
    room = sorted(zip((capacity - filled(bins, sizes)).tolist(), range(len(bins)), strict=True))
    items = np.fromiter(items, np.int64)
    order = np.argsort(-sizes[items], kind="stable")
    for i, size in zip(items[order].tolist(), sizes[items[order]].tolist(), strict=True):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
        else:
            left, k = capacity, len(bins)
            bins.append([i])
        if left > size:
            insort(room, (left - size, k))
    return bins


def filled(bins: list[list[int]], sizes) -> np.ndarray:
    """Sum of the sizes in each bin; no bin is empty."""
    counts = np.fromiter(map(len, bins), np.int64, len(bins))
    items = np.fromiter(chain.from_iterable(bins), np.int64, int(counts.sum()))
    return np.add.reduceat(sizes[items], np.cumsum(counts) - counts) if bins else np.zeros(0, np.int64)


def fitness(bins: list[list[int]], sizes, capacity: int) -> float:
    """Fewer bins first; among equals the mean squared fill, which favours full bins beside one loose one."""
    fill = filled(bins, sizes) / capacity
    return float(-len(bins) + (fill**2).mean()) if bins else 0.0


def cross(giver: list[list[int]], taker: list[list[int]], sizes, capacity: int, rng) -> list[list[int]]:
    fills = filled(giver, sizes)
    good = np.flatnonzero(fills >= np.quantile(fills, 0.5))
    chosen = rng.choice(good, size=max(1, len(good) // 2), replace=False)
    injected = [list(giver[k]) for k in chosen]
    taken = {i for b in injected for i in b}
    kept, displaced = injected, []
    for b in taker:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    return best_fit(displaced, sizes, kept, capacity)


def mutate(bins: list[list[int]], sizes, capacity: int, rng) -> list[list[int]]:
    """Opens a few of the emptiest bins and best-fits their pieces."""
    fills = filled(bins, sizes)
    opened = set(np.argsort(fills)[: max(2, len(bins) // 50)].tolist()) | set(rng.integers(0, len(bins), 2).tolist())
    kept = [list(b) for k, b in enumerate(bins) if k not in opened]
    return best_fit([i for k in opened for i in bins[k]], sizes, kept, capacity)


def as_bins(assigned) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(int(max(assigned, default=-1)) + 1)]
    for i, k in enumerate(assigned):
        bins[int(k)].append(i)
    return [b for b in bins if b]


def evolve(sizes: np.ndarray, seeds: list[list[list[int]]], capacity: int, rng, generations: int = GENERATIONS) -> list[list[int]]:
    """The best solution that a small population reaches; seeds are solutions from before."""
    n = len(sizes)
    bound = -(-int(sizes.sum()) // capacity)
    people = list(seeds) or [best_fit(range(n), sizes, [], capacity)]
    score = lambda b: fitness(b, sizes, capacity)
    scored = [(score(b), b) for b in people]
    rank = itemgetter(0)
    best = max(scored, key=rank)[1]
    if len(best) <= bound:
        return best
    while len(scored) < POPULATION:  # other orders of near-equal sizes
        noisy = sizes * rng.uniform(0.7, 1.3, n)
        order, bins, room = np.argsort(-noisy), [], []
        for i in order.tolist():
            size = int(sizes[i])
            at = bisect_left(room, (size, -1))
            left, k = room.pop(at) if at < len(room) else (capacity, len(bins))
            bins.append([i]) if k == len(bins) else bins[k].append(i)
            if left > size:
                insort(room, (left - size, k))
        scored.append((score(bins), bins))
    for _ in range(generations):
        scored.sort(key=rank, reverse=True)
        giver, taker = scored[0][1], scored[1 + int(rng.integers(0, len(scored) - 1))][1]
        child = mutate(cross(giver, taker, sizes, capacity, rng), sizes, capacity, rng)
        if (value := score(child)) > scored[-1][0]:
            scored[-1] = (value, child)
        best = max(scored, key=rank)[1]
        if len(best) <= bound:
            break
    return best


STATE = "shard long, island int, lengths array<int>, elite array<int>, bins int, bound int, fitness double"


def island_step(capacity: int, epoch: int):
    """One epoch of each island row; ``guests`` holds elites that came from other islands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard, island, lengths, guests in zip(batch["shard"], batch["island"], batch["lengths"], batch["guests"], strict=True):
                sizes = np.asarray(lengths, np.int64)
                rng = np.random.default_rng([int(shard) & 0xFFFFFFFF, int(island), epoch])
                best = evolve(sizes, [as_bins(g) for g in guests], capacity, rng)
                elite = np.zeros(len(sizes), np.int32)
                for k, b in enumerate(best):
                    elite[b] = k
                rows.append((shard, island, sizes.astype(np.int32), elite, len(best), -(-int(sizes.sum()) // capacity), fitness(best, sizes, capacity)))
            yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "elite", "bins", "bound", "fitness"])

    return run


def pack_shards(shards: DataFrame, count: int, capacity: int, scratch: Scratch, name: str, islands: int, epochs: int) -> DataFrame:
    """shard -> elite (bin of each length, in the order of lengths); each island is a task of its own, up to 4096 tasks."""
    tasks = min(4096, count * islands)
    none = F.array().cast("array<array<int>>")
    state = shards.select("shard", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), none.alias("guests"))
    done = scratch.save(
        state.repartition(tasks, "shard", "island").mapInPandas(island_step(capacity, 0), STATE), f"{name}-0"
    )
    for epoch in range(1, epochs):
        at_bound = done.filter("bins <= bound").select("shard").distinct()
        open_ = done.join(at_bound, "shard", "left_anti")
        if open_.isEmpty():
            break
        moved = open_.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
        step = open_.join(moved, ["shard", "island"]).select("shard", "island", "lengths", F.array("elite", "guest").alias("guests"))
        after = step.repartition(tasks, "shard", "island").mapInPandas(island_step(capacity, epoch), STATE)
        done = scratch.save(after.unionByName(done.join(at_bound, "shard", "left_semi")), f"{name}-{epoch}")
    return done.groupBy("shard").agg(F.max_by("elite", F.struct("fitness", -F.col("island"))).alias("elite"))


def _sharded(pieces: DataFrame) -> DataFrame:
    """A row a shard: its pieces in a fixed order."""
    item = F.struct("uid", "doc_id", "piece", "start", "length", "ids_crc32")
    return pieces.groupBy("shard").agg(F.sort_array(F.collect_list(item)).alias("items"))


def _placed(shards: DataFrame, elites: DataFrame) -> DataFrame:
    joined = shards.join(elites, "shard")
    rows = joined.select("shard", F.inline(F.arrays_zip("items", F.col("elite").alias("bin"))))
    return rows.select("shard", "bin", "items.*")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 1,
    shard_size: int = SHARD,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.save(cut_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    loose = pieces.filter(F.col("length") < capacity)
    count = max(1, -(-loose.count() // shard_size))
    shards = scratch.save(
        _sharded(loose.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(count)))), "shards"
    )
    lengths = F.transform("items", lambda x: x["length"].cast("int"))
    elites = pack_shards(shards.select("shard", lengths.alias("lengths")), count, capacity, scratch, "islands", islands, epochs)
    placed = scratch.save(_placed(shards, elites), "placed")

    # The least-filled sequence of each shard, packed again with those of other shards.
    fills = placed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
    tails = fills.groupBy("shard").agg(F.min_by("bin", F.struct("fill", "bin")).alias("tail_bin"))
    marked = placed.join(tails, "shard").withColumn("tail", F.col("bin") == F.col("tail_bin"))
    group = (-1 - F.floor(F.col("shard") / TAIL_SHARDS)).cast("long")
    tail_shards = scratch.save(_sharded(marked.filter("tail").withColumn("shard", group)), "tail-shards")
    tail_elites = pack_shards(tail_shards.select("shard", lengths.alias("lengths")), -(-count // TAIL_SHARDS), capacity, scratch, "tails", islands, epochs)
    columns = ["shard", "bin", "uid", "doc_id", "piece", "start", "length", "ids_crc32"]
    all_placed = marked.filter(~F.col("tail")).select(*columns).unionByName(_placed(tail_shards, tail_elites).select(*columns))

    # Place in a sequence: running sum of at most ``capacity`` pieces.
    per_bin = all_placed.groupBy("shard", "bin").agg(
        F.sort_array(F.collect_list(F.struct("uid", "doc_id", "piece", "start", "length", "ids_crc32"))).alias("items")
    )
    offsets = F.aggregate(
        "items", F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x["length"])
    )
    packed = per_bin.select(
        (F.col("shard") * (1 << 24) + F.col("bin")).alias("sequence_id"), F.inline(F.arrays_zip("items", offsets.alias("offset")))
    ).filter(F.col("items").isNotNull()).select(
        "items.doc_id", F.col("items.piece").cast("int").alias("piece"), "items.start", "items.length", "items.ids_crc32", "sequence_id", "offset"
    )
    # Full pieces: numbers beyond those of any shard.
    full = pieces.filter(F.col("length") == capacity).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", (F.col("uid") + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)
