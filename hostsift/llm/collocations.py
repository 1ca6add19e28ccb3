"""Phrase collocations from sorted count streams.

Words, word pairs and then phrases of three words and more are counted over all texts: a
task cuts its texts into words, numbers the words of a bounded stretch, sorts the packed
numbers and hands on one count a phrase and stretch; Spark adds these up.  A phrase can be
frequent only if all its parts are, so words and pairs that are not frequent are left out
of longer phrases.  What is frequent reaches the tasks as a bit field of bounded size: it
may let a phrase pass that is not frequent (its count then tells), and never stops one that
is.

The frequent phrases then stand in one stream, of all lengths.  In prefix order a phrase
follows all its beginnings, so a single pass that holds the open beginnings gives each
phrase the counts of its left parts and tells each beginning its most frequent extension to
the right.  The same pass in suffix order (words from the last) gives the right parts and
the extensions to the left.  Both passes merge sorted streams in lockstep; nothing is looked
up by a hash.  A cut's score is floor(1000 * a * n / (l * r)) in whole numbers of any size.

Nulls and odd input: a null text has no words; a null lang is ``und``; ids are not read, so
null and repeated ids count like any row; ties go to the smallest cut and then to the phrase
in byte order; very long texts are cut into stretches between words; an empty table has no
phrase; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, joined_by_size

LEAST, LONGEST, TOP, PERCENT = 100, 5, 2000, 100
#: Words of a stretch: what a task counts at a time.
STRETCH = 4_000_000
#: Rows that a task hands on at a time.
PART = 200_000
#: Bytes of a text that are cut into words at a time.
SLICE = 1 << 20
#: Bits of a field of frequent words or pairs: 16 for each, between these bounds (8 MB at most).
LEAST_BITS, MOST_BITS = 16, 26

_MARK = 0xFF  # in no UTF-8 text; stands for the end of a piece
_TABLE = bytearray(range(256))
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _MARK
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_MARKED = bytes([32, _MARK, 32])


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in lower case and marks between pieces, a slice at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        piece = text[at:end].translate(_TABLE)
        if end < len(text):
            last = max(piece.rfind(b" "), piece.rfind(_MARK))
            while last < 0 and end < len(text):  # a word longer than a slice is kept whole
                more = min(len(text), end + SLICE)
                tail = text[end:more].translate(_TABLE)
                found = [k for k in (tail.find(b" "), tail.find(_MARK)) if k >= 0]
                if found:
                    piece, last = piece + tail[: min(found) + 1], len(piece) + min(found)
                else:
                    piece += tail
                end = more
            if last >= 0:
                piece = piece[: last + 1]
        yield piece.replace(b"\xff", _MARKED).split()
        at += len(piece)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(3) + right)


class Field:
    """A bit field of 64-bit names, two bits a name."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def has(self, names: np.ndarray) -> np.ndarray:
        found = np.ones(len(names), bool)
        for at in places_of(names, self.mask):
            found &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def places_of(names: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return names & mask, (names >> np.uint64(32)) & mask


def _names(lang: bytes, words: list[bytes]) -> np.ndarray:
    """64-bit names of a language's words."""
    seed = xxhash.xxh64_intdigest(lang) & 0xFFFFFFFF
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def field_of(phrases: DataFrame, count: int) -> np.ndarray:
    """Bits of the phrases (lang, phrase), set where tasks hashed them and joined by OR; the driver gets at most 8 MB."""
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases_ = batch["lang"].to_pylist(), batch["phrase"].cast(pa.binary()).to_pylist()
            names = np.zeros(len(langs), np.uint64)
            for lang in set(langs):
                own = [k for k, x in enumerate(langs) if x == lang]
                split = [phrases_[k].split(b" ") for k in own]
                name = _names(lang.encode(), [w[0] for w in split])
                if len(split[0]) == 2:
                    name = _pair(name, _names(lang.encode(), [w[1] for w in split]))
                names[own] = name
            at = np.concatenate(places_of(names, np.uint64(size - 1)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "bits"])

    words = phrases.select("lang", "phrase").mapInArrow(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = words.toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return bits


class _Numbers(dict):
    """word -> its number, in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Stretch:
    """Words of one language, numbered as they come; number 0 ends a piece or text."""

    def __init__(self):
        self.numbers = _Numbers({b"\xff": 0})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def close(self) -> None:
        self.parts.append(np.zeros(1, np.int32))


def _counted(stretch: Stretch, lang: str, words: Field | None, pairs: Field | None, longest: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) of one stretch: single words, or pairs, or phrases of three words and more, as far as the fields reach."""
    codes = np.concatenate(stretch.parts)
    names = list(stretch.numbers)
    stretch.parts.clear()
    stretch.numbers.clear()
    texts = pa.array(names, pa.binary())
    if words is None:
        counts = np.bincount(codes, minlength=len(names))
        yield texts[1:], counts[1:]
        return
    hashes = _names(lang.encode(), names)
    good = words.has(hashes)
    good[0] = False
    del names
    ok = good[codes]
    # Runs of frequent words alone are looked at: pairs of neighbours in the text that are both frequent.
    at = np.flatnonzero(ok[:-1] & ok[1:])
    wide = len(good)
    both = codes[at].astype(np.int64) * wide + codes[at + 1]
    if pairs is None:
        del codes, ok, at
        both.sort()
        firsts = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
        packed, counts = both[firsts], np.diff(np.append(firsts, len(both)))
        del both, firsts
        for part in range(0, len(packed), PART):
            left, right = packed[part : part + PART] // wide, packed[part : part + PART] % wide
            yield pc.binary_join_element_wise(texts.take(pa.array(left)), texts.take(pa.array(right)), b" "), counts[part : part + PART]
        return
    packed, where = np.unique(both, return_inverse=True)
    left, right = packed // wide, packed % wide
    passed = pairs.has(_pair(hashes[left], hashes[right]))
    # A phrase is its beginning's number and the pair that goes on from its last word.
    keep = passed[where]
    at, pair = at[keep], where[keep]
    phrase_texts = pc.binary_join_element_wise(texts.take(pa.array(left)), texts.take(pa.array(right)), b" ")
    starts, phrase = at, pair
    pair_at = np.full(len(codes), -1, np.int64)
    pair_at[at] = pair
    for length in range(3, longest + 1):
        follows = np.minimum(starts + length - 2, len(codes) - 1)
        nxt = pair_at[follows]
        keep = (nxt >= 0) & (starts + length - 2 < len(codes))
        starts, phrase, nxt = starts[keep], phrase[keep], nxt[keep]
        if not len(starts):
            return
        packed, phrase_next, counts = np.unique(phrase * len(left) + nxt, return_inverse=True, return_counts=True)
        before, last = packed // len(left), right[packed % len(left)]
        phrase_texts = pc.binary_join_element_wise(phrase_texts.take(pa.array(before)), texts.take(pa.array(last)), b" ")
        yield phrase_texts, counts
        phrase = phrase_next


def phrase_counts(docs: DataFrame, words: np.ndarray | None, pairs: np.ndarray | None, longest: int, stretch: int = STRETCH) -> DataFrame:
    """lang, phrase, n: counts of each task's stretches, to be added up."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((words, pairs))  # two bit fields of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [None if bits is None else Field(bits) for bits in sent.value]
        held: dict[str, Stretch] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            own = held.pop(lang)
            for texts, counts in _counted(own, lang, *fields, longest):
                for at in range(0, len(texts), PART):
                    part = texts[at : at + PART].cast(pa.string())
                    names = pa.array([lang]).take(pa.array(np.zeros(len(part), np.int64)))
                    yield pa.RecordBatch.from_arrays([names, part, pa.array(counts[at : at + PART])], ["lang", "phrase", "n"])

        total = 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()), strict=True):
                own = held.setdefault(lang, Stretch())
                for part in words_of(text.as_py()):
                    own.add(part)
                    total += len(part)
                own.close()
                # Stretches end with texts, so no phrase is cut by one.
                if total >= stretch:
                    largest = max(held, key=lambda k: held[k].size)
                    total -= held[largest].size
                    yield from flush(largest)
        for lang in list(held):
            yield from flush(lang)

    return docs.mapInArrow(run, "lang string, phrase string, n long")


def frequent(counts: DataFrame, least: int) -> DataFrame:
    return counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)


def _lockstep(suffixes: bool):
    """Pass over a sorted stream that holds the open beginnings of the current row.

    A row leaves when the stream has passed all that begins with it: by then its most
    frequent extension is known.  At most as many rows are held as a phrase has words.
    """
    key, side, most = ("back", "r", "most_left") if suffixes else ("words", "l", "most_right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[dict] = []
        for batch in batches:
            schema = batch.schema
            done: list[dict] = []
            for row in batch.to_pylist():
                words = row[key]
                while open_ and not (open_[-1]["lang"] == row["lang"] and open_[-1][key] == words[: len(open_[-1][key])] and len(open_[-1][key]) < len(words)):
                    done.append(open_.pop())
                if open_ and len(open_[-1][key]) == len(words) - 1:
                    open_[-1][most] = max(open_[-1][most], row["f"])
                row[side] = [x["f"] for x in open_]
                row[most] = 0
                open_.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if open_:
            yield pa.RecordBatch.from_pylist(open_[::-1], schema)

    return run


_STREAM = "lang string, phrase string, words array<string>, back array<string>, f long, n long, l array<long>, r array<long>, most_right long, most_left long"


def merged_streams(phrases: DataFrame) -> DataFrame:
    """Adds l and r (counts of the beginnings and of the ends of 1 word and more) and the counts of the most frequent extension on either side.

    ``phrases`` holds (lang, phrase, f, n) of every frequent phrase of 1 word and more.  A
    stream is dealt out by ranges of its first word, so a phrase and its beginnings meet.
    """
    none = F.array().cast("array<long>")
    zero = F.lit(0).cast("long")
    words = F.split("phrase", " ", -1)
    stream = phrases.select(
        "lang", "phrase", words.alias("words"), F.reverse(words).alias("back"), "f", "n", none.alias("l"), none.alias("r"), zero.alias("most_right"), zero.alias("most_left")
    )
    for key, suffixes in (("words", False), ("back", True)):
        dealt = stream.repartitionByRange("lang", F.col(key)[0]).sortWithinPartitions("lang", key)
        stream = dealt.mapInArrow(_lockstep(suffixes), _STREAM)
    return stream


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "phrase", "a", "l", "r", "n", "score"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 5]
    for batch in batches:
        rows = []
        for lang, phrase, a, n, lefts, rights in zip(*(batch[c].to_pylist() for c in ("lang", "phrase", "f", "n", "l", "r")), strict=True):
            # lefts[k - 1] counts the first k words, rights[k - 1] the last k.
            cuts = [(1000 * a * n // (left * right), k, left, right) for k, (left, right) in enumerate(zip(lefts, reversed(rights), strict=True))]
            score, _, left, right = min(cuts)
            rows.append((lang, phrase, a, left, right, n, score))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names)


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, text_col: str = "text", lang_col: str = "lang", stretch: int = STRETCH,
) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of each lang: lang, rank, phrase, a, l, r, n, score.

    A phrase goes where 100 times the count of a longer frequent phrase around it is
    ``percent`` times its own or more.  Counts never grow with length, so an extension by
    one word decides this for all longer ones.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    single = scratch.save(phrase_counts(texts, None, None, longest, stretch).groupBy("lang", "phrase").agg(F.sum("n").alias("f")), "single")
    totals = scratch.save(single.groupBy("lang").agg(F.sum("f").alias("n"), F.count_if(F.col("f") >= least).alias("rows")), "totals")
    words = scratch.save(single.filter(F.col("f") >= least), "words")
    scratch.drop("single")
    word_field = field_of(words, words.count())
    pairs = scratch.save(frequent(phrase_counts(texts, word_field, None, longest, stretch), least), "pairs")
    pair_field = field_of(pairs, pairs.count())
    more = scratch.save(frequent(phrase_counts(texts, word_field, pair_field, longest, stretch), least), "more")
    found = words.unionByName(pairs).unionByName(more)
    stream = merged_streams(joined_by_size(found, totals, ["lang"], "rows").drop("rows"))
    kept = stream.filter((F.size("words") > 1) & (100 * F.greatest("most_left", "most_right") < percent * F.col("f")))
    scored = kept.mapInArrow(_scored, "lang string, phrase string, a long, l long, r long, n long, score long")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", rank).filter(F.col("rank") <= top)  # tasks drop what is behind before they send
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
