"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set holds its distinct shingles (``width`` words, ASCII letters in lower
case) as 64-bit hashes.  Two sets at Jaccard ``percent`` or more share a token among the
first n - ceil(t n) + 1 tokens of each, whatever total order ranks the tokens.  Three
orders are used:

1. Hash order.  An extended prefix leaves a set no partner unless enough of its tokens
   occur in another set's; how many is the least over all sizes that a partner may have.  Counting needs no join: a token held by one set only credits
   that set, and the credits are summed.
2. Rarest-first order over the sets that remain: by the level (half powers of two) of the
   count in a token's slot of a table of at most 8 MB, ties by hash.  Any order that all
   sets share keeps every link, so slots that several tokens share cost candidates at
   most; a token whose slot counted it alone brings no partner and needs no row.  Sharing
   a prefix token here, with places, sizes and parities (128 bits a set) that still allow
   the overlap, makes a candidate.
3. A second hash order.  A candidate must share a prefix token here too.

Equal sets are one node throughout, so copies are never expanded.  A list of sets that
share a token is compared with one pivot first (its set with the rarest prefix place);
what links with the pivot is connected, and only sets outside the pivot's component are
compared with the rest of the list.  So every link is found or lies inside a component
that other links already join.  In a list of more than ``LONG`` sets these meet by the
token and a prefix token of the second hash order together, which deals the list out.

Verification counts the whole sets' common hashes; two different shingles of one pair
meet in a 64-bit hash with a chance below 1e-9 for sets of 100,000.

Nulls and odd input: a null text counts as empty; an empty set links with nothing; a row
with a null id has its set counted and a null component; rows that share an id are one
node; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, Scratch, joined_by_size, tidy
from .components import connected_components

#: Sets in a list beyond which they meet under two orders at once.
LONG = 256
#: Slots of the table of levels, a byte each: at least one for each token of all sets, between these powers of two.
LEAST_BITS, MOST_BITS = 16, 23
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class _WordCodes(RecentCache):
    """Word (bytes) -> 64-bit hash."""

    limit = 60_000
    make = staticmethod(xxhash.xxh3_64_intdigest)


_codes = _WordCodes()


def forget_codes() -> None:
    """For the end of a task.  A function of the module, since tasks would get a copy of the cache itself."""
    _codes.forget()


def portions(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, whose arrays of tokens take less memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, a text of none has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_codes.__getitem__, words), np.uint64, n)
    size = min(width, n)
    h = np.full(n - size + 1, size, np.uint64) * _A
    for k in range(size):
        h = (h ^ codes[k : n - size + 1 + k]) * _B
        h ^= h >> np.uint64(31)
    h = h * _C
    return np.unique(h ^ (h >> np.uint64(29)))


def _needed(n, percent: int, whole: int = 100):
    """ceil(percent n / whole)."""
    return -(-n * percent // whole)


def _reach(n, percent: int):
    """Length of the extended prefix of a set of n tokens."""
    miss = n - _needed(n, percent)
    return np.minimum(n, miss + 1 + np.minimum(miss, n // 10))


@lru_cache(maxsize=100_000)
def _demand(n: int, percent: int) -> int:
    """Tokens that the extended prefix of a set of n tokens shares at least with the extended prefix of any partner.

    Of a pair with o common tokens the k-th common one stands at most n - o places behind
    the k-th place of a set, so the prefixes share what both reach of them.  The least is
    taken over all sizes m that a partner may have, with the least overlap of each.
    """
    m = np.arange(_needed(n, percent), n * 100 // percent + 1)
    overlap = _needed(n + m, percent, 100 + percent)
    return int(np.minimum(_reach(n, percent) - (n - overlap), _reach(m, percent) - (m - overlap)).min())


def _long(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _signatures(width: int, percent: int):
    """doc_id, n, digest, key, need and, once a task and set, the extended prefix in hash order."""

    names = ["n", "digest", "key", "size", "need", "prefix"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted: set[bytes] = set()
        for batch in portions(batches):
            rows = []
            for text in batch["text"]:
                tokens = shingle_set(text.as_py(), width)
                n = len(tokens)
                digest = blake2b(tokens.tobytes(), digest_size=16).digest()
                size = int(_reach(n, percent))
                prefix = None
                if n and digest not in emitted:
                    if len(emitted) >= 200_000:
                        emitted.clear()
                    emitted.add(digest)
                    prefix = _long(tokens[:size])
                rows.append((n, digest.hex(), int.from_bytes(digest[:8], "little", signed=True), size, _demand(n, percent) if n else 0, prefix))
            made = map(pa.array, zip(*rows, strict=True), types)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], ["doc_id", *names])
        forget_codes()

    return run, "doc_id long, n long, digest string, key long, size long, need long, prefix array<long>"


def _arrays(width: int, percent: int):
    """node, n, tokens, the prefix in the second hash order and 128 parities, for rows whose set is still the expected one."""

    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.int64(), longs, longs, pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for node, text, digest in zip(batch["node"].to_pylist(), batch["text"], batch["digest"].to_pylist(), strict=True):
                tokens = shingle_set(text.as_py(), width)
                if blake2b(tokens.tobytes(), digest_size=16).hexdigest() != digest:
                    continue
                n = len(tokens)
                size = n - _needed(n, percent) + 1
                other = tokens * _A
                other ^= other >> np.uint64(32)
                second = tokens[np.argpartition(other * _B, size - 1)[:size]] if size < n else tokens
                odd = np.bincount((tokens >> np.uint64(57)).astype(np.int64), minlength=128) & 1
                b0, b1 = np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()
                rows.append((node, n, _long(tokens), _long(second), b0, b1))
            made = map(pa.array, zip(*rows, strict=True) if rows else [[]] * 6, types)
            yield pa.RecordBatch.from_arrays(list(made), ["node", "n", "tokens", "second", "b0", "b1"])
        forget_codes()

    return run, "node long, n long, tokens array<long>, second array<long>, b0 long, b1 long"


def _levels(arrays: DataFrame, scratch: Scratch) -> np.ndarray:
    """For each slot twice the logarithm of the number of sets' tokens in it, rounded up: 0 for a slot of one token or none."""
    total = arrays.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(total).bit_length()))
    slot = F.col("token").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    counts = arrays.select(F.explode("tokens").alias("token")).groupBy(slot.alias("slot")).agg(F.count("*").alias("df")).filter("df > 1")
    levels = counts.select("slot", F.ceil(2 * F.log2("df")).cast("int").alias("level"), F.shiftright("slot", LEAST_BITS).alias("part"))

    def packed(part: pa.Table) -> pa.Table:
        field = np.zeros(1 << LEAST_BITS, np.uint8)
        field[part["slot"].to_numpy() & (len(field) - 1)] = part["level"].to_numpy()
        return pa.table({"part": part["part"][:1], "field": pa.array([field.tobytes()])})

    parts = scratch.save(levels.groupBy("part").applyInArrow(packed, "part int, field binary"), "levels")
    whole = np.zeros((1 << bits - LEAST_BITS, 1 << LEAST_BITS), np.uint8)
    for row in parts.collect():  # at most 128 parts of 64 KB
        whole[row["part"]] = np.frombuffer(row["field"], np.uint8)
    return whole.reshape(-1)


def _rarest(levels: Broadcast, percent: int):
    """The prefix in rarest-first order, a row a token, without tokens that no other set holds."""

    names = ["token", "node", "n", "b0", "b1", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        mask = np.uint64(len(table) - 1)
        for batch in portions(batches):
            tokens, places = [], []
            for held in batch["tokens"]:
                own = held.values.to_numpy().view(np.uint64)
                level = table[own & mask]
                n = len(own)
                at = np.lexsort(((own ^ (own >> np.uint64(29))) * _C, level))[: n - _needed(n, percent) + 1]
                place = np.flatnonzero(level[at])
                tokens.append(own[at[place]])
                places.append(place)
            times = np.fromiter(map(len, places), np.int64, len(places))
            same = [np.repeat(batch[c].to_numpy(), times) for c in names[1:5]]
            columns = [_long(np.concatenate(tokens or [np.zeros(0, np.uint64)])), *same, np.concatenate(places or [np.zeros(0, np.int64)])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run, ", ".join(f"{c} long" for c in names)


def _compatible(percent: int, a: str, b: str) -> Column:
    """Sizes, places of a shared token and parities that still allow the overlap.

    The first shared token of a linked pair passes: behind it each side has room for the
    overlap, and parities differ in no more bits than the sets in tokens.  ``a`` and ``b``
    are the prefixes of the columns n, at, b0, b1 of the two sides.
    """
    x, y = (lambda c: F.col(f"{a}{c}")), (lambda c: F.col(f"{b}{c}"))
    overlap = F.ceil(F.lit(percent) * (x("n") + y("n")) / F.lit(100.0 + percent) - F.lit(1e-9))
    differ = F.bit_count(x("b0").bitwiseXOR(y("b0"))) + F.bit_count(x("b1").bitwiseXOR(y("b1")))
    return (
        (F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent)
        & (F.least(x("n") - x("at"), y("n") - y("at")) >= overlap) & (differ <= x("n") + y("n") - 2 * overlap)
    )


def _verified(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Links u, v among written candidate pairs u, v: a common prefix token in the second order, then the whole sets.

    A set of very many pairs is sent to them instead of the pairs to it; at most 64 sets are.
    """
    both = pairs
    for s in ("u", "v"):
        own = arrays.select(F.col("node").alias(s), F.col("tokens").alias(f"t_{s}"), F.col("second").alias(f"s_{s}"))
        sizes = pairs.groupBy(s).agg(F.count("*").alias("pairs"))
        both = joined_by_size(both, own.join(sizes, s), [s], "pairs", most=64).drop("pairs")
    both = both.filter(F.arrays_overlap("s_u", "s_v"))
    common = F.size(F.array_intersect("t_u", "t_v"))
    return both.withColumn("c", common).filter(
        F.col("c") * 100 >= (F.size("t_u") + F.size("t_v") - F.col("c")) * percent
    ).select("u", "v")


def _met_twice(loose: DataFrame, members: DataFrame, arrays: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Candidates u, v of long lists: a loose set and a member of one of its lists that share a prefix token of the second hash order.

    A set is in many lists that hold much the same sets (one shared passage has a list for
    each of its shingles), so it meets others once, by its tokens of the second order; that
    the two share a list is asked of the pairs that are left.  A set's first place in any
    list stands for its place in the shared one, so no pair is lost.
    """

    def gathered(rows: DataFrame, p: str) -> DataFrame:
        return rows.groupBy(f"{p}node").agg(
            F.min(f"{p}at").alias(f"{p}at"), *[F.first(f"{p}{c}").alias(f"{p}{c}") for c in ("c", "n", "b0", "b1")],
            F.collect_list("token").alias(f"{p}lists"),  # at most a prefix
        )

    near, far = scratch.save(gathered(loose, "a_"), "near"), scratch.save(gathered(members, ""), "far")
    under = arrays.join(far.select("node"), "node", "left_semi").select("node", F.explode("second").alias("other"))
    # A token that one member alone holds brings it no partner.
    twice = under.groupBy("other").agg(F.count("*").alias("df")).filter("df > 1")
    under = scratch.save(joined_by_size(under, twice, ["other"], "df").select("node", "other"), "under")
    met = near.drop("a_lists").join(under.withColumnRenamed("node", "a_node"), "a_node").join(far.drop("lists").join(under, "node"), "other")
    pairs = met.filter((F.col("a_c") != F.col("c")) & _compatible(percent, "a_", "")).select("a_node", "node").distinct()
    pairs = scratch.save(pairs, "met")
    shared = pairs.join(near.select("a_node", "a_lists"), "a_node").join(far.select("node", "lists"), "node").filter(F.arrays_overlap("a_lists", "lists"))
    return shared.select(F.greatest("a_node", "node").alias("u"), F.least("a_node", "node").alias("v"))


def jaccard_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest id reachable by links, its own included)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    run, schema = _signatures(width, percent)
    signed = scratch.save(base.mapInArrow(run, schema), "signed")

    # Equal sets are one node, named by its smallest id.
    sets = signed.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n", "key", "size", "need")]
    )
    sets = scratch.save(sets, "sets")

    # Order 1: tokens of one set only, summed by set.
    tokens = signed.select(F.explode("prefix").alias("token"), "key")
    alone = tokens.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("other")).filter("key = other")
    unshared = alone.groupBy("key").agg(F.count("*").alias("unshared"))
    left = sets.filter("node IS NOT NULL").join(unshared, "key", "left").filter(F.col("size") - F.coalesce("unshared", F.lit(0)) >= F.col("need"))
    left = scratch.save(left.select("node", "digest"), "left")
    slim = scratch.save(signed.select("doc_id", "n", "digest"), "slim")
    scratch.drop("signed")
    run, schema = _arrays(width, percent)
    texts = base.join(left, base["doc_id"] == left["node"]).select("node", "text", "digest")
    arrays = scratch.save(texts.mapInArrow(run, schema).dropDuplicates(["node"]), "arrays")

    # Order 2: rarest first.
    own = ["node", "n", "b0", "b1"]
    levels = spark.sparkContext.broadcast(_levels(arrays, scratch))
    run, schema = _rarest(levels, percent)
    postings = arrays.select("tokens", *own).mapInArrow(run, schema)
    postings = scratch.save(postings, "postings")
    levels.destroy()
    del levels, run
    tidy(spark)
    pivots = postings.groupBy("token").agg(F.min(F.struct("at", *own)).alias("p"), F.count("*").alias("held")).filter("held > 1")
    pivots = scratch.save(pivots.select("token", "held", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("at", *own)]), "pivots")
    listed = postings.join(pivots, "token")
    first = (
        listed.filter((F.col("node") != F.col("p_node")) & _compatible(percent, "", "p_"))
        .select(F.greatest("node", "p_node").alias("u"), F.least("node", "p_node").alias("v")).distinct()
    )
    links = scratch.save(_verified(scratch.save(first, "pairs-1"), arrays, percent), "links-1")
    tidy(spark)
    part = scratch.save(connected_components(links, scratch, "cc-1"), "part-1")

    # What its list's pivot did not connect meets the whole list, but for sets of its own component.
    named = lambda df, node, out: df.join(
        part.select(F.col("node").alias(node), F.col("component").alias("__c")), node, "left"
    ).withColumn(out, F.coalesce("__c", node)).drop("__c")
    placed = named(named(listed.select("token", "held", *own, "at", "p_node"), "node", "c"), "p_node", "p_c")
    placed = scratch.save(placed, "placed")
    tidy(spark)
    loose = placed.filter("c != p_c").select("token", "held", *[F.col(c).alias(f"a_{c}") for c in ("at", "c", *own)])
    # In a long list sets meet under two orders at once: they must share a prefix token of the second hash order too.
    long = loose.filter(F.col("held") > LONG)
    short = loose.filter(F.col("held") <= LONG).drop("held").join(placed.drop("held"), "token")
    second = (
        short.filter((F.col("a_c") != F.col("c")) & (F.col("node") != F.col("p_node")) & ((F.col("c") == F.col("p_c")) | (F.col("a_node") < F.col("node"))))
        .filter(_compatible(percent, "a_", ""))
        .select(F.greatest("a_node", "node").alias("u"), F.least("a_node", "node").alias("v")).distinct()
    )
    if not long.isEmpty():
        members = placed.filter((F.col("held") > LONG) & (F.col("node") != F.col("p_node"))).join(long.select("token").distinct(), "token", "left_semi")
        second = second.unionByName(_met_twice(long, members, arrays, percent, scratch)).distinct()
    more = scratch.save(_verified(scratch.save(second, "pairs-2"), arrays, percent), "links-2")
    tidy(spark)
    by_set = named(sets.select("digest", "node"), "node", "component")
    if not more.isEmpty():
        # A component of the first links is one node of the second, named by its smallest.
        over = named(named(more, "u", "c_u"), "v", "c_v").select(F.col("c_u").alias("u"), F.col("c_v").alias("v"))
        whole = scratch.save(connected_components(over, scratch, "cc-2"), "part-2").select(F.col("node").alias("component"), F.col("component").alias("least"))
        by_set = by_set.join(whole, "component", "left").select("digest", F.coalesce("least", "component").alias("component"))
    return slim.join(by_set, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
