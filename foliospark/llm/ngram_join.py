"""Exact n-gram Jaccard join with grouped prefixes.

A document's set holds its distinct five-word shingles (64-bit hashes). Two
documents link when 100 * intersection >= 80 * union.

1. Rare-first order: shingles that repeat within pieces of the corpus are
   summed up over all documents; the most frequent come last in every
   document's order. The summary is bounded and only speeds the join up: any
   order gives the same links.
2. Equal sets are one node; nodes of equal size and prefix are one group.
3. Prefix shingles are aggregated to their first and last group and a count
   (no task sees all members of a shingle). Shingles with one group end here.
4. Star round: each group is compared with the most central group of each of
   its shingles (the one with the most shared shingles), each node with its
   group's first; pairs are verified on the whole sets and linked nodes are
   joined into components.
5. Rest round: pairs of groups that share a prefix shingle, pass the size and
   position filters and are not all in one component are expanded into pairs of
   their nodes in different components, which are verified as well. Pairs within
   a component need no look: links are only used for components, so the result
   is exact without listing all pairs of a group.

Defined results: fewer than five words make one shingle of the whole sequence;
null text or no words give an empty set, linked with nothing; a null id gets
its shingle count and a null component; rows of one id are one vertex; very long
texts are read in pieces and have one set; an empty table gives an empty table;
other columns are ignored by ``link_documents`` and kept by ``keep_one``. Ties
cannot occur: the smallest id names a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import discard, frugal, join_ids, materialize, may_hold, mix, small_batches, table, text_chunks, unused, window_hash, without, word_hashes
from foliospark.llm.components import connected_components

WIDTH, PERCENT = 5, 80
#: Entries of the frequent-shingle summary that tasks get (16 bytes each), the
#: least count in it, and shingles that are counted together. None of them
#: changes the result.
FREQUENT, LEAST_COUNT, COUNTED = 500_000, 6, 4_000_000
#: Shared shingles that tasks get (8 bytes each); beyond it they are joined.
BROADCAST_SHINGLES = 1_500_000
#: Bits of the bitmap that rules out pairs before whole sets travel; sets from
#: WIDE_FROM shingles on, which would fill it, get WIDE_BITS.
BITS, WIDE_BITS, WIDE_FROM = 2048, 32768, 1600
#: Shingles with more rows than their share of all rows, and than a least
#: number, are hot; so many there are at most. Rows that meet at a time.
HOT_KEYS, LEAST_HOT, BLOCK = 100_000, 1_000, 256


class Shingles:
    """Distinct shingles of a batch, sorted by row and hash."""

    def __init__(self, texts: pa.Array, width: int = WIDTH):
        hashes, first = word_hashes(texts)
        self.rows, count = len(texts), np.diff(first)
        if self.rows == 1 and len(hashes) >= width:
            h = window_hash(hashes, width)
            del hashes
            h.sort()
            own = np.zeros(len(h), np.int32)
        else:
            own, h = self._sorted(hashes, first, count, width)
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        self.own, self.hash = own[fresh], h[fresh]
        self.first = np.searchsorted(self.own, np.arange(self.rows + 1))
        self.n = np.diff(self.first)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hash ^ np.uint64(0xA5A5A5A5)))])
        self.signature = mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.n.astype(np.uint64))

    def _sorted(self, hashes: np.ndarray, first: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(self.rows), count)
        h = window_hash(hashes, width)
        at = np.flatnonzero(doc[: len(h)] == doc[width - 1 :][: len(h)])
        own, h = doc[at], h[at]
        for n in range(1, width):
            few = np.flatnonzero(count == n)
            if len(few):
                part = first[few][:, None] + np.arange(n)
                own = np.concatenate([own, few])
                h = np.concatenate([h, mix(window_hash(hashes[part].ravel(), n)[::n] + np.uint64(n))])
        key = (own.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20))
        order = np.argsort(key)
        key = key[order]
        if ((key[1:] == key[:-1]) & (h[order[1:]] != h[order[:-1]])).any() or self.rows >= 1 << 20:
            order = np.lexsort((h, own))  # two hashes share the bits in the key
        return own[order], h[order]

    def prefixes(self, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, position from 1, hash) of prefix shingles, and each row's group."""
        weight = np.zeros(len(self.hash), np.int64)
        if len(frequent) and len(self.hash):
            at = np.minimum(np.searchsorted(frequent, self.hash), len(frequent) - 1)
            weight = np.where(frequent[at] == self.hash, counts[at], 0)
        order = np.argsort((self.own.astype(np.int64) << 40) + np.minimum(weight, (1 << 40) - 1), kind="stable")  # already by row and hash
        h = self.hash[order]
        position = np.arange(len(h)) - self.first[self.own] + 1
        keep = np.flatnonzero(position <= prefix_length(self.n)[self.own])
        row, position, h = self.own[keep], position[keep], h[keep]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(77)))])
        cut = np.searchsorted(row, np.arange(self.rows + 1))
        group = mix((sums[cut[1:]] - sums[cut[:-1]]) * np.uint64(3) + self.n.astype(np.uint64))
        return row, position, h, group


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def index_length(n: Column) -> Column:
    """Prefix that suffices for the smaller of two sets."""
    return n - F.ceil(F.lit(2 * PERCENT) * n / F.lit(100 + PERCENT)) + 1


def _chunks(batches, column: int):
    for batch in batches:
        for lo, hi in text_chunks(batch.column(column)):
            yield batch.slice(lo, hi - lo)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def pack_bits(s: Shingles, wide_from: int = WIDE_FROM) -> pa.Array:
    """Parity bitmaps. Every shingle flips one bit, so two bitmaps differ in at
    most as many bits as the sets have shingles not in common."""
    out: list = [None] * s.rows
    for rows, size in ((np.flatnonzero(s.n < wide_from), BITS), (np.flatnonzero(s.n >= wide_from), WIDE_BITS)):
        at = np.full(s.rows, -1)
        at[rows] = np.arange(len(rows))
        mine = np.flatnonzero(at[s.own] >= 0)
        place = at[s.own[mine]] * size + (mix(s.hash[mine] ^ np.uint64(0x5EED)) % np.uint64(size)).astype(np.int64)
        flips = np.zeros(len(rows) * size, np.uint8)
        np.bitwise_xor.at(flips, place, 1)
        for k, bits in zip(rows.tolist(), np.packbits(flips.reshape(len(rows), size), axis=1).view(np.int64), strict=True):
            out[k] = bits
    return pa.array(out, pa.list_(pa.int64()))


def describe(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, sig, bits) of documents and (null, count, shingle) of
    shingles that occur in several sets counted together."""
    names = ["doc_id", "n", "key", "is_doc", "bits"]

    def repeated(held: list, seen: set) -> pa.RecordBatch:
        h = np.concatenate(held)
        held.clear()
        seen.clear()
        h.sort()
        same = np.zeros(len(h) + 1, bool)  # whether a place repeats the one before it
        np.equal(h[1:], h[:-1], out=same[1:-1])
        first, last = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        h, n = h[first], last - first + 1
        return pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.int64()), pa.array(n.astype(np.int64)), _i64(h), pa.array(np.zeros(len(h), bool)), pa.nulls(len(h), pa.list_(pa.int64()))], names)

    def run(batches):
        held, seen = [], set()
        for batch in _chunks(batches, 1):
            s = Shingles(batch.column(1))
            one = np.zeros(s.rows, bool)
            for k, x in enumerate(s.signature.tolist()):
                if x not in seen:
                    seen.add(x)
                    one[k] = True
            held.append(s.hash[one[s.own]])
            if sum(map(len, held)) > COUNTED:
                yield repeated(held, seen)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.n.astype(np.int64)), _i64(s.signature), pa.array(np.ones(s.rows, bool)), pack_bits(s)], names)
        if held:
            yield repeated(held, seen)

    return docs.mapInArrow(frugal(run), "doc_id long, n long, key long, is_doc boolean, bits array<long>")


def prefix_rows(docs: DataFrame, summary) -> DataFrame:
    """One row for each prefix shingle (key: shingle, v: group) and for each
    document (key: signature, v: id, with n and group)."""

    def run(batches):
        frequent, counts = summary.value
        for batch in _chunks(batches, 1):
            s = Shingles(batch.column(1))
            row, _, h, group = s.prefixes(frequent, counts)
            k = len(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, bool)), _i64(h), _i64(group[row]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], ["is_doc", "key", "v", "n", "g"])
            some = np.flatnonzero(s.n > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(some), bool)), _i64(s.signature[some]), batch.column(0).take(pa.array(some)), pa.array(s.n[some].astype(np.int64)), _i64(group[some])], ["is_doc", "key", "v", "n", "g"])

    return docs.mapInArrow(frugal(run), "is_doc boolean, key long, v long, n long, g long")


def postings_of(docs: DataFrame, summary, known) -> DataFrame:
    """``h, g, n, pos`` of prefix shingles; only those in ``known`` if given.
    Rows of one group repeat."""

    def run(batches):
        frequent, counts = summary.value
        for batch in _chunks(batches, 1):
            s = Shingles(batch.column(1))
            row, position, h, group = s.prefixes(frequent, counts)
            wanted = known.value
            if wanted is not None:
                hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h)
                row, position, h = row[hit], position[hit], h[hit]
            yield pa.RecordBatch.from_arrays([_i64(h), _i64(group[row]), pa.array(s.n[row].astype(np.int32)), pa.array(position.astype(np.int32))], ["h", "g", "n", "pos"])

    return docs.mapInArrow(frugal(run), "h long, g long, n int, pos int")


def sets_of(docs: DataFrame) -> DataFrame:
    """``sig, s``: the sorted set of every row."""

    def run(batches):
        for batch in _chunks(batches, 1):
            s = Shingles(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(s.first.astype(np.int32)), _i64(s.hash))
            yield pa.RecordBatch.from_arrays([_i64(s.signature), lists], ["sig", "s"])

    return docs.mapInArrow(frugal(run), "sig long, s array<long>")


def bitmaps_of(docs: DataFrame, wide_from: int = WIDE_FROM) -> DataFrame:
    """``sig, bits`` of every row."""

    def run(batches):
        for batch in _chunks(batches, 1):
            s = Shingles(batch.column(1))
            yield pa.RecordBatch.from_arrays([_i64(s.signature), pack_bits(s, wide_from)], ["sig", "bits"])

    return docs.mapInArrow(frugal(run), "sig long, bits array<long>")


def _folded(bits: Column) -> Column:
    """A wide bitmap as a small one: its parts laid over each other."""
    part = BITS // 64
    lay = lambda acc, k: F.zip_with(acc, F.slice(bits, k * part + 1, F.lit(part)), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) == part, bits).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(WIDE_BITS // BITS - 1)), F.slice(bits, 1, part), lay))


def _apart(x: Column, y: Column) -> Column:
    """Bits in which two bitmaps differ, at the smaller one's width."""
    count = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, k: total + k)
    return F.when(F.size(x) == F.size(y), count(x, y)).otherwise(count(_folded(x), _folded(y)))


def _ends(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct(), "wanted")


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, first: DataFrame) -> DataFrame:
    """The linked ones of ``pairs`` (a, b: node ids) as edges (a, b).

    Bitmaps of 256 bytes a node (4 KB for large sets), written with the first
    pass, rule out most pairs that cannot link; whole sets travel for the rest
    only. They are made from the texts, which are not shuffled.
    """
    pairs = materialize(pairs, "pairs")
    rows = first.filter("is_doc").select("doc_id", F.col("key").alias("sig"), "n", "bits")
    wanted = _ends(pairs)
    maps = join_ids(rows, wanted, "doc_id").withColumnRenamed("doc_id", "node").join(nodes.select("node", "sig"), ["node", "sig"], "left_semi")
    maps = materialize(maps.dropDuplicates(["node", "sig"]).drop("sig"), "bitmaps")
    both = pairs.join(maps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a").join(maps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
    apart = _apart(F.col("x"), F.col("y"))
    total = F.col("na") + F.col("nb")
    # 2 * intersection <= total - apart, and a link needs 180 * intersection >= 80 * total
    hopeful = materialize(both.filter(F.lit(100 + PERCENT) * (total - apart) >= F.lit(2 * PERCENT) * total).select("a", "b").distinct(), "hopeful")
    ends = _ends(hopeful)
    named = join_ids(nodes.select(F.col("node").alias("doc_id"), "sig"), ends, "doc_id").select("sig", F.col("doc_id").alias("node"))
    sets = materialize(sets_of(may_hold(docs, ends, "doc_id")).join(named, "sig").select("node", "s"), "sets")
    both = hopeful.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    linked = both.filter(F.lit(100) * shared >= F.lit(PERCENT) * (F.size("sa") + F.size("sb") - shared))
    links = materialize(linked.select("a", "b").distinct(), "links")
    discard(pairs, wanted, maps, hopeful, ends, sets)
    return links


def _sized(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) whose sizes na, nb allow a link."""
    near = (F.lit(100) * F.least("na", "nb") >= F.lit(PERCENT) * F.greatest("na", "nb")) & (F.col("a") != F.col("b"))
    return pairs.filter(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def spread(rows: DataFrame, keyed: DataFrame, total: int) -> DataFrame:
    """``rows`` (h, ...) joined with ``keyed`` (h, c, ...: c rows have that h).

    Shingles with many rows are few, at most HOT_KEYS by the sum of c, and are
    broadcast; no task gets all rows of one.
    """
    bound = max(LEAST_HOT, total // HOT_KEYS)
    hot, cold = keyed.filter(F.col("c") > bound), keyed.filter(F.col("c") <= bound)
    rest = rows.join(F.broadcast(hot.select("h")), "h", "left_anti")
    return rows.join(F.broadcast(hot), "h").unionByName(rest.join(cold, "h"))


def _blocks(rows: DataFrame, size: Column, node: str) -> DataFrame:
    """Adds ``i``, the block of a row, and ``k``, the number of blocks of about
    BLOCK rows that its key has."""
    return rows.withColumn("k", F.greatest(F.ceil(size / BLOCK), F.lit(1)).cast("int")).withColumn("i", F.pmod(F.xxhash64(node), F.col("k")).cast("int"))


def rest_pairs(postings: DataFrame, members: DataFrame, total: int, made: list[DataFrame]) -> DataFrame:
    """Pairs (a, na, b, nb) of nodes that are in different parts, and in one
    group or in two groups that share a prefix shingle and pass the size and
    position filters. Tables that it reads are added to ``made``.

    Pairs of groups are found first and expanded then. Both the groups of a
    shingle and the nodes of a group meet block by block.
    """
    groups = materialize(members.groupBy("g").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("size")), "group-parts")
    held = postings.join(groups.select("g", "lo", "hi"), "g")
    torn = held.groupBy("h").agg(F.count("*").alias("c"), F.min("lo").alias("first"), F.max("hi").alias("final")).filter("first <> final").select("h", "c")
    torn = materialize(torn, "torn")
    held = materialize(_blocks(spread(held, torn, total), F.col("c"), "g"), "held")
    made += [groups, torn, held]
    # every two blocks of a shingle meet once, in the piece (lesser, greater)
    pieces = held.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("h", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "g", "n", "pos", "lo", "hi", "i")
    x, y = (pieces.select("h", "p", "q", *(F.col(c).alias(f"{c}{k}") for c in ("g", "n", "pos", "lo", "hi", "i"))) for k in (1, 2))
    both = x.join(y, ["h", "p", "q"]).filter("g1 < g2 and (p = q or i1 <> i2) and not (lo1 = hi1 and lo2 = hi2 and lo1 = lo2)")
    low, high = F.least("n1", "n2"), F.greatest("n1", "n2")
    near = F.lit(100) * low >= F.lit(PERCENT) * high
    # what the shingle and all after it can give at most
    most = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2")) + 1
    indexed = ((F.col("n1") == low) & (F.col("pos1") <= index_length(F.col("n1")))) | ((F.col("n2") == low) & (F.col("pos2") <= index_length(F.col("n2"))))
    across = both.filter(near & indexed & (F.lit(100 + PERCENT) * most >= F.lit(PERCENT) * (F.col("n1") + F.col("n2")))).select("g1", "g2")
    pairs = across.unionAll(groups.filter("lo <> hi").select(F.col("g").alias("g1"), F.col("g").alias("g2"))).distinct()

    sizes = groups.select("g", F.greatest(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int").alias("k"))
    for c in ("1", "2"):
        pairs = pairs.join(sizes.select(F.col("g").alias(f"g{c}"), F.col("k").alias(f"k{c}")), f"g{c}")
    pairs = pairs.withColumn("i1", F.explode(F.sequence(F.lit(0), F.col("k1") - 1))).withColumn("i2", F.explode(F.sequence(F.lit(0), F.col("k2") - 1)))
    listed = _blocks(members.join(groups.select("g", "size"), "g"), F.col("size"), "node")
    for c, node in (("1", "a"), ("2", "b")):
        pairs = pairs.join(listed.select(F.col("g").alias(f"g{c}"), F.col("i").alias(f"i{c}"), F.col("node").alias(node), F.col("n").alias(f"n{node}"), F.col("part").alias(f"p{node}")), [f"g{c}", f"i{c}"])
    return pairs.filter("pa <> pb and (g1 <> g2 or a < b)").select("a", "na", "b", "nb")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    sc = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    first = materialize(describe(docs), "describe")
    rows = first.filter("is_doc").select("doc_id", "n", F.col("key").alias("sig"))
    top = first.filter("not is_doc").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "key").limit(FREQUENT).toPandas()
    order = np.argsort(top["key"].to_numpy(np.int64).view(np.uint64))
    summary = sc.broadcast((top["key"].to_numpy(np.int64).view(np.uint64)[order], top["n"].to_numpy(np.int64)[order]))

    whole = docs.filter("doc_id is not null and t is not null")
    keys = prefix_rows(whole, summary).groupBy("is_doc", "key").agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("n").alias("n"), F.min("g").alias("g"))
    keys = materialize(keys.filter("is_doc or lo <> hi"), "keys")
    nodes = keys.filter("is_doc").select(F.col("key").alias("sig"), F.col("lo").alias("node"), "n", "g")
    shared = keys.filter("not is_doc").select(F.col("key").alias("h"), "lo", "hi", "c")
    leaders = materialize(nodes.groupBy("g").agg(F.min("node").alias("leader"), F.max("node").alias("last"), F.min("n").alias("n")), "leaders")

    many = shared.filter("c > 2").select("h")
    if many.count() <= BROADCAST_SHINGLES:
        found = np.sort(many.toPandas()["h"].to_numpy(np.int64).view(np.uint64))
        postings = postings_of(whole, summary, sc.broadcast(found)) if len(found) else postings_of(whole.limit(0), summary, sc.broadcast(None))
    else:
        postings = postings_of(whole, summary, sc.broadcast(None)).join(many, "h", "left_semi")
    postings = materialize(postings.groupBy("h", "g", "n", "pos").agg(F.lit(1).alias("one")).drop("one"), "postings")
    total = postings.count()
    bare = postings
    postings = materialize(bare.join(bare.groupBy("g").agg(F.count("*").alias("w")), "g").join(leaders.select("g", "leader"), "g"), "led-postings")

    central = materialize(postings.groupBy("h").agg(F.count("*").alias("c"), F.max(F.struct("w", "g", "leader", "n")).alias("top")), "central")
    stars = spread(postings, central, total).filter("g <> top.g").select(F.col("top.leader").alias("a"), F.col("top.n").cast("long").alias("na"), F.col("leader").alias("b"), F.col("n").cast("long").alias("nb"))
    one, two = (leaders.select(F.col("g").alias(g), F.col("leader").alias(x), F.col("n").alias(f"n{x}")) for g, x in (("lo", "a"), ("hi", "b")))
    twos = shared.filter("c = 2").select("lo", "hi").distinct().join(one, "lo").join(two, "hi").select("a", "na", "b", "nb")
    inside = nodes.join(leaders.filter("leader <> last").select("g", "leader"), "g").select(F.col("leader").alias("a"), F.col("n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb"))
    links = verify(_sized(stars.unionAll(twos).unionAll(inside)), whole, nodes, first)
    parts = materialize(connected_components(links), "parts")

    members = materialize(nodes.join(parts, "node", "left").select("node", "n", "g", F.coalesce("component", "node").alias("part")), "members")
    made = [bare, postings, central, leaders, members]
    more = verify(_sized(rest_pairs(postings, members, total, made)), whole, nodes, first)
    discard(*made)
    if more.isEmpty():
        final = parts
    else:
        final = materialize(connected_components(links.unionAll(more)), "final")
        discard(parts)
    discard(links, more)
    named = nodes.join(final, "node", "left").select("sig", F.coalesce("component", "node").alias("component"))
    out = rows.join(named, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    out.reads = [first, keys, final]
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component (that of smallest id), with all columns.

    Rows without an id come after all others (by a hash of their text, of which
    one row stays). Rows of one id stay or go together.
    """
    (key,) = unused(docs, "_key")
    some = F.col(id_col).isNull() & F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    named = docs.filter(~some).withColumn(key, F.col(id_col).cast("long"))
    unnamed = docs.filter(some).withColumn(key, F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.col(text_col).cast("string")), 3)).dropDuplicates([key])
    keyed = named.unionByName(unnamed)
    linked = link_documents(keyed, key, text_col)
    gone = materialize(linked.filter("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "copies")
    discard(*linked.reads)
    return without(keyed, gone, key).select(*docs.columns)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))


#: The same by brute force: all pairs that share a shingle, then reachability.
_ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, both_.b FROM r JOIN both_ ON r.b = both_.a)
SELECT doc_id, n AS n_shingles, (SELECT min(b) FROM r WHERE r.a = doc_id) AS component_id FROM n
"""
QUERIES = {"op10_ngram_jaccard_join": op10_ngram_jaccard_join}
ORACLES = {"op10_ngram_jaccard_join": _ORACLE}
