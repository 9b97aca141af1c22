"""N-gram Jaccard join by universe partition and the pigeonhole principle.

Sets fall into size bands. Sets of a band, and those of the band below that are near its lower end, split the universe of hashed shingles into
segments, more than the largest symmetric difference d that linked sets of that size can have; so linked sets agree on a segment and share its
key. A key that only sets of the band below share is left out, as these meet in their own band. Segments that both leave empty say nothing and
have no key. Keys are allocated by their cost: where few segments make empty ones matter (up to ``NEIGHBOURS``), a set that has some also emits
one-deletion neighbourhoods, its segments with one element left out; with more segments there are some to spare instead. Candidates are verified
on whole texts.

Why no link is lost. With s segments to spare, d + 1 + s in all: sets that agree on empty segments only differ in all others, so they share
s + 1 empty ones at least, and both are ``poor``: they have more than s. With neighbourhoods, let m = d + 1 be the segments and e, f the
empty ones of either. Of the others each differs by one element at least; those by one and filled on both sides share a one-deletion key; if
there are none, counting differences gives m + 1 <= e + f, so both have 2 or more and one has m / 2. Poor sets go on to another partition of
the universe, and so on until they are not poor: two sets meet in the first partition in which one of them is not. After ``TRIES`` partitions
(only with far lower thresholds) they have keys for their empty segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from . import text as T
from .storage import rows_a_batch, text_key, written

WORDS, SHARE, RATIO, NEIGHBOURS, TRIES = 4, 85, 1.3, 40, 8
U64 = np.uint64


@lru_cache(maxsize=8)
def bands(share: int, most: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least size of each band, its number of segments, and how many of these are to spare."""
    low = [1]
    while low[-1] < most:
        low.append(max(low[-1] + 1, int(low[-1] * max(RATIO, 101 / share))))
    low = np.array(low)
    high = np.r_[low[1:] - 1, low[-1]]
    # union u and intersection i of linked sets: u + i <= 2 high, i >= share u / 100; they differ by u - i
    need = (100 - share) * 2 * high // (100 + share) + 1
    # Empty segments that hashed elements of the smallest sets may leave, and some more.
    least = np.maximum(share * low / 100, 1)
    spare = np.zeros(len(low))
    for _ in range(4):
        empty = np.minimum((need + spare) * np.exp(-least / (need + spare)), need)
        spare = np.where(need > NEIGHBOURS, np.ceil(empty + 2.5 * np.sqrt(empty)), 0)
    return low, need + spare.astype(np.int64), spare.astype(np.int64)


class Sets:
    """Distinct hashed shingles of some texts, sorted within each text; ``first``: where those of each text begin."""

    def __init__(self, column: pa.Array, words: int):
        data, offsets = T.raw(column)
        found = T.Words(T.LOWER[data], offsets)
        hashes, text = T.shingles(found.hashes(), found.first, words)
        ends = np.searchsorted(text, np.arange(len(offsets)))
        parts = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            own = np.sort(hashes[a:b])
            parts.append(own[np.r_[True, own[1:] != own[:-1]]] if b > a else own)
        self.first = np.r_[0, np.cumsum([len(p) for p in parts])]
        self.items = np.concatenate(parts) if parts else hashes

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def ids(self) -> np.ndarray:
        """64 bits of each set; 0 of empty ones."""
        sums = np.r_[U64(0), np.cumsum(T.mix(self.items ^ U64(0x5851F42D4C957F2D)))]
        out = T.mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.sizes().astype(U64) * T.ODD)
        out[self.sizes() == 0] = 0
        return out

    def keys(self, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment keys, the set of each, and whether it is a key of the band above the set's own."""
        low, segments, spare = bands(share)
        n = self.sizes()
        own = np.flatnonzero(n)
        band = np.searchsorted(low, n, "right") - 1
        above = own[100 * n[own] >= share * low[band[own] + 1]]
        sets, at, up = np.r_[own, above], np.r_[band[own], band[above] + 1], np.repeat([False, True], [len(own), len(above)])
        stay = segments[at] - spare[at] > 1  # others link with equal sets only
        sets, at, up = sets[stay], at[stay], up[stay]
        keys, owners, ups, level = [], [], [], 0
        while len(sets):
            m, size = segments[at], n[sets]
            owner = np.repeat(np.arange(len(sets)), size)
            items = self.items[np.repeat(self.first[sets] - np.cumsum(size) + size, size) + np.arange(len(owner))]
            salt = U64(0x9E3779B97F4A7C15 * level % (1 << 64))
            segment = ((T.mix(items ^ salt) if level else items) >> U64(32)) * m[owner].astype(U64) >> U64(32)
            if level:
                order = np.lexsort((segment, owner))
                items, segment = items[order], segment[order]
            scrambled = T.mix(items ^ U64(0x2127599BF4325C37))
            starts = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | (owner[1:] != owner[:-1])])
            sums, whose = np.add.reduceat(scrambled, starts), owner[starts]
            place = lambda x, o: (x + (at[o].astype(U64) << U64(32)) + U64(level << 56)) * T.ODD  # noqa: B023, E731
            which = place(segment[starts], whose)
            keys.append(T.mix(sums ^ which))
            owners.append(sets[whose])
            ups.append(up[whose])
            empty = m - np.bincount(whose, minlength=len(sets))
            few = m - spare[at] <= NEIGHBOURS
            inside = np.diff(np.r_[starts, len(items)])
            left = np.flatnonzero(np.repeat((inside > 1) & (few & (empty > 0))[whose], inside))
            part = np.repeat(np.arange(len(starts)), inside)[left]
            keys.append(T.mix((sums[part] - scrambled[left]) ^ which[part]))
            owners.append(sets[owner[left]])
            ups.append(up[owner[left]])
            poor = np.where(few, (empty >= 2) & ((m <= 12) | (4 * empty >= m)), empty > spare[at])
            level += 1
            if level == TRIES and poor.any():
                slot = np.cumsum(np.where(poor, m, 0)) - np.where(poor, m, 0)
                there = np.zeros(int(m[poor].sum()), bool)
                pick = poor[whose]
                there[slot[whose[pick]] + segment[starts[pick]].astype(np.int64)] = True
                of = np.repeat(np.flatnonzero(poor), m[poor])[~there]
                keys.append(T.mix(place(np.flatnonzero(~there).astype(U64) - slot[of].astype(U64), of)))
                owners.append(sets[of])
                ups.append(up[of])
                break
            sets, at, up = sets[poor], at[poor], up[poor]
        if not keys:
            return np.zeros(0, U64), np.zeros(0, np.intp), np.zeros(0, bool)
        return np.concatenate(keys), np.concatenate(owners), np.concatenate(ups)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64))


def summaries(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, h, n_shingles, s) of each row; s: the id of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            sets = Sets(batch.column(2), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets.sizes().astype(np.int64)), _long(sets.ids())], ["doc_id", "h", "n_shingles", "s"])

    return _keyed(docs).mapInArrow(run, "doc_id long, h long, n_shingles long, s long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), "text")


def segment_keys(docs: DataFrame, words: int, share: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, 1 << 20):
            sets = Sets(batch.column(0), words)
            keys, owner, up = sets.keys(share)
            yield pa.RecordBatch.from_arrays([_long(keys), _long(sets.ids()[owner]), pa.array(up)], ["key", "s", "up"])

    return docs.select("text").mapInArrow(run, "key long, s long, up boolean")


def verified(pairs: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """The pairs (a, b) of set ids that are linked. ``texts``: (s, n, packed), size and text of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            a, x, y = (batch.column(i).to_pylist() for i in (0, 2, 3))
            at, linked = 0, []
            while at < len(a):
                held, left, right, size, to = [], [], [], 0, at
                while to < len(a) and size < 1 << 20:
                    if to == at or a[to] != a[to - 1]:
                        hub = len(held)
                        held.append(unpack(x[to]))
                        size += len(held[-1])
                    left.append(hub)
                    right.append(len(held))
                    held.append(unpack(y[to]))
                    size += len(held[-1])
                    to += 1
                sets = Sets(pa.array(held, pa.binary()), words)
                own = [sets.items[p:q] for p, q in zip(sets.first[:-1], sets.first[1:], strict=True)]
                for i, j in zip(left, right, strict=True):
                    p, q = (own[i], own[j]) if len(own[i]) > len(own[j]) else (own[j], own[i])
                    both = int(np.count_nonzero(p[np.minimum(np.searchsorted(p, q), len(p) - 1)] == q))
                    linked.append(100 * both >= share * (len(p) + len(q) - both))
                at = to
            yield batch.filter(pa.array(linked, pa.bool_())).select(["a", "b"])

    joined = pairs.join(texts.toDF("b", "nb", "y"), "b").join(texts.toDF("a", "na", "x"), "a").filter(f"100 * least(na, nb) >= {share} * greatest(na, nb)")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


FEW, FINE, BLOCK_BYTES, MATRIX = 4, 2, 1 << 15, 1 << 22


def sketches(texts: DataFrame, words: int, share: int) -> DataFrame:
    """(s, n, band, own, above): a byte for each of ``FINE`` times as many cells of the universe as a set of its band (and the next) has segments.

    Six bits of a byte are a hash of what the set has in the cell, two its number, modulo 4. See ``apart``.
    """
    low, segments, _ = bands(share)
    many = (segments * FINE + 7) // 8 * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes = np.array(batch.column(1).to_pylist())
            at = np.searchsorted(low, sizes, "right") - 1
            own, above = [], []
            for i, packed in enumerate(batch.column(2).to_pylist()):
                items = Sets(pa.array([unpack(packed)], pa.binary()), words).items
                for band, out in ((at[i], own), (at[i] + 1, above)):
                    cells = int(many[band])
                    cell = ((items >> U64(32)) * U64(cells) >> U64(32)).astype(np.intp)
                    sums = np.zeros(cells, U64)
                    np.add.at(sums, cell, T.mix(items.copy()))
                    out.append(((T.mix(sums) & U64(0xFC)).astype(np.uint8) | (np.bincount(cell, minlength=cells) & 3).astype(np.uint8)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at.astype(np.int32)), pa.array(own, pa.binary()), pa.array(above, pa.binary())], ["s", "n", "band", "own", "above"])

    return texts.select("s", "n", "packed").mapInArrow(run, "s long, n long, band int, own binary, above binary")


ONES = U64(0x0101010101010101)


def apart(x: np.ndarray) -> np.ndarray:
    """The least number of differences, from the sketches' bytes (eight in a word) combined by exclusive or.

    A cell that differs has one difference at least, and two if the numbers of elements differ by an even number.
    """
    odd = np.bitwise_count(x & ONES).sum(-1, dtype=np.int64)
    for k in (4, 2, 1):  # whether any bit of a byte is set, in its lowest bit
        x = x | x >> U64(k)
    return 2 * np.bitwise_count(x & ONES).sum(-1, dtype=np.int64) - odd


def near_in_blocks(mixed: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """Pairs (a, b) of different roots that share a key and that sketches don't tell apart. ``mixed``: (key, s, root).

    Sketches rule pairs out exactly. Members of a key are dealt to blocks by a hash, a block for some bytes of sketches, and blocks meet blocks;
    pairs are no rows before they are near.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column(0).to_numpy(zero_copy_only=False)
            sides, firsts = [], []
            for i in (1, 2):
                firsts.append(np.r_[0, np.cumsum(pa.compute.list_value_length(batch.column(i)).to_numpy())])
                sides.append(batch.column(i).flatten())
            s, root, n, band = (np.concatenate([x.field(f).to_numpy() for x in sides]).astype(np.int64) for f in ("s", "root", "n", "band"))
            shift = len(sides[0])
            own, above = ([y for x in sides for y in x.field(f).to_pylist()] for f in ("own", "above"))
            p, q = [], []
            for r in range(len(same)):
                left, right = np.arange(*firsts[0][r : r + 2]), shift + np.arange(*firsts[1][r : r + 2])
                i, j = np.repeat(left, len(right)), np.tile(right, len(left))
                fit = (root[i] != root[j]) & (abs(band[i] - band[j]) < 2) & (100 * np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j]))
                fit &= (s[i] < s[j]) if same[r] else True
                p.append(i[fit])
                q.append(j[fit])
            p, q = np.concatenate(p), np.concatenate(q)
            level, near = np.maximum(band[p], band[q]), [np.zeros(0, np.int64)]
            for c in np.unique(level):
                here = np.flatnonzero(level == c)
                used, slot = np.unique(np.r_[p[here], q[here]], return_inverse=True)
                table = np.frombuffer(b"".join(own[k] if band[k] == c else above[k] for k in used.tolist()), U64).reshape(len(used), -1)
                step = max(1, MATRIX // (8 * table.shape[1]))
                for at in range(0, len(here), step):
                    some = here[at : at + step]
                    x = table[slot[at : at + len(some)]] ^ table[slot[len(here) + at : len(here) + at + len(some)]]
                    near.append(some[apart(x) * (100 + share) <= (100 - share) * (n[p[some]] + n[q[some]])])
            x, y = (s[i[np.concatenate(near)]] for i in (p, q))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    spark = mixed.sparkSession
    own = written(sketches(texts.join(mixed.select("s").distinct(), "s"), words, share), "sketches")
    dealt = written(mixed.join(own, "s"), "sketched")
    sizes = dealt.groupBy("key").agg(F.ceil(F.sum(F.length("own") + F.length("above")) / BLOCK_BYTES).alias("blocks"), F.collect_set("band").alias("bands"))
    dealt, sets = dealt.join(written(sizes, "key-sizes"), "key"), F.collect_list(F.struct("s", "root", "n", "band", "own", "above")).alias("sets")
    # The sketch for the band above is for sets of that band only.
    dealt = dealt.withColumn("above", F.when(F.array_contains("bands", F.col("band") + 1), F.col("above")).otherwise(F.lit(b""))).drop("bands")
    one = dealt.filter("blocks = 1").groupBy("key").agg(sets).select(F.lit(True).alias("same"), F.col("sets").alias("x"), F.col("sets").alias("y"))
    blocks = dealt.filter("blocks > 1").groupBy("key", "blocks", F.pmod(F.xxhash64("s"), "blocks").alias("block"))
    blocks = written(blocks.agg(sets), "blocks")
    # The blocks of a large key meet in as many tasks as there are pairs of them.
    x = blocks.select("key", F.col("block").alias("i"), F.expr("explode(sequence(block, blocks - 1))").alias("j"), F.col("sets").alias("x"))
    y = blocks.select("key", F.expr("explode(sequence(0, block))").alias("i"), F.col("block").alias("j"), F.col("sets").alias("y"))
    met = x.join(y, ["key", "i", "j"]).select((F.col("i") == F.col("j")).alias("same"), "x", "y").unionByName(one)
    with rows_a_batch(spark, 256):  # of two blocks each
        return written(met.mapInArrow(compare, "a long, b long").distinct(), "near-pairs")


def packed_texts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(2))
            blob, at = data.tobytes(), offsets.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([pack(blob[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["doc_id", "h", "packed"])

    return _keyed(docs).mapInArrow(run, "doc_id long, h long, packed binary")


def _hubs(members: DataFrame) -> DataFrame:
    """(s, hubs): the two hubs of most keys of each set that has others than itself."""
    spokes = members.filter("s <> hub").groupBy("s", "hub").agg(F.sum("w").alias("w"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("w", "hub")), asc=False), 1, 2)  # a set has no more hubs than keys
    return spokes.groupBy("s").agg(best.alias("best")).select("s", F.col("best.hub").alias("hubs"))


def _mixed(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with their roots so far, and (key, c, hub_root) of keys that have several roots."""
    marked = members.join(roots.select(F.col("node").alias("s"), "root"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    mixed = marked.groupBy("key").agg(F.min("root").alias("p"), F.max("root").alias("q"), F.count("*").alias("c"), F.max(F.when(F.col("s") == F.col("hub"), F.col("root"))).alias("hub_root"))
    return marked, written(mixed.filter("p < q").select("key", "c", "hub_root"), "mixed")


def link_classes(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """Summaries of the rows, and (node, root) of the sets that link with others."""
    rows = written(summaries(docs, words), "sets")
    keys = segment_keys(docs, words, share)
    # Sets that meet in a key of the band above them all meet in their own band too.
    shared = keys.groupBy("key").agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count("*").alias("c"), F.bool_and("up").alias("up")).filter("lo < hi AND NOT up")
    shared = written(shared.select("key", "lo", "hi", "c"), "shared-keys")
    members = written(keys.join(shared.filter("c > 2").select("key"), "key").select("key", "s").distinct(), "key-members")
    # A key's hub is the one among its sets that has most shared keys, likely the least edited of a group.
    degree = F.count("*").over(Window.partitionBy("s"))  # a set has no more keys than shingles, give or take
    hub = members.withColumn("degree", degree).groupBy("key").agg(F.max(F.struct("degree", "s")).alias("hub"), F.count("*").alias("c"), *(F.bit_xor(F.xxhash64("s", F.lit(i))).alias(f"x{i}") for i in (0, 1)))
    # Keys of the same sets give the same pairs, so one of them is enough; ``w``: how many it stands for.
    hub = written(hub.groupBy("c", "x0", "x1").agg(F.min("key").alias("key"), F.first("hub.s").alias("hub"), F.count("*").alias("w")).select("key", "hub", "w"), "hubs")
    members = written(members.join(hub, "key"), "hub-members")
    # A set is compared with one hub at a time, that of most of its keys at first: there are no more pairs than sets, however many keys a group shares.
    first = written(_hubs(members).select("s", F.col("hubs")[0].alias("hub")), "first-hubs")
    pairs = first.select(F.least("s", "hub").alias("a"), F.greatest("s", "hub").alias("b"))
    tried = written(shared.filter("c = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(pairs).distinct(), "hub-pairs")
    # A hub may be in no pair yet, if all others of its keys have a better one.
    wanted = members.select("s").unionByName(tried.select(F.col("a").alias("s"))).unionByName(tried.select(F.col("b").alias("s"))).distinct()
    # A null doc_id is taken only where a set has no other, and is joined as a value.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", F.col("n_shingles").alias("n"))).alias("v")
    chosen = rows.filter("n_shingles > 0").groupBy("s").agg(least).join(wanted, "s").select("s", F.col("v.doc_id").alias("d"), F.col("v.h").alias("g"), "v.n")
    texts = packed_texts(docs).join(chosen, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))).select("s", "n", "packed")
    texts = written(texts.groupBy("s").agg(F.first("n").alias("n"), F.first("packed").alias("packed")), "set-texts")
    roots = connected_components(verified(tried, texts, words, share))
    # Sets that are not with all their hubs by now have one more try, which joins most groups, so that fewer pairs are left.
    marked, mixed = _mixed(members, roots)
    again = _hubs(marked.join(mixed.select("key", "hub_root"), "key").filter("root <> hub_root")).join(first, "s", "left")
    again = again.select("s", F.get(F.filter("hubs", lambda h: ~h.eqNullSafe(F.col("hub"))), F.lit(0)).alias("hub")).filter("hub IS NOT NULL")
    again = written(again.select(F.least("s", "hub").alias("a"), F.greatest("s", "hub").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "second-pairs")
    roots = connected_components(roots.toDF("a", "b").unionByName(verified(again, texts, words, share)))
    tried = tried.unionByName(again)
    # Members of keys whose sets are not all in one component by now.
    marked, mixed = _mixed(members, roots)
    mixed = written(marked.join(mixed.select("key", "c"), "key").select("key", "s", "root", "c"), "mixed-keys")
    # What is left: pairs of two components that share a key and were not compared. Keys of few sets have few pairs.
    x, y = (mixed.filter(F.col("c") <= FEW).select("key", F.col("s").alias(s), F.col("root").alias(r)) for s, r in (("a", "ra"), ("b", "rb")))
    few = x.join(y, "key").filter("ra <> rb AND a < b").select("a", "b")
    many = near_in_blocks(mixed.filter(F.col("c") > FEW).select("key", "s", "root"), texts, words, share)
    rest = few.unionByName(many).distinct().join(tried, ["a", "b"], "left_anti")
    more = verified(rest, texts, words, share)
    # Links found before are as good as their components.
    return rows, connected_components(roots.toDF("a", "b").unionByName(more))


def classes(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """Per row: doc_id, h (hash of its text), n_shingles, component_id as in ``ngram_join``, and ``head``, the least (doc_id, h) of its component."""
    rows, roots = link_classes(docs, words, share)
    # Classes are made of sets, so that copies don't meet in one group.
    sets = rows.filter("n_shingles > 0").groupBy("s").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("least"))
    sets = sets.join(roots.select(F.col("node").alias("s"), "root"), "s", "left").select("s", F.coalesce("root", "s").alias("root"), "least")
    sets = written(sets, "classes")
    heads = written(sets.groupBy("root").agg(F.min("least").alias("head")), "class-heads")
    sets = written(sets.select("s", "root").join(heads, "root").select("s", F.struct("head.doc_id", "head.h").alias("head")), "set-heads")
    full = rows.filter("n_shingles > 0").join(sets, "s").select("doc_id", "h", "n_shingles", F.coalesce("head.doc_id", "doc_id").alias("component_id"), "head")
    return full.unionByName(rows.filter("n_shingles = 0").select("doc_id", "h", "n_shingles", F.col("doc_id").alias("component_id"), F.struct("doc_id", "h").alias("head")))


def ngram_join(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Two documents link when 100 * intersection >= ``share`` * union of their sets of distinct ``words``-word shingles (A-Z lower-cased; a
    shorter text is one shingle). Null and empty texts, and those without words, are empty sets and link with nothing. Rows of one doc_id are
    documents of their own, each by its text. A null doc_id links as others do, but is no component_id
    unless nothing else is reachable (then null). Equal sets are one class and compared once. Other columns are ignored. Shingles and sets are
    told apart by 64-bit hashes.
    """
    return classes(docs, words, share).select("doc_id", "n_shingles", "component_id")
