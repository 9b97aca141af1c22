"""Line dedup by a deletion-neighbourhood join.

Lines at edit distance one share a variant with one character left out, at the same place (a substitution) or one of them is the variant itself
(an insertion). Equal lines are joined first. Then only lines that have half of their characters in common with another line emit variants: one
edit leaves either the first or the last half of a line alone, so all others have no partner.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import fresh, text_key, written

LEAST_CHARS, PIECES = 20, 16
U64 = np.uint64
BREAK = np.zeros(256, bool)
BREAK[10] = True
#: White space; a line of nothing else is blank.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Another order of the byte values, for a second hash.
OTHER = np.random.Generator(np.random.PCG64(11)).permutation(256).astype(np.uint8)
LAST = (1 << 63) - 1


@lru_cache(maxsize=1)
def buckets() -> np.ndarray:
    """The least length of each bucket of lengths."""
    low = [2]
    while low[-1] < 1 << 31:
        low.append(max(low[-1] + 1, low[-1] * 5 // 4))
    return np.array(low)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k"), text_key().alias("h"), "text")


def line_rows(docs: DataFrame, least: int, exact: int, keyed: bool = True) -> DataFrame:
    """Lines of ``least`` characters or more, and those of ``exact`` or more that are not blank: place (k, h, line) and 128 bits of the line.

    Those of ``least`` or more have keys of their halves, as those of their bucket of lengths have them; the others have nulls. Without
    ``keyed`` there are none.
    """
    halved = ["a1", "a2", "b1", "b2"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = buckets()
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(2))
            found = T.Words(data, offsets, BREAK)
            begins = (data & 0xC0) != 0x80
            heads, places = np.r_[0, np.cumsum(begins)], np.r_[np.flatnonzero(begins), len(data)]
            starts, ends, doc = found.starts, found.ends, found.text_of()
            n = heads[ends] - heads[starts]
            filled = np.r_[0, np.cumsum(~SPACE[data])]
            pick = (n >= least) | ((n >= exact) & (filled[ends] > filled[starts]))
            starts, ends, doc, n = starts[pick], ends[pick], doc[pick], n[pick]
            breaks = np.r_[0, np.cumsum(data == 10)]
            line = breaks[starts] - breaks[offsets[doc]]
            at = np.maximum(np.searchsorted(low, n, "right") - 1, 0)
            halves = []
            for bucket, valid in ((at, n >= least), (at + 1, (n >= least) & (n + 1 == low[at + 1]))) if keyed else ():
                p = np.where(valid, (low[bucket] - 1) // 2, 0)
                salt = bucket.astype(U64) * T.ODD
                size = np.where(valid & (p > 0), p, 1)  # halves of the shortest lines are empty and equal
                front = np.where(p > 0, T.hash_ranges(data, starts, places[heads[starts] + size]), U64(0))
                back = np.where(p > 0, T.hash_ranges(data, places[heads[ends] - size], ends), U64(0))
                for x, side in ((front, 1), (back, 2)):
                    halves.append(pa.array(T.mix(x + salt + U64(side)).view(np.int64), mask=~valid))
            h1 = T.hash_ranges(data, starts, ends)
            h2 = T.hash_ranges(OTHER[data], starts, ends)
            keys = batch.select([0, 1]).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), pa.array(line.astype(np.int64)), _long(h1), _long(h2), *halves], ["k", "h", "line", "h1", "h2", *halved])

    return _keyed(docs).mapInArrow(run, "k long, h long, line long, h1 long, h2 long" + "".join(f", {x} long" for x in halved))


def packed(docs: DataFrame) -> DataFrame:
    """The table with its texts compressed."""
    fields = [f for f in docs.schema.fields]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in T.chunks(batches):
            column = batch.column(at)
            data, offsets = T.raw(column)
            blob, cut = data.tobytes(), offsets.tolist()
            made = pa.array([pack(blob[a:b]) if there else None for a, b, there in zip(cut, cut[1:], column.is_valid().to_pylist(), strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([made if i == at else batch.column(i) for i in range(batch.num_columns)], batch.schema.names)

    schema = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(run, schema)


def _code_points(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points (from 1 on), powers of the base and sums that give the hash of any stretch."""
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(U64) + U64(1)
    power = np.full(len(x) + 2, T.BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    return x, power, np.r_[U64(0), np.cumsum(x * power[: len(x)])]


def _inverse(n: int) -> np.ndarray:
    out = np.full(n + 1, pow(int(T.BASE), -1, 1 << 64), dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def pieces(n: int, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the part that an edit may change begins and ends, for each piece, in a line of ``n`` among lines of ``longer`` and one less."""
    cut = np.arange(PIECES + 1) * (longer - 1) // PIECES
    return cut[:-1], n - (longer - 1) + cut[1:]


def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of what stands around each piece."""
    for batch in T.chunks(batches, 1 << 19, "value"):
        keys, which = [], []
        for text in batch.column(3).to_pylist():
            x, power, sums = _code_points(text)
            n = len(x)
            inverse = _inverse(n)
            for longer in (n, n + 1):
                a, b = pieces(n, longer)
                back = (sums[n] - sums[b]) * inverse[b]
                keys.append(T.mix(T.mix(sums[a] + a.astype(U64)) + back * T.ODD + (n - b).astype(U64) + U64(longer << 8)))
                which.append(np.arange(PIECES) + PIECES * (longer - n))
        own = batch.select([0, 1, 2]).take(pa.array(np.repeat(np.arange(batch.num_rows), 2 * PIECES)))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.concatenate(which).astype(np.int32)), _long(np.concatenate(keys))], ["k", "h", "line", "piece", "key"])


def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each line (kind 0), of it with one character of the given pieces left out (1), and of that and the place (2)."""
    for batch in T.chunks(batches, 1 << 19, "value"):
        parts = []
        for text, which in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            x, power, sums = _code_points(text)
            n, inverse = len(x), U64(pow(int(T.BASE), -1, 1 << 64))
            a, b = pieces(n, n)
            at = np.unique(np.concatenate([np.arange(a[j], b[j]) for j in which if j < PIECES] or [np.zeros(0, np.int64)])).astype(np.int64)
            less = sums[at] + (sums[n] - sums[at + 1]) * inverse
            spot = (at + 1).astype(U64) * T.ODD
            parts.append((np.r_[T.mix(sums[n:].copy()), T.mix(less.copy()), T.mix(T.mix(less) ^ spot)], np.r_[0, np.ones(len(at)), np.full(len(at), 2)].astype(np.int32)))
        keys = batch.select([0, 1, 2]).take(pa.array(np.repeat(np.arange(batch.num_rows), [len(k) for k, _ in parts])))
        yield pa.RecordBatch.from_arrays([_long(np.concatenate([k for k, _ in parts])), pa.array(np.concatenate([c for _, c in parts])), *keys.columns], ["key", "kind", "k", "h", "line"])


def within_one(a: str, b: str) -> bool:
    """Edit distance one or less."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def repeated_lines(docs: DataFrame, least: int = LEAST_CHARS, exact: int | None = None) -> DataFrame:
    """(k, h, lines): the lines of each document that go."""
    exact = least if exact is None else exact
    rows, places = line_rows(docs, least, exact), line_rows(docs, least, exact, keyed=False)
    place = F.struct("k", "h", "line")
    firsts = rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("c"), *(F.first(x).alias(x) for x in ("a1", "a2", "b1", "b2")))
    firsts = written(firsts, "lines")
    equal = places.join(firsts.filter("c > 1").select("h1", "h2", "first"), ["h1", "h2"]).filter(place > F.col("first")).select("k", "h", "line")
    halves = firsts.select("first", F.explode(F.array("a1", "a2", "b1", "b2")).alias("half")).filter("half IS NOT NULL")
    common = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    wanted = halves.join(common, "half").select("first.*").distinct().groupBy("k", "h").agg(F.collect_list("line").alias("lines"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k, h, text, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = unpack(text).decode().split("\n")
                n = len(lines)
                yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int64()), pa.array([h] * n, pa.int64()), pa.array(lines, pa.int64()), pa.array([own[i] for i in lines], pa.string())], ["k", "h", "line", "value"])

    held = packed(_keyed(docs)).join(wanted, ["k", "h"]).select("k", "h", "text", "lines").mapInArrow(pick, "k long, h long, line long, value string")
    # Rows of one place are equal.
    held = written(held.dropDuplicates(["k", "h", "line"]), "candidate-lines")
    near_keys = held.select("k", "h", "line", "value").mapInArrow(around, "k long, h long, line long, piece int, key long")
    several = near_keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    where = written(near_keys.join(several, "key").groupBy("k", "h", "line").agg(F.collect_set("piece").alias("pieces")), "pieces")
    made = held.join(where, ["k", "h", "line"]).select("k", "h", "line", "value", "pieces").mapInArrow(variants, "key long, kind int, k long, h long, line long")
    groups = made.groupBy("key").agg(F.count("*").alias("c"), F.min(F.when(F.col("kind") == 0, place)).alias("whole"), F.min(F.when(F.col("kind") == 1, place)).alias("less"), F.min(F.when(F.col("kind") == 2, place)).alias("same")).filter("c > 1")
    partner = F.when(F.col("kind") == 0, F.col("less")).when(F.col("kind") == 1, F.col("whole")).otherwise(F.col("same"))
    met = made.join(groups, "key").select("k", "h", "line", partner.alias("partner")).filter(F.col("partner").isNotNull() & (F.col("partner") < place))
    best = met.groupBy("k", "h", "line").agg(F.min("partner").alias("partner"))
    pairs = best.join(held.select("k", "h", "line", "value"), ["k", "h", "line"]).join(held.select(place.alias("partner"), F.col("value").alias("earlier")), "partner")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within_one(a, b) for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield batch.filter(pa.array(near, pa.bool_())).select(["k", "h", "line"])

    near = pairs.select("k", "h", "line", "value", "earlier").mapInArrow(check, "k long, h long, line long")
    return equal.unionByName(near).distinct().groupBy("k", "h").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def line_dedup(docs: DataFrame, least: int = LEAST_CHARS, exact: int | None = None, added: tuple[str, str] = ("n_lines", "removed_lines")) -> DataFrame:
    """The rows and columns of ``docs`` with lines removed from ``text``, and ``n_lines`` (before) and ``removed_lines`` (their numbers from 0).

    ``added`` gives these two other names; columns of ``docs`` that have the names are replaced by them.

    A line of ``least`` characters or more goes if an earlier line, by doc_id and place, is equal or one edit (a character inserted, left
    out or replaced) away, whether that one stays or not. Of shorter lines, where one edit is no evidence, those of ``exact`` characters or
    more that are not blank go if an earlier one is equal; without ``exact`` they all stay. Lines end at a new line. A null doc_id is the last.
    Documents of one doc_id with different texts are ordered by the hash of the text; equal rows are one document and keep the
    same lines. A null text stays null, with no lines; an empty one has one line. Other columns may have any names.
    """
    docs = docs.drop(*added)
    taken = repeated_lines(docs, least, exact)
    columns = docs.columns
    at = columns.index("text")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    k, h, lines = (fresh(docs, x) for x in ("k", "h", "lines"))
    side = packed(docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(k), text_key().alias(h)))
    joined = side.join(taken.toDF(k, h, lines), [k, h], "left").select(*(F.col(f"`{c}`") for c in columns), lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in T.chunks(batches, 1 << 20, "text"):
            texts, n, gone = [], [], []
            for text, lines in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                if text is None:
                    texts.append(None)
                    n.append(0)
                    gone.append([])
                    continue
                own = unpack(text).decode().split("\n")
                drop = set(lines or ())
                n.append(len(own))
                texts.append("\n".join(x for i, x in enumerate(own) if i not in drop) if drop else "\n".join(own))
                gone.append(sorted(drop))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(columns))] + [pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.int64()))], [*columns, *added])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + f", `{added[0]}` long, `{added[1]}` array<long>"
    return joined.mapInArrow(run, schema)
