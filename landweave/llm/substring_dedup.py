"""Substring dedup: seed and extend.

Seeds are winnowed anchors: of the 41 ten-word sequences in a 50-word window the one with the least hash. The window's words alone choose it,
so equal windows of two documents share it at the same place. Anchors that one document alone has go no further. The windows that chose an
anchor make up its span, which is the match extended both ways as far as the anchor reaches: where spans are equal, so are all their windows.
Where an anchor stands in different spans, the first document of each span is extended window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import text_key, written

WINDOW, ANCHOR = 50, 10
U64 = np.uint64
PLACE = 26


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n + 1, b, dtype=U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64 bits of the word sequences from ``starts`` to ``ends``."""
    power, inverse = _powers(len(hashes), base)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum((hashes | U64(1)) * power[:-1], out=sums[1:])
    return T.mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


BASES = (0x9FB21C651E98DF25, 0xA24BAED4963EE407)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits, of two independent hashes."""
    again = T.mix(hashes ^ U64(0x2545F4914F6CDD1D))
    return span_hashes(hashes, starts, ends, BASES[0]), span_hashes(again, starts, ends, BASES[1])


def chosen_anchors(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The start of each whole window, its text, and its anchor's start."""
    counts = np.diff(first)
    each = np.maximum(counts - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), each)
    starts = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    if not len(starts):
        return starts, text, starts
    grams = np.zeros(len(hashes) - anchor + 1, U64)
    for j in range(anchor):
        grams *= T.BASE
        grams += hashes[j : j + len(grams)]
    T.mix(grams)
    owner = np.repeat(np.arange(len(counts)), counts)[: len(grams)]
    place = (np.arange(len(grams)) - first[:-1][owner]).astype(U64)
    keys = (grams >> U64(PLACE)) << U64(PLACE)
    keys |= (U64((1 << PLACE) - 1) - place) & U64((1 << PLACE) - 1)
    reach, span = 1, window - anchor + 1
    least = keys
    while reach * 2 <= span:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    at = U64((1 << PLACE) - 1) - (least[starts] & U64((1 << PLACE) - 1))
    return starts, text, first[:-1][text] + at.astype(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64))


def anchor_spans(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(k, h, anchor, s1, s2, start, n): runs of ``n`` windows from word ``start`` that chose one anchor; s1, s2: the hash of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(2))
            words = T.Words(data, offsets)
            hashes = words.hashes()
            starts, text, at = chosen_anchors(hashes, words.first, window, anchor)
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]) if len(at) else np.zeros(0, np.intp)
            n = np.diff(np.r_[new, len(at)])
            begin, doc = starts[new], text[new]
            s1, s2 = window_hashes(hashes, begin, begin + n + window - 1)
            a1 = span_hashes(hashes, at[new], at[new] + anchor, BASES[0])
            keys = batch.select([0, 1]).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), _signed(a1), _signed(s1), _signed(s2), pa.array((begin - words.first[doc]).astype(np.int64)), pa.array(n.astype(np.int64))], ["k", "h", "anchor", "s1", "s2", "start", "n"])

    return docs.mapInArrow(run, "k long, h long, anchor long, s1 long, s2 long, start long, n long")


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document that has some: ``spans``, its windows whose words also start in a document with a smaller doc_id, as (start, n) runs.

    ``start`` counts words from 0, ``n`` windows; a run covers n + window - 1 words. Windows of a null doc_id are neither removed nor
    removing. Rows of one doc_id are one document: what they share among themselves stays.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("k"), text_key().alias("h"), "text")
    known = keyed.filter("k IS NOT NULL")
    spans = anchor_spans(known, window, anchor)
    shared = spans.groupBy("anchor").agg(F.min("k").alias("a"), F.max("k").alias("b")).filter("a < b").select("anchor")
    shared = written(shared, "shared-anchors")  # so that the spans of a common anchor may be split among tasks
    seeds = written(spans.join(shared, "anchor"), "seeds")
    firsts = written(seeds.groupBy("anchor", "s1", "s2").agg(F.min("k").alias("first")), "first-spans")
    several = firsts.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    placed = seeds.join(firsts, ["anchor", "s1", "s2"])
    whole = placed.filter("k > first").select("k", "h", "start", "n")
    open_spans = seeds.join(firsts.join(several, "anchor"), ["anchor", "s1", "s2"]).filter("k = first").groupBy("k", "h").agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(2))
            words = T.Words(data, offsets)
            hashes = words.hashes()
            doc, start = [], []
            for i, runs in enumerate(batch.column(3).to_pylist()):
                for x in runs:
                    doc.append(np.full(x["n"], i))
                    start.append(np.arange(x["start"], x["start"] + x["n"]))
            doc, start = np.concatenate(doc), np.concatenate(start)
            begin = words.first[doc] + start
            w1, w2 = window_hashes(hashes, begin, begin + window)
            keys = batch.select([0, 1]).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), pa.array(start.astype(np.int64)), _signed(w1), _signed(w2)], ["k", "h", "start", "w1", "w2"])

    windows = keyed.join(open_spans, ["k", "h"]).select("k", "h", "text", "spans").mapInArrow(extend, "k long, h long, start long, w1 long, w2 long")
    windows = written(windows, "windows")
    least = windows.groupBy("w1", "w2").agg(F.min("k").alias("first"), F.max("k").alias("last")).filter("first < last").drop("last")
    single = windows.join(least, ["w1", "w2"]).filter("k > first").select("k", "h", "start", F.lit(1).cast("long").alias("n"))
    return whole.unionByName(single).distinct().groupBy("k", "h").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: n_words, n_removed, ``removed`` (the maximal removed stretches, as word ranges), kept_sha256 and ``kept``, the words that stay.

    A word goes if a window over it also starts in a document with a smaller doc_id; windows are judged on the input. A null text has no
    words. Repeated rows get equal results; so do rows of one doc_id with equal texts. Other columns are ignored. Exact: spans and windows
    are equal if 128 bits of hash are. Texts meet their repeats by doc_id; common passages are reduced to their first document before.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("k"), text_key().alias("h"), "text")
    found = repeats(docs, window, anchor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(1))
            words = T.Words(data, offsets)
            rows = []
            for i, runs in enumerate(batch.column(2).to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                gone = np.zeros(b - a + 1, np.int64)
                for x in runs or ():
                    gone[x["start"]] += 1
                    gone[x["start"] + x["n"] + window - 1] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                own = data[offsets[i] : offsets[i + 1]].tobytes()
                kept = own.split() if not len(edge) else [data[s:e].tobytes() for s, e in zip(words.starts[a:b][~gone], words.ends[a:b][~gone], strict=True)]
                kept = b" ".join(kept)
                rows.append((int(b - a), int(gone.sum()), [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)], hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            columns[4] = columns[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_removed", "removed", "kept_sha256", "kept"])

    joined = keyed.join(found, ["k", "h"], "left").select("k", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept_sha256 string, kept string")
