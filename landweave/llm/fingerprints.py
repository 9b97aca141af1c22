"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its five-word shingles with their counts. For each of ``SAMPLES`` independent samples every term k of weight S
gets r, c ~ Gamma(2, 1) and b ~ U(0, 1) that depend on k and the sample alone, then t = floor(ln S / r + b) and
ln a = ln c - r (t - b + 1). The term with the least a is the sample: two documents agree on (k, t) with the probability of their
generalised Jaccard similarity, sum of the smaller weights over sum of the larger ones.

The triples (r, c, b) are drawn once; hashed terms choose among ``DRAWS`` of them, and terms that tie are ordered by their hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .codec import codec_dictionary, packers
from .storage import text_key, written

WORDS, SAMPLES, DRAWS, SEED = 5, 64, 1 << 16, 20240611
CHUNK = 1 << 18
U64 = np.uint64


def ordered(x: np.ndarray) -> np.ndarray:
    """32-bit numbers in the order of the floats, in the upper half of 64 bits."""
    bits = x.astype(np.float32).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(U64) << U64(32)


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of the draws, the packed ln a of weight 1 (t is 0), and a salt for each sample."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    r, c, b = rng.gamma(2.0, 1.0, DRAWS), rng.gamma(2.0, 1.0, DRAWS), rng.random(DRAWS)
    return r, np.log(c), b, ordered(np.log(c) - r * (1 - b)), rng.integers(0, 1 << 63, SAMPLES, dtype=U64)


def signatures(terms: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bits of each sample of each weighted set; set i has the terms ``first[i]:first[i + 1]``. Sets without terms are all zeros."""
    r, ln_c, b, one, salts = draws()
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    least = np.full((SAMPLES, n), ~U64(0))
    for single in (True, False):
        pick = np.flatnonzero((weights == 1) == single)
        if not len(pick):
            continue
        own, h = owner[pick], terms[pick]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sets, ln_w = own[starts], np.log(weights[pick].astype(float))
        for j in range(SAMPLES):
            x = h + salts[j]
            x *= T.ODD
            x ^= x >> U64(29)
            x *= T.BASE
            draw = (x >> U64(48)).astype(np.intp)
            if single:
                x &= U64(0xFFFFFFFF)
                x |= one[draw]
            else:
                t = np.floor(ln_w / r[draw] + b[draw])
                x ^= t.astype(np.int64).astype(U64) * T.ODD
                x &= U64(0xFFFFFFFF)
                x |= ordered(ln_c[draw] - r[draw] * (t - b[draw] + 1))
            least[j, sets] = np.minimum(least[j, sets], np.minimum.reduceat(x, starts))
    out = T.mix(least.copy() & U64(0xFFFFFFFF)).astype(np.uint16).T.copy()
    out[np.diff(first) == 0] = 0
    return out


def sign(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The signatures of some texts, as rows of 16-bit samples."""
    found = T.Words(data, offsets)
    hashes, text = T.shingles(found.hashes(), found.first, words)
    ends = np.searchsorted(text, np.arange(len(offsets)))
    terms, weights, sizes = [], [], []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        own = np.sort(hashes[a:b])
        new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if b > a else np.zeros(0, np.intp)
        terms.append(own[new])
        weights.append(np.diff(np.r_[new, b - a]))
        sizes.append(len(new))
    return signatures(np.concatenate(terms), np.concatenate(weights), np.r_[0, np.cumsum(sizes)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of samples on which fingerprints agree."""
    return (a == b).mean(axis=-1)


def lengths(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return heads[offsets[1:]] - heads[offsets[:-1]]


def fingerprint(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, ``n_chars`` in code points and ``fingerprint`` (hexadecimal, four digits a sample) of each document.

    Words are what white space separates, unchanged; a text with fewer than ``words`` of them is one term. A null text is an empty one;
    texts without words have the fingerprint of zeros. Equal texts have equal fingerprints. Repeated rows and ids give a row each. Other
    columns are ignored. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, CHUNK):
            data, offsets = T.raw(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths(data, offsets)), pa.array([x.tobytes().hex() for x in sign(data, offsets, words)])], ["doc_id", "n_chars", "fingerprint"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def successors(ids: DataFrame) -> DataFrame:
    """For rows (k, h, n): k and h with ``own``, the (k, h, n) of the next larger (k, h); after the largest comes the smallest.

    Rows are dealt to ranges; a window runs inside each, and the last of a range is followed by the first of the next. What the driver sees
    is a row a range, as many as there are partitions.
    """
    value = F.struct("k", "h", "n").alias("v")
    ranged = ids.repartitionByRange("k", "h").select("k", "h", value, F.spark_partition_id().alias("range"))
    ranged = written(ranged, "ranges")  # the number of a partition is no longer worked out anew
    heads = sorted(ranged.groupBy("range").agg(F.min("v").alias("v")).collect())
    if not heads:
        return ids.select("k", "h", value.alias("own"))
    after = [(x["range"], *y["v"]) for x, y in zip(heads, heads[1:] + heads[:1], strict=True)]
    after = ids.sparkSession.createDataFrame(after, "range int, k long, h long, n long").select("range", F.struct("k", "h", "n").alias("then"))
    inside = ranged.withColumn("next", F.lead("v").over(Window.partitionBy("range").orderBy("k", "h")))
    return inside.join(F.broadcast(after), "range").select("k", "h", F.coalesce("next", "then").alias("own"))


def with_edits(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how alike they and the next document's are.

    The edited text: the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document in descending
    doc_id; after the last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents of one doc_id are ordered by the hash of their text, equal rows are one document and give equal results. A null doc_id
    comes last. A lone document is its own next. An empty table gives no rows. Other columns are ignored.
    Texts are shuffled once, compressed, to meet their neighbour's length, and the halves needed once more.
    """
    keys = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), text_key().alias("h")]
    ids = docs.select(*keys, F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n")).distinct()
    dictionary = codec_dictionary(docs)
    own = successors(ids).select("k", "h", F.col("own.k").alias("ok"), F.col("own.h").alias("oh"), F.col("own.n").alias("on"))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, _ = packers(dictionary)
        for batch in T.chunks(batches, CHUNK):
            data, offsets = T.raw(batch.column(3))
            blob, at = data.tobytes(), offsets.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(lengths(data, offsets)), pa.array([x.tobytes() for x in sign(data, offsets, words)], pa.binary()), pa.array([pack(blob[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())],
                ["k", "h", "doc_id", "n", "mark", "packed"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = packers(dictionary)
        for batch in T.chunks(batches, CHUNK, "packed"):
            rows = batch.to_pydict()
            texts = [unpack(x).decode() for x in rows["packed"]]
            heads = [pack(t[: n - n // 2].encode()) for t, n in zip(texts, rows["n"], strict=True)]
            given = [pack(t[: m // 2].encode()) for t, m in zip(texts, rows["on"], strict=True)]
            none = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["ok"] + rows["k"], pa.int64()), pa.array(rows["oh"] + rows["h"], pa.int64()), pa.array([0] * len(texts) + [1] * len(texts), pa.int32()), pa.array(none + rows["doc_id"], pa.int64()),
                 pa.array(none + rows["n"], pa.int64()), pa.array(rows["mark"] * 2, pa.binary()), pa.array(given + heads, pa.binary())],
                ["k", "h", "own", "doc_id", "n", "mark", "packed"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unpack = packers(dictionary)
        held, size, given = [], 0, (None, None, b"", b"")

        def flush() -> pa.RecordBatch:
            ids, n, marks, nexts, edited = zip(*held, strict=True)
            offsets = np.r_[0, np.cumsum([len(x) for x in edited])]
            made = sign(np.frombuffer(b"".join(edited), np.uint8), offsets, words)
            mark, then = (np.frombuffer(b"".join(x), np.uint16).reshape(-1, SAMPLES) for x in (marks, nexts))
            arrays = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in edited]), pa.array([x.hex() for x in marks]), pa.array([x.tobytes().hex() for x in made]), pa.array(likeness(mark, made)), pa.array(likeness(mark, then))]
            return pa.RecordBatch.from_arrays(arrays, NAMES)

        for batch in batches:
            for k, h, is_own, doc_id, n, mark, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = unpack(packed)
                if not is_own:
                    given = (k, h, mark, part)
                    continue
                if given[:2] != (k, h):
                    raise ValueError("a document has no next one")
                held.append((doc_id, n, mark, given[2], part + given[3]))
                size += len(part) + len(given[3])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    signed = docs.select(*keys, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(first_pass, "k long, h long, doc_id long, n long, mark binary, packed binary")
    halves = signed.join(own, ["k", "h"]).mapInArrow(cut, "k long, h long, own int, doc_id long, n long, mark binary, packed binary")
    met = halves.repartition("k", "h").sortWithinPartitions("k", "h", "own")
    return met.mapInArrow(meet, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

