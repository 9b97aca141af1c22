"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

The kernel counts common subsequences of four characters, each occurrence weighted by ``DECAY`` to the number of characters it skips (two at
most), normalised to 1 for equal strings. So an insult with inserted or replaced characters stays near it. Strings are segments: lower-cased
words without marks inside, and runs of single characters joined (``i d i o t``). A sentence or document is judged by its strongest segment.

Landmarks are segments of toxic training documents; a segment's coordinates are its kernel values with them, times the inverse root of the
landmarks' kernel matrix (Nyström). A linear machine in these coordinates is a weight for each subsequence of the landmarks, so scoring needs
no landmark any more: it looks up subsequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import written

LENGTH, SKIPS, DECAY = 4, 2, 0.75
SAMPLE, CANDIDATES, LANDMARKS, COST, NEAR_BEST, KEPT = 4000, 600, 160, 10.0, 0.4, 400_000
U64 = np.uint64
SETS = [(0, *c) for c in combinations(range(1, LENGTH + SKIPS), LENGTH - 1)]

_KINDS = None


def kinds() -> np.ndarray:
    """0: dropped, 1: white space, 2: letter or digit; of code points (from 0x3000 on all are letters)."""
    global _KINDS
    if _KINDS is None:
        _KINDS = np.array([1 if chr(c).isspace() else 2 if chr(c).isalnum() else 0 for c in range(0x3000)], np.uint8)
    return _KINDS


class Segments:
    """Segments of some texts: code points, start and end of each, and its text."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.r_[0, np.cumsum([len(t) for t in lowered])]
        kind = np.where(points < 0x3000, kinds()[np.minimum(points, 0x2FFF)], 2)
        stay = kind > 0
        places = np.r_[0, np.cumsum(stay)]
        points, offsets = points[stay], places[offsets]
        blank = kind[stay] == 1
        edge = np.ones(len(points) + 1, bool)
        edge[1:-1] = blank[:-1]
        edge[offsets] = True
        starts = np.flatnonzero(~blank & edge[:-1])
        edge[:-1] = blank
        edge[-1] = True
        edge[offsets] = True
        ends = np.flatnonzero(~blank & edge[1:]) + 1
        text = np.searchsorted(offsets, starts, "right") - 1
        # Runs of three or more single characters, joined.
        single = (ends - starts == 1).astype(np.int8)
        same = np.r_[False, text[1:] == text[:-1]] if len(text) else np.zeros(0, bool)
        begin = np.flatnonzero((single == 1) & ~(np.r_[0, single[:-1]].astype(bool) & same)) if len(text) else np.zeros(0, np.intp)
        extra, at, own = [], len(points), []
        for b in begin.tolist():
            e = b + 1
            while e < len(starts) and single[e] and same[e]:
                e += 1
            if e - b >= 3:
                extra.append(points[starts[b:e]])
                own.append(text[b])
        sizes = np.array([len(x) for x in extra], np.int64)
        self.points = np.concatenate([points, *extra]) if extra else points
        more = at + np.cumsum(sizes) - sizes
        self.starts, self.ends, self.text = np.r_[starts, more].astype(np.int64), np.r_[ends, more + sizes].astype(np.int64), np.r_[text, np.array(own, np.int64)].astype(np.int64)

    def word(self, i: int) -> str:
        return self.points[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def kinds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and first place of each kind of segment, and the kind of each."""
        return np.unique(T.hash_ranges(self.points, self.starts, self.ends), return_index=True, return_inverse=True)

    def unique(self) -> tuple[np.ndarray, np.ndarray]:
        """A segment of each kind, and the kind of each."""
        return self.kinds()[1:]


def subsequences(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, hash and weight of each occurrence of a subsequence."""
    each = np.maximum(ends - starts - LENGTH + 1, 0)
    string = np.repeat(np.arange(len(starts)), each)
    place = starts[string] + np.arange(len(string)) - np.repeat(np.cumsum(each) - each, each)
    stop = ends[string]
    letters = [points[np.minimum(place + j, len(points) - 1)].astype(U64) for j in range(LENGTH + SKIPS)] if len(string) else []
    strings, hashes, weights = [], [], []
    for chosen in SETS if len(string) else []:
        fits = np.flatnonzero(place + chosen[-1] < stop)
        h = np.zeros(len(fits), U64)
        for j in chosen:
            h *= T.BASE
            h += letters[j][fits] + U64(1)
        strings.append(string[fits])
        hashes.append(T.mix(h))
        weights.append(np.full(len(fits), DECAY ** (chosen[-1] + 1 - LENGTH)))
    if not strings:
        return np.zeros(0, np.intp), np.zeros(0, U64), np.zeros(0)
    return np.concatenate(strings), np.concatenate(hashes), np.concatenate(weights)


def wrapped(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings with a mark at either end, one after another."""
    sizes = ends - starts + 2
    stop = np.cumsum(sizes)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint32)
    string = np.repeat(np.arange(len(starts)), sizes)
    inside = np.arange(len(out)) - (stop - sizes)[string]
    out[:] = points[np.clip(starts[string] + inside - 1, 0, max(len(points) - 1, 0))] if len(out) and len(points) else 0
    out[inside == 0] = 2
    out[inside == sizes[string] - 1] = 3
    return out, stop - sizes, stop


def grouped(string: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences summed by string and subsequence."""
    order = np.lexsort((hashes, string))
    string, hashes, weights = string[order], hashes[order], weights[order]
    if not len(string):
        return string, hashes, weights
    new = np.flatnonzero(np.r_[True, (string[1:] != string[:-1]) | (hashes[1:] != hashes[:-1])])
    return string[new], hashes[new], np.add.reduceat(weights, new)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised subsequence weights of some strings."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    starts = np.r_[0, ends[:-1]] if len(words) else ends
    string, hashes, weights = grouped(*subsequences(*wrapped(points, starts, ends)))
    norm = np.sqrt(np.bincount(string, weights**2, len(words))) if len(string) else np.zeros(len(words))
    return string, hashes, weights / norm[string] if len(string) else weights


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel values of strings with others."""
    sa, ha, wa = features(a)
    sb, hb, wb = features(b)
    known = np.unique(hb)
    dense = np.zeros((len(b), len(known)))
    dense[sb, np.searchsorted(known, hb)] = wb
    out = np.zeros((len(a), len(b)))
    at = np.searchsorted(known, ha)
    hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == ha) if len(known) else np.zeros(len(ha), bool)
    np.add.at(out, sa[hit], wa[hit, None] * dense[:, at[hit]].T)
    return out


def disguised(word: str) -> list[str]:
    """The word with a character inserted, once in its first and once in its second half, and with one doubled."""
    a, b, c = 1 + len(word) // 4, len(word) - 1 - len(word) // 4, len(word) // 2
    return [word[:a] + "x" + word[a:], word[:b] + "q" + word[b:], word[:c] + word[c] + word[c:]]


class Machine:
    """f(segment) = sum of the weights of its subsequences / its norm + bias; score = 1 / (1 + exp(-(slope f + shift)))."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.hashes, self.weights, self.bias, self.slope, self.shift = hashes, weights, bias, slope, shift
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> U64(44)).astype(np.intp)] = True
        self.judged: dict[int, float] = {}

    def kept(self, found: Segments) -> np.ndarray:
        """f of all segments; kinds judged before are looked up."""
        hashes, first, kind = found.kinds()
        keys = hashes.tolist()
        f = np.array([self.judged.get(h, np.nan) for h in keys])
        new = np.flatnonzero(np.isnan(f))
        if len(new):
            f[new] = self.strings(found.points, found.starts[first[new]], found.ends[first[new]])
            if len(self.judged) > KEPT:
                self.judged.clear()
            self.judged.update((keys[i], v) for i, v in zip(new.tolist(), f[new].tolist(), strict=True))
        return f[kind]

    def __getstate__(self):
        return self.hashes, self.weights, self.bias, self.slope, self.shift

    def __setstate__(self, state):
        self.__init__(*state)

    def strings(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.full(len(starts), self.bias)
        string, hashes, weights = subsequences(*wrapped(points, starts, ends))
        maybe = np.flatnonzero(self.seen[(hashes >> U64(44)).astype(np.intp)])
        if not len(maybe) or not len(self.hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[maybe]
        maybe, at = maybe[hit], at[hit]
        total = np.bincount(string[maybe], weights[maybe] * self.weights[at], len(starts))
        touched = np.zeros(len(starts), bool)
        touched[string[maybe]] = True
        own = touched[string]
        s, _, w = grouped(string[own], hashes[own], weights[own])
        norm = np.sqrt(np.bincount(s, w**2, len(starts)))
        out[touched] += total[touched] / norm[touched]
        return out

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str | None]]:
        """The largest f of each text's segments (the bias without any), and that segment."""
        found = Segments(texts)
        best, strongest = np.full(len(texts), self.bias), np.full(len(texts), -1)
        if len(found.starts):
            f = self.kept(found)
            np.maximum.at(best, found.text, f)
            top = np.flatnonzero(f == best[found.text])[::-1]  # the first of equal ones is put last
            strongest[found.text[top]] = top
        return best, [found.word(i) if i >= 0 and f > self.bias else None for i, f in zip(strongest.tolist(), best.tolist(), strict=True)]

    def score(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * f + self.shift, -30, 30)))


def support_vector(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = COST) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss (the last one is the bias), by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, c = x[inside], 2 * cost * weight[inside]
        new = np.linalg.solve(ridge + (xs * c[:, None]).T @ xs, (xs * c[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def fit(words: list[str], y: np.ndarray, weight: np.ndarray, landmarks: list[str]) -> Machine:
    gram = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh(gram)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    w = support_vector(kernel(words, landmarks) @ root, y, weight)
    alpha = root @ w[:-1]
    string, hashes, weights = features(landmarks)
    known, at = np.unique(hashes, return_inverse=True)
    return Machine(known, np.bincount(at, weights * alpha[string], len(known)), float(w[-1]))


def logistic(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of scores from f, by Newton steps with smoothed targets."""
    good, bad = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x, p = np.c_[f, np.ones(len(f))], np.array([2.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (q - target) + 1e-4 * p)
        p = p - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(p[0]), float(p[1])) if p[0] > 0 else (1.0, float(np.log((good + 1) / (bad + 1))))


def held_out():
    """Rows that are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine fitted on at most ``sample`` labelled documents of each class, chosen by a hash of their id.

    What reaches the driver is bounded: counts of ``CANDIDATES`` segments, one or three segments and a value of each sampled document.
    Labels other than 0 and 1, null ids and texts are left out. Without both classes the machine knows no segment and scores all alike.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~F.coalesce(held_out(), F.lit(True))).distinct()
    parts = [known.filter(f"toxic = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # Bounded by twice ``sample`` rows of two numbers.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = written(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample").repartition(16, F.xxhash64("text"))
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not (totals.get(0) and totals.get(1)):
        return Machine(np.zeros(0, U64), np.zeros(0), 0.0, 1.0, 3.0 if totals.get(1) else -3.0)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            found = Segments(batch.column(0).to_pylist())
            if len(found.starts):
                first, kind = found.unique()
                size = found.ends[first] - found.starts[first]
                pairs = np.unique(np.c_[found.text, kind], axis=0)
                pairs = pairs[(size[pairs[:, 1]] >= LENGTH) & (size[pairs[:, 1]] <= 40)]
                word = {k: found.word(first[k]) for k in np.unique(pairs[:, 1]).tolist()}
                yield pa.RecordBatch.from_arrays([pa.array([word[k] for k in pairs[:, 1].tolist()], pa.string()), batch.column(1).take(pa.array(pairs[:, 0]))], ["segment", "toxic"])

    good, bad = totals[1], totals[0]
    odds = F.log((F.col("t") + 0.5) / (good + 1)) - F.log((F.col("c") + 0.5) / (bad + 1))
    counts = rows.mapInArrow(segments, "segment string, toxic int").groupBy("segment").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    top = counts.filter(F.col("t") >= (2 if good > 3 else 1)).withColumn("gain", F.col("t") * odds).filter(odds > 1).orderBy(F.desc("gain"), "segment").limit(CANDIDATES).collect()
    gain = {r.segment: r.gain for r in top}

    def witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The candidates of a toxic text; three segments of a clean one, by hash."""
        for batch in T.chunks(batches):
            out = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Segments([text])
                words = {found.word(i) for i in found.unique()[0]} if len(found.starts) else set()
                words = sorted(w for w in words if LENGTH <= len(w) <= 40)
                if toxic:
                    out.append([w for w in words if w in gain])
                else:
                    salt = np.array([sum(map(ord, w)) * 7919 % 1009 for w in words])
                    out.append([words[i] for i in np.argsort(salt, kind="stable")[:3]])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.list_(pa.string()))], ["toxic", "words"])

    held = rows.mapInArrow(witnesses, "toxic int, words array<string>").collect()
    # A toxic text stands by the candidates that explain most toxic texts, so words of one text's copies lose to those of many.
    positive: dict[str, int] = {}
    for r in held:
        if r.toxic and r.words:
            best = max(gain[w] for w in r.words)
            for w in r.words:
                if gain[w] >= NEAR_BEST * best:
                    positive[w] = positive.get(w, 0) + 1
    negative: dict[str, int] = {}
    for r in held:
        if not r.toxic:
            for w in r.words:
                negative[w] = negative.get(w, 0) + 1
    if not positive:
        return Machine(np.zeros(0, U64), np.zeros(0), 0.0, 1.0, float(np.log(good / bad)))
    landmarks = sorted(positive, key=lambda w: (-positive[w], w))[:LANDMARKS]
    machine = None
    for _ in range(3):
        known = {w: n / sum(positive.values()) for w, n in positive.items()}
        for w, n in list(known.items()):
            for x in disguised(w):
                if x not in negative:
                    known[x] = known.get(x, 0) + n
        words = [*known, *negative]
        y = np.r_[np.ones(len(known)), -np.ones(len(negative))]
        weight = np.r_[np.array([*known.values()]) / sum(known.values()), np.array([*negative.values()], float) / sum(negative.values())]
        machine = fit(words, y, weight * len(words) / 2, landmarks)

        def judge(batches: Iterator[pa.RecordBatch], own: Machine = machine) -> Iterator[pa.RecordBatch]:
            for batch in T.chunks(batches):
                f, word = own.texts(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(f), pa.array(word, pa.string())], ["toxic", "f", "word"])

        judged = rows.mapInArrow(judge, "toxic int, f double, word string").collect()
        # Segments of clean texts that are scored high are learnt from in the next round.
        hard = [r.word for r in judged if not r.toxic and r.word and r.f > -1]
        for w in hard:
            negative[w] = negative.get(w, 0) + 1
    f, y = np.array([r.f for r in judged]), np.array([r.toxic for r in judged])
    # Disguises stand beside the toxic texts, so that the middle of the scores lies below them.
    masked = machine.texts([x for w in positive for x in disguised(w)])[0]
    masked = np.resize(masked, int(0.3 * y.sum()) + 1)
    machine.slope, machine.shift = logistic(np.r_[f, masked], np.r_[y, np.ones(len(masked))])
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from 0.5 on) and the strongest segment (null if nothing speaks for toxicity).

    Null and empty texts have no segment and the score of that. Only texts are looked at. Repeated rows and ids give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in T.chunks(batches):
            f, words = own.texts([t or "" for t in batch.column(1).to_pylist()])
            p = own.score(f)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(words, pa.string())], ["doc_id", "score", "predicted", "strongest"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, strongest string")


def drop_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows and columns of ``docs`` whose text isn't predicted to be toxic; rows with null texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in T.chunks(batches):
            f, _ = own.texts([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array((own.score(f) < 0.5) | ~np.array(batch.column(at).is_valid())))

    return docs.mapInArrow(run, docs.schema)
