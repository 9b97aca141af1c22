"""Spelling variant grouping by finite-state composition: the vocabulary's acceptor, a transducer of one edit, and the acceptor again.

Words within one edit of each other agree outside of a window that holds the edit: the first or the last half of the shorter one. So the composed
machine falls apart by initial states, those reached by what stands outside of a window, and each part is composed by itself. In a part, the
minimal acceptor of what stands inside has two initial states, for words of the shorter and of the longer length; states that accept the same
endings are one. Paths that both tapes share are walked once; at each state an arc is replaced by another or one more is taken, and what
both states accept from there on are the pairs. Ranks along paths tell words apart. A part with very many words is cut into smaller windows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import written

# The words that count, and the share of runs that are damaged.
LEAST_CHARS, LEAST_TIMES, DAMAGED = 5, 3, 97
#: A variant's form occurs so many times as often.
RATIO = 2
#: Words of a part beyond which its window is halved. A window of one character holds fewer: about 90 letters once, and twice for the longer word.
MOST = 1 << 14
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 18


def word_counts(docs: DataFrame, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of the runs of Latin letters of all texts, A-Z lower-cased; a null text has none.

    Every run whose crc32 of `doc_id:run` is divisible by ``damaged`` lacks one of its letters (that is how misspellings get into clean corpora);
    a null doc_id is written as nothing. Words of fewer than ``LEAST_CHARS`` code points or ``LEAST_TIMES`` occurrences are left out. Other columns
    are ignored. Counts are added up in tasks before they are shuffled.
    """
    runs = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_CHARS},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        done = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(1))
            data = T.LOWER[data].tobytes()
            for doc, a, b in zip(batch.column(0).to_pylist(), offsets.tolist(), offsets[1:].tolist(), strict=False):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs.findall(data[a:b].decode())).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % damaged == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    held[word] += n
            if len(held) >= HELD:
                yield done()
                held.clear()
        if held:
            yield done()

    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.filter(F.length("word") >= LEAST_CHARS).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def _part(windows: Column, words: DataFrame) -> DataFrame:
    """A row for each word and window: what stands inside (``rest``) and ``outside``. ``size``: code points of the shorter words of the part."""
    rows = words.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*")
    length = F.col("b") - F.col("a") + F.col("longer").cast("int")
    rest, behind = F.substring("word", F.col("a") + 1, length), F.substring("word", F.col("a") + length + 1, F.length("word"))
    return rows.select("size", "a", "b", F.concat(F.substring("word", F.lit(1), F.col("a")), behind).alias("outside"), "longer", rest.alias("rest"), "word", "n")


def _window(size: Column, a: Column, b: Column, longer: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), a.cast("int").alias("a"), b.cast("int").alias("b"), longer.alias("longer"))


PART = ["size", "a", "b", "outside"]


def _halves(least: int) -> Column:
    """The windows of a word, as one of the shorter words and, if it is long enough, as one of the longer."""
    both = lambda size, longer: F.array(_window(size, F.lit(0), F.floor(size / 2), F.lit(longer)), _window(size, F.floor(size / 2), size, F.lit(longer)))
    size = F.length("word")
    return F.when(size > least, F.concat(both(size, False), both(size - 1, True))).otherwise(both(size, False))


def parts(words: DataFrame, most: int = MOST) -> list[DataFrame]:
    """Tables of rows by part, none of which has more than ``most`` words unless its window is one character."""
    out, rows = [], _part(_halves(LEAST_CHARS), words)
    while True:
        large = rows.groupBy(*PART).agg(F.count("*").alias("c")).filter((F.col("c") > most) & (F.col("b") - F.col("a") > 1)).select(*PART)
        large = written(large, "spelling-large-parts")
        if large.isEmpty():
            return [*out, rows]
        out.append(rows.join(large, PART, "left_anti"))
        middle = F.floor((F.col("a") + F.col("b")) / 2)
        windows = F.array(_window(F.col("size"), F.col("a"), middle, F.col("longer")), _window(F.col("size"), middle, F.col("b"), F.col("longer")))
        again = rows.join(large, PART, "left_semi").withColumn("windows", windows).select("word", "n", "windows")
        rows = written(_part(F.col("windows"), again), "spelling-parts")


class Acceptor:
    """Minimal acceptors of sorted lists of words that share their states. ``arcs[s]``: letter to (state, words before it); ``count[s]``: words."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, *arcs)
        if key not in self.known:
            self.known[key] = len(self.arcs)
            before, own = int(final), {}
            for letter, s in arcs:
                own[letter] = (s, before)
                before += self.count[s]
            self.arcs.append(own)
            self.final.append(final)
            self.count.append(before)
        return self.known[key]

    def add(self, words: list[str]) -> int:
        """The initial state of ``words``, sorted and distinct. Endings are closed as soon as no later word can change them."""
        path: list[tuple[list, list]] = [([False], [])]  # open states: whether final, arcs
        last = ""
        for word in [*words, None]:
            shared = 0
            if word is not None:
                top = min(len(last), len(word))
                while shared < top and last[shared] == word[shared]:
                    shared += 1
            while len(path) > shared + 1:
                (final,), arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], self._state(final, arcs)))
            if word is None:
                break
            path.extend(([False], []) for _ in word[shared:])
            path[-1][0][0] = True
            last = word
        return self._state(path[0][0][0], path[0][1])

    def both(self, p: int, q: int, i: int, j: int, unlike: str | None = None) -> Iterator[tuple[int, int]]:
        """Ranks, counted from i and j, of the words that states p and q both accept and that don't begin with ``unlike``."""
        stack = [(p, q, i, j, unlike)]
        while stack:
            p, q, i, j, unlike = stack.pop()
            if p == q and unlike is None:
                yield from ((i + k, j + k) for k in range(self.count[p]))
                continue
            if self.final[p] and self.final[q]:
                yield i, j
            mine, other = self.arcs[p], self.arcs[q]
            for letter in mine if len(mine) < len(other) else other:
                if letter != unlike and letter in mine and letter in other:
                    (s, x), (t, y) = mine[letter], other[letter]
                    stack.append((s, t, i + x, j + y, None))


def near_pairs(short: list[str], long: list[str], at_end: bool = True) -> Iterator[tuple[int, int]]:
    """Places in ``short + long`` of pairs one edit apart: two short words or a short and a long one, once each.

    The lists are sorted and their words of one length each, long ones a letter longer. Of places where a letter could be inserted the last
    counts; behind the last letter only with ``at_end``.
    """
    machine = Acceptor()
    start, n = machine.add(short), len(short)
    if n > 1:
        walk = [(start, 0)]
        while walk:  # what both tapes share
            s, i = walk.pop()
            arcs = list(machine.arcs[s].items())
            for k, (_, (p, x)) in enumerate(arcs):
                walk.append((p, i + x))
                for _, (q, y) in arcs[k + 1 :]:
                    yield from machine.both(p, q, i + x, i + y)
    if n and long:
        walk = [(start, machine.add(long), 0, n)]
        while walk:
            s, t, i, j = walk.pop()
            ended = not machine.arcs[s]
            for letter, (q, y) in machine.arcs[t].items():
                if not ended or at_end:
                    yield from machine.both(s, q, i, j + y, letter)
                if letter in machine.arcs[s]:
                    p, x = machine.arcs[s][letter]
                    walk.append((p, q, i + x, j + y))


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n_near, form, form_n) of words that have near ones: how many, and the one with the largest n (of these the least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def compose(key: tuple, rows: tuple[list, list]) -> None:
            (short, short_n), (long, long_n) = rows
            if not short or len(short) + len(long) < 2:
                return
            size, a, b, outside = key
            rest, n = short + long, short_n + long_n
            near, best = [0] * len(rest), [-1] * len(rest)
            # In a part all words share what stands outside, so those of one length are in the order of their rests.
            for i, j in near_pairs(short, long, b == size):
                for x, y in ((i, j), (j, i)):
                    near[x] += 1
                    if best[x] < 0 or (-n[y], _word(a, outside, rest[y])) < (-n[best[x]], _word(a, outside, rest[best[x]])):
                        best[x] = y
            out.extend((_word(a, outside, rest[i]), near[i], -n[best[i]], _word(a, outside, rest[best[i]])) for i in np.flatnonzero(near).tolist())

        key, rows = None, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *own, longer, rest, n in zip(*columns, strict=True):
                if own != key:
                    if key:
                        compose(key, rows)
                    key, rows = own, (([], []), ([], []))
                rows[longer][0].append(rest)
                rows[longer][1].append(n)
            if len(out) >= 10_000:
                yield _near(out)
                out.clear()
        if key:
            compose(key, rows)
        if out:
            yield _near(out)

    found = None
    for rows in parts(words, most):
        dealt = rows.drop("word").repartition(*PART).sortWithinPartitions(*PART, "longer", "rest")
        near = dealt.mapInArrow(run, "word string, n_near long, m long, form string")
        found = near if found is None else found.unionByName(near)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("m", "form")).alias("x")).select("word", "n_near", F.col("x.form").alias("form"), (-F.col("x.m")).alias("form_n"))


def _word(a: int, outside: str, rest: str) -> str:
    return outside[:a] + rest + outside[a:]


def _near(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["word", "n_near", "m", "form"])


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): where forms lead in the end. Steps double each round; a form is more frequent, so there are no rings."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        now = written(moved, "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def spelling_groups(words: DataFrame, most: int = MOST) -> DataFrame:
    """Per word of (word, n): ``n_near``, how many words are one inserted, deleted or replaced code point away; ``form``, the most frequent of
    these (ties: the least) if it occurs ``RATIO`` times as often, with ``form_n``; ``root``, where forms lead in the end, else the word.

    Words are distinct and not null; those of fewer than ``LEAST_CHARS`` code points have no near words among themselves. An empty table gives no
    rows. A task composes one part at a time, of ``most`` words or of a window of one character.
    """
    near = written(words.join(near_words(words, most), "word", "left"), "spelling-near")
    has = F.col("form_n") >= RATIO * F.col("n")
    judged = near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"))
    roots = follow(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
