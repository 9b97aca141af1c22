"""Quality rules on what a text repeats within itself, by suffix arrays of words.

The suffixes of a slice of texts are sorted at once by doubling prefixes; words are told apart by text, so suffixes of two texts never share
any. Ranks of each doubling give the longest common prefixes of neighbours. A place begins a repeat as long as its longer common prefix; the
union of these spans is what the maximal repeats cover. Intervals of common prefixes that aren't continued by one word to the left are the
maximal repeats themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T

# Fixed values of the base rules: least words, the words of a repeated window, and the share of words in such windows that fails.
LEAST_WORDS, BASE_WINDOW, BASE_PERCENT = 50, 3, 50
#: The method's own limits: repeats count from so many words on; they may cover so many percent of the words; one may have so many words.
REPEAT_WORDS, COVERED_PERCENT, LONGEST = 10, 45, 40

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
BREAK = np.zeros(256, bool)
BREAK[10] = True
#: Bytes that begin a character of a word.
LETTER = ~T.SPACES
LETTER[0x80:0xC0] = False


def doubled_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of suffixes by their first 1, 2, 4, ... symbols until all differ; equal ranks mean equal prefixes. Each has one more, -1, at the end.

    Only suffixes that share their rank are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(symbols[order]) != 0])
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.repeat(begins, np.diff(np.r_[begins, n]))
    out, step = [rank], 1
    sizes = np.diff(np.r_[begins, n])
    active = order[np.repeat(sizes > 1, sizes)]
    while len(active):
        own, after = rank[active], rank[np.minimum(active + step, n)]
        order = np.lexsort((after, own))
        active, own, after = active[order], own[order], after[order]
        fresh_group = np.r_[True, np.diff(own) != 0]
        begins = np.flatnonzero(fresh_group | np.r_[True, np.diff(after) != 0])
        sizes = np.diff(np.r_[begins, len(active)])
        group = np.flatnonzero(fresh_group)
        first = np.repeat(group, np.diff(np.r_[group, len(active)]))  # where the old group begins
        rank = rank.copy()
        rank[active] = own + np.repeat(begins, sizes) - first
        out.append(rank)
        active = active[np.repeat(sizes > 1, sizes)]
        step *= 2
    return out


def common_prefixes(symbols: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the longest common prefix of each suffix and the one before it; those known to be less than ``least`` may be 0."""
    ranks = doubled_ranks(symbols)
    suffixes = np.empty(len(symbols), np.int64)
    suffixes[ranks[-1][:-1]] = np.arange(len(symbols))
    lcp = np.zeros(len(symbols), np.int64)
    level = min(len(ranks) - 1, max(least, 1).bit_length() - 1)
    near = np.flatnonzero(ranks[level][suffixes[1:]] == ranks[level][suffixes[:-1]]) + 1  # share 2 ** level symbols, at most ``least``
    a, b, length = suffixes[near], suffixes[near - 1], np.zeros(len(near), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        # A prefix may be as long as twice the longest step and more only if the last ranks were still equal, which they are not.
        same = ranks[j][np.minimum(a + length, len(symbols))] == ranks[j][np.minimum(b + length, len(symbols))]
        length += np.where(same, 1 << j, 0)
    lcp[near] = length
    return suffixes, lcp


def covered(suffixes: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Which places repeats of ``least`` symbols or more cover."""
    longest = np.maximum(lcp, np.r_[lcp[1:], 0])
    over = np.flatnonzero(longest >= least)
    edge = np.zeros(len(suffixes) + 1, np.int64)
    np.add.at(edge, suffixes[over], 1)
    np.add.at(edge, suffixes[over] + longest[over], -1)
    return np.cumsum(edge)[:-1] > 0


def maximal_repeats(symbols: np.ndarray, suffixes: np.ndarray, lcp: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place of the first copy, symbols, copies) of each repeat of ``least`` symbols or more that no symbol on either side continues.

    ``first``: places where texts begin, before which nothing stands.
    """
    before = np.r_[-1, symbols[:-1]]
    before[first[first < len(symbols)]] = -1 - first[first < len(symbols)]
    left = before[suffixes]
    changes = np.cumsum(np.r_[0, left[1:] != left[:-1]])
    out, stack = [], []  # of open intervals: (common prefix, where it begins)
    for k in [*np.flatnonzero(lcp >= least).tolist(), None]:
        if stack and (k is None or k != last + 1):
            out.extend((size, begin, last) for size, begin in stack)
            stack = []
        if k is None:
            break
        begin, size = k - 1, int(lcp[k])
        while stack and stack[-1][0] >= size:
            if stack[-1][0] > size:
                out.append((*stack[-1], last))
            begin = stack.pop()[1]
        stack.append((size, begin))
        last = k
    return [(int(suffixes[a : b + 1].min()), size, b - a + 1) for size, a, b in out if changes[b] != changes[a]]


def measure(data: np.ndarray, offsets: np.ndarray, repeat_words: int = REPEAT_WORDS) -> dict[str, np.ndarray | list]:
    """What the rules look at, for each text."""
    words = T.Words(data, offsets)
    first, doc, n = words.first, words.text_of(), words.counts()
    total = lambda of, at: np.diff(np.r_[0, np.cumsum(of)][at])
    lines = T.Words(data, offsets, BREAK)
    worded = np.r_[0, np.cumsum(~T.SPACES[data])]
    there = worded[lines.ends] > worded[lines.starts]
    keys = np.stack([lines.text_of(), lines.hashes().view(np.int64)])[:, there]
    keys = keys[:, np.lexsort(keys[::-1])]
    again = (np.diff(keys, axis=1) == 0).all(axis=0)
    out = {
        "n_words": n,
        "word_chars": total(LETTER[data], offsets),
        "n_symbols": total(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(keys[0, 1:][again], minlength=len(n)),
    }
    if not len(words):
        zero = np.zeros(len(n), np.int64)
        return out | {"n_repeat_words": zero, "n_covered": zero, "longest_repeat": zero, "repeats": [[] for _ in n]}
    _, kinds = np.unique(words.hashes(), return_inverse=True)
    symbols = doc * (int(kinds.max()) + 1) + kinds
    suffixes, lcp = common_prefixes(symbols, min(BASE_WINDOW, repeat_words))
    longest = np.zeros(len(n), np.int64)
    np.maximum.at(longest, doc[suffixes], lcp)
    found = [[] for _ in n]
    for at, size, copies in sorted(maximal_repeats(symbols, suffixes, lcp, first[:-1], repeat_words)):
        found[doc[at]].append({"start": at - int(first[doc[at]]), "n_words": size, "copies": copies})
    return out | {
        "n_repeat_words": total(covered(suffixes, lcp, BASE_WINDOW), first),
        "n_covered": total(covered(suffixes, lcp, repeat_words), first),
        "longest_repeat": np.where(longest >= min(BASE_WINDOW, repeat_words), longest, 0),
        "repeats": found,
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", repeats array<struct<start: long, n_words: long, copies: long>>, base_failed boolean, kept boolean"


def judge_quality(docs: DataFrame, repeat_words: int = REPEAT_WORDS, covered_percent: int = COVERED_PERCENT, longest: int = LONGEST) -> DataFrame:
    """Per document: counts, ``repeats`` (its maximal repeats of ``repeat_words`` words or more: word of the first copy, words, copies),
    ``base_failed`` and ``kept``.

    Base rules: 50 words or more, at most half of them in three-word windows found again. The method then keeps texts whose repeats cover at
    most ``covered_percent`` percent of the words and have at most ``longest`` words each. Null and empty texts have no words and fail. Repeated
    rows and ids give a row each. Other columns are ignored. Words and lines are told apart by 64-bit hashes within a text. Nothing is shuffled;
    a task holds about half a megabyte of texts, or one text, and its ranks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            m = measure(*T.raw(batch.column(1)), repeat_words)
            n = m["n_words"]
            failed = (n < LEAST_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * n)
            kept = ~failed & (100 * m["n_covered"] <= covered_percent * n) & (m["longest_repeat"] <= longest)
            repeats = pa.array(m["repeats"], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "n_words", "copies")])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(m[c].astype(np.int64)) for c in COUNTS), repeats, pa.array(failed), pa.array(kept)], ["doc_id", *COUNTS, "repeats", "base_failed", "kept"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def quality_sql(repeat_words: int = REPEAT_WORDS, covered_percent: int = COVERED_PERCENT, longest: int = LONGEST) -> str:
    """The same verdicts in DuckDB: a repeat covers what windows found twice cover, and one is too long if a window of one word more is found twice."""
    joined = lambda m: f"array_to_string(list_slice(ws, i, i + {m - 1}), ' ')"
    windows = lambda m: f"SELECT k, i, count(*) OVER (PARTITION BY k, {joined(m)}) AS c FROM (SELECT k, ws, unnest(range(1, len(ws) - {m - 2})) AS i FROM d WHERE len(ws) >= {m})"
    cover = lambda m: f"SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + {m})) AS p FROM ({windows(m)}) WHERE c > 1) GROUP BY 1"
    return (
        r"WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents), "
        rf"l AS (SELECT k, sum(c - 1) AS n FROM (SELECT k, line, count(*) AS c FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2) GROUP BY 1), "
        f"r AS ({cover(BASE_WINDOW)}), c AS ({cover(repeat_words)}), x AS (SELECT DISTINCT k FROM ({windows(longest + 1)}) WHERE c > 1), "
        "m AS (SELECT d.k, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, "
        "CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(c.n, 0) AS n_covered, x.k IS NOT NULL AS too_long FROM d LEFT JOIN l ON l.k = d.k LEFT JOIN r ON r.k = d.k LEFT JOIN c ON c.k = d.k LEFT JOIN x ON x.k = d.k), "
        f"b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM m) "
        f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, base_failed, NOT base_failed AND 100 * n_covered <= {covered_percent} * n_words AND NOT too_long AS kept FROM b"
    )
