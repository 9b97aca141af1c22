"""Licence scan: an Aho-Corasick automaton finds identifier tags and notice phrases, a shunting-yard parser evaluates licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T

# Phrases of the contract and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notice phrases and their labels.
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "cc by nc": "cc-by-nc",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by sa": "cc-by-sa",
    "cc by 4 0": "cc-by-4.0",
    "cc0": "cc0",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
EXPRESSION = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)")

# How much each family restricts reuse, 0 to 1.
RESTRICTS = {
    "public-domain": 0.05, "cc0": 0.05, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "apache": 0.15, "cc-by": 0.2, "mpl": 0.4,
    "cc-by-sa": 0.5, "lgpl": 0.5, "gpl": 0.7, "agpl": 0.8, "cc-by-nc": 0.8, "reserved": 1.0,
}
UNKNOWN = 0.6


def restriction(label: str) -> float:
    """That of the longest family name that the label starts with."""
    known = [k for k in RESTRICTS if label == k or label.startswith(k + "-")]
    return RESTRICTS[max(known, key=len)] if known else UNKNOWN


#: Punctuation that may stand around an identifier.
MARKS = ".,;:!?'\"`*<>[]{}|#/\\-"


def evaluate(expression: str) -> tuple[frozenset[str], float] | None:
    """Labels and restriction of a licence expression; None if it isn't well formed.

    ``and`` binds tighter than ``or``, ``with`` tightest. Both sides of ``and`` bind (the larger restriction), of ``or`` one may choose
    (the smaller), an exception after ``with`` halves what it is attached to.
    """
    binds = {"or": 1, "and": 2, "with": 3}
    values: list[tuple[frozenset[str], float]] = []
    stack: list[str] = []

    def reduce_top() -> bool:
        op = stack.pop()
        if op == "(" or len(values) < 2:
            return False
        (lb, rb), (la, ra) = values.pop(), values.pop()
        values.append((la, ra / 2) if op == "with" else (la | lb, max(ra, rb) if op == "and" else min(ra, rb)))
        return True

    wants_value = True
    for token in re.findall(r"[()]|[^\s()]+", expression.lower()):
        if token == "(":
            if not wants_value:
                return None
            stack.append(token)
        elif token == ")":
            if wants_value:
                return None
            while stack and stack[-1] != "(":
                if not reduce_top():
                    return None
            if not stack:
                return None
            stack.pop()
        elif token in binds:
            if wants_value:
                return None
            while stack and stack[-1] != "(" and binds[stack[-1]] >= binds[token]:
                if not reduce_top():
                    return None
            stack.append(token)
            wants_value = True
        else:
            if not wants_value:
                return None
            label = re.sub(r"-(only|or-later)$|\+$", "", token.strip(MARKS))
            if not label or "," in label:
                return None
            values.append((frozenset([label]), restriction(label)))
            wants_value = False
    while stack:
        if not reduce_top():
            return None
    return values[0] if len(values) == 1 and not wants_value else None


@lru_cache(maxsize=4)
def automaton(base: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases = {p: (True, label) for p, label in base} | {p: (False, label) for p, label in notices if p not in dict(base)} | {TAG: (False, "")}
    for phrase, (is_base, label) in phrases.items():
        found.add_word(f" {phrase} ", (phrase, is_base, label))
    found.make_automaton()
    return found


#: Bytes of words to lower case, all others to a space: words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.
PLAIN = bytes(b if b > 0x7F or chr(b).isdigit() or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def scan_text(data: bytes, find: ahocorasick.Automaton) -> tuple:
    """n_words, places of base phrases as (word, label), and labels with the larger restriction of what binds."""
    words = data.translate(PLAIN).split()
    line = b" " + b" ".join(words) + b" "
    hits = [(end - len(p) - 1, p, is_base, label) for end, (p, is_base, label) in find.iter(line.decode("latin-1"))]
    if not hits:
        return len(words), [], [], [], 0.0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    places = np.searchsorted(gaps, [h[0] for h in hits])
    base = [(int(at), label) for at, (_, _, is_base, label) in zip(places, hits, strict=True) if is_base]
    labels, weight = {label for _, _, _, label in hits if label}, 0.0
    specific = {x for x in labels if any(y != x and y.startswith(x + "-") for y in labels)}
    for label in labels - specific:
        weight = max(weight, restriction(label))
    if any(p == TAG for _, p, _, _ in hits):
        for said in EXPRESSION.findall(data.translate(ASCII_LOWER).decode("utf-8", "replace")):
            if value := evaluate(re.sub(r"[*/#>-]+\s*$", "", said)):
                labels |= value[0]
                weight = max(weight, value[1])
    return len(words), base, sorted({label for _, label in base}), sorted(labels), weight


ASCII_LOWER = bytes(T.LOWER)

SCHEMA = "doc_id long, n_words long, base array<struct<word: long, label: string>>, base_labels array<string>, labels array<string>, score double"


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Per document: ``n_words``, every place of a base phrase, the labels found and ``score``, the restriction of the strictest binding notice.

    A null text is an empty one; without words there are no places, no labels and score 0. Repeated rows and ids give a row each.
    Other columns of ``docs`` are ignored. Nothing is shuffled; a task holds about 2 MB of texts or one document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton(tuple(base.items()), tuple(notices.items()))
        for batch in T.chunks(batches):
            data, offsets = T.raw(batch.column(1))
            data, offsets = data.tobytes(), offsets.tolist()
            got = [scan_text(data[a:b], find) for a, b in zip(offsets, offsets[1:], strict=False)]
            n, places, base_labels, labels, score = zip(*got, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([[{"word": w, "label": x} for w, x in p] for p in places], pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                 pa.array(base_labels, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string())), pa.array(score, pa.float64())],
                ["doc_id", "n_words", "base", "base_labels", "labels", "score"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
