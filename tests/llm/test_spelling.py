import random
import re
import zlib
from collections import Counter

import pytest

from landweave.llm import spelling as sp
from landweave.llm.queries import QUERIES


def brute_counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if is_near(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out)


def texts(rng, n):
    base = ["".join(rng.choice("abcdeéÿ×") for _ in range(rng.randrange(3, 9))) for _ in range(120)] + ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "bababab"]

    def said():
        w = list(rng.choice(base[: rng.choice([5, 30, len(base)])]))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w[i : i + rng.choice([0, 1])] = rng.choice(["", "a", "B", "É", "z"])
        return "".join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in w)

    rows = [(i, "".join(said() + rng.choice([" ", ", ", "\n", "1", "Ā", "'"]) for _ in range(rng.randrange(60)))) for i in range(n)]
    chain = "chainxx " * 40 + "chainxy " * 16 + "chainzy " * 6 + "chainzw " * 3
    return [*rows, (n + 2, chain), (None, " ".join(said() for _ in range(50))), (n, None), (n, ""), (n + 1, ("Longest" * 300 + " ") * 4 + ("Longest" * 299 + "Longesst ") * 9)]


@pytest.mark.parametrize("most", [sp.MOST, 3])
def test_matches_brute_force(spark, documents, tmp_path, most):
    rows = texts(random.Random(6), 250)
    want = brute(brute_counts(rows))
    assert len(want) > 200 and sum(r[1] is not None for r in want) > 30 and any(r[2] not in (r[0], r[1]) for r in want)
    documents(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_spelling_variants"](spark, str(tmp_path)) if most == sp.MOST else sp.spelling_groups(sp.word_counts(documents(rows)), most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_composition_finds_each_pair_once():
    rng = random.Random(1)
    for size in range(1, 6):
        for letters in ("a", "ab", "abc"):
            make = lambda k: sorted({"".join(rng.choice(letters) for _ in range(k)) for _ in range(rng.randrange(40))})  # noqa: E731, B023
            short, long = make(size), make(size + 1)
            both = short + long
            got = sorted(tuple(sorted(p)) for p in sp.near_pairs(short, long))
            assert got == [(i, j) for i in range(len(short)) for j in range(i + 1, len(both)) if is_near(both[i], both[j])]


def test_acceptor_is_minimal():
    machine = sp.Acceptor()
    start = machine.add(sorted(a + b + "ing" for a in "pqr" for b in "xyz"))
    assert machine.count[start] == 9 and len(machine.arcs) == 6


def test_empty(spark, documents):
    assert sp.spelling_groups(sp.word_counts(documents([(1, None), (2, "few words")]))).count() == 0
