import random
import re
from collections import Counter

import duckdb
import numpy as np

from landweave.llm import quality_rules as qr
from landweave.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "base_failed", "kept"]


def covered(w, m):
    seen = Counter(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    return len({p for i in range(len(w) - m + 1) if seen[tuple(w[i : i + m])] > 1 for p in range(i, i + m)})


def brute(rows, m=qr.REPEAT_WORDS, percent=qr.COVERED_PERCENT, longest=qr.LONGEST):
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        repeat, cover = covered(w, 3), covered(w, m)
        failed = len(w) < 50 or 100 * repeat > 50 * len(w)
        kept = not failed and 100 * cover <= percent * len(w) and not covered(w, longest + 1)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat, cover, failed, kept))
    return sorted(out, key=str)


def texts(rng, corpus):
    vocabulary = ["a", "b", "été", "<tag>", "#x", "word", "*"]
    rows = list(corpus)
    for i in range(100, 160):
        words = [rng.choice(vocabulary[: 2 + i % 6]) if i % 2 else f"w{rng.randrange(500)}" for _ in range(rng.randrange(200))]
        if i % 4 == 0 and len(words) > 90:
            words[60:60] = words[5 : 5 + rng.choice([9, 10, 40, 41, 55])]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", "\t", "\r\n", " \v"]) for w in words)))
    rows += [(200, "x " * 3000), (201, "\n\n \n\n"), (202, "one line\none line\n one line\none line"), (203, " ".join(f"u{j}" for j in range(4000)))]
    return rows


def test_matches_brute_force_and_sql(spark, documents, corpus, tmp_path):
    rows = texts(random.Random(4), corpus)
    documents(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_quality_rules"](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(COLUMNS)
    got = sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert {r[-1] for r in got} == {True, False} and any(not r[-2] and not r[-1] for r in got)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op13_quality_rules']})").fetchall(), key=str) == want


def test_suffix_array_and_common_prefixes():
    rng = random.Random(8)
    for n in (1, 2, 7, 60, 200):
        for kinds in (1, 2, 5, 50):
            s = [rng.randrange(kinds) for _ in range(n)]
            suffixes, lcp = qr.common_prefixes(np.array(s))
            want = sorted(range(n), key=lambda i: s[i:])
            assert suffixes.tolist() == want
            same = lambda a, b: next((k for k in range(n) if max(a, b) + k >= n or s[a + k] != s[b + k]), n)
            assert lcp.tolist() == [0] + [same(a, b) for a, b in zip(want, want[1:], strict=False)]


def maximal(w, least):
    """Repeats that no word on either side continues, by trying all."""
    out = []
    for size in range(least, len(w)):
        places = {}
        for i in range(len(w) - size + 1):
            places.setdefault(tuple(w[i : i + size]), []).append(i)
        for at in places.values():
            left = {w[i - 1] if i else None for i in at}
            right = {w[i + size] if i + size < len(w) else None for i in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                out.append((at[0], size, len(at)))
    return sorted(out)


def test_maximal_repeats(spark, documents):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc"[: 2 + i % 2]) for _ in range(rng.randrange(40)))) for i in range(40)]
    for r in qr.judge_quality(documents(rows), repeat_words=4).collect():
        assert [(x.start, x.n_words, x.copies) for x in r.repeats] == maximal(dict(rows)[r.doc_id].split(), 4)
    assert qr.judge_quality(documents([])).count() == 0
