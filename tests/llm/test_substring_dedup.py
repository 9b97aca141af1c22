import hashlib
import random

from landweave.llm import substring_dedup as sd


def brute(rows, window):
    starts = {}
    for i, t in rows:
        w = (t or "").split()
        for a in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[a : a + window])
                starts[key] = min(starts.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").split()
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and starts[tuple(w[a : a + window])] < i:
                gone.update(range(a, a + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(documents, rows, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(documents(rows), **options).collect()), key=str)


def test_matches_brute_force(spark, documents, corpus):
    got = run(documents, corpus)
    assert got == brute(corpus, 50)
    assert sum(r[2] for r in got) > 1000


def test_small_windows_and_repeated_words(spark, documents):
    rng = random.Random(3)
    rows = [(rng.randrange(30), " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for _ in range(60)] + [(7, "x " * 30), (9, "x " * 22)]
    assert run(documents, rows, window=12, anchor=4) == brute(rows, 12)


def test_spans_and_empty_table(spark, documents):
    assert sd.remove_repeats(documents([])).count() == 0
    words = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(words)), (2, "a b " + " ".join(words[10:70]) + " c")]
    got = {r.doc_id: r for r in sd.remove_repeats(documents(rows)).collect()}
    assert [(x.start, x.end) for x in got[2].removed] == [(2, 62)] and got[2].kept == "a b c" and not got[1].removed
