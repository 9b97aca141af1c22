import random

import numpy as np
import pytest

from landweave.llm import toxicity as tx


def brute_kernel(a, b):
    """Subsequences by recursion over all places."""
    from itertools import combinations

    def bag(w):
        w = "\2" + w + "\3"
        out = {}
        for c in combinations(range(len(w)), tx.LENGTH):
            skips = c[-1] - c[0] + 1 - tx.LENGTH
            if skips <= tx.SKIPS:
                key = "".join(w[i] for i in c)
                out[key] = out.get(key, 0) + tx.DECAY**skips
        return out

    x, y = bag(a), bag(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y.get(k, 0) for k, v in x.items()) / norm if norm else 0.0


def test_kernel():
    words = ["idiot", "idxiot", "idioot", "hello", "ab", "abab" * 3, "né", "ééééé"]
    got = tx.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - brute_kernel(a, b)) < 1e-9
    assert got[0, 2] > 0.4 > got[0, 3]


def test_segments():
    found = tx.Segments(["You I-D.i*ot!! x", "a i d i o t b", "", "  é  "])
    got = [(int(t), found.word(i)) for i, t in enumerate(found.text)]
    assert got == [(0, "you"), (0, "idiot"), (0, "x"), (1, "a"), (1, "i"), (1, "d"), (1, "i"), (1, "o"), (1, "t"), (1, "b"), (3, "é"), (1, "aidiotb")]


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rng = random.Random(9)
    syllables = ["the", "or", "an", "stan", "lo", "vi", "ble", "ing", "mo", "za", "er"]
    insults = ["idiot", "moron", "scumbag", "dimwit"]
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words).capitalize()))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (3, 1, None)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_accuracy_and_disguises(spark, documents, labelled):
    docs, labels, rows = labelled
    machine = tx.train(docs, labels)
    got = {r.doc_id: r for r in tx.score(docs, machine).collect()}
    assert np.mean([got[i].predicted == (i % 4 == 0) for i, _ in rows]) > 0.98
    told = {w: float(machine.score(machine.texts([w])[0])[0]) for w in ("you idxiot", "m-o-r-o-n", "s c u m b a g", "dimmwit", "scumqbag", "theor stanlo", "")}
    assert all(v > 0.5 for v in list(told.values())[:5]) and all(v < 0.5 for v in list(told.values())[5:]), told


def test_defined_results(spark, documents, labelled):
    docs, labels, _ = labelled
    machine = tx.train(docs, labels)
    odd = documents([(1, None), (1, ""), (None, "an idiot"), (2, "the " * 50000), (2, "the " * 50000)])
    got = tx.score(odd, machine).collect()
    assert len(got) == 5 and [r.predicted for r in got] == [0, 0, 1, 0, 0] and got[0].score == got[1].score
    kept = tx.drop_toxic(odd, machine)
    assert kept.columns == odd.columns and kept.count() == 4
    for few in (labels.limit(0), labels.filter("toxic = 0")):
        assert tx.score(odd, tx.train(docs, few)).filter("predicted = 0").count() == 5
    assert tx.score(documents([]), tx.train(documents([]), labels)).count() == 0
