import hashlib
from collections import Counter

import numpy as np

from landweave.llm import fingerprints as fp
from landweave.llm import text as T


def expected(rows):
    texts = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in rows})
    return texts


def jaccard(a, b):
    def bag(t):
        w = t.split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    x, y = bag(a), bag(b)
    top = sum((x | y).values())
    return sum((x & y).values()) / top if top else 1.0


def test_with_edits_matches_brute_force(spark, documents, corpus):
    rows = [r for r in corpus if r[0] != 41]  # ids with different texts are ordered by their hash: tested below
    got = fp.with_edits(documents(rows)).collect()
    assert len(got) == len(rows)
    order = sorted({(-(1 << 63) if i is None else i) for i, _ in rows}, reverse=True)
    text = {(-(1 << 63) if i is None else i): t or "" for i, t in rows}
    far = []
    for r in got:
        key = -(1 << 63) if r.doc_id is None else r.doc_id
        if r.doc_id is None or order[order.index(key) - len(order) + 1] == -(1 << 63):
            continue  # two texts have no id
        own, then = text[key], text[order[(order.index(key) + 1) % len(order)]]
        k = len(own) // 2
        edited = own[: len(own) - k] + then[:k]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        far += [r.near_edited - jaccard(own, edited), r.near_next - jaccard(own, then)]
    assert np.abs(far).max() < 0.25 and abs(np.mean(far)) < 0.03


def test_equal_texts_equal_fingerprints_and_plain_operator(spark, documents, corpus):
    rows = fp.with_edits(documents(corpus)).collect()
    assert len(rows) == len(corpus)
    by_text = {}
    for r in fp.fingerprint(documents(corpus)).collect():
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    for r in rows:
        assert r.fingerprint in by_text[(r.doc_id, r.n_chars)]
    six, seven = ({r.fingerprint for r in rows if r.doc_id == i} for i in (6, 7))
    assert six == seven and len(six) == 1


def test_lone_and_empty(spark, documents):
    assert fp.with_edits(documents([])).count() == 0
    lone = fp.with_edits(documents([(3, "abcd")])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and lone.near_next == 1.0


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(1)
    far = []
    for _ in range(60):
        n = 80
        terms = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        a, b = rng.integers(0, 6, n), rng.integers(0, 6, n)
        signs = [fp.signatures(terms[w > 0], w[w > 0], np.array([0, (w > 0).sum()]))[0] for w in (a, b)]
        far.append(fp.likeness(*signs) - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(far)) < 0.03 and np.std(far) < 0.1


def test_ids_far_apart_and_wrap(spark):
    ids = [(-5, 0, 1), (0, 0, 2), (1023, 0, 3), (1024, 0, 4), (1 << 20, 0, 5), (1 << 40, 0, 6), ((1 << 62), 1, 7), ((1 << 62), 2, 8)]
    got = {(r.k, r.h): r.own.n for r in fp.successors(spark.createDataFrame(ids, "k long, h long, n long")).collect()}
    assert got == {(k, h): ids[(i + 1) % len(ids)][2] for i, (k, h, _) in enumerate(ids)}


def test_words_of_batches():
    import pyarrow as pa

    texts = ["a bb  ccc\n", "", "dd a", "été bb a", None, " ", "x"]
    data, offsets = T.raw(pa.array(texts))
    words = T.Words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)] == [w for t in texts for w in (t or "").split()]
    assert words.counts().tolist() == [len((t or "").split()) for t in texts]
