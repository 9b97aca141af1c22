import random

from landweave.llm import ngram_join as nj


def brute(rows, words=4, share=85):
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= share * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows)), key=str)


def run(docs, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.ngram_join(docs, **options).collect()), key=str)


def test_matches_brute_force(spark, documents, corpus):
    assert run(documents(corpus)) == brute(corpus)


def test_large_group_of_near_copies_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_BYTES", 2048)
    monkeypatch.setattr(nj, "FEW", 2)
    monkeypatch.setattr(nj, "TRIES", 1)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    want = brute(rows)
    assert run(documents(rows)) == want and 3 < len({r[2] for r in want}) < 50


def test_unlinked_sets_of_a_key_are_no_pairs(spark, documents, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(20):
        words = [f"w{j}" for j in range(150)]
        for at in rng.sample(range(150), 3):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    pairs, verified = [], nj.verified

    def counted(tried, *rest):
        pairs.append(tried.count())
        return verified(tried, *rest)

    monkeypatch.setattr(nj, "verified", counted)
    assert run(documents(rows)) == brute(rows) and sum(pairs) < 100  # all pairs that share a key: 190


def test_sets_of_many_keys_meet_one_hub_first(spark, documents, monkeypatch):
    """Three places with five words each: most keys have 5, 25 or 125 sets, and their hubs differ."""
    rows = []
    for i in range(125):
        words = [f"w{j}" for j in range(150)]
        for k, at in enumerate((30, 75, 120)):
            words[at] = f"x{i // 5**k % 5}"
        rows.append((i, " ".join(words)))
    pairs, verified = [], nj.verified

    def counted(tried, *rest):
        pairs.append(tried.count())
        return verified(tried, *rest)

    monkeypatch.setattr(nj, "verified", counted)
    assert run(documents(rows)) == brute(rows) and len(pairs) == 3 and pairs[0] + pairs[1] < 2 * len(rows)


def test_small_sets_of_all_sizes(spark, documents):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        words = [f"w{j}" for j in range(rng.randrange(3, 30))]
        if rng.random() < 0.7:
            words[rng.randrange(len(words))] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(words)))
    assert run(documents(rows), words=1) == brute(rows, words=1)


def test_empty_table(spark, documents):
    assert run(documents([])) == []


def test_near_copies_of_rows_without_id(spark, documents):
    text = [f"w{i}" for i in range(120)]
    near, far = " ".join([*text[:60], "changed", *text[61:]]), " ".join([*text[:60], "changed", *text[61:110], "again", *text[111:]])
    alone = " ".join(f"v{i}" for i in range(100))
    rows = [(None, " ".join(text)), (5, " ".join(text)), (9, near), (11, far), (None, alone), (None, alone), (20, alone + " more"), (30, "by itself")]
    want = brute(rows)
    assert run(documents(rows)) == want and {(r[0], r[2]) for r in want} == {(None, 5), (5, 5), (9, 5), (11, 5), (None, 20), (20, 20), (30, 30)}
