import pytest

from landweave.llm import sentencepiece as sp


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load_pieces()


def brute(vocabulary, text):
    """The largest sum of scores over all ways to cut a text, without automaton or units."""
    score = {p: s for p, _, s in vocabulary["pieces"]}
    unknown = min(score.values()) - sp.UNKNOWN
    longest = max(map(len, score))
    marked = sp.SPACE + text.replace(" ", sp.SPACE)
    best = [0.0] + [-1e300] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + unknown
        for start in range(max(0, end - longest), end):
            if (s := score.get(marked[start:end])) is not None:
                best[end] = max(best[end], best[start] + s)
    return best[-1]


TEXTS = ["Hello world", "  two  spaces   here ", "naïve café\nnew\n\nline", "日本語 and \U0001f600!", "a", " ", "\n", "xyzzy" * 30, "tab\tand\rreturn", "1234 + 5.6"]


def test_best_score_and_round_trip(vocabulary):
    own = sp.Codec(vocabulary)
    score = {i: s for _, i, s in vocabulary["pieces"]}
    unknown = min(score.values()) - sp.UNKNOWN
    for text in TEXTS:
        ids = own.encode(text)
        assert own.decode(ids) == text
        in_bytes = b"".join(own.surface[i] for i in ids if i not in score).decode()
        assert abs(sum(score[i] for i in ids if i in score) + unknown * len(in_bytes) - brute(vocabulary, text)) < 1e-6


def test_ids_that_no_text_gave(vocabulary):
    own = sp.Codec(vocabulary)
    ids = {p: i for p, i, _ in vocabulary["pieces"]}
    assert own.decode([ids["a"]]) == "a" and own.decode([ids[sp.SPACE + "a"], ids["a"]]) == "aa" and own.decode([]) == ""
    with pytest.raises(KeyError):
        own.decode([10**9])
    with pytest.raises(ValueError, match="utf-8"):
        own.decode([own.in_bytes[0xFF]])


def test_mark_in_text(vocabulary):
    own = sp.Codec(vocabulary)
    for text in ("▁", "a▁ b▁▁", " ▁\n▁"):
        assert own.decode(own.encode(text)) == text


def test_queries_of_tables(spark, documents, corpus):
    rows = corpus + list(enumerate(TEXTS, 1000)) + [(2000, "word " * 30000)]
    out = sp.encode(documents(rows))
    got = out.collect()
    assert len(got) == len(rows) and all(r.restored and r.n_tokens == len(r.token_ids) for r in got)
    back = sorted(((r.doc_id, r.text) for r in sp.decode(out).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in rows), key=str)
    assert sp.encode(documents([])).count() == 0
