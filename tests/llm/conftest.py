import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, archive int, k int, h int, words int"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of (doc_id, text) rows with columns of other names that operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3, 4, 5) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty and long texts, repeated rows, exact and near copies, shared passages and lines."""
    rng = random.Random(5)
    vocabulary = [a + b for a in ("the", "or", "an", "é", "stan", "lo", "vi") for b in ("", "ti", "on", "ble", "êr", "ing", "mo", "za")]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, other = say(70), say(55)
    rows = [(None, say(60)), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three")]
    base = say(300)
    rows += [(6, base), (7, base), (7, base), (8, base + " more"), (9, base.replace(" ", "  ", 3))]
    for i in range(10, 40):
        words = base.split()
        for _ in range(i % 6):
            words[rng.randrange(len(words))] = "changed" + str(rng.randrange(9))
        rows.append((i, " ".join(words) if i % 3 else say(rng.randrange(1, 200)) + " " + passage + "\n" + say(rng.randrange(60)) + " " + other))
    rows += [(40, say(3000)), (41, say(40) + " " + passage), (41, passage + " " + say(30)), (60, say(120)), (61, passage + " " + passage)]
    rng.shuffle(rows)
    return rows
