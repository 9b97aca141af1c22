import random
import re

from landweave.llm import licenses as li

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def brute(text):
    """Places of the base phrases by comparing words one by one."""
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in li.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def scanned(documents, texts):
    rows = li.scan_licenses(documents([(i, t) for i, t in enumerate(texts)])).collect()
    return [r for r in sorted(rows, key=lambda r: r.doc_id)]


def test_base_places_match_brute_force(documents):
    rng = random.Random(4)
    parts = ["CC", "by", "cc-by", "General", "public", "license", "all", "rights", "reserved.", "nc", "é", "gnu", ",", "\n", "CC BY-NC", "all rights  reserved"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [None, "", " \t", "cc by", "ccby", "cc by cc by", "x" * 100_000 + " CC BY", "cc_by", "all rights reserved" * 3]
    got = scanned(documents, texts)
    assert [(r.n_words, sorted((b.word, b.label) for b in r.base)) for r in got] == [brute(t) for t in texts]
    assert all(r.base_labels == sorted({b.label for b in r.base}) and set(r.base_labels) <= set(r.labels) for r in got)


def test_labels_of_expressions(documents):
    say = "SPDX-License-Identifier: "
    texts = [say + "MIT,", say + "(MIT OR Apache-2.0) AND GPL-2.0-only.", say + "GPL-2.0+ WITH Classpath-exception-2.0 */", say + "MIT AND", say + "mit,isc", say + "'ISC'"]
    got = scanned(documents, texts)
    assert [r.labels for r in got] == [["mit"], ["apache-2.0", "gpl-2.0", "mit"], ["gpl-2.0"], [], [], ["isc"]]
    assert [round(r.score, 3) for r in got] == [0.1, 0.7, 0.35, 0, 0, 0.1]
    assert not any("," in x for r in got for x in r.labels)


def test_precedence_and_brackets():
    assert li.evaluate("mit or gpl and agpl") == (frozenset({"mit", "gpl", "agpl"}), 0.1)
    assert li.evaluate("(mit or gpl) and agpl")[1] == 0.8
    assert li.evaluate("((mit)") is None and li.evaluate("") is None and li.evaluate("mit gpl") is None


def test_repeated_rows_and_empty_table(documents):
    assert len(li.scan_licenses(documents([(1, "cc by"), (1, "cc by"), (None, "mit license")])).collect()) == 3
    assert li.scan_licenses(documents([])).collect() == []
