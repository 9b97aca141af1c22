import random

from landweave.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, least):
    places = sorted({(ld.LAST if i is None else i, t) for i, t in rows if t is not None})
    lines = [(k, n, x) for k, t in places for n, x in enumerate(t.split("\n")) if len(x) >= least]
    gone = {(k, n) for j, (k, n, x) in enumerate(lines) if any(abs(len(x) - len(y)) < 2 and (x == y or distance(x, y) < 2) for _, _, y in lines[:j])}
    out = []
    for i, t in rows:
        k = ld.LAST if i is None else i
        own = [] if t is None else t.split("\n")
        drop = [n for n in range(len(own)) if (k, n) in gone]
        out.append((i, None if t is None else "\n".join(x for n, x in enumerate(own) if n not in drop), len(own), drop))
    return sorted(out, key=str)


def run(docs, **options):
    return sorted(((r.doc_id, r.text, r.n_lines, r.removed_lines) for r in ld.line_dedup(docs, **options).collect()), key=str)


def table():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(18, 60))) for _ in range(12)] + ["a" * 30, "a" * 31, "é" * 25]
    rows = [(None, base[0]), (1, None), (2, ""), (3, "\n\n"), (4, "short"), (5, "short")]
    for i in range(6, 60):
        lines = []
        for _ in range(rng.randrange(6)):
            x = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                p = rng.randrange(len(x))
                x[p : p + rng.randrange(2)] = rng.choice(["", "z", "y"])
            lines.append("".join(x))
        rows.append((i, "\n".join(lines)))
    return rows + [rows[10], rows[10]]


def test_matches_brute_force(spark, documents):
    rows = table()
    want = brute(rows, 20)
    assert run(documents(rows)) == want and sum(len(r[3]) for r in want) > 60


def test_small_lengths_and_columns(spark, documents):
    rows = [(i, "\n".join(x)) for i, x in enumerate([["aab", "acb"], ["ab", "abc"], ["b", "xyz"], ["xz", "zz"], ["zzz"]])]
    assert run(documents(rows), least=2) == brute(rows, 2)
    assert ld.line_dedup(documents(rows)).columns == [*documents(rows).columns, "n_lines", "removed_lines"]


def test_names_of_added_columns(spark, documents):
    from pyspark.sql import functions as F

    docs = documents([(1, "a" * 30 + "\nb"), (2, "a" * 30)]).withColumns({"n_lines": F.lit("own"), "removed_lines": F.lit(7)})
    assert {r.doc_id: (r.n_lines, r.removed_lines) for r in ld.line_dedup(docs).collect()} == {1: (2, []), 2: (1, [0])}
    got = {r.doc_id: (r.n_lines, r.removed_lines, r.n, r.gone) for r in ld.line_dedup(docs, added=("n", "gone")).collect()}
    assert got == {1: ("own", 7, 2, []), 2: ("own", 7, 1, [0])}


def test_empty_table(spark, documents):
    assert run(documents([])) == []


def test_exact_repeats_of_short_lines(spark, documents):
    rows = [(1, "short\nshirt\n \n\na"), (2, "short\n \n\na\néé"), (3, "éé\nx" + "y" * 30), (4, "z" + "y" * 30 + "\n" + " " * 25), (5, " " * 25), (None, "shirt"), (6, None)]
    got = {r.doc_id: r.removed_lines for r in ld.line_dedup(documents(rows), exact=1).collect()}
    # One edit is no evidence for short lines; blank ones stay unless they have ``least`` characters.
    assert got == {1: [], 2: [0, 3], 3: [0], 4: [0], 5: [0], None: [0], 6: []}


def test_query_and_stage_take_short_lines(spark, documents, tmp_path):
    import corpus_pipeline
    from landweave.llm import queries

    docs = documents([(1, "Ietzte.\none"), (2, "Ietzte.\ntwo")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.removed_lines for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()} == {1: [], 2: [0]}
    assert {r.doc_id: r.text for r in corpus_pipeline.line_dedup_stage(spark, docs, str(tmp_path)).collect()} == {1: "Ietzte.\none", 2: "two"}
