import random

from landweave.llm import decontamination as dc

ITEM = "Yesterday in town Alice bought 12 apples for 30 dollars and gave 12 apples to Bob before lunch so how many were left"
PLAIN = "the quick brown fox jumps over the lazy dog while seven grey wolves watch from under old trees near water"
BENCH = [(1, ITEM), (2, PLAIN), (3, "too short"), (4, None), (5, "")]


def run(spark, documents, rows, bench=BENCH, **options):
    got = dc.report(documents(rows), spark.createDataFrame(bench, "item_id long, text string"), **options).collect()
    assert len(got) == len(rows)
    return {r.doc_id: r.items for r in got}


def test_passages_and_other_parameters(spark, documents):
    other = ITEM.replace("Alice", "Carla").replace("Bob", "Dan").replace("12", "7").replace("30", "45")
    mixed = ITEM.replace("Alice", "Carla").replace("Bob", "Dan").replace("12 apples for", "7 apples for").replace("30", "45")
    rows = [
        (10, "intro words here, " + PLAIN + " and more"), (11, "(" + PLAIN.upper() + ")!"), (12, "some text. " + other + "?"), (13, "some text. " + mixed),
        (14, PLAIN[: len(PLAIN) // 3]), (15, None), (16, ""), (17, "Too\n short"), (20, "it is too short"), (None, PLAIN), (18, PLAIN + "\n" + other), (19, " ".join(reversed(PLAIN.split()))),
    ]
    assert run(spark, documents, rows) == {10: [2], 11: [2], 12: [1], 13: [], 14: [], 15: [], 16: [], 17: [3], 20: [], None: [2], 18: [1, 2], 19: []}


def test_against_brute_force_windows(spark, documents, corpus):
    bench = [(i, " ".join((t or "").split()[3:30])) for i, t in corpus if t and len(t.split()) > 60][:6]
    rows = [r for r in corpus if r[0] != 41]

    def words(t):
        return t.lower().split()

    def expect(t):
        w, found = words(t or ""), []
        for item, b in bench:
            x = words(b)
            if any(w[i : i + 13] == x[j : j + 13] for i in range(len(w) - 12) for j in range(len(x) - 12)):
                found.append(item)
        return sorted(found)

    got = dc.report(documents(rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = sorted(((i, expect(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.items) for r in got), key=str) == want and sum(bool(x) for _, x in want) > 3


def test_stage_keeps_columns_and_rows(spark, documents):
    docs = documents([(1, PLAIN), (1, "clean"), (2, None), (3, "clean"), (3, "clean")])
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "clean"), (3, "clean"), (3, "clean")]
    assert kept.count() == 4 and dc.decontaminate(docs, bench.limit(0)).count() == 5 and dc.report(docs.limit(0), bench).count() == 0


def test_shuffled_benchmark(spark, documents, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    assert run(spark, documents, [(1, PLAIN), (2, "x " * 40)]) == {1: [2], 2: []}


def test_long_lists_of_numbers(spark, documents):
    rng = random.Random(1)
    say = lambda n: " ".join(str(rng.randrange(1000)) for _ in range(n))
    items = [(i, say(20)) for i in range(8)]
    renamed = dict(zip(items[4][1].split(), map(str, range(5000, 5020))))
    rows = [(1, say(2000)), (2, "so " + say(700) + " " + items[3][1] + " " + say(300)), (3, " ".join(renamed[x] for x in items[4][1].split())), (4, "0 " * 1500)]
    want = {i: sorted(item for item, b in items if brute(t, b)) for i, t in rows}
    assert run(spark, documents, rows, bench=items) == want and 3 in want[2] and 4 in want[3] and not want[4]


def brute(text, item, run=13):
    """Whether ``run`` words of an item of plain numbers stand in the text with one value for each, somewhere."""
    w, x = text.split(), item.split()
    w = [v if v.isdigit() else None for v in w]
    for i in range(len(w) - run + 1):
        for j in range(len(x) - run + 1):
            pairs = set(zip(x[j : j + run], w[i : i + run], strict=True))
            if None not in {b for _, b in pairs} and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
                # A run is as long as placeholders fit: the whole stretch is one, and has to be consistent.
                a, b = j, i
                while a and b and w[b - 1]:
                    a, b = a - 1, b - 1
                end = 0
                while a + end < len(x) and b + end < len(w) and w[b + end]:
                    end += 1
                pairs = set(zip(x[a : a + end], w[b : b + end], strict=True))
                if len({p for p, _ in pairs}) == len({q for _, q in pairs}) == len(pairs):
                    return True
    return False


def test_fillers_do_not_shift(spark, documents):
    # Each of these words once gave a placeholder without a filler, or a filler without a placeholder.
    starts = ["It costs 5 USD and 10 EUR. ", "It weighs 3 KG. ", "We had Covid19 here. ", "Take B12 days on end. ", "She read <num> and <name> there. "]
    rows = [(i, start + ITEM) for i, start in enumerate(starts)]
    wrong = ITEM.replace("12 apples for", "7 apples for").replace("Alice", "Carla").replace("30", "45").replace("Bob", "Dan")
    rows += [(10 + i, start + wrong) for i, start in enumerate(starts)]
    assert run(spark, documents, rows) == {i: [1] if i < 10 else [] for i, _ in rows}


def test_units_in_capitals_of_an_item(spark, documents):
    item = "we paid 5 USD and 10 EUR for 3 KG of flour while 5 USD was what the old shop asked"
    rows = [(1, item), (2, item.replace("5", "8").replace("10", "40")), (3, item.replace("5", "8", 1).replace("10", "40").replace("3", "6"))]
    assert run(spark, documents, rows, bench=[(1, item)]) == {1: [1], 2: [1], 3: []}


def test_exact_copies_whatever_capitals_and_layout(spark, documents):
    copies = [ITEM.lower(), ITEM.upper(), ITEM.title(), ITEM.replace(" Alice", "\nAlice").replace(" Bob", "  Bob"), ITEM.replace("Alice", "(Alice)").replace("Bob", '"Bob"'), ITEM.replace(" ", "\r\n\t"), ITEM.replace(" ", "\u00a0")]
    changed = ITEM.replace("Alice", "Carla").replace("12", "7").replace(" Carla", "\nCarla").replace("Bob", "(Dan)")
    rows = [(i, "Before it. " + t + " After it.") for i, t in enumerate([*copies, changed])] + [(20, ITEM.lower().replace("alice", "carla").replace("12", "7", 1).replace("30", "45").replace("bob", "dan"))]
    assert run(spark, documents, rows) == {i: [] if i == 20 else [1] for i, _ in rows}


def test_short_items_and_every_place(spark, documents):
    item = "one two three four five six seven eight nine"
    rows = [(i, "x " * i + item + " y" * 9) for i in range(14)] + [(20, item[:-5]), (21, item.upper())]
    assert run(spark, documents, rows, bench=[(1, item), (2, PLAIN)]) == {i: [] if i == 20 else [1] for i, _ in rows}
    rows = [(i, "x " * i + " ".join(PLAIN.split()[4:17]) + " y" * 9) for i in range(14)] + [(20, " ".join(PLAIN.split()[4:16]))]
    assert run(spark, documents, rows) == {i: [] if i == 20 else [2] for i, _ in rows}
