import hashlib
import itertools
import random
import re
import zlib

from landweave.llm import conversation_repair as cr
from landweave.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, h int, audit string, k int"


def brute(turns):
    """(cost, audit, repaired) of turns (role, text, fault) by trying all edits, place by place; the least cost, then the least audit."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    roles = {"u": "user", "a": "assistant"}

    def inserted(state):
        out = list(state)
        for _ in range(2):  # more than two inserted turns side by side never pay
            out += [(c + 3, a + "I", said + ((roles[r], ""),)) for c, a, said in out[:] for r in legal[said[-1][0][0] if said else ""] if r in "ua"]
        return out

    state = [(0, "", ())]
    for role, text, fault in turns:
        after = []
        for c, a, said in inserted(state):
            after.append((c + 4, a + "D", said))
            more = 3 * (fault == "truncated")
            if fault not in ("blank", "duplicate"):
                for r in legal[said[-1][0][0] if said else ""]:
                    if r == role[:1]:
                        after.append((c + more, a + "K", said + ((role, text),)))
                    if r in "ua":
                        after.append((c + 3 + more, a + "R", said + ((roles[r], text),)))
        # what is cheapest so far isn't all that counts, so everything within reach of the best stays
        low = min(x[0] for x in after)
        state = sorted({x for x in after if x[0] <= low + 12})
    done = [x for x in inserted(state) if not x[2] or x[2][-1][0][0] == "a"]
    cost = min(x[0] for x in done)
    return min((x for x in done if x[0] == cost), key=lambda x: x[1])


def expected(rows):
    ids = {r[0] for r in rows}
    turns = {i: [] for i in ids}
    for i, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            turns[i] += [(t, "user" if k == 4 else role, text)] * (1 + (k == 3))
    out = []
    for i, own in turns.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        seen, marked = set(), []
        for _, role, text in own:
            inner = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = {t for t, _, _ in own if t is not None}
        cost, audit, said = brute(marked)
        faults = [m[2] for m in marked]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.append((i, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(rng, n):
    rows = []
    for i in range(n):
        for t in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "utterer"])
            rows.append((i, rng.choice([t, t, t, t + 10 * (i % 3), None if t == 0 else t]), role, rng.choice(["Yes.", "Well then!", "No end", "", " \t", None, "Really? \n", f"Number {t}."])))
    rows = list({(i, t): (i, t, r, x) for i, t, r, x in rows}.values())  # one turn a number; ties have a test of their own
    rows += [(None, 1, "user", "Alone."), (None, None, "assistant", "First."), (10**6, 0, "user", "A."), (10**6, 0, "user", "A."), (10**6, 1, "assistant", "B.")]
    rng.shuffle(rows)
    return rows


def test_query_matches_brute_force(spark, tmp_path):
    rows = conversations(random.Random(11), 400)
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert got.columns == columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_search_matches_dynamic_programme():
    """Long and short codes: least cost and least audit by suffixes, over the whole lattice."""
    rng = random.Random(3)
    for n in [*range(9), 40, 300]:
        for _ in range(60 if n < 50 else 3):
            codes = bytes(rng.choice([8, 12, 8, 12, 4, 0, *range(16)]) for _ in range(n))
            rest = {4 * n + e: (0, "") for e in cr.GOALS}
            for place in range(n, -1, -1):
                for _ in range(4):  # insertions move within a place
                    for end in range(4):
                        node = 4 * place + end
                        tries = [(c + rest[v][0], x + rest[v][1]) for v, c, x in cr._edges(codes, node, 0) if v in rest]
                        if tries:
                            rest[node] = min([*tries, *([rest[node]] if node in rest else [])])
            assert cr.search(codes) == rest[0]


def test_repaired_turns_and_ties(spark):
    rows = [(1, 0, "user", "Hi.", 0, "", 0), (1, 1, "user", "Again.", 0, "", 0), (1, 2, "assistant", "Done.", 0, "", 0), (2, 5, "assistant", "B.", 0, "", 0), (2, 5, "assistant", "A.", 0, "", 0), (2, 5, "user", "Q.", 0, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = cr.repairs(df)
    turns = sorted(tuple(r) for r in cr.repaired_turns(df, found).collect())
    assert [t[1:] for t in turns if t[0] == 1] == [(0, "K", 0, "user", "Hi."), (1, "I", None, "assistant", ""), (2, "K", 1, "user", "Again."), (3, "K", 2, "assistant", "Done.")]
    # turns of one number go by role, so the question comes last and one answer of two is re-roled
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {1: (3, "KIKK"), 2: (6, "RKKI")}
    assert cr.repairs(df.limit(0)).count() == 0 and cr.repair_report(df.limit(0), df.limit(0)).count() == 0


def test_long_conversation(spark):
    n = 20_000
    df = spark.range(n).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "if(id = 777, '', concat('Turn ', id, '.')) text")
    r = cr.repairs(df).first()
    assert (r.n_turns, r.blank, r.cost) == (n, 1, 7) and len(r.audit) == n + 1 and r.audit.count("D") == 1
