"""Conversation structure repair: the cheapest edits that give a conversation the roles `(s?(ua)+)?`, by a bidirectional Dijkstra search.

A node of the edit lattice is a place between turns and what the roles kept so far end with. Edits are its edges: Keep, Rerole, Delete and Insert.
A heap from the start and one from the goals settle nodes until their tops add up to more than the best meeting, so every crossing of that cost
is settled from both sides. The least audit is then read off: from the start on, always the smallest letter that stays on a cheapest path.

Turns travel once as codes of a byte (role initial and fault) and once as texts, each time sorted by conversation. A task holds the codes of one
conversation, as many bytes as its audit has, and never its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\f\r"

#: What the roles end with: nothing, s, u or a. NEXT: after an inserted or re-roled turn (its role is forced). GOALS may end a conversation.
NEXT, GOALS, FORCED = (2, 2, 3, 2), (0, 3), (None, None, "user", "assistant")
#: After a kept turn, by its initial (1: s, 2: u, 3: a; 0: any other).
KEPT = {1: {0: 1}, 2: {0: 2, 1: 2, 3: 2}, 3: {2: 3}}
FINE, CUT, BLANK, DUPLICATE = range(4)
#: As many codes as are worth remembering.
SHORT = 64


def _moves(code: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letter) of the edits of a turn."""
    who, fault = code >> 2, code & 3
    out = [(s, s, DELETE, "D") for s in range(4)]
    if fault in (FINE, CUT):
        more = TRUNCATED * (fault == CUT)
        out += [(s, NEXT[s], REROLE + more, "R") for s in range(4)] + [(s, t, more, "K") for s, t in KEPT.get(who, {}).items()]
    return out


def _tables(moves: list[tuple[int, int, int, str]]) -> tuple[list, list]:
    ahead, behind = [[] for _ in range(4)], [[] for _ in range(4)]
    for s, t, cost, letter in moves:
        ahead[s].append((t, cost, letter))
        behind[t].append((s, cost, letter))
    return ahead, behind


TURN = [_tables(_moves(code)) for code in range(16)]
ADDED = _tables([(s, NEXT[s], INSERT, "I") for s in range(4)])


def _edges(codes: bytes, node: int, back: int) -> Iterator[tuple[int, int, str]]:
    """(node, cost, letter) of the edges from a node, or to it (``back``). A node is 4 * place + end."""
    place, end = node >> 2, node & 3
    for t, cost, letter in ADDED[back][end]:
        yield place * 4 + t, cost, letter
    if back and place:
        for t, cost, letter in TURN[codes[place - 1]][1][end]:
            yield node - end - 4 + t, cost, letter
    elif not back and place < len(codes):
        for t, cost, letter in TURN[codes[place]][0][end]:
            yield node - end + 4 + t, cost, letter


def search(codes: bytes) -> tuple[int, str]:
    """Least cost and, of the audits of that cost, the one that is least in ASCII."""
    goals = [4 * len(codes) + e for e in GOALS]
    known, settled = ({0: 0}, dict.fromkeys(goals, 0)), ({}, {})
    heaps = ([(0, 0)], [(0, g) for g in goals])
    best = 0 if 0 in goals else float("inf")
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        back = int(heaps[1][0] < heaps[0][0])
        cost, node = heappop(heaps[back])
        if node in settled[back]:
            continue
        settled[back][node] = cost
        for other, more, _ in _edges(codes, node, back):
            if cost + more < known[back].get(other, float("inf")):
                known[back][other] = cost + more
                heappush(heaps[back], (cost + more, other))
                if other in known[1 - back]:
                    best = min(best, cost + more + known[1 - back][other])
    return int(best), _least_audit(codes, settled[0], settled[1], best, goals)


def _least_audit(codes: bytes, ahead: dict[int, int], behind: dict[int, int], best: int, goals: list[int]) -> str:
    """``ahead``, ``behind``: settled costs from the start and to a goal; all crossings of cost ``best`` are among them."""
    rest = behind = behind | dict.fromkeys(goals, 0)  # what a cheapest path still costs from a node on it
    stack = [u for u, d in ahead.items() if any(v in behind and d + cost + behind[v] == best for v, cost, _ in _edges(codes, u, 0)) or (u in behind and d + behind[u] == best)]
    rest = rest | {u: best - ahead[u] for u in stack}
    seen = set(stack)
    while stack:
        node = stack.pop()
        for u, cost, _ in _edges(codes, node, 1):
            if u not in seen and u in ahead and ahead[u] + cost == ahead[node]:
                seen.add(u)
                rest[u] = best - ahead[u]
                stack.append(u)
    front, audit = {0}, []
    while not any(g in front and rest[g] == 0 for g in goals):
        tight = [(letter, v) for u in front for v, cost, letter in _edges(codes, u, 0) if v in rest and rest[u] == cost + rest[v]]
        letter = min(tight)[0]
        audit.append(letter)
        front = {v for x, v in tight if x == letter}
    return "".join(audit)


@lru_cache(1 << 16)
def _short(codes: bytes) -> tuple[int, str]:
    return search(codes)


def edits(audit: str) -> Iterator[tuple[str, str | None]]:
    """Each letter of an audit and the role that a re-roled or inserted turn gets. For kept turns send the initial."""
    end = 0
    for letter in audit:
        if letter in "RI":
            end = NEXT[end]
        initial = yield letter, FORCED[end] if letter in "RI" else None
        if letter == "K":
            end = {"s": 1, "u": 2, "a": 3}[initial]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that tests repair: by crc32 of `conv_id:turn` modulo 20 a turn is dropped (0), emptied (1),
    loses its `[.!?]` (2), is repeated (3) or becomes the user's (4). Nulls in role and text, and in the number's text, are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), k.alias("k")).filter("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1)).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def _own(conversations: DataFrame) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text")).withColumn("h", F.xxhash64("role", "text"))


def _fault() -> Column:
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    return F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(FINE)


def repairs(conversations: DataFrame) -> DataFrame:
    """Per conv_id: n_turns, gaps, blank, duplicate, truncated, illegal, cost (longs) and ``audit``, the edits that repair it.

    Turns stand by number, nulls first; those of one number by role, then by a hash of the text, equal ones side by side. Nulls of role and
    text are one space; a null conv_id is one conversation. An empty text is blank. Of equal turns all but the first are duplicates. Roles that
    don't start with s, u or a can't be kept. Other columns are ignored. An empty table gives no rows. Equality of texts is that of a
    64-bit hash within a conversation.
    """
    initial = F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END")
    turns = _own(conversations).select("conv_id", "turn", "role", "h", initial.alias("who"), _fault().alias("fault"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "h").orderBy(F.col("turn").asc_nulls_first())) > 1
    turns = turns.withColumn("again", again).withColumn("fault", F.when(F.col("again") & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")))
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "h", "again")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, codes, numbers, first = None, bytearray(), [0, None, None], True

        def judged() -> tuple:
            own = bytes(codes)
            faults = [c & 3 for c in own]
            legal = sum(1 for a, b in zip(own, own[1:], strict=False) if (a >> 2, b >> 2) in ((1, 2), (2, 3), (3, 2)))
            cost, audit = _short(own) if len(own) <= SHORT else search(own)
            distinct, low, high = numbers
            return conv, len(own), high - low + 1 - distinct if distinct else 0, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), max(len(own) - 1, 0) - legal, cost, audit

        for batch in batches:
            out = []
            for c, turn, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if first or c != conv:
                    if not first:
                        out.append(judged())
                    conv, codes, numbers, first = c, bytearray(), [0, None, None], False
                codes.append(code)
                if turn is not None and turn != numbers[2]:  # in order, so equal numbers stand side by side
                    numbers = [numbers[0] + 1, turn if numbers[1] is None else numbers[1], turn]
            if out:
                yield _batch(out, batch.schema.field(0).type)
        if not first:
            yield _batch([judged()], batch.schema.field(0).type)

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return dealt.select("conv_id", "turn", (F.col("who") * 4 + F.col("fault")).alias("code")).mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")


COUNTS = ["n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:-1]), pa.array(columns[-1], pa.string())], ["conv_id", *COUNTS, "audit"])


def repaired_turns(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The turns that stand after the edits of ``found`` (conv_id, audit): conv_id, place (from 0), edit (K, R or I), turn, role and text.

    Inserted turns have no number and an empty text. A conversation's turns stand side by side in one partition, in order. Conversations that
    ``found`` doesn't have are left out.
    """
    texts = _own(conversations).select("conv_id", F.lit(1).alias("of"), "turn", "role", "h", "text")
    heads = found.select("conv_id", F.lit(0).alias("of"), F.lit(None).cast("long").alias("turn"), F.col("audit").alias("role"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("string").alias("text"))
    dealt = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "of", F.col("turn").asc_nulls_first(), "role", "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, plan, edit, place = None, None, None, 0

        def step(initial: str | None = None) -> tuple[str, str | None] | None:
            try:
                return plan.send(initial)
            except StopIteration:
                return None

        def inserted() -> Iterator[tuple]:
            """Turns that stand before the next turn of the table."""
            nonlocal edit, place
            while edit and edit[0] == "I":
                yield conv, place, "I", None, edit[1], ""
                place, edit = place + 1, step()

        for batch in batches:
            out = []
            for c, of, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if of == 0:
                    if plan:
                        out.extend(inserted())
                    conv, plan, place = c, edits(role), 0
                    edit = step()
                    continue
                if plan is None or c != conv:
                    continue
                out.extend(inserted())
                letter, forced = edit
                if letter != "D":
                    out.append((c, place, letter, turn, forced or role, text))
                    place += 1
                edit = step(role[:1] if letter == "K" else None)
            if out:
                yield _turns(out, batch.schema.field(0).type)
        if plan and (out := list(inserted())):
            yield _turns(out, batch.schema.field(0).type)

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return dealt.select("conv_id", "of", "turn", "role", "text").mapInArrow(run, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def _turns(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "place", "edit", "turn", "role", "text"])


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and ``repaired_sha256`` of what ``repaired_turns`` gives, hashed as it streams by: `role:text` of each turn, joined by newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])
        for batch in batches:
            kind = batch.schema.field(0).type
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        yield row()
                    conv, state = c, sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
        if state is not None:
            yield row()

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """Per conv_id of ``conversations``: what was found in its turns of ``damaged``, the cheapest edits and a digest of what they give.

    Without turns all counts are 0, the audit is empty and the digest is that of an empty text.
    """
    found = written(repairs(damaged), "conversation-repairs")
    hashed = digests(repaired_turns(damaged, found)).withColumnRenamed("conv_id", "c")
    rows = found.join(hashed, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").withColumnRenamed("conv_id", "c")
    ids = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS[1:]]
    return ids.join(rows, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
