"""Repaired conversations against a shortest path over edits, and against all edits of short ones."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from tarmaq.llm.queries import QUERIES
from tarmaq.llm.turn_repair import Chart, cheapest, leaf, repair_conversations

DATA = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, rank int, audit string"
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen
                   else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def shortest(rows, found):
    """``cost, audit, texts`` by Dijkstra over (row, last initial)."""
    heap, settled = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, told = heapq.heappop(heap)
        if (i, last) in settled:
            continue
        settled.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, told
        steps = [(3, "I", i, r, (*told, f"{NAMES[r]}:")) for r in "ua" if r in AFTER[last]]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((4, "D", i + 1, last, told))
            if found[i] not in ("blank", "duplicate"):
                extra = 3 * (found[i] == "truncated")
                steps += [(3 + extra, "R", i + 1, r, (*told, f"{NAMES[r]}:{text}"))
                          for r in "ua" if r in AFTER[last]]
                if role[:1] and role[:1] in AFTER[last]:
                    steps.append((extra, "K", i + 1, role[:1], (*told, f"{role}:{text}")))
        for more, edit, *rest in steps:
            heapq.heappush(heap, (cost + more, audit + edit, *rest))
    raise AssertionError


def expected(rows):
    """The columns of one conversation from ``(turn, role, text)`` in order."""
    found = faults(rows)
    turns = [t for t, *_ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, told = shortest(rows, found) if rows else (0, "", ())
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def repaired(spark, rows, partitions=4):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
        return {r[0]: tuple(r)[1:] for r in repair_conversations(df).select(
            "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
            "repaired_sha256").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role or " " * (role is None),
                                         text if text is not None else " "))
    return {conv: in_order(group) for conv, group in out.items()}


def test_chart_against_every_edit_of_short_conversations():
    """All ways to keep, rerole, delete and insert, without the grammar's shortcuts."""
    for rows in itertools.product(itertools.product("sux", ["", "truncated", "blank"]), repeat=2):
        best = None
        inserts = [[""], ["u", "a"], ["uu", "ua", "au", "aa"]]
        gaps = [[p for n in inserts for p in n]] * (len(rows) + 1)
        for between in itertools.product(*gaps):
            if sum(map(len, between)) > 3:
                continue
            choices = []
            for initial, fault in rows:
                extra = 3 * (fault == "truncated")
                own = [(4, "D", "")]
                if fault != "blank":
                    own += [(extra, "K", initial), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
                choices.append(own)
            for edits in itertools.product(*choices):
                roles = audit = ""
                cost = 3 * sum(map(len, between))
                for new, (price, edit, role) in zip(between, (*edits, (0, "", "")), strict=True):
                    roles, audit, cost = roles + new + role, audit + "I" * len(new) + edit, cost + price
                if re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best or (cost, audit), (cost, audit))
        chart = Chart()
        for row in rows:
            chart.add(leaf(*row))
        assert cheapest(chart.cell()) == best


def test_chart_against_shortest_paths():
    draw = random.Random(2)
    for _ in range(300):
        rows = [(i, draw.choice(["system", "user", "assistant", "tool", ""]),
                 draw.choice(["a.", "b", "", "c!"]) + str(i) * draw.randrange(2))
                for i in range(draw.randrange(1, 14))]
        found = faults(rows)
        chart = Chart()
        for (_, role, _), fault in zip(rows, found, strict=True):
            chart.add(leaf(role[:1], fault))
        assert cheapest(chart.cell()) == shortest(rows, found)[:2]


def test_edge_rows(spark):
    draw = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "usher"]
    texts = ["Yes.", "no", None, "", "  \t", "Eh? \n", "über!", "a:b\nuser:x."]
    rows = [(draw.choice([None, *range(25)]), draw.choice([None, *range(8)]), draw.choice(roles),
             draw.choice(texts)) for _ in range(300)]
    rows += [(77, None, "user", "x.")] * 3 + [(78, 5, "user", "x.")] * 40  # only repeated rows
    want = {c: expected(g) for c, g in by_conversation(rows).items()}
    assert repaired(spark, rows) == want
    assert repaired(spark, rows, partitions=13) == want


def test_long_conversation_in_parts(spark):
    draw = random.Random(6)
    rows = [(1, i // 2 * 2, draw.choice(["user", "assistant", "system"]),
             draw.choice(["a.", "b", ""]) + str(draw.randrange(900))) for i in range(3000)]
    rows += [(2, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(10_000)]
    found = repaired(spark, rows, partitions=16)
    groups = by_conversation(rows)
    assert found[1] == expected(groups[1])
    assert found[2][:6] == (0, 0, 0, 0, 0, 0) and found[2][6] == "K" * 10_000
    assert found[2][7] == hashlib.sha256("\n".join(
        f"{r}:{t}" for _, r, t in groups[2]).encode()).hexdigest()


def test_empty_table(spark):
    assert repaired(spark, []) == {}


@pytest.mark.parametrize("folder", [DATA])
def test_query(spark, folder):
    read = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    rows, names = [], set()
    for r in read:
        names.add(r["conv_id"])
        place = ":".join(" " if r[c] is None else str(r[c]) for c in ("conv_id", "turn"))
        role, text = (" " if r[c] is None else r[c] for c in ("role", "text"))
        damage = zlib.crc32(place.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(damage, text)
        role = "user" if damage == 4 else role
        rows += [(r["conv_id"], r["turn"], role, text)] * (0 if damage == 0 else 1 + (damage == 3))
    groups = by_conversation(rows)
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op12_turn_repair"](spark, folder).collect()}
    assert found == {c: expected(groups.get(c, [])) for c in names}
