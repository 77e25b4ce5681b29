"""Prefix trees: what is laid out reads back exactly, and shared turns stand once."""

from __future__ import annotations

import hashlib
import random

import pytest

from tarmaq.llm.chat_format import (
    escape,
    format_turn,
    op5_chat_format,
    parse_turns,
    prefix_trees,
    read_back,
    unescape,
)

SCHEMA = "conv_id long, turn long, role string, text string, path string"


def conversations():
    rng = random.Random(4)
    texts = ["hi", "<|im_end|>", "a\\b<|", "", "é\n", "<", "|im_end|>"]
    rows = []
    for conv in range(40):
        rows.append((conv, 0, "system", "shared", "x"))
        for turn in range(1, rng.randint(1, 6)):
            role = "assistant" if turn % 2 == 0 else "user"
            rows.append((conv, turn, role, rng.choice(texts), None))
    rows += [(None, 1, "user", "lost", None), (None, 0, None, None, None), (None, 1, "user",
                                                                             "lost", None)]
    return rows


def covered(intervals):
    return [place for start, end in intervals for place in range(start, end)]


@pytest.mark.parametrize("most", [1, 3, 64])
def test_round_trip(spark, most):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    nodes, members = prefix_trees(df, most=most)
    told = {r.conv: r for r in read_back(nodes, members).collect()}
    want: dict = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (
            r[0] is None, r[0] or 0, r[1], r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert told.keys() == want.keys()
    for conv, turns in want.items():
        assert parse_turns(told[conv].formatted) == turns
        assert told[conv].formatted == "".join(format_turn(*t)[0] for t in turns)
        assert [unescape(x) for x in told[conv].learnt] == [
            t for r, t in turns if r == "assistant"]


def test_shared_turns_stand_once_and_depth_first(spark):
    df = spark.createDataFrame(conversations(), SCHEMA)
    nodes, _ = prefix_trees(df, most=64)
    trees: dict = {}
    for n in nodes.collect():
        trees.setdefault(n.tree, []).append(n)
    assert len(trees) == 2  # all that start with "shared", and the null one
    for tree in trees.values():
        tree.sort(key=lambda n: n.start)
        assert len({n.path for n in tree}) == len(tree)
        at = 0
        for n in tree:
            assert n.start == at and n.end == at + len(n.formatted)
            at = n.end
            assert n.position == sum(a.end - a.start for a in n.ancestors)
            held = [m for m in tree if any(a.start <= m.start < a.end for a in n.ancestors)]
            assert sorted(m.place for m in held) == list(range(1, n.place))
            assert all(a.end <= n.start for a in n.ancestors)
            assert all(a.end < b.start for a, b in zip(n.ancestors, n.ancestors[1:],
                                                       strict=False))


def test_trees_stay_small(spark):
    rows = [(c, t, "user", "same" if t == 0 else f"{c % 50}", None)
            for c in range(100) for t in range(2)]
    nodes, members = prefix_trees(spark.createDataFrame(rows, SCHEMA), most=8)
    assert max(r["count"] for r in nodes.groupBy("tree").count().collect()) <= 9
    assert members.count() == 100 and read_back(nodes, members).count() == 100


def test_empty_table(spark):
    nodes, members = prefix_trees(spark.createDataFrame([], SCHEMA))
    assert nodes.collect() == [] and read_back(nodes, members).collect() == []


@pytest.mark.parametrize("text", ["", "\\", "<|im_end|>", "\\<|", "<\\|", "a<|b|>\\n\n"])
def test_escapes(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)


def test_query(spark):
    found = {r.conv_id: r for r in op5_chat_format(spark, "/root/testdata/sf0.001").collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert found[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert found[-1].loss_chars == len(said) and found[-1].n_turns == 2
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy(
        "conv_id", "turn").collect()
    turns: dict = {}
    for r in rows:
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert found.keys() == turns.keys() | {-1}
    for conv, told in turns.items():
        whole = "".join(f"{a}\n{b}\n" for a, b in told)
        learnt = "".join(b for a, b in told if a == "assistant")
        assert found[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert found[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_shared_turns_stand_once_above_the_cap(spark):
    rows = [(c, t, "assistant" if t else "system", ["sa\\<|me\n", f"g{c % 3}", "x\\n", f"{c}"][t],
             None) for c in range(300) for t in range(4)]
    rows += [(1000, 0, "system", "sa\\<|me\n", None)]  # ends within the trunk
    rows += [(2000 + c, t, "a\nb", ["other", f"{c}"][t], None) for c in range(20) for t in range(2)]
    nodes, members = prefix_trees(spark.createDataFrame(rows, SCHEMA), most=8)
    found = nodes.collect()
    assert len(found) == len({n.path for n in found}) == 1 + 3 + 3 + 300 + 1 + 20
    layouts: dict = {}
    for n in found:
        layouts.setdefault(n.layout, []).append(n)
    assert sorted(map(len, layouts.values())) == [21, 307]
    for layout in layouts.values():
        at, above = 0, []
        for n in sorted(layout, key=lambda n: n.start):
            assert n.start == at and n.end == at + len(n.formatted)
            above = [*above[: n.place - 1], (n.start, n.end)]  # depth first
            assert covered((a.start, a.end) for a in n.ancestors) == covered(above[:-1])
            assert n.position == sum(b - a for a, b in above[:-1])
            at = n.end
    told = {r.conv: r.formatted for r in read_back(nodes, members).collect()}
    want: dict = {}
    for conv, _, role, text, _ in rows:
        want[conv] = want.get(conv, "") + format_turn(role, text)[0]
    assert told == want


def test_a_very_long_conversation(spark):
    """10,000 turns, and others that leave it at some turn, take intervals by branch, not by turn."""
    rows = [(0, t, "assistant" if t % 2 else "user", f"t{t}", None) for t in range(10_000)]
    for conv, leaves in ((1, 4_000), (2, 9_999)):
        rows += [(conv, *r[1:]) for r in rows[:leaves]] + [(conv, leaves, "user", f"{conv}", None)]
    nodes, members = prefix_trees(spark.createDataFrame(rows, SCHEMA))
    found = nodes.collect()
    assert len(found) == 10_002 and max(len(n.ancestors) for n in found) <= 2
    for r in read_back(nodes, members).collect():
        turns = [(x[2], x[3]) for x in rows if x[0] == r.conv]
        assert parse_turns(r.formatted) == turns
        assert len(r.learnt) == sum(role == "assistant" for role, _ in turns)
