"""The n-gram join against all pairs of gram sets."""

from __future__ import annotations

import random

import pytest

from tarmaq.llm.components import connected_components
from tarmaq.llm.jaccard_join import Banding, near_duplicates


def grams(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    sets = [grams(t) for _, t in rows]
    links = [[i != j and bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b) - 1e-9
              for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    low = [r[0] for r in rows]
    changed = True
    while changed:
        new = [min([low[i], *(low[j] for j in range(len(rows)) if links[i][j])])
               for i in range(len(rows))]
        changed, low = new != low, new
    return {r[0]: (low[i], sum(links[i])) for i, r in enumerate(rows)}


@pytest.mark.parametrize("block", [7, 256])
def test_links_and_classes(spark, block):
    rng = random.Random(3)
    texts = []
    for group in range(8):
        base = [f"g{group}w{rng.randint(0, 60)}" for _ in range(120)]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    texts += [*texts[:4], "a b", "a  b", "b a", "one", "", None, " \n"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "doc_id long, text string, key int, band int").repartition(3)
    found = near_duplicates(df, block_texts=block).collect()
    assert {r.id: (r.class_id, r.n_links) for r in found} == brute(rows)
    assert len(found) == len(rows)


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c"), (None, None), (4, "a b c")],
                               "doc_id long, text string")
    found = sorted((r.n_links, r.n_copies, r.class_id) for r in near_duplicates(df).collect()
                   if r.n_links)
    assert found == [(1, 2, 4), (1, 2, 4)]


def test_banding_meets_its_recall():
    banding = Banding.choose(0.8, 0.9995)
    assert banding.bands * banding.rows <= 160
    assert 1 - (1 - 0.8**banding.rows) ** banding.bands >= 0.9995


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    found = connected_components(spark.createDataFrame([*path, *star, (7, 7)], "a long, b long"),
                                 "test").collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
