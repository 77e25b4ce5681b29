"""Mined negatives against a brute force over all pairs, and the query against its SQL."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from tarmaq.compare import difference
from tarmaq.llm.hard_negatives import SuffixBoundIndex, comparable, hard_negatives
from tarmaq.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, id string"


def brute(rows, is_anchor, n_positives=5, n_negatives=5, low=80):
    """``anchor, positive, rank, negative, scores`` of rows ``(id, vector, label, ...)``."""
    clean = {(i, y, tuple(math.floor(256 * x) for x in v)) for i, v, y, *_ in rows
             if y is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}

    def order(r):
        return -r[0], math.inf if r[1] is None else r[1], r[2]

    out = []
    for anchor in clean:
        if not is_anchor(anchor[0]):
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), *r)
                  for r in clean if r != anchor]
        same = sorted((r for r in scored if r[2] == anchor[1]), key=order)[:n_positives]
        for p in same:
            fit = [r for r in scored if r[2] != anchor[1]
                   and low * p[0] <= 100 * r[0] <= 100 * p[0]]
            for rank, r in enumerate(sorted(fit, key=order)[:n_negatives], 1):
                out.append((anchor[0], p[1], rank, r[1], p[0], r[0]))
    return sorted(out, key=repr)


def mined(spark, rows, is_anchor, **settings):
    df = comparable(spark.createDataFrame(rows, SCHEMA))
    found = hard_negatives(df, df.where(is_anchor), **settings)
    return sorted((tuple(r)[:6] for r in found.collect()), key=repr)


def vectors(seed, n, width, labels, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    return [(i, [(c + spread * draw.gauss(0, 1)) / 8 for c in centres[draw.randrange(labels)]],
             draw.randrange(labels), "x") for i in range(n)]


@pytest.mark.parametrize("index_rows, anchor_rows", [(8192, 4096), (40, 7)])
@pytest.mark.parametrize("spread", [0.2, 1.0])
def test_against_brute_force(spark, index_rows, anchor_rows, spread):
    rows = vectors(index_rows, 300, 12, 4, spread)
    found = mined(spark, rows, "id % 11 = 0", index_rows=index_rows, anchor_rows=anchor_rows)
    assert found == brute(rows, lambda i: i % 11 == 0) and found


def test_edge_rows(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(0, same, 1, "a"), (0, same, 1, "a"),  # a repeated row is one
            *[(i, same, 1 + i % 2, "b") for i in range(1, 30)],  # ties
            (40, None, 1, "c"), (41, [1.0, None], 1, "c"), (42, [float("nan")], 2, "c"),
            (43, [float("inf")], 2, "c"), (44, same, None, "c"), (45, [], 2, "c"),
            (46, [0.5], 2, "c"), (47, [0.5, 0.0, 0.0, 9.0], 1, "c"), (None, same, 2, "c"),
            (50, [-1.0, 0.0, 0.0], 7, "c"), (51, [1.0, 0.0, 0.0], 7, "c"),  # a negative positive
            (60, [0.1], 9, "alone")]
    for index_rows in (8192, 5):
        found = mined(spark, rows, "id % 10 = 0", index_rows=index_rows)
        assert found == brute(rows, lambda i: i is not None and i % 10 == 0)
    assert len(found) > 20


def test_large_numbers_stay_exact(spark):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1e6, 1e6) for _ in range(4)], i % 2, "") for i in range(40)]
    rows.append((99, [1e30], 0, "too long for 64 bits"))
    expected = brute(rows[:-1], lambda i: i % 10 == 0)
    assert mined(spark, rows, "id % 10 = 0") == expected and expected


def test_empty_table(spark):
    assert mined(spark, [], "id % 10 = 0") == []


def test_index_leaves_out_dimensions_and_loses_no_pair():
    draw = np.random.default_rng(5)
    x = np.floor(draw.normal(size=(500, 32)) * np.linspace(60, 1, 32))
    q = np.floor(draw.normal(size=(20, 32)) * np.linspace(60, 1, 32))
    full = q @ x.T
    limits = np.sort(full, axis=1)[:, -5]
    index = SuffixBoundIndex(x, q, limits.min())
    assert index.lists.sum() < 0.7 * x.size
    a, r, s = index.search(slice(0, 20), limits)
    assert set(zip(a, r, strict=True)) == set(zip(*np.nonzero(full >= limits[:, None]), strict=True))
    assert (s == full[a, r]).all()


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    database = duckdb.connect()
    database.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = QUERIES["op11_hard_negatives"](spark, folder).toArrow()
    assert found.num_rows > 10
    assert difference(found, database.sql(
        ORACLE_SQL["op11_hard_negatives"]).to_arrow_table()) is None
