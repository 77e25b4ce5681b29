"""The quality ledger and the source mix on edge rows, and both queries against their SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tarmaq.compare import difference
from tarmaq.llm.quality_rules import POLICIES, RULES, ablations, kept, ledger, mask_of, measure
from tarmaq.llm.queries import ORACLE_SQL, QUERIES
from tarmaq.llm.source_mix import repeated, systematic_mix, targets

DATA = "/root/testdata/sf0.001"
TEXTS = ["", None, " \t\n", "a", "a b c a b c", "a a a a a", "x\n\nx\ny\n x", "#$ <|> 5%", "é" * 90,
         "q w e r " * 40, "one two three"]


def repeat_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    counts = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({i + j for i in range(len(words) - 2) if counts[tuple(words[i : i + 3])] > 1
                for j in range(3)})


def test_measures(spark):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, entry int")
    for row in measure(df).collect():
        text = row.document.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == repeat_words(text)


def test_ablations(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    judged = ledger(measure(df)).cache()
    bits = [r.failed for r in judged.collect()]
    for row in ablations(judged).collect():
        mask = mask_of(POLICIES[row.policy])
        bit = next(1 << r.bit for r in RULES if r.name == row.rule)
        assert row.failing == sum(bool(b & mask & bit) for b in bits)
        assert row.rejected == sum(bool(b & mask) for b in bits)
        assert row.rejected_by_it_alone == sum(b & mask == bit for b in bits)
        assert row.kept_without_it == sum(not b & mask & ~bit for b in bits)
    assert kept(judged, "base").count() == sum(not b & mask_of(POLICIES["base"])
                                                       for b in bits)
    assert ablations(ledger(measure(df.where("false")))).collect() == []


def fill(sizes, weights, share, most):
    """Targets by giving out what is left again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and left * weight[s] / total > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else left * weight[s] / total for s in order}
        full |= over


def test_targets_are_the_repeated_resharing(spark):
    sizes = {"b": 10, "a": 1000, None: 3, "é": 500, "z": 0, "B": 40}
    rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = fill(sizes, (3.0, 1.0, 2.0), 1.5, 2.0)
    assert {r.source: pytest.approx(r.target) for r in rows.collect()} == want


def test_mix(spark):
    rows = [(i, "w " * (i % 37), ("a", "b", None, "c")[min(3, i % 7)], i, 0)
            for i in range(600)] + [(1, "w ", "b", 1, 0)] * 3 + [(None, None, "a", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copies int")
    mixed = systematic_mix(df.repartition(5))
    found = mixed.collect()
    assert len(found) == len(rows)
    taken, targets_of = defaultdict(int), {}
    for r in found:
        assert 0 <= r.copies <= 2
        taken[r.document.source] += r.copies * r["size"]
        targets_of[r.document.source] = r.target
    for source, target in targets_of.items():
        assert abs(taken[source] - target) <= 40
    again = systematic_mix(df.repartition(2)).collect()
    assert Counter((r.document, r.copies) for r in again) == Counter(
        (r.document, r.copies) for r in found)
    assert repeated(mixed).columns == df.columns
    assert repeated(mixed).count() == sum(r.copies for r in found)
    assert systematic_mix(df.where("false")).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, DATA).toArrow()
    assert difference(found, database.sql(ORACLE_SQL[name]).to_arrow_table()) is None
