"""Fingerprints against a direct implementation, and the order of documents."""

from __future__ import annotations

import hashlib
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tarmaq.llm.winnowing import (
    UNIT,
    fingerprints_and_edits,
    hashes_of,
    likeness,
    op4_winnowing,
    with_fingerprint,
)

LAST = (1 << 31) - 1


def units_of(text):
    return re.findall(UNIT, text or "", flags=re.ASCII)


@pytest.mark.parametrize(("k", "w"), [(3, 9), (2, 4)])
def test_fingerprint(spark, k, w):
    rng = random.Random(6)
    texts = ["", None, " \n", "one", "a b c d e", "x " * 100, "字幕かな字幕" * 9, "y" * 70, "\U0001F600e\u0301 \u0e01\u0e32" * 8] + [
        " ".join(rng.choice("abc") for _ in range(rng.randint(1, 80))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    grams = {tuple(u[i : i + k]) for u in map(units_of, texts) for i in range(len(u))}
    hashes = {tuple(r.g): r.h & 0xFFFFFFFF for r in spark.createDataFrame(
        [(list(g),) for g in grams], "g array<string>").select(
        "g", F.xxhash64(*[F.get("g", F.lit(i)) for i in range(k)]).alias("h")).collect()}
    for row in with_fingerprint(df, "text", "fp", k, w).collect():
        u = units_of(row.text)
        count = max(1, len(u) - k + 1)
        keys = [(hashes[tuple(u[i : i + k])] << 31) + LAST - i for i in range(count)] if u else [
            LAST]
        chosen = [min(keys[i : i + w]) for i in range(max(1, len(keys) - w + 1))]
        assert row.fp == list(dict.fromkeys(chosen))


def test_edits_and_order(spark):
    rows = [(5, "abcdefgh", 0), (2, "xy", 1), (9, None, 2), (None, "nullid!!", 3), (7, "", 4),
            (5, "abcdefgh", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(4)
    found = {r.id: r for r in fingerprints_and_edits(df).collect()}
    assert fingerprints_and_edits(df).count() == len(rows)
    assert {i: r.edited for i, r in found.items()} == {
        2: "xy", 5: "abcdef", 7: "", 9: "", None: "nullid" + "xy"}
    assert {i: r.n_chars for i, r in found.items()} == {2: 2, 5: 8, 7: 0, 9: 0, None: 8}
    alone = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert fingerprints_and_edits(alone).first().edited == "abcdefab"
    assert fingerprints_and_edits(alone.where("false")).collect() == []


def test_each_text_is_fingerprinted_once(spark):
    """In the plan: one shuffle of the texts, and one hash of all units besides the edited end's."""
    df = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    plan = fingerprints_and_edits(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(lambda ") == 2
    assert plan.count("Repartition") == 1


def test_the_edited_end_gives_the_whole_fingerprint(spark):
    """Wherever the edit falls: in a unit, a run without spaces, next to marks of several units."""
    rng = random.Random(12)
    kinds = ["ab .", "\u0e01\u0e32x ", "\u5b57\u5e55", "\u00e9\U0001F600", "abc", "\x7f\n\t q\u3042\u00e9"]
    texts = ["".join(rng.choice(kinds[i % 6]) for _ in range(rng.randint(0, 150)))
             for i in range(240)]
    rows = [(i // 2 if i % 9 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:20], "doc_id long, text string").repartition(5)
    found = with_fingerprint(with_fingerprint(
        fingerprints_and_edits(df), "text", "own_again"), "edited", "changed_again").collect()
    assert len(found) == len(rows) + 20
    for r in found:
        assert r.own == r.own_again
        assert r.changed == r.changed_again, (r.text, r.edited)
    order = sorted({(r.id is None, r.id or 0, r.text) for r in found})
    hashes = {r.text: set(r.own_hashes) for r in found}
    by_id = {}
    for last, i, text in order:
        by_id.setdefault((last, i), []).append(text)
    places = list(by_id)
    for r in found:  # of documents with equal ids any may be the next
        at = places.index((r.id is None, r.id or 0))
        may = by_id[places[at]] + by_id[places[(at + 1) % len(places)]]
        assert any(set(r.next_hashes) == hashes[t] for t in may)


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = rows.collect()
    found = {r.doc_id: r for r in op4_winnowing(spark, "/root/testdata/sf0.001").collect()}
    prints: dict = {}
    for row, after in zip(rows, rows[1:] + rows[:1], strict=True):
        text, other = row.text or "", after.text or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        r = found[row.doc_id]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.n_chars == len(text)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        if edited == text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    long = [r for r in found.values() if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.5
    assert sum(r.near_next for r in long) / len(long) < 0.1


def test_short_texts_are_told(spark):
    """Texts under 20 words of which the edit leaves three quarters, in a table with enough."""
    folder = "/root/testdata/sf0.01"
    words = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(
        f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    short = [r for r in op4_winnowing(spark, folder).collect()
             if words[r.doc_id] < 20 and r.fingerprint != r.edited_fingerprint]
    assert len(short) > 10
    assert statistics.mean(r.near_edited for r in short) > 0.3
    assert statistics.mean(r.near_next for r in short) < 0.1


def test_an_insertion_moves_only_its_own_grams(spark):
    """Also in writing without spaces, where nothing but the characters can be a gram."""
    rng = random.Random(8)
    thai = "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(600))
    df = spark.createDataFrame([(thai, thai[:300] + "x" + thai[300:])], "a string, b string")
    prints = with_fingerprint(with_fingerprint(df, "a", "fa"), "b", "fb").select(
        hashes_of("fa").alias("ha"), hashes_of("fb").alias("hb"))
    assert prints.select(likeness("ha", "hb")).first()[0] > 0.9
    # Any 11 shared units hold a gram that both keep.
    for at in range(0, 570, 190):
        part = spark.createDataFrame([("<" * 9 + thai[at : at + 11] + ">" * 9, thai)],
                                     "a string, b string")
        both = with_fingerprint(with_fingerprint(part, "a", "fa"), "b", "fb").select(F.size(
            F.array_intersect(hashes_of("fa"), hashes_of("fb"))))
        assert both.first()[0] > 0
