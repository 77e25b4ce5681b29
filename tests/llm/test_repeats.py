"""Both repeat removals against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tarmaq.llm.queries import QUERIES
from tarmaq.llm.substring_dedup import repeated_passages, without_passages
from tarmaq.llm.suffix_dedup import RunLengthIndex, repeated_strings, without_strings


def kept_symbols(texts, window):
    counts = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    kept = []
    for t in texts:
        gone = set()
        for i in range(len(t) - window + 1):
            if counts[tuple(t[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept.append([x for i, x in enumerate(t) if i not in gone])
    return kept


def corpus(seed, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 60))] for _ in range(12)]
    texts = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [
                rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        texts.append(" ".join(parts))
    return [*texts, *texts[:5], "", None, " \t\n", "a " * 100, "é" * 90, "x y " * 40]


@pytest.mark.parametrize("extended", [0, 2, 64])
@pytest.mark.parametrize("words", [3, 400])
def test_passages(spark, words, extended):
    texts = corpus(1, words)
    rows = [(i, t, "extra") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(5)
    found = without_passages(repeated_passages(
        df, window=12, anchor=5, extended=extended), 12).collect()
    want = kept_symbols([(t or "").encode().split() for t in texts], 12)
    assert len(found) == len(rows)
    for row in found:
        assert row.text.encode().split() == want[row.id], row.id
        assert row.n_words == len((texts[row.id] or "").encode().split())
        assert row.n_removed == row.n_words - len(want[row.id])


@pytest.mark.parametrize("largest", [0, 2, 1000])
@pytest.mark.parametrize("words", [2, 300])
def test_strings(spark, words, largest):
    texts = corpus(2, words)[::2]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = without_strings(
        repeated_strings(df, window=40, seeds=(17, 36), largest_seed=largest, block_symbols=500),
        40).collect()
    want = kept_symbols([(t or "").encode() for t in texts], 40)
    assert len(found) == len(rows)
    for row in found:
        assert list(row.kept) == want[row.id], row.id


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, "a b"), (None, None)],
                               "doc_id long, text string")
    found = without_passages(repeated_passages(df)).collect()
    assert sorted((r.n_words, r.n_removed) for r in found) == [(0, 0), (2, 0), (60, 60), (60, 60)]
    found = without_strings(repeated_strings(df, window=100, seeds=(60,)), 100).collect()
    assert sorted(r.n_spans for r in found) == [0, 0, 1, 1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert without_passages(repeated_passages(df)).collect() == []
    assert without_strings(repeated_strings(df)).collect() == []


def test_index_gives_longest_matches():
    rng = np.random.default_rng(5)
    text = np.append(np.tile(rng.integers(0, 3, 30), 4), 99)
    text[[40, 77]] = 2
    index = RunLengthIndex(text)
    assert index.n_runs < len(text) / 2

    def longest(i):
        best = 0
        for j in range(len(text)):
            if j != i:
                n = 0
                while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
                    n += 1
                best = max(best, n)
        return best

    assert index.matching_statistics().tolist() == [longest(i) for i in range(len(text))]


def test_registered_queries(spark, tmp_path):
    """Both queries with their own windows, 35 words and 400 bytes, over a table of documents."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    passages = [[rng.choice(words) for _ in range(rng.randint(30, 130))] for _ in range(15)]
    texts = [None, "", "one two"]
    for i in range(90):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 40)
            parts += passage[cut : cut + rng.randint(20, 120)]
            parts += [rng.choice(words) for _ in range(rng.randint(0, 9))]
        texts.append("\t".join(parts) if i % 5 == 0 else " ".join(parts))
    texts += texts[10:13]
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                          "n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    by_words = kept_symbols([(t or "").encode().split() for t in texts], 35)
    for row in QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect():
        kept = by_words[row.doc_id]
        assert row.n_words == len((texts[row.doc_id] or "").encode().split())
        assert row.n_removed == row.n_words - len(kept)
        assert row.kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()
    by_bytes = kept_symbols([(t or "").encode() for t in texts], 400)
    for row in QUERIES["op8_suffix_array_dedup"](spark, str(tmp_path)).collect():
        kept = by_bytes[row.doc_id]
        assert row.n_bytes == len((texts[row.doc_id] or "").encode())
        assert row.n_removed == row.n_bytes - len(kept)
        assert row.kept_sha256 == hashlib.sha256(bytes(kept)).hexdigest()
