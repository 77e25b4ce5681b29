"""The lattice and fold against all segmentations, and exact round trips."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from tarmaq.llm import sentence_pieces
from tarmaq.llm.sentence_pieces import (
    Pieces,
    decode,
    default_model,
    encode,
    lattice,
    op9_sentence_pieces,
    units,
    viterbi,
    word_groups,
    word_pattern,
)

BYTES = range(1000, 1256)


@pytest.fixture(scope="module")
def pieces():
    rng = random.Random(1)
    texts = {"".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ab▁", repeat=n)
             if rng.random() < 0.5} | {"a", "▁"}
    return Pieces.of([(i, t, -float(rng.randint(1, 30))) for i, t in enumerate(sorted(texts))],
                     BYTES)


def segmentations(word, pieces):
    if not word:
        yield 0.0, []
        return
    for n in range(1, len(word) + 1):
        piece = word[:n]
        if piece in pieces.ids:
            score, ids = pieces.scores[piece], [pieces.ids[piece]]
        elif n == 1:
            score, ids = pieces.unknown, pieces.spell(piece)
        else:
            continue
        for rest, more in segmentations(word[n:], pieces):
            yield score + rest, ids + more


WORDS = [" " * (i % 2) + "".join(w) for i, w in enumerate(
    itertools.chain.from_iterable(itertools.product("abc", repeat=n) for n in (1, 3, 6)))]


def test_both_folds_find_the_best_segmentation(spark, pieces):
    rows = lattice(spark.createDataFrame([(w,) for w in WORDS], "word string"), pieces).select(
        "word", viterbi().alias("path")).collect()
    assert len(rows) == len(set(WORDS))
    for row in rows:
        best = max(score for score, _ in segmentations(row.word, pieces))
        ids = [i for at, i in row.path for i in ([i] if i >= 0 else pieces.spell(row.word[at]))]
        assert ids == pieces.fold(row.word)
        assert any(score == best and found == ids
                   for score, found in segmentations(row.word, pieces))


def test_words_end_where_no_piece_goes_on():
    """For any crossings; with one look at the next character instead of all kinds behind it."""
    kinds = {"a": 0, "é": 0, "7": 0, "_": 1, " ": 2, "\n": 3, ".": 4, "-": 4, "\t": 4}
    rng = random.Random(4)
    for _ in range(150):
        share = rng.choice((0.05, 0.4, 0.9))
        pieces = ["a", *(a + b for a in "a_ \n." for b in "é_ \n-" if rng.random() < share)]
        crossed = {(kinds[p[0]], kinds[p[1]]) for p in pieces[1:]}
        found = word_pattern(pieces)
        for _ in range(20):
            text = "".join(rng.choice(list(kinds)) for _ in range(30))
            words = [text[0]]
            for a, b in itertools.pairwise(text):
                if (kinds[a], kinds[b]) in crossed:
                    words[-1] += b
                else:
                    words.append(b)
            assert found.findall(text) == words
    assert r"(?:(?![ \n])" in word_pattern([" a", "aa", "a.", "..", "  "]).pattern.replace("_", "")


@pytest.mark.parametrize("entries", [1, 1 << 20])
def test_round_trip(spark, pieces, entries):
    texts = ["", None, "a b", " a  b ", "\n\nab\n a", "▁a ▁", "é😀\t", "ab" * 5000, " ", "a b"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids string")
    encoded = encode(df, pieces, entries=entries)
    assert encoded.columns == ["doc_id", "text", "ids"]
    rows = decode(encoded, pieces).collect()
    assert {r.doc_id: r.decoded for r in rows} == dict(enumerate(texts))
    for r in rows:
        assert r.ids == (None if r.text is None else
                         [i for u in units(r.text) for i in pieces.fold(u)])


def test_public_model(spark):
    pieces = Pieces.from_model(default_model())
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = decode(encode(df, pieces), pieces).collect()
    assert all(r.decoded == r.text for r in rows) and len(rows) == df.count()


def test_empty_table(spark, pieces):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(df, pieces), pieces).collect() == []


def whole_text_ids(text, entries, byte_ids):
    """Viterbi over the whole text, from the entries alone."""
    text = " " + text
    table = {p.replace("▁", " "): (i, s) for i, p, s in entries}
    unknown = min(s for _, s in table.values()) - 10
    longest = max(map(len, table))
    best = [(0.0, 0, [])]
    for end in range(1, len(text) + 1):
        ways = []
        for start in range(max(0, end - longest), end):
            found = table.get(text[start:end])
            if found:
                ways.append((best[start][0] + found[1], start, [found[0]]))
            elif end - start == 1:
                ways.append((best[start][0] + unknown, start,
                             [byte_ids[b] for b in text[start].encode()]))
        best.append(max(ways, key=lambda w: w[:2]))
    out, end = [], len(text)
    while end:
        out.append(best[end][2])
        end = best[end][1]
    return [i for part in reversed(out) for i in part]


CODE = ["x_{i}^{2}+\\_a", "def __init__(self, *_): return self._x", "a->_b ._c\n    if (__name__):",
        "\\frac{a_{1}}{b_{2}} _ __ '_' \"__\"", "  two  spaces\t_{\n\n  x", "don't U.S. 3.5%_"]


@pytest.mark.parametrize("entries", [1, 1 << 20])
def test_bundled_pieces_across_signs(spark, entries):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    rows = [(i, model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = Pieces.from_model(default_model())
    df = spark.createDataFrame(list(enumerate(CODE)), "doc_id long, text string")
    ids = {r.doc_id: r.ids for r in encode(df, pieces, entries=entries).collect()}
    assert ids == {i: whole_text_ids(t, rows, pieces.byte_ids) for i, t in enumerate(CODE)}
    assert model.piece_to_id("_{") in ids[0]
    assert {model.piece_to_id("▁" * n) for n in (2, 3, 4)} & set(ids[2])


@pytest.mark.parametrize("crossing", [["'s", "U.S."], ["of▁the", "▁▁"], [".\n", "_{"], []])
def test_unigram_pieces_across_words(spark, crossing):
    rng = random.Random(3)
    singles = "abUS.'▁_{ofthe\n"
    rows = [(i, t, -float(rng.randint(5, 30))) for i, t in enumerate([*singles, "ab", "▁a", "the"])]
    rows += [(100 + i, t, -2.0) for i, t in enumerate(crossing)]
    pieces = Pieces.of(rows, BYTES)
    texts = ["a's  U.S. of the", "b.\nab _{a}", "U.S.'s of  the\n\n_{_", "é's", " "] + [
        "".join(rng.choice(singles.replace("▁", " ")) for _ in range(60)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = encode(df, pieces)
    found = {r.doc_id: (r.ids, r.decoded) for r in decode(encoded, pieces).collect()}
    assert found == {i: (whole_text_ids(t, rows, list(BYTES)), t) for i, t in enumerate(texts)}


def test_trie_folds_as_word_by_word(pieces):
    rng = random.Random(8)
    words = ["".join(rng.choice("abab c") for _ in range(rng.randint(1, 20))) for _ in range(3000)]
    for longest in (5, 48):
        found = [np.frombuffer(p, np.int32).tolist() for p in pieces.fold_all(words, longest)]
        assert found == [pieces.fold(w) for w in words]
    assert list(pieces.fold_all([], 48)) == []


@pytest.mark.parametrize("at_once", [1, 7])
def test_long_texts_come_in_parts(spark, pieces, at_once, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "LONG_TEXT", 10)
    monkeypatch.setattr(sentence_pieces, "WORDS_AT_ONCE", at_once)
    texts = ["ab a b ba" * 9, None, "", "a", " ba  b\n" * 5, "b"]
    groups = list(word_groups(pa.array(texts), pieces.words))
    assert all(sum(len(w) for _, w in g) < at_once + 10 for g in groups)
    for i, text in enumerate(texts):
        assert [w for g in groups for p, part in g if p == i for w in part] == units(
            text, pieces.words)


def test_query(spark, tmp_path):
    """The registered query over whole texts, one of them long."""
    rows = [(i, t, "x") for i, t in enumerate([*CODE, "", None, "Ünḯ 字 ⁀_ \x00\t" * 40, CODE[0],
                                               "word and_ more. " * 2000])]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(
        f"{tmp_path}/documents.parquet")
    pieces = Pieces.from_model(default_model())
    entries = [(i, p, pieces.scores[p]) for p, i in pieces.ids.items()]
    for r in op9_sentence_pieces(spark, str(tmp_path)).collect():
        text = rows[r.doc_id][1]
        assert r.decoded_sha256 == r.text_sha256
        if text is None:
            assert r.ids is None and r.text_sha256 is None
        else:
            assert r.ids == (whole_text_ids(text, entries, pieces.byte_ids) if text else [])
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert r.n_tokens == len(r.ids)
