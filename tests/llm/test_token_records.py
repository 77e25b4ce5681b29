"""Record files against the tokenizer itself, their framing, and reads that survive damage."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tarmaq.llm.queries import QUERIES
from tarmaq.llm.token_records import (
    END_ID,
    Encoder,
    default_tokenizer,
    frame,
    read_records,
    read_shuffled,
    record_index,
    token_array,
    unframe,
    write_records,
)

DATA = "/root/testdata/sf0.001"
TEXTS = ["", None, " \t\n", "one two", "It's 3:45, they'll!\x0b!go", "áb ́c d e",
         "ΣΑΣ Σ İstanbul ẞ", "x" * 5000, "<|endoftext|> a<|startoftext|>b", "\x1c\x85 q\x00r",
         "日本語 テスト。漢字", "word " * 3000, "'s'S 'T we've WE'VE", "a.. É! b!? 3.1. ... !x. <p>. \u00aa. z\u0301, " + "y" * 80 + ":"]


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def test_runs_encode_like_whole_texts(library):
    own = Encoder(default_tokenizer())
    documents = pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist()
    for texts in (TEXTS, documents, TEXTS):
        for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
            assert [*np.frombuffer(ids, "<u2"), END_ID] == whole(library, text)


def test_every_ascii_white_space_parts_words(library):
    own = Encoder(default_tokenizer())
    texts = [f"{a}{chr(c)}{b}" for c in range(0x21) for a in "a!1'́" for b in "b?2ś"]
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert [*np.frombuffer(ids, "<u2"), END_ID] == whole(library, text)


def test_query_against_the_library(spark, library):
    documents = sorted(zip(*pq.read_table(f"{DATA}/documents.parquet", columns=[
        "doc_id", "text"]).to_pydict().values(), strict=True))
    found = {r["doc_id"]: r for r in QUERIES["op13_token_records"](spark, DATA).collect()}
    assert len(found) == len(documents)
    start = 0
    for key, text in documents:
        ids = whole(library, text)
        row = found[key]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_edge_rows_over_many_shards(spark, library, tmp_path):
    rows_in = [(None if i == 1 else i // 2, t, i, "x") for i, t in enumerate(TEXTS * 2)]
    rows_in += [(3, "one two", 0, "y")] * 40  # repeated rows, enough for several files
    df = spark.createDataFrame(rows_in, "doc_id long, text string, shard int, file string")
    write_records(df, str(tmp_path), shard_bytes=2000, batch_texts=3)
    back = read_records(spark, str(tmp_path)).orderBy("start").collect()
    assert len(back) == len(rows_in) and {r["problem"] for r in back} == {None}
    assert len({r["shard"] for r in back}) > 5
    ids = [r["id"] for r in back]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    total = 0
    for r in back:
        assert r["start"] == total and r["n_tokens"] == len(token_array(r["ids"]))
        total += r["n_tokens"]
    expected = sorted((repr(i), whole(library, t)) for i, t, *_ in rows_in)
    assert sorted((repr(r["id"]), token_array(r["ids"])) for r in back) == expected


def test_empty_table(spark, tmp_path):
    write_records(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path))
    assert read_records(spark, str(tmp_path)).count() == 0
    assert read_shuffled(spark, str(tmp_path), 1).count() == 0


def test_frames():
    data = b"".join(frame(p) + b"\n" for p in (b"", b"\n\n", b"abc" * 100))
    at, payloads = 0, []
    while at < len(data):
        payload, at, problem = unframe(data, at)
        assert problem is None
        payloads.append(payload)
    assert payloads == [b"", b"\n\n", b"abc" * 100]
    assert unframe(data[:-5], at=len(frame(b"")) + 1 + len(frame(b"\n\n")) + 1)[2] == "record cut off"


def test_shuffled_reads_and_damage(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(200)],
                               "doc_id long, text string")
    write_records(df, str(tmp_path), shard_bytes=1 << 20)
    orders = {}
    for seed in (1, 1, 2):
        got = [r["id"] for r in read_shuffled(spark, str(tmp_path), seed).collect()]
        assert sorted(got) == list(range(200)) and got != sorted(got)
        assert orders.setdefault(seed, got) == got
    assert orders[1] != orders[2]

    index = sorted(record_index(spark, str(tmp_path)).collect(), key=lambda r: r["offset"])
    file = Path(tmp_path, "records", index[0]["file"])
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    data = bytearray(file.read_bytes())
    data[index[5]["offset"] + 30] ^= 1  # in a payload
    data[index[9]["offset"]] ^= 1  # in a length
    file.write_bytes(data)
    problems = {r["id"]: r["problem"] for r in read_records(spark, str(tmp_path)).collect()}
    assert problems[index[4]["id"]] is None
    assert [p for p in problems.values() if p] == ["checksum differs", "length damaged"]
    assert len(problems) == 10  # nothing can be read on behind a damaged length
    read = {r["id"]: r["problem"] for r in read_shuffled(spark, str(tmp_path), 3).collect()}
    assert sum(p is None for p in read.values()) == 198  # but by the index it can
