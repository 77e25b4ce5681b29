"""Archives: exact round trips, revisits, and segments that are damaged."""

from __future__ import annotations

import base64
import hashlib
from uuid import uuid4

import pytest

from tarmaq.llm.warc import (
    chunked,
    dechunked,
    http_payload,
    op6_warc,
    parse,
    read_archives,
    segments,
    serialise,
    write_archives,
)
from tarmaq.session import shared_folder


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/warc-{uuid4().hex}"


def test_round_trip_with_segments_and_revisits(spark, folder):
    rows = [(i, f"http://x/{i}", html, "extra") for i, html in enumerate([
        "é" * 5000, "short", "", None, "short", "a\r\n\r\nWARC/1.1\r\n" * 300, "é" * 5000, "\r\n"])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, key string")
    write_archives(df.repartition(3), folder, segment_bytes=700)
    back = {int(r.page_id): r for r in read_archives(spark, folder).collect()}
    assert len(back) == len(rows)
    first: dict = {}
    for page, url, html, _ in rows:
        payload = (html or "").encode()
        r = back[page]
        assert r.problem is None and r.target_uri == url
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if payload in first:
            assert (r.type, int(r.refers_to)) == ("revisit", first[payload])
            assert r.payload_length == len(payload)
        else:
            first[payload] = page
            assert r.type == "response" and bytes(r.payload) == payload


def test_small_payloads_are_written_in_full(spark, folder):
    df = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (None, None, "b" * 30),
                                (3, None, "b" * 30), (3, None, "b" * 30)],
                               "page_id long, url string, html string")
    write_archives(df, folder, least_bytes=3)
    back = sorted((r.page_id or "", r.type) for r in read_archives(spark, folder).collect())
    assert back == [("", "revisit"), ("1", "response"), ("2", "response"), ("3", "response"),
                    ("3", "response")]


def test_damaged_segments_are_told(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(b"x" * 900, 100)
    archive = {"gap": [0, 2, 3], "twice": [0, 1, 1, 2, 3], "order": [3, 1, 0, 2],
               "headless": [1, 2, 3]}
    for name, picked in archive.items():
        headers = {"WARC-Type": "response", "WARC-Record-ID": f"<{name}>", "WARC-Date": "d"}
        parts = list(segments(headers, block, 300))
        assert len(parts) == 4
        for n, i in enumerate(picked):
            (tmp_path / f"{name}-{n}.warc").write_bytes(
                serialise(*parts[i]) + b"\r\n\r\n")
    (tmp_path / "cut.warc").write_bytes(serialise({"WARC-Type": "response"}, b"abc")[:-1])
    found = {(r.record_id or "") + str(r.problem) for r in
             read_archives(spark, str(tmp_path)).where("type <> 'continuation'").collect()}
    assert found == {"<gap>segments missing or repeated", "<twice>segments missing or repeated",
                     "<order>None", "record cut short"}
    lost = read_archives(spark, str(tmp_path)).where("type = 'continuation'").collect()
    assert [r.problem for r in lost] == ["segments missing or repeated"]


def test_damaged_numbers_are_told(spark, tmp_path):
    for name, line in (("length", b"Content-Length: many"), ("none", b"X: y"),
                       ("segment", b"WARC-Segment-Number: -\r\nContent-Length: 1"),
                       ("payload", b"X-Payload-Length: \xff\r\nContent-Length: 1")):
        (tmp_path / f"{name}.warc").write_bytes(
            f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\n".encode()
            + line + b"\r\n\r\nz\r\n\r\n")
    found = {r.record_id: r.problem for r in read_archives(spark, str(tmp_path)).collect()}
    assert found == {"length": "no content length", "none": "no content length",
                     "segment": "warc-segment-number is no number",
                     "payload": "x-payload-length is no number"}


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 9):
        assert dechunked(chunked(payload, 4)) == payload
    assert dechunked(b"3;name=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            dechunked(bad)
    with pytest.raises(ValueError):
        http_payload(b"no end")


def test_parse_reads_what_serialise_writes():
    data = b"".join(serialise({"WARC-Type": t}, b) + b"\r\n\r\n"
                    for t, b in (("a", b""), ("b", b"\r\n\r\nWARC/1.1\r\n"), ("c", b"\xff")))
    assert [(r.headers["warc-type"], r.block, r.problem) for r in parse(data)] == [
        ("a", b"", ""), ("b", b"\r\n\r\nWARC/1.1\r\n", ""), ("c", b"\xff", "")]
    assert [r.problem for r in parse(b"junk")] == ["no record header"]


def test_empty_table(spark, folder):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    write_archives(df, folder)
    assert read_archives(spark, folder).collect() == []


def test_query(spark):
    found = {r.page_id: r for r in op6_warc(spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        r, payload = found[p.page_id], (p.html or "").encode()
        assert r.payload_bytes == len(payload) and r.digest_verified and r.problem is None
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
