"""WARC archives: writing with revisits and segments, reading with reassembly."""

from __future__ import annotations

import base64
import gzip
import re
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, row_key, stored, table
from tarmaq.session import shared_folder

#: Record blocks up to this many bytes are one record, longer ones are cut into continuations.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 8 * 1024
#: Archives are closed at about this many bytes of payload.
ARCHIVE_BYTES = 8 * 1024 * 1024
#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT_BYTES = 0
_END = b"\r\n\r\n"
#: Headers that hold numbers, besides the length that parts the records.
_NUMBERS = ("warc-segment-number", "warc-segment-total-length", "x-payload-length")
DATE = "2024-01-01T00:00:00Z"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes = b""
    problem: str = ""


def serialise(headers: dict[str, str], block: bytes) -> bytes:
    """One record without its closing line ends."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items() if v),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in HTTP chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[a : a + size]), payload[a : a + size])
             for a in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of chunked framing; raises ``ValueError`` where a chunk is cut or mismarked."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size expected")
        size = int(body[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The entity of an HTTP response block, after transfer decoding."""
    head, end, body = block.partition(_END)
    if not end:
        raise ValueError("HTTP header without end")
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return dechunked(body)
    return body


def segments(headers: dict[str, str], block: bytes, size: int = SEGMENT_BYTES
             ) -> Iterator[tuple[dict[str, str], bytes]]:
    """The record itself, or its first segment and the continuations."""
    if len(block) <= size:
        yield headers, block
        return
    starts = range(0, len(block), size)
    for number, at in enumerate(starts, 1):
        part = block[at : at + size]
        if number == 1:
            yield headers | {"WARC-Segment-Number": "1"}, part
        else:
            last = {"WARC-Segment-Total-Length": str(len(block))} if at + size >= len(block) else {}
            yield {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:uuid:{uuid4()}>",
                "WARC-Date": headers["WARC-Date"],
                "WARC-Target-URI": headers.get("WARC-Target-URI", ""),
                "WARC-Segment-Origin-ID": headers["WARC-Record-ID"],
                "WARC-Segment-Number": str(number)} | last, part


def number_in(headers: dict[str, str], name: str) -> int | None:
    """The header's number; none where it is missing or no plain number."""
    value = headers.get(name, "")
    return int(value) if re.fullmatch(r"[0-9]{1,9}", value) else None


def parse(data: bytes) -> Iterator[Record]:
    """All records of an archive, plain or compressed as a whole or record by record.

    A header that should be a number and is none makes the record a problem; without a length
    nothing tells where the next record begins, so it is the last.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(_END, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            yield Record({}, problem="no record header")
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = number_in(headers, "content-length")
        if length is None:
            yield Record(headers, problem="no content length")
            return
        block = data[end + 4 : end + 4 + length]
        bad = [n for n in _NUMBERS if n in headers and number_in(headers, n) is None]
        cut = len(block) < length
        yield Record(headers, block, "record cut short" if cut else
                     f"{bad[0]} is no number" if bad else "")
        if cut:
            return
        at = end + 4 + length


def revisits(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``key, refers_to`` for pages whose payload a page with a smaller id already holds.

    Only digests are grouped and joined, not payloads. Of rows that share the smallest id all are
    responses; null ids come last.
    """
    light = pages.where(F.octet_length("payload") >= least_bytes).select("key", "id", "digest")
    first = light.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n"))
    return light.join(stored(first.where("n > 1 AND refers_to IS NOT NULL"), "revisited"),
                      "digest").where("id IS NULL OR id > refers_to").select(
        "key", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id",
                   url_column: str = "url", payload_column: str = "html",
                   least_bytes: int = LEAST_REVISIT_BYTES,
                   segment_bytes: int = SEGMENT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one WARC record per row, payloads as UTF-8 in chunked HTTP responses.

    Pages with an equal payload and a larger id become revisit records without a body. Blocks over
    ``segment_bytes`` are cut into continuation records. Spark's own writer makes the gzip files,
    so any file system that Spark knows will do, and a retried task leaves no half archive. Null
    payloads are empty; null ids and addresses leave their header out; other columns are ignored.
    """
    rows_in = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"),
        F.encode(F.coalesce(F.col(f"`{payload_column}`"), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows_in.withColumn("key", row_key("id", "url", "payload")).withColumn(
        "digest", F.unhex(F.sha1("payload")))
    joined = keyed.join(revisits(keyed, least_bytes), "key", "left")

    def rows(batch: pa.RecordBatch):
        out = []
        columns = (batch[c].to_pylist() for c in ("id", "url", "payload", "digest", "refers_to"))
        for page, url, payload, digest, refers_to in zip(*columns, strict=True):
            headers = {
                "WARC-Type": "response" if refers_to is None else "revisit",
                "WARC-Record-ID": f"<urn:uuid:{uuid4()}>", "WARC-Date": DATE,
                "WARC-Target-URI": re.sub(r"[\r\n]", "", url or ""),
                "Content-Type": "application/http; msgtype=response",
                "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
                "X-Page-Id": "" if page is None else str(page),
                "X-Payload-Length": str(len(payload))}
            head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    b"Transfer-Encoding: chunked\r\n\r\n")
            if refers_to is not None:
                headers |= {
                    "WARC-Profile":
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    "X-Refers-To-Page-Id": str(refers_to)}
                out.append(serialise(headers, head))
                continue
            for part_headers, part in segments(headers, head + chunked(payload), segment_bytes):
                out.append(serialise(part_headers, part))
        yield {"record": out}

    records = arrow_map(joined, rows, "record binary").select(
        F.col("record").cast("string").alias("value"))
    per_archive = max(1, archive_bytes // (segment_bytes // 4 + 1))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", per_archive).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, whole ones as they are, segmented ones joined.

    ``record_id, type, target_uri, page_id, payload_digest, payload_length, refers_to, payload,
    problem``. Segments may lie in any archive: those of one origin are grouped, ordered by number
    and checked for gaps and for the total length the last one states. ``payload`` is the entity
    after chunked framing is undone, null for revisits and where ``problem`` says what is wrong.
    A task holds one archive, or the segments of one record.
    """
    fields = ("record_id string, type string, target_uri string, page_id string, "
              "payload_digest string, payload_length bigint, refers_to string, origin string, "
              "segment int, total bigint, block binary, problem string")

    def rows(batch: pa.RecordBatch):
        names = [f.split()[0] for f in fields.split(", ")]
        for data in batch["content"].to_pylist():
            out: dict[str, list] = {n: [] for n in names}
            for r in parse(data):
                h = r.headers
                out["record_id"].append(h.get("warc-record-id"))
                out["type"].append(h.get("warc-type"))
                out["target_uri"].append(h.get("warc-target-uri"))
                out["page_id"].append(h.get("x-page-id"))
                out["payload_digest"].append(
                    h.get("warc-payload-digest", "").removeprefix("sha1:") or None)
                out["payload_length"].append(number_in(h, "x-payload-length"))
                out["refers_to"].append(h.get("x-refers-to-page-id"))
                out["origin"].append(h.get("warc-segment-origin-id") or h.get("warc-record-id"))
                out["segment"].append(number_in(h, "warc-segment-number") or 0)
                out["total"].append(number_in(h, "warc-segment-total-length"))
                out["block"].append(r.block)
                out["problem"].append(r.problem or None)
            yield out

    files = spark.read.format("binaryFile").load(path).select("content")
    records = arrow_map(files, rows, fields)
    described = [c for c in records.columns if c not in ("segment", "origin", "block", "problem")]
    whole = records.where("segment = 0").select(*described, F.array("block").alias("blocks"),
                                                "problem")
    parts = records.where("segment > 0").groupBy("origin").agg(F.array_sort(F.collect_list(
        F.struct("segment", *described, "block"))).alias("parts"))
    first, last = F.element_at("parts", 1), F.element_at("parts", -1)
    gap = (first["segment"] != 1) | (last["segment"] != F.size("parts"))
    joined = parts.select(
        *[(last if c == "total" else first)[c].alias(c) for c in described],
        F.transform("parts", lambda p: p["block"]).alias("blocks"),
        F.when(gap, "segments missing or repeated")
        .when(last["total"].isNull(), "total length missing").alias("problem"))
    return arrow_map(
        whole.unionByName(joined), _payloads,
        "record_id string, type string, target_uri string, page_id string, payload_digest string, "
        "payload_length bigint, refers_to string, payload binary, problem string")


def _payloads(batch: pa.RecordBatch):
    kept = ("record_id", "type", "target_uri", "page_id", "payload_digest", "payload_length",
            "refers_to")
    payloads, problems = [], []
    columns = (batch[c].to_pylist() for c in ("type", "blocks", "total", "problem"))
    for kind, blocks, total, problem in zip(*columns, strict=True):
        payload, block = None, b"".join(blocks)
        if problem is None and total is not None and total != len(block):
            problem = "total length differs"
        if kind == "response" and problem is None:
            try:
                payload = http_payload(block)
            except ValueError as wrong:
                problem = str(wrong)
        payloads.append(payload)
        problems.append(problem)
    yield {c: batch[c] for c in kept} | {"payload": payloads, "problem": problems}


def base32_sha1(payload: str = "payload"):
    """RFC 4648 base 32 of the SHA-1: its 160 bits are 32 digits without padding."""
    hexed = F.sha1(payload)
    digits = [F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(
        F.conv(F.substring(hexed, 1 + 10 * (i // 8), 10), 16, 10).cast("bigint"),
        35 - 5 * (i % 8)).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for i in range(32)]
    return F.concat(*digits)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write the pages as archives to the shared folder, and say what reading them back gives."""
    path = f"{shared_folder(spark)}/tarmaq-llm/warc-{uuid4().hex}"
    write_archives(table(spark, folder, "pages"), path)
    back = read_archives(spark, path)
    response = F.col("type") == "response"
    digest = F.when(response, base32_sha1()).otherwise(F.col("payload_digest"))
    return back.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("bigint"))
        .otherwise(F.col("payload_length")).alias("payload_bytes"),
        digest.alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"), "problem",
        (F.col("payload_digest") == digest).alias("digest_verified"))
