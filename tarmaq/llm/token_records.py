"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record file is a plain sequence of frames::

    length of the payload   8 bytes, little endian
    masked CRC-32 of those  4 bytes
    payload                 shard, sequence, flags, document id, then the ids, 2 or 4 bytes each
    masked CRC-32 of it     4 bytes
    line feed               1 byte: what Spark's text writer puts after a value

so any file system that Spark knows will do, and a retried task leaves no half file. The index is
a Parquet table beside the files: one row per record with its file, offset and length.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from array import array
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, stored, table
from tarmaq.session import shared_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Text bytes that a record file is cut for; a reader holds one file at a time.
SHARD_BYTES = 16 << 20
#: The starts of so many files, 12 bytes each, are broadcast to the readers.
BROADCAST_FILES = 1 << 20
#: A worker remembers the words of about this many to twice as many, and no longer ones.
REMEMBERED_WORDS, REMEMBERED_LETTERS, REMEMBERED_SIGNS = 120_000, 48, 10_000
#: Signs that part from a letter before them in every text; none is part of a special token.
_CLOSING = ".,;:!?%$#*&)]}'\""
#: Letters with one lower-case form of one letter, and no form in which they would be composed.
_LATIN = "".join(c for c in map(chr, range(0x41, 0x17F))
                 if c.isalpha() and c not in "\u00aa\u00b5\u00ba\u0130")
_LETTERS = re.compile(f"[{_LATIN}]+").fullmatch
_TYPES = {2: "H", 4: "I"}

_LENGTH, _CHECK, _HEADER = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<IQBBq")
_FRAME_BYTES = _LENGTH.size + 2 * _CHECK.size + 1
#: Keeps a checksum of bytes that hold checksums from being trivial.
_MASK = 0xA282EAD8

RECORD = ("shard int, sequence bigint, id bigint, n_tokens bigint, before bigint, offset bigint, "
          "length bigint, problem string")


def masked(data: bytes) -> bytes:
    """The CRC-32, rotated and shifted by a constant."""
    crc = zlib.crc32(data)
    return _CHECK.pack((((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF)


def frame(payload: bytes) -> bytes:
    """One record without its line feed, which the writer adds."""
    length = _LENGTH.pack(len(payload))
    return b"".join((length, masked(length), payload, masked(payload)))


def unframe(data: bytes, at: int) -> tuple[bytes | None, int, str | None]:
    """Payload at an offset, where the next frame starts, and what is wrong.

    A damaged length leaves no way on in this file: the next start is then the end of the data.
    """
    body = at + _LENGTH.size + _CHECK.size
    length = data[at : at + _LENGTH.size]
    if len(data) < body or masked(length) != data[at + _LENGTH.size : body]:
        return None, len(data), "length damaged"
    end = body + _LENGTH.unpack(length)[0]
    if len(data) < end + _CHECK.size:
        return None, len(data), "record cut off"
    payload = data[body:end]
    wrong = None if masked(payload) == data[end : end + _CHECK.size] else "checksum differs"
    return payload, end + _CHECK.size + 1, wrong


def id_width(vocabulary: int) -> int:
    """Bytes for an id: two are enough for vocabularies of up to 65,536."""
    return 2 if vocabulary <= 1 << 16 else 4


def payload_of(shard: int, sequence: int, key: int | None, ids: bytes, width: int) -> bytes:
    return _HEADER.pack(shard, sequence, key is None, width, key or 0) + ids


def parts_of(payload: bytes | None) -> tuple:
    """``shard, sequence, id, ids``; the ids take 4 bytes each. Null and empty for no payload."""
    if payload is None:
        return None, None, None, b""
    shard, sequence, no_key, width, key = _HEADER.unpack_from(payload)
    ids = payload[_HEADER.size :]
    if width != 4:
        ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
    return shard, sequence, None if no_key else key, ids


class Encoder:
    """Ids of texts by the tokenizers library, remembered for each run between white space.

    Neither the normaliser nor the splitting of this tokenizer reaches over an ASCII white space,
    so the ids of a text are those of its runs, one after the other. A new run of Latin letters
    with closing signs is given to the library's BPE model as the two words that the splitting
    makes of it, in the form that the normaliser gives them; any other run goes through the whole
    library. Tests hold both against whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.width = id_width(self.library.get_vocab_size())
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LATIN}
        self.signs: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return array(_TYPES[self.width], ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """The ids of lower-case letters. Words that stay in use stay remembered."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self._packed(
                    [t.id for t in self.library.model.tokenize(word.translate(self.spelt))])
            if len(word) <= REMEMBERED_LETTERS:
                self.words[word] = ids
        return ids

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The ids of each run."""
        if len(self.words) > REMEMBERED_WORDS:
            self.older, self.words = self.words, {}
        if len(self.signs) > REMEMBERED_SIGNS:
            self.signs = {"": b""}
        out, signs = [], self.signs
        for run in runs:
            core = run.rstrip(_CLOSING)
            if _LETTERS(core):
                closing = run[len(core) :]
                if closing not in signs:
                    signs[closing] = self._whole(closing)
                out.append(self._word(core.lower()) + signs[closing])
            else:
                out.append(self._whole(run))
        return out

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers of ``width`` bytes."""
        parted = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = parted.flatten().dictionary_encode()
        ids = self._runs(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(ids), f"<u{self.width}")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        firsts = np.cumsum(sizes) - sizes
        places = coded.indices.to_numpy()
        lengths = sizes[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        data = flat[np.repeat(firsts[places] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(parted).to_numpy())])
        borders = (ends[borders] * self.width).tolist()
        return [data[a:b] for a, b in zip(borders, borders[1:], strict=False)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one for all tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def write_records(documents: DataFrame, path: str, tokenizer: str | None = None,
                  id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID,
                  shard_bytes: int = SHARD_BYTES, batch_texts: int = 1000) -> None:
    """Encode every whole text, append ``end_id`` and write one record per row below ``path``.

    Records lie in ascending order of id, null ids first, rows of one id by a hash of their text;
    repeated rows are records of their own, and their place among each other makes no difference.
    The rows are sorted by range, so no task holds more than about ``shard_bytes`` of text, or one
    text that is longer; a row number breaks ties, so an id with very many rows is split too. Null
    and empty texts hold only ``end_id``. An empty table gives no record; other columns are
    ignored, whatever their names. ``tokenizer`` is a file that every executor has.
    """
    tokenizer = tokenizer or default_tokenizer()
    text = F.col(f"`{text_column}`")
    rows_in = documents.select(F.col(f"`{id_column}`").cast("bigint").alias("id"),
                               text.alias("text"), F.xxhash64(text).alias("tie"),
                               F.monotonically_increasing_id().alias("row"))
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    place = ["id", "tie", "row"]
    shards = rows_in.repartitionByRange(max(1, math.ceil(size / shard_bytes)), *place)
    ordered = shards.sortWithinPartitions(*place).select(
        F.spark_partition_id().alias("shard"), "id", "text")

    def run(batches):
        own, sequence = encoder(tokenizer), 0
        end = end_id.to_bytes(own.width, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, batch_texts):
                part = batch.slice(at, batch_texts)
                columns = (part[c].to_pylist() for c in ("shard", "id"))
                ids = own.encode(part["text"])
                frames = []
                for shard, key, tokens in zip(*columns, ids, strict=True):
                    frames.append(frame(payload_of(
                        shard, sequence, key, tokens + end, own.width)))
                    sequence += 1
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["record"])

    records = ordered.mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\n").text(f"{path}/records")
    scanned = scan_records(documents.sparkSession, path, with_ids=False)
    scanned.drop("ids").write.parquet(f"{path}/index")


def _scan(with_ids: bool):
    """Rows of ``RECORD``, and the ids as bytes, of whole files."""
    names = [f.split()[0] for f in RECORD.split(", ")]

    def rows(batch: pa.RecordBatch):
        for file, data in zip(batch["file"].to_pylist(), batch["content"].to_pylist(),
                              strict=True):
            out: dict[str, list] = {n: [] for n in [*names, "ids"]}
            at = before = 0
            while at < len(data):
                payload, following, problem = unframe(data, at)
                shard, sequence, key, ids = parts_of(payload)
                values = (shard, sequence, key, len(ids) // 4, before, at,
                          min(following, len(data)) - at, problem)
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
                out["ids"].append(ids if with_ids and problem is None else None)
                before += len(ids) // 4
                at = following
            yield out | {"file": [file] * len(out["ids"])}

    return rows


def _files(spark: SparkSession, path: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(
        f"{path}/records")
    return listed.select(F.col("_metadata.file_name").alias("file"), "content")


def scan_records(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every record below ``path``, file by file: the columns of ``RECORD``, ``ids``, ``file``.

    ``ids`` are little-endian unsigned 32-bit integers, null where ``problem`` says what is wrong;
    ``before`` counts the ids before the record in its file. A task holds one file.
    """
    return arrow_map(_files(spark, path), _scan(with_ids),
                     f"{RECORD}, ids binary, file string")


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: ``file, offset, length`` of each record, its id, place and ids."""
    return spark.read.parquet(f"{path}/index")


def shard_starts(index: DataFrame) -> DataFrame:
    """``shard, first``: the ids in all files before. One row per file meets in one task."""
    totals = index.where("problem IS NULL").groupBy("shard").agg(
        F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("tokens").over(earlier),
                                             F.lit(0)).alias("first"))


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``records`` of :func:`scan_records` with ``start``: the ids in the whole data set before.

    One row per file is broadcast as long as there are at most ``BROADCAST_FILES``; beyond that
    Spark joins by shard, so drop ``ids`` first where they are not needed.
    """
    first = stored(shard_starts(index), "starts")
    if first.count() <= BROADCAST_FILES:
        first = F.broadcast(first)
    return records.join(first, "shard", "left").withColumn(
        "start", F.col("first") + F.col("before"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record in its place: ``id, start, n_tokens, ids, problem`` and more."""
    return with_starts(scan_records(spark, path), record_index(spark, path))


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in an order that only ``seed`` decides: ``rank, id, ids, problem``.

    Each file is cut at the offsets of the index, not by following lengths, so a record behind a
    damaged length is still found. Partitions and the rows in them are ordered by ``rank``.
    """
    index = record_index(spark, path).where("problem IS NULL")
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("offset", "length", F.xxhash64(
        F.lit(seed), "shard", "sequence").alias("rank"))).alias("places"))

    def rows(batch: pa.RecordBatch):
        for data, places in zip(batch["content"].to_pylist(), batch["places"].to_pylist(),
                                strict=True):
            out: dict[str, list] = {n: [] for n in ("rank", "id", "ids", "problem")}
            for place in places:
                cut = data[place["offset"] : place["offset"] + place["length"]]
                payload, _, problem = unframe(cut, 0)
                _, _, key, ids = parts_of(payload)
                for name, value in (("rank", place["rank"]), ("id", key), ("problem", problem),
                                    ("ids", ids if problem is None else None)):
                    out[name].append(value)
            yield out

    found = arrow_map(_files(spark, path).join(wanted, "file"), rows,
                      "rank bigint, id bigint, ids binary, problem string")
    return found.orderBy("rank")


def token_array(ids: bytes) -> list[int]:
    """The ids of a record as integers."""
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def op13_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """Write the documents' ids to the shared folder, and say what reading them back gives."""
    path = f"{shared_folder(spark)}/tarmaq-llm/tokens-{uuid4().hex}"
    write_records(table(spark, folder, "documents"), path)
    light = scan_records(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(light, record_index(spark, path)).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "problem")
