"""Removal of long repeated byte strings with run-length compressed Burrows-Wheeler indexes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, row_key, table
from tarmaq.llm.minimizers import Prefix, mix, ordered
from tarmaq.llm.repeats import COUNT_BITS, Units, covered, repeated_windows, unpack, with_spans

WINDOW_BYTES = 400
SEED_BYTES = (256, 385)
#: A block of the index closes at this many symbols, at the end of a seed.
BLOCK_SYMBOLS = 1 << 17
#: Seeds with more contexts than this are split by longer seeds instead of being indexed whole.
LARGEST_SEED = 1024

_BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))


def byte_symbols(text: bytes) -> np.ndarray:
    return _BYTE_SYMBOLS[np.frombuffer(text, np.uint8)]


BYTES = Units(byte_symbols, lambda text: lambda start, end: text[start:end])


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform with samples at the ends of its runs.

    Only the run heads and tails keep their text position and the length of the match with their
    neighbour in suffix order. Inside a run that length falls by one from a text position to the
    next, so the samples give the matching statistics of the whole text in one pass over it.
    The last symbol of ``text`` must occur once.
    """

    def __init__(self, text: np.ndarray):
        n = len(text)
        levels = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
        step = 1
        while levels[-1].max() < n - 1 and step < n:
            later = np.zeros(n, np.int64)
            later[: n - step] = levels[-1][step:] + 1
            levels.append(np.unique(levels[-1] * (n + 1) + later, return_inverse=True)[1])
            step *= 2
        suffixes = np.empty(n, np.int64)
        suffixes[levels[-1]] = np.arange(n)
        bwt = text[suffixes - 1]
        heads = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.n = n
        self.n_runs = len(heads) + 1
        self.run_symbols = bwt[np.append(0, heads)]
        lengths = self._match_lengths(levels, suffixes[heads], suffixes[heads - 1])
        self.head_places, self.head_lengths = suffixes[heads], lengths
        self.tail_places, self.tail_lengths = suffixes[heads - 1], lengths

    @staticmethod
    def _match_lengths(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at ``a`` and ``b`` agree, by halving steps over the ranks."""
        total, n = np.zeros(len(a), np.int64), len(levels[0])
        for level in range(len(levels) - 1, -1, -1):
            x, y = a + total, b + total
            inside = np.maximum(x, y) < n
            same = inside.copy()
            same[inside] = levels[level][x[inside]] == levels[level][y[inside]]
            total += same.astype(np.int64) << level
        return total

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest match of the text from there with any other place."""
        best = np.zeros(self.n, np.int64)
        for places, lengths in ((self.head_places, self.head_lengths),
                                (self.tail_places, self.tail_lengths)):
            sampled = np.full(self.n, -1, np.int64)
            sampled[places] = places
            value = np.zeros(self.n, np.int64)
            value[places] = lengths
            nearest = np.maximum.accumulate(sampled)
            found = np.where(nearest >= 0, value[nearest] - (np.arange(self.n) - nearest), 0)
            np.maximum(best, found, out=best)
        return best


def _flanks(k: int):
    """The bytes to both sides of each slice's seed."""

    def rows(batch: pa.RecordBatch):
        out = {c: batch[c] for c in ("seed", "key", "place", "weight")}
        ahead, behind = [], []
        for data in batch["data"].to_pylist():
            grams = Prefix(byte_symbols(data)).grams(k)
            seed = int(ordered(grams).argmin())
            ahead.append(data[:seed])
            behind.append(data[seed + k :])
        yield out | {"ahead": ahead, "behind": behind}

    return rows


def _matches(block: dict[str, list], needed: int) -> dict[str, list]:
    """The ranges of a block's windows that match another context."""
    seeds = np.unique(np.array(block["seed"], np.int64), return_inverse=True)[1]
    parts, starts, at = [], [], 0
    first_end = 256 + int(seeds.max()) + 1
    for i, (ahead, behind) in enumerate(zip(block["ahead"], block["behind"], strict=True)):
        part = np.empty(len(ahead) + len(behind) + 2, np.int64)
        part[: len(ahead)] = np.frombuffer(ahead, np.uint8)
        part[len(ahead)] = 256 + seeds[i]  # the seed, equal for all contexts around it
        part[len(ahead) + 1 : -1] = np.frombuffer(behind, np.uint8)
        part[-1] = first_end + i  # an end that matches nothing
        parts.append(part)
        starts.append(at)
        at += len(part)
    statistics = RunLengthIndex(np.concatenate(parts)).matching_statistics()
    out = {"key": [], "place": []}
    for i, place in enumerate(block["place"]):
        if block["weight"][i] != 1:
            continue
        start, count = unpack(place)
        hit = statistics[starts[i] : starts[i] + count] >= needed
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2).tolist():
            out["key"].append(block["key"][i])
            out["place"].append(((start + a) << COUNT_BITS) | (b - a))
    return out


def indexed_matches(window: int, block_symbols: int = BLOCK_SYMBOLS):
    """``resolve`` for :func:`repeated_windows`: an index for each block of whole seeds."""

    def resolve(slices: DataFrame, k: int) -> DataFrame:
        flanks = arrow_map(slices, _flanks(k), "seed bigint, key bigint, place bigint, "
                           "weight int, ahead binary, behind binary")
        # A fixed number, as the work is in the sorting and not in the bytes that Spark would see.
        parts = int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_seed = flanks.repartition(parts, "seed").sortWithinPartitions("seed")

        def run(batches):
            block: dict[str, list] = {}
            symbols = 0

            def close():
                return pa.RecordBatch.from_pydict(
                    _matches(block, window - k + 1),
                    pa.schema([("key", pa.int64()), ("place", pa.int64())]))

            for batch in batches:
                columns = batch.to_pydict()
                for row in range(batch.num_rows):
                    new = block and columns["seed"][row] != block["seed"][-1]
                    if new and symbols >= block_symbols:
                        yield close()
                        block, symbols = {}, 0
                    for name, values in columns.items():
                        block.setdefault(name, []).append(values[row])
                    symbols += len(columns["ahead"][row]) + len(columns["behind"][row]) + 2
            if block:
                yield close()

        return by_seed.mapInArrow(run, "key bigint, place bigint")

    return resolve


def repeated_strings(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     window: int = WINDOW_BYTES, seeds: tuple[int, ...] = SEED_BYTES,
                     largest_seed: int = LARGEST_SEED,
                     block_symbols: int = BLOCK_SYMBOLS) -> DataFrame:
    """Documents with the places of byte strings of ``window`` bytes that start twice or more.

    The corpus is cut into contexts around shared seeds, and equal contexts are folded to one, so
    what is left is short and repetitive. Whole seeds are gathered to blocks of about
    ``block_symbols``; each block gets a :class:`RunLengthIndex` in which a seed is one symbol, and
    its matching statistics mark the windows that another context holds too. Seeds with more than
    ``largest_seed`` contexts are split by the longer ``seeds`` and, at last, by whole windows,
    so that no block depends on how often a string occurs.

    Result: ``id, text, key, places``. Null texts are empty; repeated rows repeat each other; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = documents.select(F.col(f"`{id_column}`").alias("id"),
                            F.col(f"`{text_column}`").alias("text"))
    keyed = rows.withColumn("key", row_key("id", "text"))
    texts = keyed.repartition("key")
    spans = repeated_windows(keyed.select("key", "text"), texts, BYTES, window, seeds,
                             largest_seed, indexed_matches(window, block_symbols))
    return with_spans(texts, spans)


def without_strings(found: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept``: the bytes outside all places, as binary.

    What stays may cut a character in two, so it is no string.
    """
    id_type = found.schema["id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch):
        out = {"id": batch["id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for text, places in zip(batch["text"].to_pylist(), batch["places"].to_pylist(),
                                strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            gone = covered(places, len(data), window)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum()))
            out["kept"].append(data[~gone].tobytes())
        yield out

    return arrow_map(found, rows, f"id {id_type}, n_bytes bigint, n_removed bigint, "
                     "n_spans bigint, kept binary")


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = without_strings(repeated_strings(table(spark, folder, "documents")))
    return cleaned.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))
