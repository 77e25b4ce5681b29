"""Removal of word passages that repeat, by seed and extend on winnowed anchors."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, row_key, table
from tarmaq.llm.minimizers import Prefix, ordered
from tarmaq.llm.repeats import COUNT_BITS, Units, covered, repeated_windows, unpack, with_spans

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
#: Anchors with up to this many different surroundings are extended; around others each window is
#: looked up by its own hash, so that a frequent phrase makes no pairs.
EXTENDED = 64
#: Surroundings that are extended together.
BLOCK = 20_000


def word_symbols(text: bytes) -> np.ndarray:
    """A 64-bit hash per word; ``bytes.split`` parts at exactly the six ASCII white spaces."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _word_cutter(text: bytes):
    words = text.split()
    return lambda start, end: b" ".join(words[start:end])


WORDS = Units(word_symbols, _word_cutter)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading symbols each row of ``a`` shares with the same row of ``b``."""
    same = a == b
    return np.where(same.all(axis=1), a.shape[1], np.argmin(same, axis=1))


def extend(seeds: np.ndarray, slices: list[bytes], counts: np.ndarray, window: int,
           anchor: int) -> np.ndarray:
    """Which windows of each slice match another slice around the same anchor.

    Slices are sorted by seed. From the anchor each pair of a seed is compared to the left and to
    the right as far as it agrees; a repeat of ``window`` words or more marks its windows. The
    result has a row per slice and a column per window.
    """
    reach = window - anchor
    # Beyond a slice stand numbers that agree with nothing else.
    ends = np.arange(2 * len(slices) * reach, dtype=np.uint64).reshape(2, len(slices), reach)
    left, right = ends.copy()
    places = np.empty(len(slices), np.int64)
    for i, data in enumerate(slices):
        symbols = word_symbols(data)
        at = int(ordered(Prefix(symbols).grams(anchor)).argmin())
        before, after = symbols[max(0, at - reach) : at][::-1], symbols[at + anchor :][:reach]
        left[i, : len(before)], right[i, : len(after)] = before, after
        places[i] = at
    change = np.zeros((len(slices), int(counts.max(initial=0)) + 1), np.int32)
    step = 1
    while len(first := np.flatnonzero(seeds[step:] == seeds[:-step])):
        second = first + step
        to_left = _agreement(left[first], left[second])
        to_right = _agreement(right[first], right[second])
        long = to_left + anchor + to_right >= window
        for side in (first[long], second[long]):
            low = np.maximum(places[side] - to_left[long], 0)
            high = np.minimum(places[side] + anchor + to_right[long] - window, counts[side] - 1)
            own = low <= high  # other windows of the match belong to other anchors
            np.add.at(change, (side[own], low[own]), 1)
            np.add.at(change, (side[own], high[own] + 1), -1)
        step += 1
    return np.cumsum(change, axis=1)[:, :-1] > 0


def _ranges(block: dict[str, list], window: int, anchor: int) -> pa.RecordBatch:
    """The ranges of a block's windows that another surrounding of their anchor holds too."""
    start, counts = unpack(np.array(block["place"], np.int64))
    hit = extend(np.array(block["seed"], np.int64), block["data"], counts, window, anchor)
    hit &= (np.array(block["weight"]) == 1)[:, None]
    edges = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edges == 1)
    high = np.nonzero(edges == -1)[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(block["key"], np.int64)[row]),
         pa.array(((start[row] + low) << COUNT_BITS) | (high - low))], ["key", "place"])


def extended_matches(window: int, block: int = BLOCK):
    """``resolve`` for :func:`repeated_windows`: matches are extended around each anchor."""

    def resolve(slices: DataFrame, k: int) -> DataFrame:
        # A fixed number, as the work is in the comparisons and not in the bytes Spark would see.
        parts = int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_seed = slices.select("seed", "key", "place", "weight", "data").repartition(
            parts, "seed").sortWithinPartitions("seed")

        def run(batches):
            held: dict[str, list] = {}
            for batch in batches:
                columns = batch.to_pydict()
                for name, values in columns.items():
                    held.setdefault(name, []).extend(values)
                seeds = held["seed"]
                if len(seeds) < block:
                    continue
                cut = len(seeds)  # the last seed may go on in the next batch
                while cut and seeds[cut - 1] == seeds[-1]:
                    cut -= 1
                if cut:
                    yield _ranges({n: v[:cut] for n, v in held.items()}, window, k)
                    held = {n: v[cut:] for n, v in held.items()}
            if held:
                yield _ranges(held, window, k)

        return by_seed.mapInArrow(run, "key bigint, place bigint")

    return resolve


def repeated_passages(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
                      extended: int = EXTENDED) -> DataFrame:
    """Documents with the places of their repeated passages: ``id, text, places``.

    Anchors are the winnowed ``anchor``-word grams: each window of ``window`` words holds one, and
    equal windows hold the same one at the same offset, so every repeat of ``window`` words or
    more is seeded. A surrounding that occurs again as a whole is kept at once. The other
    surroundings of an anchor are compared in pairs, to the left and to the right of it, as far as
    the next anchor takes over; anchors with more than ``extended`` of them are not paired: around
    these each window is looked up by its own hash. Touching ranges join to the maximal repeats. A
    place is ``start << 24 | windows``.

    Null and short texts have no window and keep all words. Repeated rows repeat each other, so
    all copies lose the passage. An empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(F.col(f"`{id_column}`").alias("id"),
                            F.col(f"`{text_column}`").alias("text"))
    keyed = rows.withColumn("key", row_key("id", "text"))
    texts = keyed.repartition("key")
    spans = repeated_windows(keyed.select("key", "text"), texts, WORDS, window,
                             [anchor], extended, extended_matches(window))
    return with_spans(texts, spans)


def without_passages(found: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``id, n_words, n_removed, text``: the words outside all places, joined by one space."""
    id_type = found.schema["id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch):
        columns = {"id": batch["id"], "n_words": [], "n_removed": [], "text": []}
        for text, places in zip(batch["text"].to_pylist(), batch["places"].to_pylist(),
                                strict=True):
            words = (text or "").encode().split()
            drop = covered(places, len(words), window)
            kept = [w for w, gone in zip(words, drop.tolist(), strict=True) if not gone]
            columns["n_words"].append(len(words))
            columns["n_removed"].append(len(words) - len(kept))
            columns["text"].append(b" ".join(kept).decode())
        yield columns

    return arrow_map(found, rows, f"id {id_type}, n_words bigint, n_removed bigint, text string")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = without_passages(repeated_passages(table(spark, folder, "documents")))
    return cleaned.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
