"""Which windows of a corpus occur more than once: the common part of both repeat removals.

Windows are found through seeds. Every window of ``window`` symbols chooses one of its ``k``-grams
(smallest hash, rightmost tie), so equal windows choose equal grams at equal offsets, and
neighbouring windows mostly choose the same one. A *run* of such windows is one row: the seed, the
hash of all symbols the run covers (its context), the document and the place. Then

* seeds that occur once are dropped: none of their windows can repeat;
* a context that occurs twice or more is settled: all its windows repeat;
* of the other contexts around a seed, and one occurrence of each settled one, the single windows
  are compared: by ``resolve`` for seeds with up to ``cap`` contexts, and for the rest by
  starting again with longer seeds, in the end with the window itself as the key. Only these
  slices of the texts are kept for that.

No step gathers the occurrences of one seed or context, only its different contexts where these
are few: counts are combined before each shuffle and come back by equi-joins, whose hot keys Spark
splits. What is used twice is a table, so each text is hashed once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmaq.llm.common import arrow_map, stored
from tarmaq.llm.minimizers import BASES, Prefix, Runs, mix, runs

RUNS = "seed bigint, context bigint, key bigint, place bigint, weight int"
SLICES = RUNS + ", data binary"
COUNT_BITS = 24


@dataclass(frozen=True)
class Units:
    """What a text is counted in: a 64-bit symbol per unit, and the bytes of some units."""

    symbols: Callable[[bytes], np.ndarray]
    cutter: Callable[[bytes], Callable[[int, int], bytes]]


def pack(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A place: the first window of a range, and how many windows follow from there."""
    return (start.astype(np.int64) << COUNT_BITS) | count.astype(np.int64)


def unpack(place):
    return place >> COUNT_BITS, place & ((1 << COUNT_BITS) - 1)


def _columns(parts: list[dict], schema: str) -> dict:
    names = [field.split()[0] for field in schema.split(", ")]
    out = {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64)
           for c in names if c != "data"}
    if "data" in names:
        out["data"] = [data for p in parts for data in p["data"]]
    return out


def _run_columns(found: Runs, key: int, weight: int, offset: int = 0) -> dict:
    size = len(found.start)
    return {"seed": found.seed.view(np.int64), "context": found.context.view(np.int64),
            "key": np.full(size, key), "place": pack(found.start + offset, found.count),
            "weight": np.full(size, weight, np.int32)}


def _document_runs(units: Units, window: int, k: int):
    """Rows of ``RUNS`` for whole texts."""

    def rows(batch: pa.RecordBatch):
        parts = []
        for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            symbols = units.symbols((text or "").encode())
            if len(symbols) >= window:
                parts.append(_run_columns(runs(Prefix(symbols), window, k), key, 1))
        yield _columns(parts, RUNS)

    return rows


def _slices(units: Units, window: int):
    """The bytes of each range that is still open."""

    def rows(batch: pa.RecordBatch):
        out = {c: [] for c in ("seed", "key", "place", "weight", "width", "data")}
        for key, text, ranges in zip(batch["key"].to_pylist(), batch["text"].to_pylist(),
                                     batch["ranges"].to_pylist(), strict=True):
            cut = units.cutter(text.encode())
            for r in ranges:
                start, count = unpack(r["place"])
                out["key"].append(key)
                out["data"].append(cut(start, start + count - 1 + window))
                for c in ("seed", "place", "weight", "width"):
                    out[c].append(r[c])
        yield out

    return rows


def _slice_runs(units: Units, window: int, k: int):
    """Rows of ``SLICES`` for the windows of slices, of which each is short."""

    def rows(batch: pa.RecordBatch):
        parts = []
        for key, place, weight, data in zip(*(batch[c].to_pylist() for c in (
                "key", "place", "weight", "data")), strict=True):
            start, count = unpack(place)
            found = runs(Prefix(units.symbols(data)), window, k)
            part = _run_columns(found, key, weight, start)
            cut = units.cutter(data)
            part["data"] = [cut(a, a + n - 1 + window) for a, n in zip(
                found.start.tolist(), found.count.tolist(), strict=True)]
            parts.append(part)
        yield _columns(parts, SLICES)

    return rows


def _slice_windows(units: Units, window: int):
    """Rows of ``RUNS`` for each window of a slice alone, with two hashes of all its symbols."""

    def rows(batch: pa.RecordBatch):
        parts = []
        for key, place, weight, data in zip(*(batch[c].to_pylist() for c in (
                "key", "place", "weight", "data")), strict=True):
            first, count = unpack(place)
            symbols = units.symbols(data)
            start = np.arange(count)
            parts.append({
                "seed": Prefix(symbols).slices(start, start + window).view(np.int64),
                "context": Prefix(mix(symbols), BASES[1]).slices(start, start + window)
                .view(np.int64),
                "key": np.full(count, key), "weight": np.full(count, weight, np.int32),
                "place": pack(start + first, np.ones(count, np.int64))})
        yield _columns(parts, RUNS)

    return rows


def _judge(found: DataFrame, label: str) -> DataFrame:
    """The runs of seeds that occur again, with what is known of their windows.

    ``settled``: the whole context occurs again. ``open``: its windows are yet to be compared with
    those of other contexts around the seed, of which there are ``width``.

    What the runs are joined with is a table, not an aggregate: then both sides of the join come
    straight from a shuffle, and Spark can split a seed or context with very many runs.
    """
    found = stored(found, f"{label}-runs")
    frequent = found.groupBy("seed").agg(F.sum("weight").alias("total")).where("total > 1")
    hits = stored(found.join(stored(frequent.select("seed"), f"{label}-frequent"), "seed"),
                  f"{label}-hits")
    counted = stored(hits.groupBy("seed", "context").agg(
        F.sum("weight").alias("total"), F.min("key").alias("owner")), f"{label}-counted")
    widths = (counted.groupBy("seed").agg(F.count("*").alias("width")).where("width > 1"))
    contexts = stored(counted.join(widths, "seed", "left"), f"{label}-contexts")
    first = (F.col("total") == 1) | (F.col("key") == F.col("owner"))
    return stored(
        hits.join(contexts, ["seed", "context"]).select(
            *[c for c in hits.columns if c != "context"], (F.col("total") > 1).alias("settled"),
            (F.col("width").isNotNull() & first).alias("open"), "width"),
        f"{label}-judged")


def repeated_windows(documents: DataFrame, texts: DataFrame, units: Units, window: int,
                     seeds: Sequence[int], cap: int = 1,
                     resolve: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Ranges of windows (``key, place``) whose symbols also start anywhere else.

    ``documents`` and ``texts`` both hold ``key`` and ``text``; ``texts`` is hashed by ``key``.
    ``seeds`` are the seed lengths, ascending, all below ``window``. ``resolve`` takes slices
    (``seed, key, place, weight, width, data``) and the length of their seed, and returns
    ``key, place`` for those of weight 1.
    """
    spans: list[DataFrame] = []
    slices = None
    for k in seeds:
        if slices is None:
            found = arrow_map(documents, _document_runs(units, window, k), RUNS)
        else:
            found = arrow_map(slices, _slice_runs(units, window, k), SLICES)
        judged = _judge(found, f"seeds-{k}")
        spans.append(judged.where("settled AND weight = 1").select("key", "place"))
        opened = judged.where("open").withColumn(
            "weight", F.when(F.col("settled"), 2).otherwise(F.col("weight")))
        if slices is None:  # one row per document; it has no more ranges than windows
            ranges = opened.groupBy("key").agg(F.collect_list(
                F.struct("seed", "place", "weight", "width")).alias("ranges"))
            slices = stored(arrow_map(
                texts.join(ranges, "key"), _slices(units, window),
                "seed bigint, key bigint, place bigint, weight int, width bigint, data binary"),
                f"slices-{k}")
        else:
            slices = opened
        if resolve is not None:
            spans.append(resolve(slices.where(F.col("width") <= cap), k).select("key", "place"))
            slices = slices.where(F.col("width") > cap)
        if slices.isEmpty():
            break
    else:
        found = stored(arrow_map(slices, _slice_windows(units, window), RUNS), "windows")
        counts = found.groupBy("seed", "context").agg(F.sum("weight").alias("total"))
        repeated = stored(counts.where("total > 1"), "windows-repeated")
        spans.append(found.where("weight = 1").join(repeated, ["seed", "context"]).select(
            "key", "place"))
    return reduce(DataFrame.unionByName, spans)


def covered(places, n: int, window: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a window of the given ranges."""
    if places is None or len(places) == 0:
        return np.zeros(n, bool)
    start, count = unpack(np.asarray(places, np.int64))
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + count - 1 + window, -1)
    return np.cumsum(change[:n]) > 0


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Each text with the places found in it; texts without any keep a null."""
    by_document = spans.groupBy("key").agg(F.collect_list("place").alias("places"))
    return texts.join(by_document, "key", "left")
