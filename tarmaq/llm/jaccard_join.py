"""Similarity join of documents on their word n-grams, by MinHash banding."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import WORD, arrow_map, stored, table
from tarmaq.llm.components import connected_components
from tarmaq.llm.minimizers import Prefix, mix
from tarmaq.llm.substring_dedup import word_symbols

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 160
#: Texts that one task compares with one another, or with as many of another block.
BLOCK_TEXTS = 256


@dataclass(frozen=True)
class Banding:
    bands: int
    rows: int

    @classmethod
    def choose(cls, threshold: float, recall: float, most_hashes: int = MOST_HASHES) -> Banding:
        """The longest rows whose bands, within ``most_hashes``, find a pair at ``threshold``
        with probability ``recall``; one row a band if no choice reaches it."""
        best = cls(most_hashes, 1)
        for rows in range(1, most_hashes + 1):
            hit = threshold**rows
            bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
            if bands * rows <= most_hashes:
                best = cls(bands, rows)
        return best


def shingles(text: str | None, n: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of all ``n``-word grams; a shorter text is one gram."""
    words = word_symbols((text or "").encode())
    if len(words) == 0:
        return words
    return np.unique(Prefix(words).grams(min(n, len(words))))


def _sketch(banding: Banding, n: int):
    rng = np.random.default_rng(20)
    size = banding.bands * banding.rows
    factors = rng.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, size, np.uint64)
    weights = rng.integers(0, 2**63, banding.rows, np.uint64) * np.uint64(2) + np.uint64(1)
    numbers = np.arange(banding.bands, dtype=np.uint64)

    def rows(batch: pa.RecordBatch):
        keys, bands = [], []
        for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            grams = shingles(text, n)
            lowest = np.full(size, np.uint64(2**64 - 1))
            for at in range(0, len(grams), 2048):
                part = grams[at : at + 2048, None] * factors
                part += offsets
                np.minimum(lowest, part.min(axis=0), out=lowest)
            parts = mix(lowest).reshape(banding.bands, banding.rows) * weights
            keys.append(key)
            bands.append(mix(parts.sum(axis=1, dtype=np.uint64) + numbers).view(np.int64))
        yield {"key": keys, "bands": bands}

    return rows


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """The number of grams that each two sets share; grams of one set alone are left out."""
    count = np.zeros((len(sets), len(sets)), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = often[gram] > 1
    owner = owner[keep]
    gram = np.unique(gram[keep], return_inverse=True)[1]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    total = int(gram[-1]) + 1 if len(gram) else 0
    for first in range(0, total, 4096):
        a, b = np.searchsorted(gram, [first, first + 4096])
        holds = np.zeros((len(sets), min(4096, total - first)), np.float32)
        holds[owner[a:b], gram[a:b] - first] = 1
        count += np.rint(holds @ holds.T).astype(np.int64)
    return count


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets have a Jaccard similarity of at least ``threshold``; not a set with itself."""
    size = np.array([len(s) for s in sets], np.int64)
    both = _shared(sets)
    either = size[:, None] + size[None, :] - both
    links = both >= threshold * either - 1e-9 * either
    np.fill_diagonal(links, False)
    return links


def _lowest_reachable(links: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys.copy()
    while True:
        around = np.where(links, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(low, around)
        if (new == low).all():
            return low
        low = new


def _compare(threshold: float, n: int):
    def block(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy()
        own = table["block"].to_numpy()
        copies = table["copies"].to_numpy()
        links = linked([shingles(t, n) for t in table["text"].to_pylist()], threshold)
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        if lo != hi:  # pairs inside a block are counted where it meets itself
            links &= own[:, None] != own[None, :]
        return pa.table({
            "key": keys, "low": _lowest_reachable(links, keys),
            "links": (links * copies[None, :]).sum(axis=1)})

    return block


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    threshold: float = THRESHOLD, recall: float = RECALL,
                    n: int = SHINGLE_WORDS, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """``id, class_id, n_links, n_copies`` for every row of ``documents``.

    Equal texts are one text with copies. Each text is hashed to bands; texts that share a band are
    candidates and are chained to the smallest of their bucket, never paired. The groups that
    result hold every candidate pair, so all pairs inside a group are verified on their full gram
    sets, block by block: a group of any size is dealt over tasks of two blocks at most, which
    return counts and one chain link a text, not pairs. ``n_links`` is the number of other rows at
    ``threshold`` or above (equal texts included), ``class_id`` the smallest id that chains of
    such links reach.

    Texts without a word (null included) have no grams: no links and a class of their own. Null ids
    are allowed, and other columns are ignored. Repeated rows count as copies. A pair at the
    threshold itself is found with probability ``recall``, closer ones more surely.
    """
    banding = Banding.choose(threshold, recall)
    text = F.col(f"`{text_column}`")
    rows = documents.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    worded = rows.where(F.col("text").rlike(WORD)).withColumn("key", F.xxhash64("text"))

    sketches = arrow_map(worded.select("key", "text"), _sketch(banding, n),
                         "key bigint, bands array<bigint>")
    sketches = stored(sketches.groupBy("key").agg(F.any_value("bands").alias("bands")),
                      "sketches")
    bands = sketches.select("key", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("size"))
    candidates = bands.join(hubs.where("size > 1"), "band").select(
        F.col("key").alias("a"), F.col("hub").alias("b"))
    groups = stored(connected_components(candidates, "candidates"), "groups")

    copies = worded.groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    blocks = groups.groupBy("component").agg(
        F.ceil(F.count("*") / F.lit(block_texts)).cast("int").alias("blocks"))
    members = groups.join(blocks, "component").join(copies, F.col("node") == F.col("key")).select(
        "key", "component", "blocks", "copies",
        F.pmod(F.xxhash64("key", F.lit(1)), "blocks").cast("int").alias("block"))
    texts = worded.select("key", "text").join(members, "key").dropDuplicates(["key"])
    dealt = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", "key", "text", "copies", "block",
                         F.least("block", "other").alias("lo"),
                         F.greatest("block", "other").alias("hi"))
    verified = stored(dealt.groupBy("component", "lo", "hi").applyInArrow(
        _compare(threshold, n), "key bigint, low bigint, links bigint"), "verified")
    chains = connected_components(
        verified.where("key <> low").select(F.col("key").alias("a"), F.col("low").alias("b")),
        "classes")

    counted = verified.groupBy("key").agg(F.sum("links").alias("links"))
    classes = (copies.join(counted, "key", "left")
               .join(chains.withColumnRenamed("node", "key"), "key", "left")
               .withColumn("component", F.coalesce("component", "key")))
    firsts = classes.groupBy("component").agg(F.min("first").alias("class_id"))
    per_text = classes.join(firsts, "component").select(
        "key", "class_id", "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    keyed = rows.select("id", F.when(F.col("text").rlike(WORD), F.xxhash64("text"))
                        .otherwise(F.xxhash64("id", F.lit("no words"))).alias("key"),
                        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("worded"))
    hit = F.col("worded") & F.col("copies").isNotNull()
    return keyed.join(per_text, "key", "left").select(
        "id", F.when(hit, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.when(hit, F.col("n_links")).otherwise(0).alias("n_links"),
        F.when(hit, F.col("copies")).otherwise(1).alias("n_copies"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
