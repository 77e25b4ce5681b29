"""Hard negatives for anchors of an embedding table, by threshold joins in the manner of L2AP."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmaq.llm.common import stored, table

N_POSITIVES, N_NEGATIVES = 5, 5
#: A negative scores between these hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Hundredths of a positive's score down to which negatives are looked for, round by round.
THRESHOLDS = (95, 90, LOW)
#: Rows of an index, and anchors that meet one: what a task holds at a time.
INDEX_ROWS, ANCHOR_ROWS = 8192, 4096
#: Anchors that are scored together, and dimensions that are added between two prunings.
TILE, STEP = 256, 8
#: Rows longer than this take no part: their scores might not fit in 64 bits.
LONGEST_SQUARED = 2.0**62

#: One row or anchor; ``mark`` is a hash of its content, and equal rows are one.
ROW = ["id", "label", "mark", "vector"]
FOUND = "anchor bigint, window bigint, id bigint, label bigint, mark bigint, score bigint"
_NAMES = [field.split()[0] for field in FOUND.split(", ")]


class SuffixBoundIndex:
    """An inverted index over integer vectors that leaves out what no score needs.

    Dimensions stand in the order of their weight in this block. Row ``x`` is listed under its
    dimensions up to the first from which on ``|x_j..| * |q_j..|`` stays below the lowest threshold
    for every anchor ``q``: a pair that meets in omitted dimensions alone cannot reach it. Rows
    are sorted by the number of their lists, so each list is a prefix of the rows.
    """

    def __init__(self, vectors: np.ndarray, anchors: np.ndarray, threshold: float):
        order = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0), kind="stable")
        self.anchors = anchors[:, order]
        self.anchor_rest = suffix_norms(self.anchors)
        rest = suffix_norms(vectors[:, order])
        bound = rest * self.anchor_rest.max(axis=0, initial=0.0)
        # Bounds fall from left to right, so those that reach the threshold are the first ones.
        lists = (reaches(bound[:, :-1], threshold)).sum(axis=1)
        self.rows = np.argsort(-lists, kind="stable")[: int((lists > 0).sum())]
        if not math.isfinite(threshold) or threshold <= 0:  # every row may score that much
            self.rows, lists = np.arange(len(vectors)), np.full(len(vectors), vectors.shape[1])
        self.lists = lists[self.rows]
        self.vectors = vectors[self.rows][:, order]
        self.rest = rest[self.rows]

    def search(self, tile: slice, thresholds: np.ndarray) -> tuple[np.ndarray, ...]:
        """``anchor, row, score`` of every pair that reaches its anchor's threshold.

        Partial scores are added over the lists of some dimensions at a time; after that a pair is
        dropped when even its remaining norms cannot bring it to the threshold.
        """
        anchors, anchor_rest = self.anchors[tile], self.anchor_rest[tile]
        width = self.vectors.shape[1]
        end = 0
        partial = np.zeros((len(anchors), len(self.rows)), anchors.dtype)
        alive = np.ones(partial.shape, bool)
        for at in range(0, width, STEP):
            listed = int(np.searchsorted(-self.lists, -at))  # rows with a list from here on
            if listed == 0:
                break
            end = min(at + STEP, width)
            partial[:, :listed] += anchors[:, at:end] @ self.vectors[:listed, at:end].T
            most = partial[:, :listed] + np.outer(anchor_rest[:, end], self.rest[:listed, end])
            alive[:, :listed] &= reaches(most, thresholds[:, None])
            if alive[:, :listed].mean() < 0.05:
                break
        a, x = np.nonzero(alive)
        score = partial[a, x]
        added = np.minimum(-(-self.lists // STEP) * STEP, end)
        part = np.flatnonzero(added[x] < width)  # pairs of which dimensions are still missing
        for at in range(0, len(part), 65536):
            i = part[at : at + 65536]
            score[i] = np.einsum("ij,ij->i", anchors[a[i]], self.vectors[x[i]])
        good = score >= thresholds[a]
        return a[good], self.rows[x[good]], score[good]


def reaches(bound: np.ndarray, threshold) -> np.ndarray:
    """Whether a bound of rounded norms may reach a threshold."""
    return bound * (1 + 1e-9) + 1e-6 >= threshold


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """``[:, j]``: the length of each row without its first ``j`` components."""
    squares = np.cumsum((vectors.astype(float) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(vectors), 1))]))


def matrices(*sides: list[list[int]]) -> list[np.ndarray]:
    """Rows of any lengths as matrices of one width; missing components are zero.

    Floats where all sums stay exact in them, else 64-bit integers.
    """
    width = max((len(v) for side in sides for v in side), default=0) or 1
    out = []
    for side in sides:
        full = np.zeros((len(side), width), np.int64)
        for i, vector in enumerate(side):
            full[i, : len(vector)] = vector
        out.append(full)
    longest = [suffix_norms(m)[:, 0].max(initial=0.0) for m in out]
    exact = math.prod(longest) < 2**52
    return [m.astype(np.float64) for m in out] if exact else out


def _column(found: pa.Table, name: str) -> np.ndarray:
    """Null ids as the largest number, so that they come last among ties."""
    return found[name].combine_chunks().fill_null(2**63 - 1).to_numpy()


def _window_search(rows: pa.Table, anchors: pa.Table, same_label: bool, n: int) -> pa.Table:
    """The best rows of one block for each window of each anchor.

    A window is ``key, floor, top``: scores from ``floor`` to ``top``, null for no limit. The index
    is built for the lowest floor.
    """
    vectors, probes = matrices(rows["vector"].to_pylist(), anchors["vector"].to_pylist())
    ids, labels, marks = (_column(rows, c) for c in ("id", "label", "mark"))
    own_label, own_mark = (_column(anchors, c) for c in ("label", "mark"))
    windows = anchors["windows"].to_pylist()
    floors = np.array([min(-math.inf if w["floor"] is None else w["floor"] for w in ws)
                       for ws in windows], float)
    floors = np.where(np.isfinite(floors), floors - np.abs(floors) * 1e-12, floors)
    index = SuffixBoundIndex(vectors, probes, floors.min(initial=math.inf))
    chosen_rows, found = [], {"anchor": [], "window": [], "score": []}
    for at in range(0, len(windows), TILE):
        tile = slice(at, at + TILE)
        of, row, score = index.search(tile, floors[tile])
        fit = (labels[row] == own_label[tile][of]) == same_label
        fit &= marks[row] != own_mark[tile][of]
        of, row, score = of[fit], row[fit], score[fit]
        edges = np.searchsorted(of, np.arange(len(windows[tile]) + 1))
        for i, ws in enumerate(windows[tile]):
            r, s = row[edges[i] : edges[i + 1]], score[edges[i] : edges[i + 1]]
            order = np.lexsort((marks[r], labels[r], ids[r], -s))
            r, s = r[order], s[order]
            for w in ws:
                first = 0 if w["top"] is None else np.searchsorted(-s, -w["top"])
                last = len(s) if w["floor"] is None else np.searchsorted(
                    -s, -w["floor"], side="right")
                best = slice(first, min(first + n, max(first, last)))
                chosen_rows.append(r[best])
                found["score"].append(s[best].astype(np.int64))
                size = len(chosen_rows[-1])
                found["anchor"].extend([own_mark[at + i]] * size)
                found["window"].extend([w["key"]] * size)
    found["score"] = np.concatenate(found["score"])
    places = np.concatenate(chosen_rows)
    taken = rows.select(["id", "label", "mark"]).take(places)
    columns = {"anchor": pa.array(found["anchor"], pa.int64()),
               "window": pa.array(found["window"], pa.int64()),
               "score": pa.array(found["score"]), **dict(zip(taken.column_names, taken.columns,
                                                             strict=True))}
    return pa.table({name: columns[name] for name in _NAMES})


def threshold_join(rows: DataFrame, anchors: DataFrame, keys: list[str], n_blocks: int,
                   same_label: bool, n: int, groups: int) -> DataFrame:
    """``FOUND``: per anchor and window, the best ``n`` rows of each block of rows.

    Rows are dealt to blocks by their mark, within ``keys``; anchors go to every block and are
    dealt to ``groups``, to which the rows are copied. So a task holds one block of each, however
    many rows share a label, a vector or an anchor.
    """
    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = rows.select(*ROW, F.pmod("mark", F.lit(n_blocks)).cast("int").alias("slot")).select(
        "*", every(groups).alias("part"))
    right = anchors.select(*ROW, "windows", F.pmod(F.xxhash64("mark"), F.lit(groups)).cast("int")
                           .alias("part")).select("*", every(n_blocks).alias("slot"))

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in _NAMES})
        return _window_search(mine, theirs, same_label, n)

    by = [*keys, "slot", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, FOUND)


def best_of(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key by score, then id (null last); ``rank`` counts from 1."""
    order = [F.desc("score"), F.asc_nulls_last("id"), "label", "mark"]
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def comparable(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
               label_column: str = "label", scale: int = 256) -> DataFrame:
    """The rows that take part, as ``ROW``: components become ``floor(scale * x)``.

    Without: null labels, null vectors, null or non-finite components, and vectors whose scaled
    length exceeds 2^31. Rows that are equal in id, label and vector count once.
    """
    vector = F.col(f"`{vector_column}`")
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    length = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x * x)
    kept = embeddings.where(F.col(f"`{label_column}`").isNotNull() & finite).select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{label_column}`").cast("bigint").alias("label"),
        scaled.alias("scaled"), length.alias("length")).where(F.col("length") < LONGEST_SQUARED)
    whole = kept.select("id", "label", F.transform("scaled", lambda x: F.floor(x)).alias("vector"))
    return whole.withColumn("mark", F.xxhash64("id", "label", "vector")).select(*ROW).distinct()


def hard_negatives(rows: DataFrame, anchors: DataFrame, n_positives: int = N_POSITIVES,
                   n_negatives: int = N_NEGATIVES, thresholds: tuple[int, ...] = THRESHOLDS,
                   high: int = HIGH, index_rows: int = INDEX_ROWS,
                   anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels whose score lies
    between hundredths of the positive's score.

    ``rows`` and ``anchors`` are as :func:`comparable` gives them, the anchors among the rows.
    Positives are the first ``n_positives`` other rows of the anchor's label. Their search starts
    at the score that the label's rows of one block reach already (at none, where these are too
    few), so it needs no second round. Negatives are looked for from the first of
    ``thresholds`` on; only windows that are not filled are searched again, down to the last one,
    which is the lower limit.

    Higher scores come first; ties by smaller id, null ids last, then by label. An anchor without
    other rows of its label has no result, nor has a window without negatives; positives below
    zero have none, as their limits cross. Vectors may differ in length: missing components are
    zero. Empty tables give an empty result.

    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    rows = stored(rows, "vectors")
    anchors = stored(anchors, "anchors")
    n_blocks = max(1, math.ceil(rows.count() / index_rows))
    groups = max(1, math.ceil(anchors.count() / anchor_rows))
    no_limit = F.lit(None).cast("bigint")
    of_score = ["anchor", "positive_score"]

    def window(key, floor, top):
        return F.struct(key.alias("key"), floor.alias("floor"), top.alias("top"))

    # Positives: first the rows of slot 0, then all others that beat what was found there.
    in_slot_0 = F.pmod("mark", F.lit(n_blocks)) == 0
    found = stored(threshold_join(
        rows.where(in_slot_0), anchors.withColumn("windows", F.array(
            window(no_limit, no_limit, no_limit))), ["label"], 1, True, n_positives, groups),
        "probe")
    if n_blocks > 1:
        reached = found.groupBy("anchor").agg(
            F.count("*").alias("n"), F.min("score").alias("least"))
        known = anchors.join(reached.where(F.col("n") == n_positives).withColumnRenamed(
            "anchor", "mark"), "mark", "left")
        found = found.unionByName(threshold_join(
            rows.where(~in_slot_0), known.withColumn("windows", F.array(
                window(no_limit, F.col("least"), no_limit))),
            ["label"], n_blocks, True, n_positives, groups))
    positives = stored(best_of(found, ["anchor"], n_positives).select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("rank").alias("positive_rank")), "positives")

    # Negatives: windows of one anchor and one score are the same.
    score = F.col("positive_score")
    whole, rest = F.expr("positive_score div 100"), score % 100
    open_windows = positives.where(score >= 0).select(*of_score).distinct()
    rounds = []
    for hundredths in thresholds:
        floor = whole * hundredths + F.floor((rest * hundredths + 99) / 100)
        top = whole * high + F.floor(rest * high / 100)
        windows = open_windows.groupBy("anchor").agg(F.collect_list(window(
            score, floor, top)).alias("windows"))
        searched = anchors.join(windows.withColumnRenamed("anchor", "mark"), "mark")
        got = stored(best_of(threshold_join(
            rows, searched, [], n_blocks, False, n_negatives, groups).withColumnRenamed(
            "window", "positive_score"), of_score, n_negatives), f"negatives-{hundredths}")
        if hundredths == thresholds[-1]:
            rounds.append(got)
            break
        filled = got.groupBy(*of_score).agg(F.count("*").alias("n")).where(
            F.col("n") == n_negatives).drop("n")
        rounds.append(got.join(filled, of_score, "left_semi"))
        open_windows = stored(open_windows.join(filled, of_score, "left_anti"),
                              f"open-{hundredths}")
        if open_windows.isEmpty():
            break
    negatives = reduce(DataFrame.unionByName, rounds).select(
        *of_score, F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
        F.col("rank").cast("int").alias("rank"))
    named = anchors.select(F.col("mark").alias("anchor"), F.col("id").alias("anchor_id"))
    return positives.join(negatives, of_score).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        "positive_rank")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives for every 100th row, where the label of every seventh row is moved by one."""
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        .alias("label"))
    rows = comparable(embeddings)
    return hard_negatives(rows, rows.where(F.col("id") % 100 == 0))


OP11_SQL = """
WITH rows AS (
    SELECT vec_id AS id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.id AS anchor_id, r.id, r.label = a.label AS same,
           list_inner_product(a.vector, r.vector)::BIGINT AS score
    FROM rows a JOIN rows r ON a.id <> r.id
    WHERE a.id % 100 = 0
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS positive_rank
    FROM scores WHERE same
    QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                          ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score,
       p.positive_rank::INTEGER AS positive_rank
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
