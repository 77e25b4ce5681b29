"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmaq.llm.common import WORD, stored, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Expected copies are whole multiples of 2^-24, so that sums do not depend on their order.
UNIT_BITS = 24
#: Leading bits of a size that place a document; sizes within one step of them count as alike.
SIZE_BITS = 4
#: Hexadecimal digits of the id's digest that split the documents of one source and size.
SALT_DIGITS = 3


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``source, number, source_size, target`` for a table of ``source, source_size``.

    Sources take the weights in turn, by code point, null last. The mix has ``share`` times all
    sizes; no target exceeds ``most`` times its source, and what a source cannot take goes to the
    others by weight. In order of capacity per weight there is one level at which that holds:
    sources below it are full, the others get their weight times the level. One row per source is
    all that is sorted here.
    """
    numbered = sources.withColumn(
        "number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1
    weighted = numbered.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    weighted = weighted.withColumn("full", F.lit(float(most)) * F.col("source_size"))
    by_room = Window.orderBy(F.col("full") / F.col("weight"), "number")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighted.withColumn("level", (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    open_level = F.when(F.col("full") / F.col("weight") >= F.col("level"), F.col("level"))
    levels = levels.withColumn("level", F.first(open_level, ignorenulls=True).over(everything))
    return levels.select(
        "source", "number", "source_size",
        F.least(F.col("full"), F.coalesce(F.col("weight") * F.col("level"), F.col("full")))
        .alias("target"))


def systematic_mix(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   source_column: str = "source", weights: Sequence[float] = WEIGHTS,
                   share: float = SHARE, most: float = MOST, seed: str = SEED,
                   keep: Sequence[str] | None = None) -> DataFrame:
    """``document, size, source_size, target, copies``: how often the mix takes each row.

    Sizes are word counts; a null text has none. Every document of a source expects the same
    number of copies, target / source size. Their prefix sum, largest documents first, plus one
    offset per source drawn from ``seed``, crosses a whole number once per copy. Neighbours are of
    like size, so the taken words stay near the target, and copies differ from the expectation by
    less than one, so none exceeds ``most``. Reruns agree: order and offset come from ids, texts
    and ``seed`` only; rows that repeat entirely are interchangeable. A null source is a source; an
    empty table gives an empty result. ``document`` holds the columns ``keep`` (all by default),
    so that no name of theirs can clash.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    kept = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or documents.columns]).alias("document"),
        F.col(f"`{source_column}`").alias("source"), F.col(f"`{id_column}`").alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(text).alias("digest"))
    sources = kept.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, share, most), "targets").withColumnRenamed(
        "source", "of_source")
    unit = 1 << UNIT_BITS
    bits = F.length(F.bin("size"))
    step = bits * (1 << SIZE_BITS) + F.when(
        bits > SIZE_BITS, F.expr(f"shiftright(size, length(bin(size)) - {SIZE_BITS})")
    ).otherwise(F.col("size"))
    placed = kept.join(goals, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "document", "id", "digest", "size", "number", "source_size", "target",
        F.when(F.col("source_size") > 0,
               F.floor(F.col("target") / F.col("source_size") * unit)).otherwise(0)
        .cast("bigint").alias("units"),
        step.alias("step"),
        F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, SALT_DIGITS)
        .alias("salt"),
        F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), F.coalesce("source", F.lit("")))),
                           1, UNIT_BITS // 4), 16, 10).cast("bigint").alias("offset"))
    until = F.col("before") + F.col("offset")
    crossed = F.shiftright(until + F.col("units"), UNIT_BITS) - F.shiftright(until, UNIT_BITS)
    return _with_running_sum(placed).select(
        "document", "size", "source_size", "target", crossed.cast("int").alias("copies"))


def _with_running_sum(rows: DataFrame) -> DataFrame:
    """Add ``before``: the units of all rows of the same source that come earlier.

    A prefix sum in three levels (size steps of a source, salts of a step, rows of a salt), so
    that no task sorts a whole source however large it is.
    """
    by_salt = rows.groupBy("number", "step", "salt").agg(F.sum("units").alias("salt_units"))
    by_step = by_salt.groupBy("number", "step").agg(F.sum("salt_units").alias("step_units"))

    def earlier(units: str, within: list[str], *order: Column | str) -> Column:
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(units).over(window), F.lit(0))

    by_step = by_step.select("number", "step", earlier("step_units", ["number"], F.desc("step"))
                             .alias("before_step"))
    by_salt = by_salt.select("number", "step", "salt", earlier(
        "salt_units", ["number", "step"], "salt").alias("before_salt"))
    before = by_salt.join(by_step, ["number", "step"]).select(
        "number", "step", "salt", (F.col("before_step") + F.col("before_salt")).alias("earlier"))
    return rows.join(before, ["number", "step", "salt"]).withColumn(
        "before", F.col("earlier") + earlier(
            "units", ["number", "step", "salt"], F.desc("size"), "id", "digest"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it has copies."""
    return mixed.where("copies > 0").select(
        "document", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("document.*")


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = systematic_mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select(
        "document.doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP2_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(text, '')) AS row_digest FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM sources
), weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(number - 1) % 3 + 1]::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS room FROM numbered
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(room) OVER (ORDER BY room / weight, number
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY room / weight, number
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted
), open_level AS (
  SELECT arg_min(level, number_in_order) AS level FROM (
    SELECT *, row_number() OVER (ORDER BY room / weight, number) AS number_in_order FROM levels)
  WHERE room / weight >= level
), goals AS (
  SELECT source, source_size,
         least(room, coalesce(weight * open_level.level, room)) AS target
  FROM levels, open_level
), placed AS (
  SELECT sized.*, source_size, target,
    CASE WHEN source_size > 0
      THEN CAST(floor(target / source_size * {1 << UNIT_BITS}) AS BIGINT) ELSE 0 END AS units,
    length(bin(size)) * {1 << SIZE_BITS} + CASE WHEN length(bin(size)) > {SIZE_BITS}
      THEN size >> (length(bin(size)) - {SIZE_BITS}) ELSE size END AS step,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {SALT_DIGITS}) AS salt,
    CAST('0x' || substr(md5('{SEED}/' || coalesce(sized.source, '')), 1, {UNIT_BITS // 4})
      AS BIGINT) AS start
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
), summed AS (
  SELECT *, start + coalesce(CAST(sum(units) OVER (PARTITION BY source
    ORDER BY step DESC, salt, size DESC, doc_id NULLS FIRST, row_digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS until FROM placed
), counted AS (
  SELECT *, CAST(((until + units) >> {UNIT_BITS}) - (until >> {UNIT_BITS}) AS INTEGER) AS copies
  FROM summed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(copies * size AS BIGINT) AS taken, copies
FROM counted
"""
