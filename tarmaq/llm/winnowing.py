"""Document fingerprints by winnowing, in built-in expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmaq.llm.common import row_key, stored, table

_SPACELESS = r"฀-໿က-႟ក-៿぀-ヿ㐀-鿿"
#: What a gram is made of: up to two visible ASCII characters, a character of a script that writes
#: without spaces (Thai to Burmese, Khmer, Chinese and Japanese), or up to two others beyond ASCII.
#: ASCII comes first because a single range is matched much faster than the rest.
UNIT = rf"[!-~]{{1,2}}|[{_SPACELESS}]|[^\x00-\x7F{_SPACELESS}]{{1,2}}"
#: The longest beginning of a text after which a unit must begin, whatever follows.
WHOLE_UNITS = rf"(?s)^.*[\x00-\x20\x7F{_SPACELESS}]"
GRAM_UNITS = 3
WINDOW_GRAMS = 9
#: Ranges of documents, in their order, that a task is dealt: it gets about as many as any other.
RANGES_PER_TASK = 8
_POSITION_BITS = 31
_LAST_POSITION = (1 << _POSITION_BITS) - 1


def _least_of(column: str, count: int, stride: int) -> Column:
    """For each element, the least of it and its followers at ``stride``; none past the end."""
    return F.transform(F.col(column), lambda x, i: F.least(
        x, *[F.get(column, i + j * stride) for j in range(1, count)]))


def _units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = GRAM_UNITS,
                     w: int = WINDOW_GRAMS) -> DataFrame:
    """Add ``name``, the fingerprint of ``text``: one number per chosen gram, in order of place.

    A number is ``hash << 31 | (2^31 - 1 - place)`` with 32 bits of hash; the least in each window
    of ``w`` grams is kept, so of equal hashes the rightmost. Any ``w + k - 1`` units that two
    texts share hold a gram that both keep. A text of fewer units is one gram or one window; a
    text without any, null included, has the one number of the empty gram. ``df`` may have any
    other columns but ``name`` and those that start with it; ``w`` is a square.
    """
    units = f"{name}__units"
    df = df.select(*df.columns, _units(F.coalesce(F.col(text), F.lit(""))).alias(units))
    return _fingerprint_of_units(df, units, name, k, w).drop(units)


def _fingerprint_of_units(df: DataFrame, units: str, name: str, k: int, w: int,
                          first: Column | None = None) -> DataFrame:
    """Add ``name``, the fingerprint of the array ``units``, of which the first has place ``first``.

    Each step is a projection that names its input twice, so that no lambda computes it again.
    """
    side = math.isqrt(w)
    if side * side != w:
        raise ValueError("the window must be a square number")
    others = df.columns
    last = F.lit(_LAST_POSITION) - (F.lit(0) if first is None else first)

    def whole(column: str, cut: int) -> Column:
        """Without the last ``cut`` elements, which reach over the end; one stays."""
        return F.slice(column, F.lit(1), F.greatest(F.size(column) - cut, F.lit(1)))

    grams = F.transform(F.col(units), lambda u, i: F.shiftleft(
        F.xxhash64(u, *[F.get(units, i + j) for j in range(1, k)])
        .bitwiseAND(F.lit(0xFFFFFFFF)), _POSITION_BITS) + (last - i))
    df = df.select(*others, F.when(F.size(units) > 0, grams).otherwise(
        F.array(F.lit(_LAST_POSITION).cast("bigint"))).alias(name))
    df = df.select(*others, whole(name, k - 1).alias(name))
    df = df.select(*others, _least_of(name, side, 1).alias(name))
    df = df.select(*others, _least_of(name, side, side).alias(name))
    return df.select(*others, F.array_distinct(whole(name, w - 1)).alias(name))


def hashes_of(fingerprint: str) -> Column:
    """The distinct hashes of a fingerprint, without places."""
    return F.array_distinct(F.transform(
        F.col(fingerprint), lambda x: (
            F.shiftright(x, _POSITION_BITS) - (1 << 31)).cast("int")))


def likeness(left: str, right: str) -> Column:
    """The share of hashes that two sets have in common, 0 to 1."""
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def digest(fingerprint: str) -> Column:
    """Hashes and places as one short text; equal texts have equal digests."""
    return F.sha2(F.array_join(F.transform(F.col(fingerprint), lambda x: x.cast("string")), ","),
                  256)


def in_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` with ``range`` and ``guest``: ranges of ``place``, each with the next one's first.

    ``place`` is any column that can be ordered and is never null. A range begins at a place that
    occurs. Rows of that place come a second time, as guests of the range before, those of the
    least place as guests of the last range. Only places are sorted to find the beginnings, and a
    row finds its range in two steps: among the first beginnings of groups, then in one group.
    """
    step = math.isqrt(ranges - 1) + 1
    dealt = rows.select("place").repartitionByRange(ranges, "place")
    begins = stored(dealt.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("place").alias("begin")).select("begin"), "ranges")
    in_order = Window.orderBy("begin")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.row_number().over(in_order) - 1
    members = begins.select(
        "begin", F.lead("begin").over(in_order).alias("until"), number.alias("range"),
        F.pmod(number - 1, F.count("*").over(whole).cast("int")).alias("before"),
        F.floor(number / step).alias("group"))
    groups = members.groupBy("group").agg(F.min("begin").alias("group_begin"),
                                          F.max_by("until", "range").alias("group_until"))

    def between(begin: str, until: str) -> Column:
        return (F.col(begin) <= F.col("place")) & (
            F.col(until).isNull() | (F.col("place") < F.col(until)))

    # Both tables have fewer rows than ``ranges``.
    found = rows.join(F.broadcast(groups), between("group_begin", "group_until")).join(
        F.broadcast(members), "group").where(between("begin", "until"))
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))
    return found.select(*rows.columns, F.inline(F.when(
        F.col("begin") == F.col("place"), F.array(own, guest)).otherwise(F.array(own))))


def fingerprints_and_edits(documents: DataFrame, id_column: str = "doc_id",
                           text_column: str = "text") -> DataFrame:
    """Each text, its edited text and the next document's, with their fingerprints.

    ``id, text, n_chars, edited, own, changed, own_hashes, changed_hashes, next_hashes``. The
    edited text has its last quarter replaced by the first as many characters of the next
    document, in ascending order of ``id``, null last. The texts are shuffled once, to ranges in
    that order, and each text's fingerprint is taken once. That of the edited text follows from it
    as far as both texts begin alike: only windows that reach over that are hashed again. Null texts
    are empty; rows that repeat entirely share a place in the order; a single document is its own
    neighbour; other columns are ignored.
    """
    k, w = GRAM_UNITS, WINDOW_GRAMS
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = documents.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    rows = rows.withColumn("place", F.struct(
        F.col("id").isNull().alias("last"), "id", row_key("id", "text").alias("key")))
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = in_ranges(rows, RANGES_PER_TASK * tasks).repartition(tasks, "range")
    ordered = ordered.sortWithinPartitions("range", "guest", "place")

    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    alike = F.regexp_extract(F.substring("text", F.lit(1), size - cut), WHOLE_UNITS, 0)
    # Units of both texts; behind ``n_alike`` of them the texts may differ. ``reach`` of these are in
    # windows that end behind them, or share their gram with one that does.
    reach = 2 * w + k - 3
    place = ["range", "guest", "place", "id", "text"]
    parted = ordered.select(*place, alike.alias("alike"))
    parted = parted.select(
        *place, F.length("alike").alias("alike_chars"), _units(F.col("alike")).alias("before"),
        _units(F.substring("text", F.length("alike") + 1, size)).alias("after"))
    place += ["alike_chars", "n_alike", "reaching"]
    united = parted.select(
        *place[:-2], F.size("before").alias("n_alike"), F.slice(
            "before", F.greatest(F.size("before") - reach + 1, F.lit(1)), reach).alias("reaching"),
        F.concat("before", "after").alias("units"))
    found = _fingerprint_of_units(united, "units", "own", k, w).drop("units")

    inside = Window.partitionBy("range")
    following = inside.orderBy("rank").rangeBetween(1, 1)
    found = found.withColumn("rank", F.dense_rank().over(inside.orderBy("guest", "place")))
    found = found.withColumn("next", F.first(F.struct(
        "text", hashes_of("own").alias("hashes"))).over(following)).where("NOT guest")

    out = ["id", "text", "own", "alike_chars", "n_alike", "reaching"]
    edited = F.concat(F.substring("text", F.lit(1), size - cut),
                      F.substring("next.text", F.lit(1), cut))
    found = found.select(*out, F.col("next.hashes").alias("next_hashes"), edited.alias("edited"))
    out = ["id", "text", "own", "n_alike", "next_hashes", "edited"]
    found = found.select(*out, F.concat("reaching", _units(F.substring(
        "edited", F.col("alike_chars") + 1, F.length("edited")))).alias("units"))
    found = _fingerprint_of_units(found, "units", "rest", k, w,
                                  F.greatest(F.col("n_alike") - reach, F.lit(0)))
    same = F.filter("own", lambda x: F.lit(_LAST_POSITION) - x.bitwiseAND(F.lit(_LAST_POSITION))
                    < F.col("n_alike") - (w + k - 2))
    found = found.withColumn("changed", F.array_distinct(F.concat(same, "rest")))
    return found.select(
        "id", "text", size.cast("bigint").alias("n_chars"), "edited", "own", "changed",
        hashes_of("own").alias("own_hashes"), hashes_of("changed").alias("changed_hashes"),
        "next_hashes")


def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints_and_edits(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256)
        .alias("edited_sha256"), digest("own").alias("fingerprint"),
        digest("changed").alias("edited_fingerprint"),
        likeness("own_hashes", "changed_hashes").alias("near_edited"),
        likeness("own_hashes", "next_hashes").alias("near_next"))
