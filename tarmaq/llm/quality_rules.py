"""Quality rules as a ledger: measurements and one failure bit per rule, judged by policies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.common import WORD, table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
REPEAT_WORDS = 3


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the measurements; ``bit`` never changes its meaning."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("too_few_words", 0, "n_words < 50"),
    Rule("repetitive_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_heavy", 2, "n_symbols > n_words"),
    Rule("short_words", 3, "word_chars < 2 * n_words"),
    Rule("long_words", 4, "word_chars > 40 * n_words"),
    Rule("repeated_lines", 5, "2 * n_dup_lines > n_lines"),
)

#: Versions of the verdict; a ledger once computed serves them all.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repetitive_words"),
    "v1": ("too_few_words", "repetitive_words", "symbol_heavy", "short_words", "long_words",
           "repeated_lines"),
}


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in set(names))


def _repeat_words(words: Column, width: int) -> Column:
    """How many words lie in a window of ``width`` words that the text holds twice or more."""
    last = F.size(words) - width
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get(words, i + j) for j in range(width)]))
    return F.when(last >= 0, windows).otherwise(F.array().cast("array<bigint>"))


def _in_order(windows: Column) -> Column:
    """The windows with their places, equal ones side by side; none if all differ."""
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _covered(placed: Column, width: int) -> Column:
    """How many words the windows with an equal neighbour cover."""
    again = F.filter(placed, lambda x, i: (
        F.coalesce(F.get(placed, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(placed, i + 1)["h"] == x["h"], F.lit(False))))
    starts = F.transform(again, lambda x: x["i"])
    return F.aggregate(
        F.array_sort(starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda seen, i: F.struct(
            (seen["n"] + i + width - F.greatest(seen["end"], i)).alias("n"),
            (i + width).alias("end")),
        lambda seen: seen["n"])


def measure(documents: DataFrame, text_column: str = "text",
            repeat_words: int = REPEAT_WORDS) -> DataFrame:
    """``document``, all columns of a row, and the measurements of its text.

    A null text counts as empty. Rows are neither lost nor merged, and as their columns are
    nested, no name can clash. Only built-in expressions over one row: nothing is shuffled, so
    neither hot sources nor copies matter. The word list is taken once, and only texts in which a
    window of words occurs twice are searched for the words it covers. Each step is a projection
    that names its input more than once, so that no lambda computes it again.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    first = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        lines.alias("lines"))
    second = first.select(
        "document", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words"), repeat_words).alias("windows"))
    measured = ["document", *[c for c in MEASURES if c != "n_repeat_words"]]
    third = second.select(*measured, _in_order(F.col("windows")).alias("placed"))
    return third.select(*measured, _covered(F.col("placed"), repeat_words).cast("bigint")
                        .alias("n_repeat_words"))


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``failed``, the bit of each rule that the row fails, and ``entry``, a number of the row.

    A null condition counts as a pass.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("bigint") for r in rules]
    return measured.withColumns({"failed": reduce(lambda a, b: a.bitwiseOR(b), bits),
                                 "entry": F.monotonically_increasing_id()})


def passes(policy: str, policies: Mapping[str, Sequence[str]] = POLICIES,
           rules: Sequence[Rule] = RULES, failed: str = "failed") -> Column:
    mask = F.lit(mask_of(policies[policy], rules)).cast("bigint")
    return F.col(failed).bitwiseAND(mask) == 0


def kept(judged: DataFrame, policy: str, policies: Mapping[str, Sequence[str]] = POLICIES,
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of a ledger that pass a policy.

    The condition on ``entry`` is always true. It keeps the filter above the measurements, which
    are computed once there; pushed below them it would compute them anew for every mention.
    """
    return judged.where(passes(policy, policies, rules) & (F.col("entry") >= 0))


def ablations(judged: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES,
              rules: Sequence[Rule] = RULES) -> DataFrame:
    """``policy, rule, failing, rejected, rejected_by_it_alone, kept_without_it`` from the bits.

    The ledger is folded to one row per bit pattern first; rules are then counted on those.
    """
    patterns = judged.groupBy("failed").agg(F.count("*").alias("rows"))
    bits = {r.name: 1 << r.bit for r in rules}
    asked = F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(name).alias("rule"),
                 F.lit(bits[name]).cast("bigint").alias("bit"),
                 F.lit(mask_of(names, rules)).cast("bigint").alias("mask"))
        for p, names in policies.items() for name in names])
    each = patterns.select("failed", "rows", F.explode(asked).alias("a")).select(
        "rows", "a.*", F.col("failed").bitwiseAND(F.col("a.mask")).alias("hit"))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(0))

    return each.groupBy("policy", "rule").agg(
        rows_where(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        rows_where(F.col("hit") != 0).alias("rejected"),
        rows_where(F.col("hit") == F.col("bit")).alias("rejected_by_it_alone"),
        rows_where((F.col("hit") == 0) | (F.col("hit") == F.col("bit"))).alias("kept_without_it"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = ledger(measure(table(spark, folder, "documents")))
    return judged.select(
        "document.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), "n_lines", "failed")


OP7_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))
           AS lines
  FROM texts
), words AS (
  SELECT r, unnest(words) AS a, unnest(range(len(words))) AS i FROM parts
), windows AS (
  SELECT r, i, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM words
  WINDOW w AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM again, range(3) AS t(j) WHERE n > 1 GROUP BY r
), measured AS (
  SELECT parts.r, doc_id, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM parts LEFT JOIN covered ON covered.r = parts.r
), judged AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, n_lines,
       CAST(failed AS BIGINT) AS failed
FROM judged
"""
