"""Data-quality rules that measure and explain, and never drop a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarmaq.functions.measures import percent, rows_where
from tarmaq.functions.typing import named

REASON_SEPARATOR = " | "


@dataclass(frozen=True)
class Rule:
    """A named condition. A row it cannot judge (NULL) fails."""

    name: str
    passes: Column

    @property
    def holds(self) -> Column:
        return F.coalesce(self.passes, F.lit(False))


def expectation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its passed and failed counts, from one pass over ``df``."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[rows_where(rule.holds).alias(f"passed_{i}") for i, rule in enumerate(rules)],
    )
    per_rule = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"passed_{i}").alias("passed"),
            (F.col("rows") - F.col(f"passed_{i}")).alias("failed"),
        )
        for i, rule in enumerate(rules)
    ])
    return counts.select(F.inline(per_rule))


def observed(df: DataFrame, rules: Sequence[Rule], name: str) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, with its rule counts collected by whichever action runs it first.

    The observation holds ``rows`` and one failed count per rule name.
    """
    watch = Observation(name)
    failed = [rows_where(~rule.holds).alias(rule.name) for rule in rules]
    return df.observe(watch, F.count("*").alias("rows"), *failed), watch


def failure_reasons(rules: Sequence[Rule]) -> Column:
    """Names of the failed rules in rule order; empty text if all hold."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(~r.holds, F.lit(r.name)) for r in rules])


def quarantine(df: DataFrame, rules: Sequence[Rule], reasons: str) -> DataFrame:
    """The rows that fail any rule, with their reasons. A mirror, not a filter on ``df``."""
    clean = reduce(lambda a, b: a & b, [rule.holds for rule in rules])
    return df.where(~clean).withColumn(reasons, failure_reasons(rules))


def violation_distribution(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per failed rule and their share of all rows, from one pass over ``df``."""
    failed = expectation_counts(df, rules).where(F.col("failed") > 0)
    return failed.select(
        F.col("rule").alias("reason"), F.col("failed").alias("rows"),
        percent(F.col("failed"), F.col("passed") + F.col("failed")).alias("pct_of_rows"))


def quarantine_share(quarantined: DataFrame, audited: DataFrame) -> DataFrame:
    """One row: quarantined rows, audited rows and the share."""
    total = audited.agg(F.count("*")).scalar()
    return quarantined.agg(F.count("*").alias("quarantined")).select(
        "quarantined", total.alias("audited"),
        percent(F.col("quarantined"), total).alias("pct_quarantined"),
    )


def token_profile(df: DataFrame, columns: Sequence[str], token: str, fragment: str) -> DataFrame:
    """Per text column: real NULLs, rows equal to ``token``, rows that contain ``fragment``.

    All columns are profiled in one pass; only the counts are turned into rows.
    """
    counts = df.agg(
        F.count("*").alias("rows"),
        *[
            measure.alias(f"{kind}_{i}")
            for i, column in enumerate(columns)
            for kind, measure in (
                ("null", rows_where(named(column).isNull())),
                ("token", rows_where(named(column) == token)),
                ("fragment", rows_where(named(column).like(f"%{fragment}%"))),
            )
        ],
    )
    per_column = F.array(*[
        F.struct(
            F.lit(column).alias("column_name"),
            F.col("rows"),
            F.col(f"null_{i}").alias("truly_null"),
            F.col(f"token_{i}").alias("token_text"),
            F.col(f"fragment_{i}").alias("with_fragment"),
        )
        for i, column in enumerate(columns)
    ])
    return counts.select(F.inline(per_column))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the non-NULL count of each column."""
    return df.agg(*[F.count(named(column)).alias(f"{column}_ok") for column in columns])


def masked(df: DataFrame, columns: Sequence[str], implausible: Column) -> DataFrame:
    """NULL all ``columns`` of an implausible row; the row stays."""
    return df.withColumns({column: F.when(~implausible, F.col(column)) for column in columns})
