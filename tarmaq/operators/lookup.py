"""Left equi-joins that resolve keys and never change the row count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.predicates import key_present
from tarmaq.functions.typing import named
from tarmaq.operators.dedup import first_per_key


def best_per_key(registry: DataFrame, key: str, order: Sequence[str | Column],
                 columns: Sequence[str]) -> DataFrame:
    """A registry reduced to one row per usable key."""
    usable = registry.where(key_present(F.col(key)))
    return first_per_key(usable, [key], order).select(key, *columns)


def attach(df: DataFrame, on: str, side: DataFrame, key: str,
           columns: Mapping[str, str]) -> DataFrame:
    """Left join a side with unique ``key``; ``columns`` maps its columns to their new names.

    Renaming before the join lets one side be attached several times in different roles.
    """
    joined_key = f"__{key}_of_{on}"
    renamed = side.select(
        named(key).alias(joined_key), *[named(c).alias(new) for c, new in columns.items()]
    )
    return df.join(renamed, named(on) == named(joined_key), "left").drop(joined_key)


@dataclass(frozen=True)
class Mark:
    """Flag ``flag``: does ``column`` occur as a usable ``key`` of ``registry``?

    ``unique`` says that the registry holds each key once. Then nothing is folded between its
    shuffle and a merge join, so that Spark can split a hot key of the marked table there.
    """

    flag: str
    column: str
    registry: DataFrame
    key: str
    unique: bool = False


def mark_membership(df: DataFrame, marks: Sequence[Mark]) -> DataFrame:
    """Add one never-NULL flag per mark; rows are neither lost nor repeated.

    Nothing runs while the plan is built. Marks on the same registry share its distinct keys, as
    equal exchanges are reused, and the session's own limit decides what is broadcast.
    """
    for mark in marks:
        key, member = named(mark.key), f"__{mark.flag}"
        keys = mark.registry.where(key_present(key)).select(key.alias(member))
        keys = keys if mark.unique else keys.distinct()
        df = (
            df.join(keys, named(mark.column) == named(member), "left")
            .withColumn(mark.flag, named(member).isNotNull())
            .drop(member)
        )
    return df


def without_match(df: DataFrame, on: str, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from ``others``; NULLs in ``others`` are ignored.

    ``others`` is reduced to distinct keys first, so its repeated keys cost one row per map task.
    """
    keys = others.select(named(key).alias("__other")).where("__other IS NOT NULL").distinct()
    return df.join(keys, named(on) == F.col("__other"), "left_anti")


def not_in(df: DataFrame, on: str, others: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN``: empty if ``others`` holds a NULL, everything if it is empty.

    Spark's own null-aware anti join has to broadcast ``others`` whatever its size; the two
    NULL rules are scalar conditions, so the rest is an ordinary anti join.
    """
    keys = others.select(named(key).alias("__other"))
    holds_null = keys.agg(
        F.coalesce(F.bool_or(F.col("__other").isNull()), F.lit(False))
    ).scalar()
    is_empty = keys.agg(F.count("*") == 0).scalar()
    candidates = df.where(~holds_null & (named(on).isNotNull() | is_empty))
    return without_match(candidates, on, others, key)
