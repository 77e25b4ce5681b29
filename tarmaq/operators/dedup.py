"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column],
                  order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key; NULL keys form a group of their own.

    Asking a row number for rank 1 lets Catalyst cut every group to one row per map task
    before the shuffle (``WindowGroupLimit``), so a key that holds a third of the table
    sends one row per map task to its reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct combinations of ``keys``.

    A hash aggregate; no sort is needed. The better form when every wanted column follows from
    the keys. The rows are dealt by their keys first: a scan task may hold millions of rows that
    are nearly all different, and a map-side table of them would spill and fold next to nothing.
    """
    return df.select(*keys).repartition(*keys).distinct()


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that shows a few keys which would fan out a join."""
    offenders = repeated_keys(df, keys).limit(3).collect()
    if offenders:
        raise ValueError(f"{list(keys)} is not unique: {[row.asDict() for row in offenders]}")
    return df
