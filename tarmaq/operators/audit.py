"""Counts that compare tables, sources, snapshots and groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.measures import percent, rows_where
from tarmaq.functions.predicates import key_present
from tarmaq.functions.typing import named


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count, all in one query."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def reconcile(sources: Sequence[DataFrame], target: DataFrame) -> DataFrame:
    """One row: the summed source rows, the target rows and their difference."""
    tagged = {f"source_{i}": df for i, df in enumerate(sources)} | {"target": target}
    is_target = F.col("table_name") == "target"
    return (
        row_counts(tagged)
        .agg(
            F.sum(F.when(~is_target, F.col("rows")).otherwise(0)).alias("source_rows"),
            F.sum(F.when(is_target, F.col("rows")).otherwise(0)).alias("target_rows"),
        )
        .withColumn("difference", F.col("source_rows") - F.col("target_rows"))
    )


def row_chain(steps: Sequence[tuple[str, DataFrame]],
              targets: Sequence[int | None]) -> DataFrame:
    """One row per consecutive pair of layers: counts, difference, target and verdict.

    ``targets`` holds the largest accepted difference of each pair; None accepts any loss.
    """
    return chain_of_counts(row_counts(dict(steps)), [name for name, _ in steps], targets)


def chain_of_counts(counted: DataFrame, names: Sequence[str],
                    targets: Sequence[int | None]) -> DataFrame:
    """:func:`row_chain` from counts that are known: ``table_name, rows``, one row per table.

    A table without a count gives NULL differences and the verdict ``CHECK``.
    """
    counts = counted.agg(*[
        F.sum(F.when(F.col("table_name") == name, F.col("rows"))).alias(f"rows_{i}")
        for i, name in enumerate(names)
    ])
    pairs = []
    for i, target in enumerate(targets):
        difference = F.col(f"rows_{i}") - F.col(f"rows_{i + 1}")
        accepted = difference >= 0
        if target is not None:
            accepted = accepted & (difference <= target)
        pairs.append(F.struct(
            F.lit(f"{names[i]} -> {names[i + 1]}").alias("step"),
            F.col(f"rows_{i}").alias("rows_before"),
            F.col(f"rows_{i + 1}").alias("rows_after"),
            difference.alias("difference"),
            F.lit(target).cast("bigint").alias("target"),
            F.when(accepted, "OK").otherwise("CHECK").alias("verdict"),
        ))
    return counts.select(F.inline(F.array(*pairs)))


def load_summary(df: DataFrame, by: str, latest: str, name: str) -> DataFrame:
    """Rows and latest value of ``latest`` per source, in source order."""
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("rows"), F.max(named(latest)).alias(name))
        .orderBy(by)
    )


def key_coverage(df: DataFrame, by: str, key: str) -> DataFrame:
    """Rows, and rows with a usable key, per source."""
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("rows"),
             rows_where(key_present(F.col(key))).alias("with_key"))
        .orderBy(by)
    )


def coverage(df: DataFrame, by: Sequence[str], covered: Column, digits: int = 1) -> DataFrame:
    """Total, uncovered and covered share per group, the share rounded."""
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("total"), rows_where(~covered).alias("missing"))
        .withColumn("pct_covered",
                    F.round(percent(F.col("total") - F.col("missing"), F.col("total")), digits))
    )


def snapshot_compare(snapshots: Mapping[str, DataFrame], stamp: str) -> DataFrame:
    """Rows and earliest stamp of each named snapshot."""
    described = [
        df.agg(F.count("*").alias("rows"), F.min(named(stamp)).alias("first_stamp"))
        .select(F.lit(name).alias("snapshot"), "rows", "first_stamp")
        for name, df in snapshots.items()
    ]
    return reduce(DataFrame.unionByName, described)


def key_skew(df: DataFrame, key: str, top: int = 3, rest: str = "others") -> DataFrame:
    """Rows and share of the ``top`` largest keys, and of all others together.

    The counts are aggregated once: leaders, groups and total all read the same exchange. The
    ranked side is ``top`` rows, so its join needs no shuffle.
    """
    counts = df.groupBy(named(key).alias("key")).agg(F.count("*").alias("n"))
    largest = counts.orderBy(F.desc("n"), F.asc("key")).limit(top)
    leaders = largest.select(F.col("key").alias("leader"), F.lit(True).alias("leads"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return (
        counts.join(F.broadcast(leaders), F.col("key").eqNullSafe(F.col("leader")), "left")
        .groupBy(F.when(F.col("leads"), F.col("key")).otherwise(F.lit(rest)).alias("key"))
        .agg(F.sum("n").alias("rows"), F.count("*").alias("keys"))
        .withColumn("pct_of_rows", percent(F.col("rows"), total))
    )


def listing(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each combination of ``by`` once, in order, with its number of rows."""
    return df.groupBy(*by).agg(F.count("*").alias("rows")).orderBy(*by)


def extremes(df: DataFrame, by: str) -> DataFrame:
    """One row: the smallest and the largest group of ``by`` with their row counts."""
    counts = df.where(named(by).isNotNull()).groupBy(named(by).alias("g")).agg(
        F.count("*").alias("n"))
    return counts.agg(
        F.min(F.struct("n", "g")).alias("low"), F.max(F.struct("n", "g")).alias("high"),
        F.count("*").alias("groups"),
    ).select(
        F.col("low.g").alias("smallest"), F.col("low.n").alias("smallest_rows"),
        F.col("high.g").alias("largest"), F.col("high.n").alias("largest_rows"), "groups",
    )


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct usable values over several columns, read in one pass."""
    return (
        df.select(F.explode(F.array(*[named(c) for c in columns])).alias(name))
        .where(key_present(F.col(name)))
        .distinct()
    )


def lineage_edges(run_log: DataFrame, source: str, target: str, day: str, as_of: Column,
                  days: int = 7, prefix: str = "", blank: str = "(file)") -> DataFrame:
    """Distinct source and target pairs of the last ``days`` days, blank sources labelled.

    The bare column is compared, so that the bound reaches the scan.
    """
    recent = run_log.where(
        (named(day) >= F.date_sub(as_of, days)) & named(target).startswith(prefix)
    )
    label = F.coalesce(F.nullif(named(source), F.lit("")), F.lit(blank))
    return recent.select(label.alias("source"), named(target).alias("target")).distinct()
