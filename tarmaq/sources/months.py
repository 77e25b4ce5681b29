"""Tables laid out by a column such as the month, of which a refresh rewrites the parts it has."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.functions.typing import named


def balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows dealt for writing by ``column``: small parts go to one task, large ones are split.

    AQE cuts and joins the partitions of a rebalance to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a part that holds a third of the rows
    is written by many tasks, and one of a few rows as one file.
    """
    return df.hint("rebalance", named(column))


def _dealt(df: DataFrame, column: str,
           derive: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    dealt = balanced(df, column)
    return dealt if derive is None else derive(dealt)


def replace_parts(df: DataFrame, path: str, column: str,
                  derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write ``df`` by ``column``; parts that it holds are replaced, all others stay as they are.

    ``derive`` makes the rows to write from rows of ``df``, row by row or by lookups, and keeps
    the value of ``column``; it runs after the rows are dealt, so only ``df`` is shuffled.
    Only parts with rows are touched, so an empty ``df`` changes nothing; to empty a part, drop
    its folder. The committer moves the new files of a part in place at the end of the job, and a
    failed job leaves the old ones. Readers of a part at that moment may see it empty: they should
    read between refreshes.
    """
    _dealt(df, column, derive).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def append_parts(df: DataFrame, path: str, column: str,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Add rows to their parts; ``derive`` as in :func:`replace_parts`."""
    _dealt(df, column, derive).write.mode("append").partitionBy(column).parquet(path)


def part_values(df: DataFrame, column: str, most: int = 10_000) -> list:
    """The parts that ``df`` touches, on the driver: months, of which there are few.

    More than ``most`` are refused, as a column with so many values is no part of a layout.
    """
    found = [row[0] for row in df.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return found


def in_parts(column: str, values: Sequence) -> Column:
    """Rows of the given parts, a NULL among them included; prunes the scan to their folders."""
    known = [v for v in values if v is not None]
    wanted = named(column).isin(known) if known else F.lit(False)
    return wanted | named(column).isNull() if None in values else wanted


def read_parts(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table as columns of ``like``; empty before anything was written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)
