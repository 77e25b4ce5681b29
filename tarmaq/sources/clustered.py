"""Tables sorted across their files, so that filters skip most row groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows dealt to files by ranges of ``columns`` and sorted in each.

    Each file and row group then holds a narrow range of the first columns, which its minimum and
    maximum in the footer show, and Spark skips those that a filter on them rules out. Name the
    filtered columns first and a finer one after them: a value of the first that holds a third of
    the rows is then still split over files. Without ``files`` the session's shuffle partitions
    decide, joined by AQE where they are small.
    """
    ranged = (df.repartitionByRange(*columns) if files is None
              else df.repartitionByRange(files, *columns))
    return ranged.sortWithinPartitions(*columns)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None,
                    row_group_bytes: int | None = None,
                    derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write ``df`` clustered, in row groups of a given size or the format's own.

    ``derive`` makes the rows to write from rows of ``df``, row by row or by lookups, and keeps
    the values of ``columns``; it runs after the sort, so only ``df`` is sampled, shuffled and
    sorted. A lookup side too large to broadcast would deal the rows anew: derive first then.
    """
    dealt = clustered(df, columns, files)
    writer = (dealt if derive is None else derive(dealt)).write.mode("overwrite")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
