"""Layers of named tables in the session catalog, each backed by snapshots."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.operators.audit import row_counts
from tarmaq.sources.footers import footer_counts
from tarmaq.sources.snapshots import (
    latest_version,
    load_history,
    read_snapshot,
    snapshot_path,
    write_snapshot,
)


RUN_LOG = "audit.run_log"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Lake:
    """Tables ``layer.table`` under one root folder; ``comments`` describe columns by name."""

    def __init__(self, spark: SparkSession, root: str, comments: Mapping[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.comments = dict(comments or {})

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Refresh a table in full and return it; the catalog name follows the new snapshot.

        The name is a view that one statement replaces, so it answers at any time, with the old
        rows or the new. It carries the columns' comments.
        """
        folder = self._folder(name)
        version = write_snapshot(df, folder, partition_by=partition_by)
        layer = name.split(".")[0]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        written = self.read(name, version)
        columns = ", ".join(f"`{c}`" + (f" COMMENT {_quoted(self.comments[c])}"
                                        if c in self.comments else "") for c in written.columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} ({columns}) AS "
                       f"SELECT * FROM parquet.`{snapshot_path(folder, version)}`")
        return written

    def build(self, name: str, make: Callable[..., DataFrame], *sources: str,
              partition_by: str | None = None) -> DataFrame:
        """Write what ``make`` returns for the named tables, and log that they fed it.

        Without sources the table is a file load, logged with a blank source.
        """
        written = self.write(name, make(*[self.read(s) for s in sources]), partition_by)
        edges = F.array(*[F.lit(s) for s in sources or [""]])
        self.append(RUN_LOG, self.spark.range(0, 1, 1, 1).select(
            F.explode(edges).alias("source"), F.lit(name).alias("target"),
            F.current_date().alias("event_date")))
        return written

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a log table, which has no snapshots."""
        df.write.mode("append").parquet(self._folder(name))

    def read_appended(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._folder(name))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table by name; an earlier version on request."""
        return read_snapshot(self.spark, self._folder(name), version)

    def history(self, name: str) -> DataFrame:
        return load_history(self.spark, self._folder(name))

    def tables(self, layer: str) -> list[str]:
        if not self.spark.catalog.databaseExists(layer):
            return []
        listed = self.spark.catalog.listTables(layer)
        return sorted(f"{layer}.{t.name}" for t in listed if not t.isTemporary)

    def count_tables(self, names: list[str]) -> DataFrame:
        """Row count per named table; NULL for a table that does not exist yet."""
        there = {n: self.spark.table(n) for n in names if self.spark.catalog.tableExists(n)}
        missing = self.spark.createDataFrame(
            [(n, None) for n in names if n not in there], "table_name string, rows bigint")
        return reduce(DataFrame.unionByName, [row_counts(there)] if there else [], missing)

    def written_counts(self, names: list[str]) -> DataFrame:
        """``table_name, rows`` as the newest write of each table counted them; no table is read.

        NULL for a table that was never written.
        """
        newest = [self.history(name).agg(
            F.lit(name).alias("table_name"),
            F.max_by("rows_written", "version").alias("rows")) for name in names]
        return reduce(DataFrame.unionByName, newest)

    def count_footers(self, names: list[str]) -> DataFrame:
        """:meth:`count_tables` for tables with a folder, from the footers of their files alone.

        The aggregate is pushed down to the Parquet reader, which takes row counts from each
        footer, so no row group is read however large the tables are.
        """
        newest = {name: latest_version(self.spark, self._folder(name)) for name in names}
        return footer_counts(self.spark, {
            name: snapshot_path(self._folder(name), version)
            for name, version in newest.items() if version is not None})

    def columns(self, layers: list[str]) -> DataFrame:
        """One row per column of every table: the base of a data dictionary."""
        described = [
            (*name.split("."), column.name, column.dataType)
            for layer in layers
            for name in self.tables(layer)
            for column in self.spark.catalog.listColumns(name)
        ]
        return self.spark.createDataFrame(
            described, "layer string, table_name string, column_name string, data_type string"
        )
