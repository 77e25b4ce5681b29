"""Which files of a folder a table has loaded already, so that a load reads only new ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = ["file", "bytes", "modified"]
LEDGER_SCHEMA = "file string, bytes bigint, modified timestamp, load_id string, loaded_at timestamp"


@dataclass(frozen=True)
class Load:
    """What one load did."""

    load_id: str
    files: int


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, modified`` of every file under a path or pattern; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("modified"))


def loaded_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger: one row per file and load. Empty before the first load."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Files that no load has seen by this name, size and time; a rewritten file is new."""
    return listed_files(spark, path).join(
        loaded_files(spark, ledger).select(*FILE), FILE, "left_anti")


def load_new_files(spark: SparkSession, path: str, target: str, ledger: str, load_id: str,
                   read: Callable[[list[str]], DataFrame]) -> Load:
    """Write what ``read`` makes of the files that are new, and then list them in the ledger.

    Rows go to ``target/load_id=...`` and replace what an earlier try of the same load left there,
    so a load that died between the two writes is simply repeated under its id and nothing is
    loaded twice. Without new files nothing is read or written. The names of the new files reach
    the driver, as they do in any read of listed files.
    """
    found = new_files(spark, path, ledger).collect()
    if not found:
        return Load(load_id, 0)
    read([row["file"] for row in found]).write.mode("overwrite").parquet(
        f"{target}/load_id={load_id}")
    listed = spark.createDataFrame([tuple(row) for row in found],
                                   "file string, bytes bigint, modified timestamp")
    listed.select(*FILE, F.lit(load_id).alias("load_id"),
                  F.current_timestamp().alias("loaded_at")).coalesce(1).write.mode(
        "append").parquet(ledger)
    return Load(load_id, len(found))
