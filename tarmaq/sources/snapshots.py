"""Tables refreshed in full as numbered snapshots, with a ledger of their loads.

A load writes a new snapshot folder and then appends its ledger row. Readers follow the
ledger, so they see the old snapshot until the new one is complete, and a failed load
leaves nothing visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "version int, loaded_at timestamp, operation string, rows_written bigint"


def snapshot_path(root: str, version: int) -> str:
    return f"{root}/_snapshot={version}"


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/ledger")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/ledger")


def load_history(spark: SparkSession, root: str) -> DataFrame:
    """One row per completed load, in version order. Empty if there was none."""
    ledger = _ledger(spark, root)
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER_SCHEMA)
    return ledger.orderBy("version")


def latest_version(spark: SparkSession, root: str) -> int | None:
    ledger = _ledger(spark, root)
    return None if ledger is None else ledger.agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, root: str, operation: str = "overwrite",
                   partition_by: str | None = None) -> int:
    """Write ``df`` as the next snapshot of ``root`` and record it; returns its version.

    The row count is observed in the write itself, so the data is read once.
    """
    spark = df.sparkSession
    newest = latest_version(spark, root)
    version = 0 if newest is None else newest + 1
    written = Observation(f"load {version}")
    writer = df.observe(written, F.count("*").alias("rows")).write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(snapshot_path(root, version))
    spark.range(1).select(
        F.lit(version).cast("int").alias("version"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(operation).alias("operation"),
        F.lit(written.get["rows"]).cast("bigint").alias("rows_written"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A snapshot by version, or the latest."""
    newest = latest_version(spark, root)
    if newest is None:
        raise FileNotFoundError(f"no completed load in {root}")
    wanted = newest if version is None else version
    if not 0 <= wanted <= newest:
        raise ValueError(f"version {wanted} of {root} does not exist; latest is {newest}")
    return spark.read.parquet(snapshot_path(root, wanted))
