"""Intermediate tables in the folder that the cluster names for checkpoints."""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.session import shared_folder
from tarmaq.sources.snapshots import latest_version, snapshot_path, write_snapshot


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A text that changes when a file under ``paths`` is added, removed or rewritten.

    Only names, sizes and times are read, never contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    trace = files.agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()[0]
    return f"{(trace or 0) & (2**64 - 1):016x}"


_building = Lock()


def stored_once(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``key`` of this application in the shared folder, built on first use.

    ``build`` runs before the lock is taken, so it may itself ask for stored tables.
    """
    root = f"{shared_folder(spark)}/tarmaq/{spark.sparkContext.applicationId}/{key}"
    if latest_version(spark, root) is None:
        plan = build()
        with _building:
            if latest_version(spark, root) is None:
                write_snapshot(plan, root)
    return spark.read.parquet(snapshot_path(root, 0))
