"""Session defaults for local runs, and the folder every executor can reach."""

from __future__ import annotations

import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarmaq")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, for tables between two steps.

    A local session, as in tests, may leave it unset and then uses the folder of its warehouse.
    A cluster has to name it: a folder of one machine would be invisible to the others.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/between-steps"


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, which need it wherever Python runs in a task.

    Call it once after the session starts, unless the cluster has the package installed or
    ``--py-files`` names it. The archive is built on the driver, and Spark sends it to each
    executor, also to those that come later; no folder has to be shared for that.
    """
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
