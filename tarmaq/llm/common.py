"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.session import shared_folder

#: A word of the contracts: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/tarmaq-llm/{label}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's content that is never null; equal rows share it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: str,
              barrier: bool = False) -> DataFrame:
    """``mapInArrow`` for a function that turns a batch into dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for columns in rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema, barrier)
