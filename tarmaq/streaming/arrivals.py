"""Incremental load of monthly flight files.

Typing and provenance need no state, so the batch functions apply to a stream as they are.
A month delivered twice needs none either: its copies are folded where the fact is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmaq.operators.quality import observed
from tarmaq.plans import contract, silver
from tarmaq.plans import vocabulary as V
from tarmaq.sources.delimited import read_delimited, with_ingest_time, with_source_file


def arriving_flights(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Raw flight rows of each new file in ``folder``, once."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    rows = read_delimited(spark, folder, list(V.FLIGHT_COLUMNS), escape='"', reader=reader)
    return with_ingest_time(with_source_file(rows))


def load_arrivals(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Type all files that arrived since the last call and append them to ``target``.

    The checkpoint remembers the files, and the file sink's own log makes each append visible
    once, also when a run is repeated after a failure. Await the returned query.
    """
    return (
        silver.flights(arriving_flights(spark, folder))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_audited(batch: DataFrame, batch_id: int, target: str, airlines: DataFrame,
                  aerodromes: DataFrame) -> None:
    """Audit one batch of typed flights: rows, quarantine and rule counts, each in its own folder.

    Every folder is named by the batch and replaced as a whole, so a batch that is run again after
    a failure, at whatever point, leaves what one run leaves. The batch is written first and then
    read back, so its source is read once; the counts are observed in the quarantine's write.
    """
    spark = batch.sparkSession
    place = f"batch={batch_id}"
    batch.write.mode("overwrite").parquet(f"{target}/flights/{place}")
    written = spark.read.schema(batch.schema).parquet(f"{target}/flights/{place}")
    audited, watch = observed(contract.marked(written, airlines, aerodromes),
                              contract.flight_rules(), f"batch {batch_id}")
    contract.quarantined(audited).write.mode("overwrite").parquet(f"{target}/quarantine/{place}")
    counts = watch.get
    failed = F.array(*[F.struct(F.lit(rule.name).alias("rule"),
                                F.lit(counts[rule.name]).cast("bigint").alias("failed"))
                       for rule in contract.flight_rules()])
    spark.range(0, 1, 1, 1).select(
        F.lit(counts["rows"]).cast("bigint").alias("rows"), F.inline(failed)).write.mode(
        "overwrite").parquet(f"{target}/expectations/{place}")


def audit_arrivals(spark: SparkSession, folder: str, target: str, checkpoint: str,
                   airlines: DataFrame, aerodromes: DataFrame) -> StreamingQuery:
    """Type and audit all files that arrived since the last call; await the returned query.

    Spark repeats an unfinished batch with the same id and the same files, and
    :func:`write_audited` replaces by that id: together the counts and the quarantine hold each
    arrival once.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        write_audited(batch, batch_id, target, airlines, aerodromes)

    return (
        silver.flights(arriving_flights(spark, folder))
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
