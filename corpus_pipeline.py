"""The corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.llm.jaccard_join import near_duplicates
from tarmaq.llm.quality_rules import kept, ledger, measure
from tarmaq.llm.sentence_pieces import Pieces, default_model, encode
from tarmaq.llm.source_mix import repeated, systematic_mix
from tarmaq.llm.surrogates import pseudonymised
from tarmaq.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules of the policy."""
    return kept(ledger(measure(docs)), "v1").select("document.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each class of near duplicates.

    Rows are named by their place in the stored input, so that of repeated rows one stays.
    """
    place = F.monotonically_increasing_id()
    rows = docs.select(place.alias("place"), "text")
    first = near_duplicates(rows, "place").where("id = class_id").select(
        F.col("id").alias("place"))
    named = docs.select(F.struct(*docs.columns).alias("document"), place.alias("place"))
    return named.join(first, "place", "left_semi").select("document.*")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the personal data in their texts."""
    replaced = pseudonymised(docs, count_column=None)
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes them."""
    return repeated(systematic_mix(docs))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` of each document of the mix."""
    encoded = encode(docs.select("doc_id", "source", "text"),
                     Pieces.from_model(default_model()), keep_text=False)
    return encoded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"),
                          "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("ngram jaccard join", one_of_each_group),
    ("pii surrogates", surrogates),
    ("source mix", source_mix),
    ("sentence pieces", sentence_pieces),
]

#: Near duplicates, keyed surrogates and pieces cannot be said in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/tarmaq-llm/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
