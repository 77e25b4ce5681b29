"""Is everything documented, tagged and traceable? Audits over the lake's own metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmaq.functions.predicates import key_present
from tarmaq.operators.audit import coverage, lineage_edges, listing, row_counts
from tarmaq.operators.lookup import not_in
from tarmaq.plans import dictionary
from tarmaq.plans.refresh import chain_report
from tarmaq.sources.lake import RUN_LOG, Lake

LAYERS = ["bronze", "silver", "gold"]


def described_columns(lake: Lake, layers: list[str] | None = None) -> DataFrame:
    columns = lake.columns(layers or LAYERS)
    return columns.join(dictionary.meanings(lake.spark), "column_name", "left")


def documentation_coverage(lake: Lake) -> DataFrame:
    """Columns, undocumented columns and documented share of each table."""
    covered = key_present(F.col("meaning"))
    return coverage(described_columns(lake), ["layer", "table_name"], covered).orderBy(
        "layer", "table_name")


def undocumented_columns(lake: Lake) -> DataFrame:
    missing = described_columns(lake).where(~key_present(F.col("meaning")))
    return missing.select("layer", "table_name", "column_name").orderBy(
        "layer", "table_name", "column_name")


def tag_listing(lake: Lake) -> DataFrame:
    tags = listing(dictionary.tags(lake.spark), ["layer", "table_name", "tag_name", "tag_value"])
    return tags.drop("rows")


def tables_without_tag(lake: Lake, layer: str, tag: str) -> DataFrame:
    tables = lake.columns([layer]).select("table_name").distinct()
    tagged = dictionary.tags(lake.spark).where(
        (F.col("layer") == layer) & (F.col("tag_name") == tag))
    return not_in(tables, "table_name", tagged, "table_name")


def recent_lineage(lake: Lake, days: int = 7) -> DataFrame:
    """What fed what in the last days."""
    edges = lineage_edges(lake.read_appended(RUN_LOG), "source", "target", "event_date",
                          F.current_date(), days, blank="(file)")
    return edges.orderBy("target", "source")


def row_count_report(lake: Lake) -> DataFrame:
    """Rows of every table of every layer."""
    return lake.count_tables([name for layer in LAYERS for name in lake.tables(layer)])


def validation_report(lake: Lake, accepted_copies: int | None = None) -> DataFrame:
    """``check, found, target, verdict`` over all layers: documents, tags, tables and row chain."""
    tagged = dictionary.tags(lake.spark).select("layer", "table_name").distinct()
    columns = lake.columns(LAYERS)
    tables = lake.spark.createDataFrame(
        [tuple(t.split(".")) for t in dictionary.TABLES], "layer string, table_name string")
    counts = {
        "columns without a meaning": described_columns(lake).where(~key_present(F.col("meaning"))),
        "tables without a tag": columns.select("layer", "table_name").distinct().join(
            tagged, ["layer", "table_name"], "left_anti"),
        "tables missing": tables.join(columns, ["layer", "table_name"], "left_anti"),
    }
    counted = row_counts(counts).select(
        F.col("table_name").alias("check"), F.col("rows").alias("found"),
        F.lit(0).cast("bigint").alias("target"),
        F.when(F.col("rows") == 0, "OK").otherwise("CHECK").alias("verdict"))
    chain = chain_report(lake, accepted_copies).select(
        F.concat(F.lit("rows "), F.col("step")).alias("check"),
        F.col("difference").alias("found"), "target", "verdict")
    return counted.unionByName(chain)
