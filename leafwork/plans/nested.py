"""Problem 5: nested payloads as related flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafwork.operators import nested
from leafwork.plans.registry import Registry
from leafwork.session import once
from leafwork.sources.tables import table

registry = Registry()


def payload_nodes(spark: SparkSession, root: str) -> DataFrame:
    """The relation all tables are projections of: payloads are parsed once in a session."""
    return once(spark, "nested payloads", f"{root}/mineru_responses.parquet", lambda: nested.flatten_payloads(table(spark, root, "mineru_responses")))


@registry.add("p5_found")
def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return nested.found_nodes(payload_nodes(spark, root))


@registry.add("p5_blocks")
def p5_blocks(spark: SparkSession, root: str) -> DataFrame:
    return nested.block_table(payload_nodes(spark, root))


@registry.add("p5_plain_blocks")
def p5_plain_blocks(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "plain_block")


@registry.add("p5_table_blocks")
def p5_table_blocks(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "table_block")


@registry.add("p5_figure_blocks")
def p5_figure_blocks(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "figure_block")


@registry.add("p5_container_blocks")
def p5_container_blocks(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "container_block")


@registry.add("p5_cells")
def p5_cells(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "cell")


@registry.add("p5_captions")
def p5_captions(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "caption")


@registry.add("p5_footnotes")
def p5_footnotes(spark: SparkSession, root: str) -> DataFrame:
    return nested.subtype(payload_nodes(spark, root), "footnote")
