"""Access to the landed Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The whole table `name` below `root`; pruning and pushdown are left to Catalyst."""
    return spark.read.parquet(f"{root}/{name}.parquet")
