"""Reading a stored component table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_component_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a component table written with ``partitionBy('shard')``;
    filters on ``shard`` prune partitions, filters on ``uid`` / ``cmp`` are
    pushed to the Parquet reader."""
    return spark.read.parquet(path).select("uid", "cmp", "mapped", "shard")
