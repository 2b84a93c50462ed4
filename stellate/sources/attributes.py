"""Attribute files: ``id,username,full name`` without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import USER_ATTRIBUTES


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(USER_ATTRIBUTES).option("header", "false").csv(path)
