"""Enumeration of the full code domain of a given length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import shard_of


def enumerate_codes(spark: SparkSession, length: int,
                    num_partitions: int | None = None) -> DataFrame:
    """All ``10**length`` codes of ``length`` digits in ascending order.

    ``cmp`` is the running number from 0 in that order (the number the code
    spells), ``mapped`` is false and ``shard`` is the first digit.  ``range``
    splits the domain into partitions without any shuffle.
    """
    if length < 1 or length > 18:
        raise ValueError("length must be in 1..18 to fit a BIGINT")
    ids = spark.range(0, 10 ** length, numPartitions=num_partitions)
    uid = F.lpad(F.col("id").cast("string"), length, "0")
    return ids.select(uid.alias("uid"), F.col("id").alias("cmp"),
                      F.lit(False).alias("mapped"), shard_of(uid).alias("shard"))


def code_width(numbers: DataFrame, column: str) -> DataFrame:
    """One-row DataFrame ``(width)``: the digits needed for the largest value."""
    return numbers.agg(
        F.greatest(F.lit(1), F.length(F.max(F.col(column)).cast("string"))).alias("width"))
