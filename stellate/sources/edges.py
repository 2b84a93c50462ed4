"""Edge sources: edge-list text files and in-memory rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import integer_token
from ..schemas import EDGE


@dataclass
class EdgeFile:
    edges: DataFrame       # (src, dst)
    quarantine: DataFrame  # (line, reason)


def read_edge_list(spark: SparkSession, path: str, mode: str = "quarantine") -> EdgeFile:
    """One edge per line, ``src dst`` split on one space; extra tokens are
    ignored.  Lines whose first two tokens are not integers are quarantined
    (``mode='strict'`` raises).  The text is split by Spark's file splits, so
    a large file is read by many tasks."""
    text = spark.read.text(path)
    toks = F.split(F.col("value"), " ")
    p = text.select(F.col("value").alias("line"),
                    integer_token(F.try_element_at(toks, F.lit(1))).alias("src"),
                    integer_token(F.try_element_at(toks, F.lit(2))).alias("dst"))
    good = p.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    bad = (p.where(F.col("src").isNull() | F.col("dst").isNull())
           .select("line", F.lit("not an edge").alias("reason")))
    if mode == "strict":
        first = bad.limit(1).collect()
        if first:
            raise ValueError(f"not an edge: {first[0]['line']!r}")
    return EdgeFile(good, bad)


def edges_from_rows(spark: SparkSession, rows: Iterable[tuple[int, int]]) -> DataFrame:
    """Edges from a small in-memory list (also the empty edge set)."""
    return spark.createDataFrame(list(rows), EDGE)


def empty_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EDGE)


def union_edges(*batches: DataFrame) -> DataFrame:
    """Bag union of edge batches (repeats kept), by column name."""
    if not batches:
        raise ValueError("no edge batches")
    out = batches[0].select("src", "dst")
    for b in batches[1:]:
        out = out.unionByName(b.select("src", "dst"))
    return out
