"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math
import pickle
from typing import Any

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the ASCII blanks (Java regular expression).
#: ``bytes.split()`` cuts UTF-8 text at exactly the same characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df``
    has it (column names compare without case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = "_" + name
    return name


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def chunks_of(rows: int, most: int) -> int:
    return max(1, math.ceil(rows / most))


class Shipped:
    """A broadcast object of a class of this package.  A plain broadcast
    pickles such a class by reference, and executors without a copy of the
    repository cannot read it; here the class travels with the object, and
    each task opens it once."""

    def __init__(self, spark: SparkSession, obj: Any):
        self._data = spark.sparkContext.broadcast(cloudpickle.dumps(obj))

    def __getstate__(self) -> dict:
        return {"_data": self._data}

    @property
    def value(self) -> Any:
        if "_value" not in self.__dict__:
            self._value = pickle.loads(self._data.value)
        return self._value


class BitFilter:
    """Which 64-bit hashes may be in a set: one bit for each value of their
    first ``bits`` bits.  Its size is fixed, whatever the set."""

    def __init__(self, bits: int, words: list[tuple[int, int]]):
        self.shift = np.uint64(64 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        if words:
            at, mask = zip(*words)
            self.words[list(at)] = np.array(mask, np.int64).view(np.uint64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        v = hashes >> self.shift
        return (self.words[v >> np.uint64(6)] >> (v & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_filter(df: DataFrame, col: str, bits: int) -> BitFilter:
    """Filter over a bigint column; at most ``2^bits / 64`` rows come to the
    driver."""
    v = F.shiftrightunsigned(F.col(col), 64 - bits)
    bit = F.expr("shiftleft(1L, b)")
    words = (df.select(F.shiftright(v, 6).alias("w"), (v % 64).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(bit).alias("m")))
    return BitFilter(bits, [(r["w"], r["m"]) for r in words.collect()])


def keep_known(df: DataFrame, col: str, known: DataFrame, bits: int = 24) -> DataFrame:
    """The rows of ``df`` whose bigint column ``col`` may be in the one column
    of ``known``: all that are, and few others.  One bit for each value of
    the hashes' first ``bits`` bits, so at most ``2^bits / 64`` rows are
    broadcast, whatever ``known`` holds."""
    def place(c: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(c), 64 - bits)

    w, m = fresh(df, "_w"), fresh(df, "_m")
    v = known.select(place(known.columns[0]).alias("v"))
    words = (v.select(F.shiftright("v", 6).alias(w), (F.col("v") % 64).cast("int").alias("b"))
             .groupBy(w).agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias(m)))
    hit = F.col(m).bitwiseAND(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({col}), {64 - bits}) % 64 as int))"))
    got = df.withColumn(w, F.shiftright(place(col), 6)).join(F.broadcast(words), w)
    return got.where(hit != 0).select(*df.columns)


def tell_known(df: DataFrame, col: str, known: DataFrame, out: str, bits: int = 24) -> DataFrame:
    """``df`` with a boolean column ``out``: whether the row's bigint column
    ``col`` may be in the one column of ``known`` (true for all that are, and
    for few others).  One bit for each value of the hashes' first ``bits``
    bits, so at most ``2^bits / 64`` rows are broadcast, whatever ``known``
    holds."""
    def place(c: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(c), 64 - bits)

    w, m = fresh(df, "_w"), fresh(df, "_m")
    v = known.select(place(known.columns[0]).alias("v"))
    words = (v.select(F.shiftright("v", 6).alias(w), (F.col("v") % 64).cast("int").alias("b"))
             .groupBy(w).agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias(m)))
    hit = F.col(m).bitwiseAND(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({col}), {64 - bits}) % 64 as int))"))
    got = df.withColumn(w, F.shiftright(place(col), 6)).join(F.broadcast(words), w, "left")
    return got.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(hit != 0, F.lit(False)).alias(out))


def even_keys(spark: SparkSession, parts: int) -> list[int]:
    """One int for each of ``parts`` shuffle partitions, such that
    ``repartition(parts, key)`` sends each to a partition of its own."""
    ids = spark.range(max(64, 32 * parts)).select(F.col("id").cast("int").alias("k"))
    rows = ids.groupBy(F.pmod(F.hash("k"), F.lit(parts)).alias("p")).agg(F.min("k").alias("k")).collect()
    return sorted(r["k"] for r in rows)
