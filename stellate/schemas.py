"""Schemas of the data model (explicit, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Component table: one row per item; ``uid`` is unique, ``shard`` is the
# partition column of the stored table.
COMPONENT_TABLE = T.StructType([
    T.StructField("uid", T.StringType(), False),
    T.StructField("cmp", T.LongType(), False),
    T.StructField("mapped", T.BooleanType(), False),
    T.StructField("shard", T.IntegerType(), False),
])

# Undirected edge between two vertex ids.
EDGE = T.StructType([
    T.StructField("src", T.LongType(), True),
    T.StructField("dst", T.LongType(), True),
])

# Vertex -> component label (the least vertex id of its component).
LABELS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("cmp", T.LongType(), False),
])

# Message lines of one or more logs.
MESSAGE_LINES = T.StructType([
    T.StructField("log_id", T.StringType(), True),
    T.StructField("line_no", T.LongType(), True),
    T.StructField("line", T.StringType(), True),
])

# Attribute file: CSV without header.
USER_ATTRIBUTES = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("full_name", T.StringType(), True),
])

# Scratch rows of the storage smoke harness.
SCRATCH_ROWS = T.StructType([
    T.StructField("a", T.StringType(), True),
    T.StructField("b", T.IntegerType(), True),
])

# Quarantined input: what could not be parsed, and why.
QUARANTINE = T.StructType([
    T.StructField("log_id", T.StringType(), True),
    T.StructField("line_no", T.LongType(), True),
    T.StructField("line", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
])
