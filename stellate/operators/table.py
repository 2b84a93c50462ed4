"""Operators on the component table ``(uid, cmp, mapped, shard)``.

Lookup, members, progress rows, dense numbering, relabelling and the
contraction of uid edges to component edges.  All are DataFrame plans; no
rows pass through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import shard_of
from ..session import join_on, materialize, tidy

ShardFn = Callable[[Column], Column]


def assign_dense_ids(df: DataFrame, order_by: list[str], id_col: str = "cmp",
                     num_partitions: int | None = None,
                     partition_by: list[str] | None = None) -> DataFrame:
    """Running number from 0 in ``order_by`` order (within each
    ``partition_by`` group, if given), computed in parallel.

    Rows are range-partitioned on (group, order) and sorted inside each
    partition, so a very large group spreads over several range partitions
    instead of one task.  Each row takes its position inside its partition;
    the rows of each (partition, group) are counted and the running sum of
    those counts over the partitions of a group is the offset (a window
    over one row per partition and group).  The ranged rows are written
    once, so the positions and counts come from the same data; the range
    partitioning reads its input twice (sampling, then the shuffle), so
    write an expensive input first.
    """
    spark = df.sparkSession
    g = list(partition_by or [])
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Input position breaks ties, so equal order keys keep their input order
    # and a long run of them can still be spread over range partitions.
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(n, *g, *order_by, "_tie")
              .sortWithinPartitions(*g, *order_by, "_tie")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    staged = materialize(ranged, "dense-ids")
    cols = [c for c in df.columns if c != id_col]
    staged = staged.drop("_tie")
    parts = staged.groupBy(*g, "_pid").agg(F.count(F.lit(1)).alias("_n"),
                                          F.min("_pos").alias("_first"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = parts.select(*g, "_pid", "_first",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # A NULL group is a group.
    return (join_on(staged, off, [*g, "_pid"], null_safe=tuple(g))
            .select(*cols, (F.col("_off") + F.col("_pos") - F.col("_first")).alias(id_col)))


def populate(uids: DataFrame, shard_fn: ShardFn = shard_of,
             order_by: list[str] | None = None) -> DataFrame:
    """Initial component table: every uid gets its running number (in
    ``order_by`` order, default ``uid``) as component, ``mapped`` false, and
    its shard from ``shard_fn``."""
    numbered = assign_dense_ids(uids.select("uid"), order_by or ["uid"], "cmp")
    return numbered.select(F.col("uid").cast("string").alias("uid"),
                           F.col("cmp").cast("bigint").alias("cmp"),
                           F.lit(False).alias("mapped"),
                           shard_fn(F.col("uid")).cast("int").alias("shard"))


def lookup_uid(table: DataFrame, uid: str, shard_fn: ShardFn = shard_of) -> DataFrame:
    """Rows of one uid.  The shard predicate is added so that the scan of a
    table partitioned by ``shard`` reads one partition; ``uid = x`` is pushed
    to the Parquet reader."""
    shard = shard_fn(F.lit(uid))
    # A uid may have no shard (NULL); the constant side folds to one test.
    same = (F.col("shard") == shard) | (shard.isNull() & F.col("shard").isNull())
    return table.where(same & (F.col("uid") == F.lit(uid)))


def lookup_uids(table: DataFrame, keys: DataFrame, key: str = "uid") -> DataFrame:
    """Rows of many uids at once (semi join, no per-key queries).  Repeated
    keys are removed first (combined map-side), so a key asked for very
    often is one row in the join."""
    return table.join(keys.select(F.col(key).alias("uid")).distinct(), "uid", "left_semi")


def component_members(table: DataFrame, cmp: int | Column) -> DataFrame:
    """The uids whose component is ``cmp``."""
    value = cmp if isinstance(cmp, Column) else F.lit(cmp)
    return table.where(F.col("cmp") == value).select("uid")


def progress_rows(table: DataFrame, every: int = 1000) -> DataFrame:
    """Rows whose running number is a multiple of ``every``."""
    return table.where(F.col("cmp") % every == 0)


def relabel(table: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row whose ``cmp`` is an old label takes the new one.

    ``labels`` is ``(id, cmp)`` = (old label, new label).  All rows read the
    old labels, so a new label that equals another old label cannot chain.
    Rows of components without a label keep their own.  Catalyst broadcasts
    ``labels`` only when its measured size is under the broadcast threshold;
    otherwise the join is shuffled and a hot old label is split by AQE.
    """
    lab = labels.select(F.col("id").alias("_old"), F.col("cmp").alias("_new"))
    out_cols = [F.coalesce(F.col("_new"), F.col("cmp")).alias("cmp") if c == "cmp" else F.col(c)
                for c in table.columns]
    return table.join(lab, table["cmp"] == lab["_old"], "left").select(*out_cols)


@dataclass
class Contracted:
    edges: DataFrame     # (src, dst) on cmp, no self-loops, no repeats (unless asked for)
    unknown: DataFrame   # input edges with an end that is not in the table


def known_ends(e: DataFrame, table: DataFrame,
               resolve: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(uid, cmp)`` of the distinct ends of edges ``(_s, _d)`` that are in
    the table: an inner join, so small ends are broadcast and the table is
    streamed, not shuffled."""
    ends = e.select(F.col("_s").alias("uid")).unionByName(e.select(F.col("_d").alias("uid"))).distinct()
    known = table.select("uid", "cmp").join(ends, "uid")
    return resolve(known) if resolve is not None else known


@tidy
def contract_edges(uid_edges: DataFrame, table: DataFrame, src: str = "src",
                   dst: str = "dst",
                   resolve: Callable[[DataFrame], DataFrame] | None = None,
                   repeats: bool = False) -> Contracted:
    """Replace both ends of uid edges by their current component number.

    Edges inside one component become self-loops and are dropped; an edge
    with an end that is not stored cannot be placed and is returned in
    ``unknown`` instead of vanishing in an inner join.

    The table is touched once, by an inner join with the distinct ends of the
    round; a round whose ends fit the broadcast threshold streams the table
    without shuffling it.  ``resolve`` maps the matched ``(uid, cmp)`` rows
    to current labels (a store resolves them through its label history here,
    on the round-sized rows rather than on the whole table).  The rest of the
    work is edge-sized.  ``repeats=True`` leaves repeated component edges in
    (one shuffle of the edges less, for a caller that links them anyway).
    """
    e = uid_edges.select(F.col(src).cast("string").alias("_s"), F.col(dst).cast("string").alias("_d"))
    # Round-sized, and read for both ends: written once, so the table is
    # scanned once per contraction.
    known = materialize(known_ends(e, table, resolve), "contract-known")
    s = known.select(F.col("uid").alias("_s"), F.col("cmp").alias("_sc"))
    d = known.select(F.col("uid").alias("_d"), F.col("cmp").alias("_dc"))
    # One left join for each end, written once: the edges and the unknown
    # ends are told apart by NULL.  An edge that is placed is its two labels:
    # the uids are written for the others only, and an edge inside one
    # component is not written.
    lost = F.col("_sc").isNull() | F.col("_dc").isNull()
    placed = materialize(e.join(s, "_s", "left").join(d, "_d", "left")
                         .where(lost | (F.col("_sc") != F.col("_dc")))
                         .select(*(F.when(lost, F.col(c)).alias(c) for c in ("_s", "_d")), "_sc", "_dc"),
                         "contract-placed")
    edges = (placed.where(F.col("_sc") != F.col("_dc"))
             .select(F.col("_sc").alias("src"), F.col("_dc").alias("dst")))
    unknown = placed.where(lost).select(F.col("_s").alias("src"), F.col("_d").alias("dst"))
    return Contracted(edges if repeats else edges.distinct(), unknown)
