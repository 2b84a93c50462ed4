"""Neighbour codes and neighbour search against stored items.

Two codes are neighbours when one unit moves from one digit to another.  The
moves of a code are generated as an array inside the row and exploded, so
the work is spread over the partitions of the codes, with no cross join and
no per-row Python.  A code of length L has at most L*(L-1) neighbours.  Spark's
size estimate does not count the exploded rows, so a join of the neighbours
names its strategy: left to the estimate, Spark would send them all through the
driver to broadcast them.  Where
only the components matter, :func:`successor_edges` describes the same graph
by stars around shared successors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import shard_of


def _moves(codes: DataFrame, uid: str, keep: tuple[str, ...], upward_only: bool) -> DataFrame:
    """Explode every position pair ``p < q`` of each code and build the
    neighbour with native string functions (no higher-order lambdas, so the
    whole step stays in generated code).

    *up*: one unit moves from ``q`` to ``p`` (the neighbour is larger);
    *down*: one unit moves from ``p`` to ``q`` (the neighbour is smaller).
    """
    n = F.length(F.col("uid"))
    base = codes.select(F.col(uid).alias("uid"), *keep)
    pp = base.select("uid", *keep, F.explode(
        F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    ).alias("_p"))
    pq = pp.select("uid", *keep, "_p", F.explode(F.sequence(F.col("_p") + 1, n - 1)).alias("_q"))
    p, q = F.col("_p"), F.col("_q")
    u = F.col("uid")
    dp = u.substr(p + 1, F.lit(1)).try_cast("int")
    dq = u.substr(q + 1, F.lit(1)).try_cast("int")
    head, mid, tail = u.substr(F.lit(1), p), u.substr(p + 2, q - p - 1), u.substr(q + 2, n)

    def spliced(ap, aq):
        return F.concat(head, (dp + ap).cast("string"), mid, (dq + aq).cast("string"), tail)

    up = F.when((dp < 9) & (dq > 0), spliced(1, -1))
    if upward_only:
        nbrs = F.array(up)
    else:
        nbrs = F.array(up, F.when((dp > 0) & (dq < 9), spliced(-1, 1)))
    # Digits are checked too: a character that is not a digit gives NULL.
    ok = F.col("uid").rlike("^[0-9]*$")
    return (pq.where(ok).select("uid", *keep, F.explode(nbrs).alias("nbr"))
            .where(F.col("nbr").isNotNull()))


def neighbors(codes: DataFrame, uid: str = "uid", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(uid, *keep, nbr)`` for every valid neighbour code of every input code."""
    return _moves(codes, uid, tuple(keep), upward_only=False)


def stored_neighbors(codes: DataFrame, table: DataFrame, uid: str = "uid",
                     within_shard: bool = False,
                     shard_fn: Callable[[Column], Column] = shard_of) -> DataFrame:
    """Neighbours of ``codes`` that are stored in ``table``.

    Returns ``(uid, nbr, nbr_cmp, nbr_shard)``.  By default all shards are
    searched; ``within_shard=True`` keeps only neighbours stored in the shard of
    the code itself (the one-shard view): the shard that ``codes`` gives, or
    that of ``shard_fn`` if there is no such column.  The join is on the unique
    ``uid`` of the table, so no key is hot: a code is the neighbour of at
    most L*(L-1) codes.
    """
    keep = ()
    if within_shard:
        own = F.col("shard") if "shard" in codes.columns else shard_fn(F.col(uid))
        codes, keep = codes.select(F.col(uid), own.alias("_own")), ("_own",)
    t = table.select(F.col("uid").alias("nbr"), F.col("cmp").alias("nbr_cmp"),
                     F.col("shard").alias("nbr_shard"))
    nb = neighbors(codes, uid, keep).join(t.hint("merge"), "nbr")
    if within_shard:
        nb = nb.where(F.col("_own").eqNullSafe(F.col("nbr_shard")))
    return nb.select("uid", "nbr", "nbr_cmp", "nbr_shard")


def neighbor_edges(table: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` on ``cmp`` between stored neighbour codes.

    Every neighbour pair is found from both ends; only the upward move is
    generated (the neighbour above the code), which halves the rows and
    leaves each pair exactly once (``edges_distinct`` for the components).
    """
    nb = _moves(table.select("uid", F.col("cmp").alias("src")), "uid", ("src",), upward_only=True)
    right = table.select(F.col("uid").alias("nbr"), F.col("cmp").alias("dst"))
    return nb.join(right.hint("merge"), "nbr").select("src", "dst")


def successor_keys(codes: DataFrame, uid: str = "uid", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(uid, *keep, key)``: the codes that have one unit more than ``uid`` in
    one digit.  Two codes are neighbours exactly when they share such a key
    (x + e_p = y + e_q), and they share one only: at most L rows a code
    describe what takes L*(L-1) neighbour candidates."""
    u, p = F.col("uid"), F.col("_p")
    n = F.length(u)
    at = (codes.select(F.col(uid).alias("uid"), *keep).where(u.rlike("^[0-9]+$"))
          .select("uid", *keep, F.explode(F.sequence(F.lit(1), n)).alias("_p")))
    digit = u.substr(p, F.lit(1)).cast("int")
    return (at.where(digit < 9)
            .select("uid", *keep, F.concat(u.substr(F.lit(1), p - 1), (digit + 1).cast("string"),
                                           u.substr(p + 1, n)).alias("key")))


def successor_edges(table: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` on ``cmp`` with the components of the neighbour
    graph of the stored codes: the members of a key (at most L of them) form
    a star around the least.  One shuffle of at most L rows a code; no
    candidate is generated that has to be looked up."""
    members = successor_keys(table.select("uid", "cmp"), keep=("cmp",)).groupBy("key").agg(
        F.min("cmp").alias("src"), F.collect_list("cmp").alias("all"))
    return (members.where(F.size("all") > 1).select("src", F.explode("all").alias("dst"))
            .where(F.col("src") != F.col("dst")))
