"""Rounds of edges: the protocol's round loop as DataFrame jobs.

In the message protocol a ``c1`` starts a round, data lines add edges, and
each ``c2`` asks for the components of the edges since the last ``c1``; the
components are written and ``c3`` acknowledges.  Here:

* :func:`snapshot_components` computes the components of every ``c2``
  snapshot of every log in one job (the snapshots are the groups);
* :func:`acknowledgements` gives the ``c3`` of each snapshot;
* :func:`merge_rounds` folds rounds of uid edges into a table, one
  contraction + components + relabel per round;
* :meth:`ComponentStore.merge_round` does the same against stored versions.

For uid edges the final labelling does not depend on how the edges are split
into rounds or ordered, which is what allows a whole log, or a micro-batch,
to be merged as one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import CONTROL_FINISHED, CONTROL_WRITTEN, control_line
from ..operators.components import connected_components
from ..operators.forest import snapshot_labels, weighted_forest
from ..operators.messages import DEFAULT_CHUNK, assign_rounds, parse_edges
from ..operators.table import contract_edges, relabel
from ..session import join_on, materialize, release, shuffle_partitions, tidy


#: Edges of one round that a task takes, and rows that it gives.
ROUND_EDGES, ROUND_ROWS = 1 << 18, 1 << 22


@tidy
def snapshot_components(lines: DataFrame, chunk_size: int = DEFAULT_CHUNK,
                        round_edges: int | None = None, round_rows: int | None = None) -> DataFrame:
    """``(log_id, snapshot_line, id, cmp)``: components of each snapshot, the
    graph of all edges of the round before a ``c2``.

    An edge is never paired with the snapshots that hold it.  Its weight is
    the first ``c2`` after it (the running number of the ``c2`` lines), and
    the snapshot of the k-th ``c2`` has the components of the forest edges of
    weight up to k, for any minimum spanning forest of the round.  So each
    round's distinct edges are read once, lightest first, and every ``c2``
    on the way gives the labels as they stand.

    A round of more than ``round_edges`` distinct edges is cut into chunks
    whose minimum spanning forests take its place, again and again while
    that at least halves it; what is still larger (that many vertices in one
    round) is solved as a distributed job, one graph a snapshot, from those
    forests.  A round that gives more than ``round_rows`` rows is given by
    several tasks, each for a run of its snapshots.
    """
    most, rows_most = round_edges or ROUND_EDGES, round_rows or ROUND_ROWS
    r = materialize(assign_rounds(lines, chunk_size), "rounds")
    asks = (r.where((F.col("kind") == "control") & (F.col("control") == CONTROL_FINISHED))
            .select("log_id", "round", (F.col("asks") + 1).alias("w"), F.col("line_no").alias("snapshot")))
    edges = parse_edges(r, keep=("log_id", "round", "line_no", "asks")).edges
    # The next c2 after an edge has the number asks + 1; in another round it
    # does not ask for the edge.
    weighted = (edges.groupBy("log_id", "round", F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                .agg(F.min(F.col("asks") + 1).alias("w")))
    rounds = asks.groupBy("log_id", "round").agg(F.min("w").alias("first"), F.max("w").alias("last"))
    rounds = materialize(rounds.withColumn("group", F.monotonically_increasing_id()), "snapshot-rounds")
    e = join_on(weighted, rounds, ["log_id", "round"], null_safe=("log_id",))
    e = materialize(e.where("w <= last").select("group", "w", "u", "v"), "snapshot-edges")
    sizes = _group_sizes(e)
    large = sizes.where(F.col("n") > most)
    if not large.isEmpty():
        e, sizes = _thinned(e, sizes, most)
        large = sizes.where(F.col("n") > most)
    marks = join_on(asks, rounds, ["log_id", "round"], null_safe=("log_id",)).select("group", "w", "snapshot")
    out = _labels_in_tasks(e, marks, rounds, sizes.where(F.col("n") <= most), rows_most)
    if not large.isEmpty():
        out = out.unionByName(_labels_by_job(e.join(large.select("group"), "group", "left_semi"), marks))
    back = join_on(out, rounds.select("group", "log_id"), ["group"])
    return back.select("log_id", F.col("snapshot").alias("snapshot_line"), "id", "cmp")


def _group_sizes(e: DataFrame) -> DataFrame:
    return materialize(e.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "snapshot-sizes")


def _thinned(e: DataFrame, sizes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Forests in place of the edges of large rounds, while that helps."""
    parts = shuffle_partitions(e.sparkSession)
    while True:
        cut = sizes.where(F.col("n") > most).select("group", F.ceil(F.col("n") / most).cast("int").alias("chunks"))
        before = cut.join(sizes, "group").agg(F.sum("n")).first()[0] or 0
        dealt = (e.join(cut, "group").withColumn("chunk", F.pmod(F.xxhash64("u", "v"), F.col("chunks")).cast("int"))
                 .select("group", "chunk", "w", "u", "v").repartition(parts, "group", "chunk")
                 .sortWithinPartitions("group", "chunk", "w"))
        forest = dealt.mapInArrow(weighted_forest(), "group bigint, chunk int, w bigint, u bigint, v bigint")
        rest = e.join(cut.select("group"), "group", "left_anti")
        e = materialize(rest.unionByName(forest.select(*e.columns)), "snapshot-edges")
        now = _group_sizes(e)
        after = cut.select("group").join(now, "group").agg(F.sum("n")).first()[0] or 0
        sizes = now
        if 2 * after > before or now.where(F.col("n") > most).isEmpty():
            return e, sizes


def _labels_in_tasks(e: DataFrame, marks: DataFrame, rounds: DataFrame, sizes: DataFrame, rows_most: int) -> DataFrame:
    span = rounds.select("group", "first", (F.col("last") - F.col("first") + 1).alias("snaps")).join(sizes, "group")
    slices = F.least(F.col("snaps"), F.ceil(2 * F.col("n") * F.col("snaps") / rows_most)).cast("int")
    span = span.select("group", "first", "snaps", slices.alias("slices"))
    own = F.expr("(greatest(w, first) - first) * slices div snaps").cast("int")
    marked = marks.join(span, "group").select("group", own.alias("slice"), "w", F.lit(None).cast("bigint").alias("u"),
                                              F.lit(None).cast("bigint").alias("v"), "snapshot")
    # An edge counts in the slice of its first snapshot and in all later ones.
    given = e.join(span, "group").select(
        "group", F.explode(F.sequence(own, F.col("slices") - 1)).alias("slice"), "w", "u", "v",
        F.lit(None).cast("bigint").alias("snapshot"))
    rows = (given.unionByName(marked).repartition(shuffle_partitions(e.sparkSession), "group", "slice")
            .sortWithinPartitions("group", "slice", "w", F.col("snapshot").isNotNull()))
    return rows.mapInArrow(snapshot_labels(), "group bigint, snapshot bigint, id bigint, cmp bigint")


def _labels_by_job(e: DataFrame, marks: DataFrame) -> DataFrame:
    m = marks.withColumnRenamed("w", "k")
    graphs = e.join(m, "group").where("w <= k").select("group", "snapshot", "u", "v")
    return connected_components(graphs, "u", "v", group_by=["group", "snapshot"], edges_distinct=True)


def acknowledgements(lines: DataFrame, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """One ``c3`` line per ``c2`` that is answered (lines after a stop are
    not): ``(log_id, snapshot_line, round, message)``."""
    r = assign_rounds(lines, chunk_size)
    return (r.where((F.col("kind") == "control") & (F.col("control") == CONTROL_FINISHED))
            .select("log_id", F.col("line_no").alias("snapshot_line"), "round",
                    control_line(CONTROL_WRITTEN).alias("message")))


def resolve_labels(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Current labels of table rows, through a history ``(old, cur)``."""
    return relabel(rows, history.select(F.col("old").alias("id"), F.col("cur").alias("cmp")))


def advance_history(history: DataFrame, labels: DataFrame) -> DataFrame:
    """History after a round with ``labels`` ``(id, cmp)`` (old -> new):
    entries pointing at a merged label point at its new one, and the merged
    labels are added, so every old label is one step from its current one."""
    merged = labels.where(F.col("id") != F.col("cmp"))
    lab = merged.select(F.col("id").alias("cur"), F.col("cmp").alias("_n"))
    moved = history.join(lab, "cur", "left").select("old", F.coalesce("_n", "cur").alias("cur"))
    return moved.unionByName(merged.select(F.col("id").alias("old"), F.col("cmp").alias("cur")))


def merge_rounds(table: DataFrame, rounds: list[DataFrame], src: str = "src",
                 dst: str = "dst") -> DataFrame:
    """Fold rounds of uid edges into a component table, in order.

    Each round contracts its edges through the current labels (only the
    rows of its ends are resolved), computes the components of the
    contracted graph and moves the label history; the table itself is
    relabelled once, at the end.  Rounds cost what their edges and merged
    labels cost, not the size of the table.  ``table`` should be stored (a
    scan): every round reads it.
    """
    spark = table.sparkSession
    history = spark.createDataFrame([], "old bigint, cur bigint")
    for e in rounds:
        h = history
        # Repeats go where the components' tasks contract them, not to a shuffle of their own.
        con = contract_edges(e, table, src, dst, resolve=lambda rows, h=h: resolve_labels(rows, h), repeats=True)
        labels = connected_components(con.edges)
        history = materialize(advance_history(h, labels), "merge-history")
        for used in (h, labels, con.edges):
            release(used)
    return resolve_labels(table, history)


def file_components(spark, path: str, mode: str = "quarantine"):
    """Components of an edge-list file (``src dst`` per line): the labels
    ``(id, cmp)`` and the lines that are not edges."""
    from ..sources.edges import read_edge_list

    f = read_edge_list(spark, path, mode)
    return connected_components(f.edges), f.quarantine
