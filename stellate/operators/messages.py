"""Message logs: classification, edge parsing, formatting, rounds, snapshots.

A log is a sequence of lines ``(log_id, line_no, line)``.  Rounds and stop
markers are running values over ``line_no`` inside each log.  They are
computed as a segmented scan: the log is cut into chunks of ``line_no``, the
chunk totals get a running sum (one row per chunk), and a window inside each
chunk finishes the job.  So no log, however long, is sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.messages import (CONTROL_FINISHED, CONTROL_SHUTDOWN, CONTROL_START,
                                  control_number, edge_parts, integer_token,
                                  invalid_reason, message_kind)
from ..session import join_on, materialize

DEFAULT_CHUNK = 1 << 20


class MalformedMessage(ValueError):
    pass


def classify_messages(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``kind`` (data / control / exit / invalid), ``control`` (1..4) and
    ``reason`` (why a line is invalid)."""
    k = message_kind(line)
    return (lines.withColumn("kind", k)
            .withColumn("control", F.when(k == "control", control_number(F.col(line))))
            .withColumn("reason", invalid_reason(line)))


def assign_rounds(lines: DataFrame, chunk_size: int = DEFAULT_CHUNK, keep_stopped: bool = False) -> DataFrame:
    """Round number of every line and removal of lines after a stop.

    A line without ``line_no`` has no place in its log: it comes out as
    ``invalid`` with a reason and no round.

    ``round`` counts the ``c1`` lines up to and including the line (0 before
    the first); lines after the first ``c4`` or test-exit marker of their log
    are dropped, or kept and marked in a column ``stopped``.  ``asks`` counts
    the ``c2`` lines of the log before the line.  Input: ``(log_id, line_no,
    line)``; output adds the columns of :func:`classify_messages`, ``round``
    and ``asks``.
    """
    every = classify_messages(lines)
    c = every.where(F.col("line_no").isNotNull())
    lost = (every.where(F.col("line_no").isNull())
            .withColumn("kind", F.lit("invalid")).withColumn("reason", F.lit("no line number"))
            .withColumn("control", F.lit(None).cast(every.schema["control"].dataType))
            .withColumn("round", F.lit(None).cast("bigint")).withColumn("asks", F.lit(None).cast("bigint")))
    x = (c.withColumn("_start", ((F.col("kind") == "control")
                                 & (F.col("control") == CONTROL_START)).cast("int"))
         .withColumn("_ask", ((F.col("kind") == "control")
                              & (F.col("control") == CONTROL_FINISHED)).cast("int"))
         .withColumn("_stop", ((F.col("kind") == "exit")
                               | ((F.col("kind") == "control")
                                  & (F.col("control") == CONTROL_SHUTDOWN))).cast("int"))
         .withColumn("_chunk", F.expr(f"line_no div {int(chunk_size)}")))
    totals = x.groupBy("log_id", "_chunk").agg(F.sum("_start").alias("_st"), F.sum("_ask").alias("_as"),
                                              F.max("_stop").alias("_sp"))
    before = Window.partitionBy("log_id").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("log_id", "_chunk",
                            F.coalesce(F.sum("_st").over(before), F.lit(0)).alias("_st0"),
                            F.coalesce(F.sum("_as").over(before), F.lit(0)).alias("_as0"),
                            F.coalesce(F.max("_sp").over(before), F.lit(0)).alias("_sp0"))
    inside = Window.partitionBy("log_id", "_chunk").orderBy("line_no")
    y = join_on(x, offsets, ["log_id", "_chunk"], null_safe=("log_id",))
    y = (y.withColumn("round", F.col("_st0") + F.sum("_start").over(
            inside.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("asks", F.col("_as0") + F.coalesce(F.sum("_ask").over(
             inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_stopped", F.greatest(F.col("_sp0"), F.coalesce(F.max("_stop").over(
             inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))))
    temporary = ("_start", "_ask", "_stop", "_chunk", "_st0", "_as0", "_sp0", "_stopped")
    if keep_stopped:
        return (y.withColumn("stopped", F.col("_stopped") == 1).drop(*temporary)
                .unionByName(lost.withColumn("stopped", F.lit(False))))
    return y.where(F.col("_stopped") == 0).drop(*temporary).unionByName(lost)


def asked_edges(rounds: DataFrame, edges: DataFrame) -> DataFrame:
    """The edges that a ``c2`` of their own round and log asks for: those
    before its last ``c2``.  Each edge comes out once."""
    asks = (rounds.where((F.col("kind") == "control") & (F.col("control") == CONTROL_FINISHED))
            .groupBy("log_id", "round").agg(F.max("line_no").alias("_ask")))
    return (join_on(edges, asks, ["log_id", "round"], null_safe=("log_id",))
            .where(F.col("line_no") < F.col("_ask")).drop("_ask"))


def _where_cols(df: DataFrame):
    log = F.col("log_id") if "log_id" in df.columns else F.lit(None)
    ln = F.col("line_no") if "line_no" in df.columns else F.lit(None)
    return log.cast("string").alias("log_id"), ln.cast("bigint").alias("line_no")


@dataclass
class Parsed:
    edges: DataFrame       # (..., line_no, pos, src, dst)
    quarantine: DataFrame  # (log_id, line_no, line, reason)


def parse_edges(lines: DataFrame, keep: tuple[str, ...] = ("log_id", "line_no"),
                mode: str = "quarantine") -> Parsed:
    """Turn data lines into edges ``(*keep, pos, src, dst)``.

    ``pos`` is the 0-based place of the edge in its line.  The first two
    tokens of each part are the ends; extra tokens are ignored.  Parts that
    are empty, short, or not integers, and invalid lines, are returned in
    ``quarantine`` with a reason; ``mode='strict'`` raises on the first one
    instead.  Control and exit lines yield nothing.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError("mode must be 'quarantine' or 'strict'")
    c = lines if "kind" in lines.columns else classify_messages(lines)
    data = c.where(F.col("kind") == "data")
    parts = data.select(*keep, "line", F.posexplode(edge_parts("line")).alias("pos", "_part"))
    toks = F.split(F.col("_part"), " ")
    a, b = F.try_element_at(toks, F.lit(1)), F.try_element_at(toks, F.lit(2))
    parsed = parts.select(*keep, "pos", "_part", integer_token(a).alias("src"),
                          integer_token(b).alias("dst"),
                          F.when((F.size(toks) < 2) | (b == ""), True).otherwise(False).alias("_short"))
    good = parsed.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    reason = (F.when(F.col("_part") == "", F.lit("empty part"))
              .when(F.col("_short"), F.lit("missing token"))
              .otherwise(F.lit("bad token")))
    bad_parts = (parsed.where(F.col("src").isNull() | F.col("dst").isNull())
                 .select(*_where_cols(parsed), F.col("_part").alias("line"), reason.alias("reason")))
    bad_lines = (c.where(F.col("kind") == "invalid")
                 .select(*_where_cols(c), "line", "reason"))
    quarantine = bad_lines.unionByName(bad_parts)
    if mode == "strict":
        first = quarantine.limit(1).collect()
        if first:
            r = first[0]
            raise MalformedMessage(f"line {r['line_no']}: {r['reason']}: {r['line']!r}")
    return Parsed(good.select(*keep, "pos", "src", "dst"), quarantine)


def format_messages(edges: DataFrame, group: list[str], order: str,
                    src: str = "src", dst: str = "dst",
                    max_edges_per_line: int = 1000) -> DataFrame:
    """Serialise edges to data lines ``"a b;c d"``: one line per group and
    chunk of ``max_edges_per_line`` edges, edges in ``order`` (then by ends).

    The edges of each group are numbered in order first (in parallel, see
    :func:`stellate.operators.table.assign_dense_ids`), so every line, and
    every collected list, holds at most ``max_edges_per_line`` edges however
    large a group is.  Returns ``(*group, chunk, line)``.
    """
    from .table import assign_dense_ids

    base = edges.select(*group, F.col(order).alias("_o"), F.col(src).cast("bigint").alias("_s"),
                        F.col(dst).cast("bigint").alias("_d"))
    numbered = assign_dense_ids(base, ["_o", "_s", "_d"], "_k", partition_by=group)
    keyed = numbered.select(*group, F.expr(f"_k div {int(max_edges_per_line)}").alias("chunk"),
                            F.struct("_k", "_s", "_d").alias("_e"))
    agg = keyed.groupBy(*group, "chunk").agg(F.sort_array(F.collect_list("_e")).alias("_es"))
    line = F.array_join(F.transform("_es", lambda e: F.concat_ws(" ", e["_s"].cast("string"),
                                                                  e["_d"].cast("string"))), ";")
    return agg.select(*group, "chunk", line.alias("line"))


def round_snapshots(lines: DataFrame, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """The graph each ``c2`` asks for: all edges since the last ``c1`` of the
    same log (a second ``c2`` without a new ``c1`` sees the earlier edges
    too).  Returns ``(log_id, round, snapshot_line, line_no, pos, src, dst)``.

    Each edge is paired only with the ``c2`` lines of its own round that
    follow it, so the output is the sum of the snapshot sizes (one snapshot
    per round in the usual protocol); edges are never paired with edges.
    """
    # Both the edges and the c2 lines come from the rounds: written once, so
    # the window pipeline runs once.
    r = materialize(assign_rounds(lines, chunk_size), "rounds")
    finished = r.where((F.col("kind") == "control") & (F.col("control") == CONTROL_FINISHED)) \
        .select("log_id", "round", F.col("line_no").alias("snapshot_line"))
    edges = parse_edges(r, keep=("log_id", "round", "line_no")).edges
    return (join_on(edges, finished, ["log_id", "round"], null_safe=("log_id",))
            .where(F.col("line_no") < F.col("snapshot_line"))
            .select("log_id", "round", "snapshot_line", "line_no", "pos", "src", "dst"))


def drop_after_stop(lines: DataFrame, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Lines of each log up to (and including) its first stop marker."""
    return assign_rounds(lines, chunk_size).select(*lines.columns)
