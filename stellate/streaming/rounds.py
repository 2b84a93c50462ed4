"""Structured Streaming: message lines in, rounds merged into the store.

The files of the stream are logs, or parts of logs, and follow the protocol as
in a batch: ``c1`` starts a round, ``c2`` asks for the edges since it, lines
after the ``c4`` (or the test-exit marker) of their own log do not count.  A
micro-batch merges exactly the edges that a ``c2`` asks for, inside
``foreachBatch``.

What a log that goes on needs is remembered between batches: where it stands
(next part, lines so far, whether it has stopped), the lines of parts that came
too early, and the data lines of its open round that no ``c2`` has asked for
yet.  This state is written with the round and named in the same manifest of
the store, so a round and its state are committed together or not at all, and
the result depends neither on the trigger nor on how a log is cut into files.

A round is recorded under its stream (an id kept beside the stream's
checkpoint) and batch id, so a batch replayed after a failure is skipped and
another stream's batch is not.  Whatever is not merged is written to
``_quarantine`` with a reason before the round is committed (a replay writes it
again): malformed lines, unknown ends, lines after a stop, late parts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.messages import CONTROL_FINISHED, CONTROL_SHUTDOWN
from ..operators.messages import asked_edges, assign_rounds, parse_edges
from ..plans.rounds import snapshot_components
from ..plans.store import ComponentStore
from ..session import delete_path, join_on, list_dirs, materialize, path_exists, tidy
from ..sources.messages import LOG_STATE, number_lines, place_parts

Sink = Callable[[DataFrame, int], None]


@dataclass
class Advanced:
    """One micro-batch put behind what its logs had before."""
    lines: DataFrame       # classified lines with their rounds, carried ones included; none after a stop
    fresh: DataFrame       # those that are new
    quarantine: DataFrame  # (line, reason) of new lines that have no place
    logs: DataFrame        # the state after the batch
    held: DataFrame
    open: DataFrame        # data lines of the open round of each log that goes on, with ``asked``

    def state(self, unasked_only: bool) -> dict[str, DataFrame]:
        carry = self.open.where("not asked") if unasked_only else self.open
        return {"logs": self.logs, "held": self.held, "carry": carry.select("log_id", "line_no", "line")}


def _state(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: tables[k] if k in tables else spark.createDataFrame([], s) for k, s in LOG_STATE.items()}


def advance_logs(batch: DataFrame, before: dict[str, DataFrame]) -> Advanced:
    """The lines of a batch of :func:`stellate.sources.messages.stream_messages`
    in the order of their logs, behind the lines carried from earlier batches.

    A micro-batch comes in a session of the stream, without adaptive
    execution; its lines are written once and go on in the session of
    ``before``, where all further work has it."""
    spark = before["logs"].sparkSession
    staged = materialize(batch.withColumn("_mid", F.monotonically_increasing_id()), "stream-batch")
    batch = spark.read.schema(staged.schema).parquet(staged._stellate_path)
    files = number_lines(batch, "_mid").select("log_id", "part", "file", "at", "line")
    placed = place_parts(files.unionByName(before["held"]), before["logs"])
    logs = materialize(placed.logs, "stream-logs")
    new = materialize(placed.lines.join(before["logs"].where("stopped").select("log_id", F.lit(True).alias("_over")),
                                        "log_id", "left").select("log_id", "line_no", "line",
                                                                 F.coalesce("_over", F.lit(False)).alias("_over")),
                      "stream-lines")
    both = (new.where("not _over").select("log_id", "line_no", "line", F.lit(True).alias("fresh"))
            .unionByName(before["carry"].withColumn("fresh", F.lit(False))))
    every = materialize(assign_rounds(both, keep_stopped=True), "stream-rounds")
    live = every.where("not stopped").drop("stopped")
    fresh = live.where("fresh")
    # The open round of a log is its last one; a c2 in it asks for what is before.
    control = F.col("kind") == "control"
    ends = every.groupBy("log_id").agg(
        F.max("round").alias("_last"), F.bool_or(((F.col("kind") == "exit") | (control & (F.col("control") == CONTROL_SHUTDOWN)))
                                                & ~F.col("stopped")).alias("_stop"))
    asked = (live.where(control & (F.col("control") == CONTROL_FINISHED)).groupBy("log_id", "round")
             .agg(F.max("line_no").alias("_ask")))
    goes_on = join_on(logs.select("log_id"), ends.where("not _stop"), ["log_id"])
    tail = (live.where(F.col("kind") == "data").join(goes_on, "log_id").where(F.col("round") == F.col("_last"))
            .join(asked, ["log_id", "round"], "left")
            .select("log_id", "line_no", "line",
                    F.coalesce(F.col("line_no") < F.col("_ask"), F.lit(False)).alias("asked")))
    after = logs.join(ends.where("_stop").select("log_id", F.lit(True).alias("_stop")), "log_id", "left").select(
        "log_id", "next_part", "lines", (F.col("stopped") | F.coalesce("_stop", F.lit(False))).alias("stopped"))
    lost = (new.where("_over").select("line", F.lit("after the stop").alias("reason"))
            .unionByName(every.where("stopped").select("line", F.lit("after the stop").alias("reason")))
            .unionByName(placed.late.select("line", F.lit("part read before").alias("reason"))))
    return Advanced(live, fresh, lost, after, placed.held, materialize(tail, "stream-open"))


def round_writer(store: ComponentStore, on: str = "uid", source: str | None = None):
    """The ``foreachBatch`` function that merges one micro-batch of
    :func:`stellate.sources.messages.stream_messages`."""

    @tidy
    def write(batch: DataFrame, batch_id: int) -> None:
        if store.seen(source, batch_id):
            return
        a = advance_logs(batch, _state(store.spark, store.stream_state(source)))
        edges = parse_edges(a.lines, keep=("log_id", "round", "line_no")).edges
        malformed = parse_edges(a.fresh).quarantine

        def keep_bad(unknown: DataFrame) -> None:
            bad = (malformed.select("line", "reason").unionByName(a.quarantine)
                   .unionByName(unknown.select(F.concat_ws(" ", "src", "dst").alias("line"),
                                               F.lit("unknown end").alias("reason"))))
            bad.write.mode("overwrite").parquet(f"{store.path}/_quarantine/source={source}/batch={batch_id}")

        asks = a.fresh.where((F.col("kind") == "control") & (F.col("control") == CONTROL_FINISHED))
        store.merge_round(asked_edges(a.lines, edges), on=on, batch_id=batch_id, source=source,
                          before_commit=keep_bad, state=a.state(unasked_only=True),
                          acknowledge=bool(asks.limit(1).collect())).release()

    return write


def stream_source(store: ComponentStore, checkpoint: str) -> str:
    """The id of the stream that owns ``checkpoint``, made on its first run."""
    path = f"{checkpoint.rstrip('/')}/stellate_source"
    if not path_exists(store.spark, f"{path}/_SUCCESS"):
        row = store.spark.createDataFrame([(uuid.uuid4().hex,)], "value string")
        row.coalesce(1).write.mode("overwrite").text(path)
    return store.spark.read.text(path).first()[0]


def run_rounds_stream(lines: DataFrame, store: ComponentStore, checkpoint: str,
                      on: str = "uid", available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Start the round loop on a stream of message logs."""
    source = stream_source(store, checkpoint)
    w = (lines.writeStream.foreachBatch(round_writer(store, on, source))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def components_writer(spark: SparkSession, sink: Sink, checkpoint: str):
    """``foreachBatch`` function for a stream without a table: every ``c2``
    gets the components of all edges of its round before it, whatever batch
    they came in, and ``sink((log_id, snapshot_line, id, cmp), batch_id)``
    writes them (the pluggable component writer).

    The state after batch b is kept under ``<checkpoint>/stellate_state``; a
    batch that is replayed starts from the one before it and calls the sink
    again with the same rows and batch id."""
    root = f"{checkpoint.rstrip('/')}/stellate_state"

    @tidy
    def write(batch: DataFrame, batch_id: int) -> None:
        done = sorted(int(d.removeprefix("batch=")) for d in list_dirs(spark, root))
        done = [b for b in done if b < batch_id and path_exists(spark, f"{root}/batch={b}/carry/_SUCCESS")]
        before = {k: spark.read.parquet(f"{root}/batch={done[-1]}/{k}") for k in LOG_STATE} if done else {}
        a = advance_logs(batch, _state(spark, before))
        # Carried lines hold no c2, so all snapshots are new.
        sink(snapshot_components(a.lines.select("log_id", "line_no", "line")), batch_id)
        for k, df in a.state(unasked_only=False).items():
            df.write.mode("overwrite").parquet(f"{root}/batch={batch_id}/{k}")
        for b in done[:-1]:
            delete_path(spark, f"{root}/batch={b}")

    return write


def run_components_stream(lines: DataFrame, sink: Sink, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    """Components of every snapshot of the streamed logs, handed to ``sink``."""
    w = (lines.writeStream.foreachBatch(components_writer(lines.sparkSession, sink, checkpoint))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
