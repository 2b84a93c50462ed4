"""Message-line sources: text files, logs cut over several files, text streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import few_listing_tasks, join_on, materialize, tidy

#: What a stream of logs has to remember between batches, by name.
LOG_STATE = {
    "logs": "log_id string, next_part bigint, lines bigint, stopped boolean",
    "held": "log_id string, part bigint, file string, at bigint, line string",
    "carry": "log_id string, line_no bigint, line string",
}


@tidy
def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Message logs stored one log per text file: ``(log_id, line_no, line)``.

    ``log_id`` is the file and ``line_no`` the 0-based line, exact even for a
    file that Spark splits over many tasks (:func:`number_lines`).  For logs
    that go on in another file see :func:`read_log_parts`.
    """
    raw = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("_blk"), F.col("value").alias("line"))
    return number_lines(raw).select(F.col("file").alias("log_id"), F.col("at").alias("line_no"), "line")


def number_lines(raw: DataFrame, order: str | None = None) -> DataFrame:
    """Lines ``(file, _blk, line, ...)`` as they come from a text scan, with
    their 0-based place ``at`` in their file; or written lines whose column
    ``order`` holds the running ids of the scan.

    Inside one file split the lines come in order, so a line's number is the
    count of lines in the earlier splits of its file plus its place in its
    own split.  The split counts are one row per split; their running sum is
    a window per file over those rows only.  The scan is written once so that
    the ids and the counts come from the same read.
    """
    staged = raw.withColumnRenamed(order, "_mid") if order else materialize(
        raw.withColumn("_mid", F.monotonically_increasing_id()), "message-lines")
    splits = staged.groupBy("file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy("file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "_blk", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    keep = [c for c in raw.columns if c not in ("_blk", order)]
    return (staged.join(splits, ["file", "_blk"])
            .select(*keep, (F.col("_off") + F.col("_mid") - F.col("_first")).alias("at")))


def part_of(file: Column, parts: str | None) -> tuple[Column, Column]:
    """``(log_id, part)`` of a file path.  ``parts`` is a regular expression
    whose first group is the log and whose second one the number of the
    part; a file that it does not match is a log by itself (part NULL)."""
    if parts is None:
        return file, F.lit(None).cast("bigint")
    part = F.regexp_extract(file, parts, 2).try_cast("bigint")
    return F.when(part.isNotNull(), F.regexp_extract(file, parts, 1)).otherwise(file), part


@dataclass
class PlacedLines:
    lines: DataFrame  # (log_id, line_no, line) of parts whose turn has come
    held: DataFrame   # (log_id, part, file, at, line): an earlier part is missing
    late: DataFrame   # (log_id, part, file, at, line): the part was read before
    logs: DataFrame   # (log_id, next_part, lines, stopped) of the logs that may go on


def place_parts(files: DataFrame, logs: DataFrame, first: int = 0) -> PlacedLines:
    """Numbers lines ``(log_id, part, file, at, line)`` through the parts of
    their logs.

    ``logs`` tells where each log stands.  Parts follow each other by one,
    from ``first``; a part whose predecessor has not come is held back, with
    all that follow it.  A part that was read before, or the second file of
    one part, is late.  Windows run over one row per part.
    """
    one = F.coalesce("part", F.lit(first)).alias("part")
    x = files.select("log_id", F.col("part").isNotNull().alias("_goes_on"), one, "file", "at", "line")
    x = materialize(x, "log-files")
    parts = x.groupBy("log_id", "part", "file").agg(F.count(F.lit(1)).alias("n"), F.first("_goes_on").alias("_goes_on"))
    known = logs.select("log_id", F.col("next_part").alias("_next"), F.col("lines").alias("_lines"),
                        F.col("stopped").alias("_was"))
    p = parts.join(known, "log_id", "left").withColumn("_next", F.coalesce("_next", F.lit(first)))
    copy = F.row_number().over(Window.partitionBy("log_id", "part").orderBy("file"))
    p = p.withColumn("_late", (copy > 1) | (F.col("part") < F.col("_next")))
    w = Window.partitionBy("log_id", "_late").orderBy("part")
    turn = F.col("part") - F.col("_next") == F.row_number().over(w) - 1
    upto = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    p = p.withColumn("_ready", ~F.col("_late") & turn).withColumn("_off", F.coalesce("_lines", F.lit(0)) + upto)
    p = materialize(p, "log-parts")
    x = x.select("log_id", "part", "file", "at", "line")
    keys = ["log_id", "part", "file"]

    def of(which: Column) -> DataFrame:
        return join_on(x, p.where(which).select(*keys, "_off"), keys)

    lines = of(F.col("_ready")).select("log_id", (F.col("_off") + F.col("at")).alias("line_no"), "line")
    done = (p.where("_ready and _goes_on").groupBy("log_id")
            .agg((F.max("part") + 1).alias("_to"), F.max(F.col("_off") + F.col("n")).alias("_n")))
    after = logs.join(done, "log_id", "full").select(
        "log_id", F.coalesce("_to", "next_part").alias("next_part"), F.coalesce("_n", "lines").alias("lines"),
        F.coalesce("stopped", F.lit(False)).alias("stopped"))
    rest = [*keys, "at", "line"]
    return PlacedLines(lines, of(~F.col("_late") & ~F.col("_ready")).select(*rest), of(F.col("_late")).select(*rest), after)


@dataclass
class LogParts:
    lines: DataFrame       # (log_id, line_no, line)
    quarantine: DataFrame  # (log_id, line_no, line, reason): lines that have no place


@tidy
def read_log_parts(spark: SparkSession, path: str, parts: str, first: int = 0) -> LogParts:
    """Message logs that go on from file to file.

    ``parts`` gives each file's log and number (:func:`part_of`); line numbers
    run on over the parts of a log.  Lines behind a missing part, and those of
    the second file of a part, have no place in their log and are returned in
    ``quarantine`` (with the line's place in its file).
    """
    log, part = part_of(F.input_file_name(), parts)
    raw = spark.read.text(path).select(log.alias("log_id"), part.alias("part"), F.input_file_name().alias("file"),
                                       F.input_file_block_start().alias("_blk"), F.col("value").alias("line"))
    placed = place_parts(number_lines(raw), spark.createDataFrame([], LOG_STATE["logs"]), first)

    def bad(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select("log_id", F.col("at").alias("line_no"), "line", F.lit(reason).alias("reason"))

    return LogParts(placed.lines, bad(placed.held, "an earlier part is missing")
                    .unionByName(bad(placed.late, "second file of a part")))


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    parts: str | None = None) -> DataFrame:
    """Streaming text source of message logs: ``(log_id, part, file, _blk, line)``.

    A file arrives whole in one micro-batch; its path and the start of each
    split are kept, so that the lines can be numbered as :func:`read_messages`
    does.  Every file is one log, or, with ``parts``, a part of one
    (:func:`part_of`); parts may come in any order and in any batch.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    file = F.col("_metadata.file_path")
    log, part = part_of(file, parts)
    few_listing_tasks(spark)
    return r.load(path).select(log.alias("log_id"), part.alias("part"), file.alias("file"),
                               F.col("_metadata.file_block_start").alias("_blk"), F.col("value").alias("line"))
