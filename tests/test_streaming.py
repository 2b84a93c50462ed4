"""Structured Streaming round loop: files of message lines -> store."""

from __future__ import annotations

import os

import pytest
from conftest import PROTOCOL_EDGES, PROTOCOL_EXAMPLE, union_find
from stellate.plans.store import ComponentStore
from stellate.sources.codes import enumerate_codes
from stellate.sources.messages import read_log_parts, read_messages, stream_messages
from stellate.streaming.rounds import run_rounds_stream


def write(path, name, lines):
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def codes_store(spark, scratch, name="tbl"):
    store = ComponentStore(spark, os.path.join(scratch, name))
    store.populate(enumerate_codes(spark, 2).select("uid"))
    return store


def labels(store):
    return {int(r.uid): r.cmp for r in store.read().where("cmp <> cast(uid as int)").collect()}


def quarantine(spark, store):
    path = f"{store.path}/_quarantine"
    return sorted((r.line, r.reason) for r in spark.read.parquet(path).collect())


def stream(spark, src, store, ck, files=None, parts=None):
    q = run_rounds_stream(stream_messages(spark, src, files, parts), store, ck)
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_rounds_and_restart(spark, scratch):
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    log = PROTOCOL_EXAMPLE  # fixed values of the protocol example
    write(src, "a.txt", log[:3] + ["c2"])
    stream(spark, src, store, ck, 1)
    write(src, "b.txt", ["c1"] + log[3:5] + ["x y", "c2"])
    stream(spark, src, store, ck, 1)  # restart from the checkpoint
    write(src, "c.txt", ["c4", "1 2", "c2"])  # stops its own log only
    stream(spark, src, store, ck, 1)
    write(src, "d.txt", ["c1", "20 21", "c2"])
    stream(spark, src, store, ck, 1)
    uf = union_find(PROTOCOL_EDGES + [(20, 21)])
    assert labels(store) == {i: c for i, c in uf.items() if i != c}
    # a batch in which no c2 was answered is no round
    assert [r.message for r in store.rounds().orderBy("round").collect()] == ["c3", "c3", "c3"]
    assert quarantine(spark, store) == [("1 2", "after the stop"), ("c2", "after the stop"), ("x y", "bad token")]


def test_stream_follows_the_protocol(spark, scratch):
    """Reset edges, edges not asked for and edges after the stop are not merged."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    write(src, "a.txt", ["c1", "1 2", "c1", "3 4", "c2", "5 6", "c4", "7 8"])
    stream(spark, src, store, os.path.join(scratch, "ck"))
    assert labels(store) == {4: 3}


@pytest.mark.parametrize("files", [1, 3, None])
def test_a_stop_ends_its_own_log(spark, scratch, files):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    for k in (1, 3, 5):
        write(src, f"log{k}.txt", ["c1", f"{k} {k + 1}", "c2", "c4"])
    stream(spark, src, store, os.path.join(scratch, "ck"), files)
    assert labels(store) == {2: 1, 4: 3, 6: 5}


#: One log in pieces: rounds and their c2 in different files, a reset, a second
#: c2 in a round, a stop with lines behind it.
LONG_LOG = [["c1", "1 2"], ["2 3", "c2", "3 4"], ["c2", "4 5"], ["c1", "6 7"], ["7 8;8 9"], ["c2", "10 11", "c4", "12 13"],
            ["14 15", "c2"]]
LONG_LABELS = {2: 1, 3: 1, 4: 1, 7: 6, 8: 6, 9: 6}
PARTS = r"/([a-z]+)\.([0-9]+)\.txt"


@pytest.mark.parametrize("files,order", [(1, 1), (None, 1), (2, -1)])
def test_a_log_goes_on_over_files_and_batches(spark, scratch, files, order):
    """Neither the trigger nor the order of arrival matters."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    for t, k in enumerate(list(range(len(LONG_LOG)))[::order]):
        write(src, f"x.{k}.txt", LONG_LOG[k])
        if k < 3:
            write(src, f"y.{k}.txt", [f"{60 + k} {61 + k}"] + (["c2"] if k == 1 else []))
        for name in ("x", "y")[:1 + (k < 3)]:  # files are taken by their time
            os.utime(os.path.join(src, f"{name}.{k}.txt"), (1000 + t, 1000 + t))
    stream(spark, src, store, os.path.join(scratch, "ck"), files, PARTS)
    assert labels(store) == LONG_LABELS | {61: 60, 62: 60}
    assert quarantine(spark, store) == [("12 13", "after the stop"), ("14 15", "after the stop"), ("c2", "after the stop")]
    (source,) = store._need()["streams"]
    state = store.stream_state(source)
    assert {tuple(r) for r in state["logs"].collect()} == {("x", 7, 16, True), ("y", 3, 4, False)}
    assert state["held"].count() == 0
    assert [r.line for r in state["carry"].orderBy("line_no").collect()] == ["62 63"]  # not asked for yet


def test_parts_wait_for_the_missing_one(spark, scratch):
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    write(src, "x.0.txt", ["c1", "1 2"])
    write(src, "x.2.txt", ["3 4", "c2"])
    stream(spark, src, store, ck, None, PARTS)
    assert labels(store) == {}
    other = os.path.join(scratch, "other")  # another stream into the same table
    os.makedirs(other)
    write(other, "x.0.txt", ["c1", "40 41", "c2"])
    stream(spark, other, store, os.path.join(scratch, "ck2"), None, PARTS)
    write(src, "x.1.txt", ["2 3"])
    stream(spark, src, store, ck, None, PARTS)
    assert labels(store) == {2: 1, 3: 1, 4: 1, 41: 40}
    write(src, "more.x.1.txt", ["50 51", "c2"])  # part 1 of x again
    stream(spark, src, store, ck, None, r"(x)\.([0-9]+)\.txt")
    assert labels(store) == {2: 1, 3: 1, 4: 1, 41: 40}
    assert quarantine(spark, store) == [("50 51", "part read before"), ("c2", "part read before")]


def test_a_replayed_batch_leaves_state_and_labels(spark, scratch):
    from stellate.streaming.rounds import round_writer

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    store = codes_store(spark, scratch)
    write(src, "x.0.txt", ["c1", "1 2", "c2", "3 4"])
    batch = (spark.read.text(src).selectExpr("'x' log_id", "cast(0 as bigint) part", "input_file_name() file",
                                             "input_file_block_start() _blk", "value line"))
    w = round_writer(store, source="s")
    w(batch, 0)
    v = store.current_version()
    w(batch, 0)
    assert store.current_version() == v and labels(store) == {2: 1}
    assert [r.line for r in store.stream_state("s")["carry"].collect()] == ["3 4"]


def test_read_log_parts(spark, scratch):
    for k, part in enumerate(LONG_LOG):
        write(scratch, f"x.{k}.txt", part)
    write(scratch, "y.0.txt", ["c1"])
    write(scratch, "y.2.txt", ["a gap"])
    write(scratch, "y.3.txt", ["behind it"])
    write(scratch, "single", ["1 2", "c2"])
    got = read_log_parts(spark, scratch, PARTS)
    x = sorted((r.line_no, r.line) for r in got.lines.where("log_id = 'x'").collect())
    assert x == list(enumerate(line for part in LONG_LOG for line in part))
    assert sorted((r.log_id.rsplit("/", 1)[-1], r.line_no, r.line) for r in got.lines.where("log_id <> 'x'").collect()) == [
        ("single", 0, "1 2"), ("single", 1, "c2"), ("y", 0, "c1")]
    assert sorted((r.line, r.reason) for r in got.quarantine.collect()) == [
        ("a gap", "an earlier part is missing"), ("behind it", "an earlier part is missing")]


def test_read_message_files(spark, scratch):
    write(scratch, "log1.txt", ["c1", "1 2", "c2"])
    write(scratch, "log2.txt", ["c1", "3 4;4 5", "c2", "c4"])
    rows = read_messages(spark, scratch).collect()
    by_log = {}
    for r in rows:
        by_log.setdefault(r.log_id.rsplit("/", 1)[-1], []).append((r.line_no, r.line))
    assert sorted(by_log["log1.txt"]) == [(0, "c1"), (1, "1 2"), (2, "c2")]
    assert len(by_log["log2.txt"]) == 4


def sink_stream(spark, src, ck, files=None, parts=None):
    from stellate.streaming.rounds import run_components_stream

    seen = {}

    def sink(labels, batch_id):
        for r in labels.collect():
            seen.setdefault((r.log_id.rsplit("/", 1)[-1], r.snapshot_line), {})[r.id] = r.cmp

    q = run_components_stream(stream_messages(spark, src, files, parts), sink, ck)
    q.awaitTermination(300)
    assert q.exception() is None
    return seen


def test_components_stream_to_sink(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    write(src, "a.txt", PROTOCOL_EXAMPLE)
    write(src, "b.txt", ["c1", "1 2", "c1", "3 4", "c2", "5 6", "c4", "7 8", "c2"])
    write(src, "c.txt", ["1 2"])  # nobody asks
    got = sink_stream(spark, src, os.path.join(scratch, "ck"))
    (answer,) = [v for k, v in got.items() if k[0] == "a.txt"]
    assert len(answer) == 10 and answer[10] == 2 and answer[6] == 1 and answer[9] == 8
    assert {k: v for k, v in got.items() if k[0] != "a.txt"} == {("b.txt", 4): {3: 3, 4: 3}}


@pytest.mark.parametrize("files", [1, None])
def test_sink_gets_rounds_that_span_batches(spark, scratch, files):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for k, part in enumerate(LONG_LOG):
        write(src, f"x.{k}.txt", part)
        os.utime(os.path.join(src, f"x.{k}.txt"), (1000 + k, 1000 + k))
    got = sink_stream(spark, src, os.path.join(scratch, "ck"), files, PARTS)
    assert got == {("x", 3): {1: 1, 2: 1, 3: 1}, ("x", 5): {1: 1, 2: 1, 3: 1, 4: 1},
                   ("x", 10): {6: 6, 7: 6, 8: 6, 9: 6}}


def test_read_messages_numbers_lines_across_splits(spark, scratch):
    """A file split over many tasks still gets exact line numbers."""
    path = os.path.join(scratch, "big")
    os.makedirs(path)
    lines = [f"{i} {i + 1}" if i % 7 else "c1" for i in range(60000)]
    write(path, "log.txt", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 4  # the file is split
        df = read_messages(spark, path)
        got = sorted((r.line_no, r.line) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_many_files_are_listed_in_few_tasks(spark, scratch):
    """40 logs of two parts each: listing them must not take a task for each
    folder, when the stream is made or when it runs."""
    from stellate.sources.messages import stream_messages
    from stellate.streaming.rounds import run_components_stream

    rows = spark.range(240).selectExpr("id % 40 as log", "id % 80 div 40 as piece",
                                       "element_at(array('c1', '1 2', 'c2'), int(id div 80) + 1) as line")
    rows.repartition("log").write.partitionBy("log", "piece").text(f"{scratch}/logs")
    sc, name = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, most, got = spark.conf.get(name), int(spark.conf.get("spark.sql.shuffle.partitions")), []
    sc.setJobGroup("listing", "")
    try:
        lines = stream_messages(spark, f"{scratch}/logs", parts="log=([0-9]+)/piece=([0-9]+)/")
        tasks = [sc.statusTracker().getStageInfo(i).numTasks
                 for job in sc.statusTracker().getJobIdsForGroup("listing")
                 for i in sc.statusTracker().getJobInfo(job).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= most
    try:
        q = run_components_stream(lines, lambda labels, batch: got.append(batch), f"{scratch}/stream")
        q.awaitTermination()
        assert got and int(spark.conf.get(name)) <= most  # the source reads it at every batch
    finally:
        spark.conf.set(name, before)
