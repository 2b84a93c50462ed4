"""Message lines: classification, parsing, malformed input, formatting, rounds."""

from __future__ import annotations

import pytest
from conftest import PROTOCOL_EXAMPLE
from pyspark.sql import functions as F

from stellate.operators.messages import (MalformedMessage, assign_rounds, classify_messages,
                                         drop_after_stop, format_messages, parse_edges,
                                         round_snapshots)
from stellate.plans.rounds import acknowledgements, snapshot_components


def log(spark, lines, log_id="L"):
    return spark.createDataFrame([(log_id, i, s) for i, s in enumerate(lines)],
                                 "log_id string, line_no bigint, line string")


def test_g1_log_end_to_end(spark):
    lines = log(spark, PROTOCOL_EXAMPLE)
    comps = {r.id: r.cmp for r in snapshot_components(lines).collect()}
    assert len(comps) == 10
    assert {comps[v] for v in (1, 3, 5, 6)} == {1}
    assert {comps[v] for v in (2, 4, 7, 10)} == {2}
    assert comps[8] == comps[9] == 8
    acks = acknowledgements(lines).collect()
    assert [a.message for a in acks] == ["c3"]


def test_classification(spark):
    lines = log(spark, ["", "c9", "cX", "c3", "c1", "1 2", "c01", "cTEST_EXIT"])
    got = [(r.kind, r.control, r.reason) for r in classify_messages(lines).orderBy("line_no").collect()]
    assert got == [("invalid", None, "empty line"),
                   ("invalid", None, "unknown control message"),
                   ("invalid", None, "control is not a number"),
                   ("control", 3, None), ("control", 1, None), ("data", None, None),
                   ("control", 1, None), ("exit", None, None)]


@pytest.mark.parametrize("line,edges,bad", [
    ("1 2;x y", [(1, 2)], ["x y"]),
    ("1 2;;3 4", [(1, 2), (3, 4)], [""]),
    ("1 2;", [(1, 2)], []),
    ("1 2 9", [(1, 2)], []),
    (";", [], []),
    ("7", [], ["7"]),
])
def test_malformed_parts(spark, line, edges, bad):
    p = parse_edges(log(spark, [line]))
    assert [(r.src, r.dst) for r in p.edges.orderBy("pos").collect()] == edges
    assert sorted(r.line for r in p.quarantine.collect()) == sorted(bad)


def test_strict_mode_raises(spark):
    with pytest.raises(MalformedMessage):
        parse_edges(log(spark, ["1 2;x y"]), mode="strict")
    assert parse_edges(log(spark, ["1 2"]), mode="strict").edges.count() == 1


def test_lines_after_stop_dropped(spark):
    lines = log(spark, ["c1", "1 2", "c4", "3 4", "c2"])
    assert [r.line for r in drop_after_stop(lines).orderBy("line_no").collect()] == ["c1", "1 2", "c4"]


def test_rounds_and_snapshots(spark):
    lines = log(spark, ["0 9", "c1", "1 2", "c2", "2 3", "c2", "c1", "5 6", "c2", "7 8"])
    r = {r.line_no: r.round for r in assign_rounds(lines).collect()}
    assert [r[i] for i in range(10)] == [0, 1, 1, 1, 1, 1, 2, 2, 2, 2]
    snaps = {}
    for s in round_snapshots(lines).collect():
        snaps.setdefault(s.snapshot_line, set()).add((s.src, s.dst))
    # the second c2 without a new c1 still sees the first edge
    assert snaps == {3: {(1, 2)}, 5: {(1, 2), (2, 3)}, 8: {(5, 6)}}


def test_segmented_scan_matches_single_chunk(spark):
    lines = log(spark, ["c1", "1 2", "c2", "c1", "3 4", "c2", "c4", "c1", "5 6", "c2"] * 3)
    a = sorted(map(tuple, assign_rounds(lines, chunk_size=1 << 20).select("line_no", "round").collect()))
    b = sorted(map(tuple, assign_rounds(lines, chunk_size=4).select("line_no", "round").collect()))
    assert a == b and len(a) == 7


def test_format_parse_roundtrip(spark):
    e = spark.createDataFrame([(1, 0, 5, 6), (1, 1, 7, 8), (2, 0, 9, 10)],
                              "g bigint, o int, src bigint, dst bigint")
    lines = {r.g: r.line for r in format_messages(e, ["g"], "o").collect()}
    assert lines == {1: "5 6;7 8", 2: "9 10"}
    back = format_messages(e, ["g"], "o", max_edges_per_line=1)
    assert back.count() == 3
    p = parse_edges(format_messages(e, ["g"], "o"), keep=("g",)).edges
    assert sorted((r.g, r.pos, r.src, r.dst) for r in p.collect()) == [(1, 0, 5, 6), (1, 1, 7, 8), (2, 0, 9, 10)]


def test_format_chunks_are_bounded_without_positions(spark):
    """Every edge has the same order value; lines still hold at most k edges."""
    e = spark.range(0, 2500).select(F.lit(1).alias("g"), F.lit(0).alias("o"),
                                    F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    lines = format_messages(e, ["g"], "o", max_edges_per_line=1000).collect()
    assert sorted(len(r.line.split(";")) for r in lines) == [500, 1000, 1000]
    back = parse_edges(format_messages(e, ["g"], "o", max_edges_per_line=1000), keep=("g",)).edges
    assert sorted((r.src, r.dst) for r in back.collect()) == [(i, i + 1) for i in range(2500)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-10**12, 10**12),
                          st.integers(-10**12, 10**12)), min_size=1, max_size=40))
def test_parse_format_identity(spark, rows):
    e = spark.createDataFrame([(g, i, a, b) for i, (g, a, b) in enumerate(rows)],
                              "g int, o int, src bigint, dst bigint")
    lines = format_messages(e, ["g"], "o", max_edges_per_line=7)
    back = parse_edges(lines, keep=("g", "chunk"), mode="strict").edges
    got = sorted((r.g, r.chunk * 7 + r.pos, r.src, r.dst) for r in back.collect())
    exp = []
    for g in {r[0] for r in rows}:
        mine = [(i, a, b) for i, (gg, a, b) in enumerate(rows) if gg == g]
        exp += [(g, k, a, b) for k, (_, a, b) in enumerate(sorted(mine))]
    assert got == sorted(exp)


def test_null_log_id_is_a_log_of_its_own(spark):
    lines = spark.createDataFrame([(None, 0, "c1"), (None, 1, "1 2"), (None, 2, "c2"),
                                   ("A", 0, "c1"), ("A", 1, "3 4"), ("A", 2, "c2")],
                                  "log_id string, line_no bigint, line string")
    got = sorted((r.log_id or "", r.id, r.cmp) for r in snapshot_components(lines).collect())
    assert got == [("", 1, 1), ("", 2, 1), ("A", 3, 3), ("A", 4, 3)]


@pytest.mark.parametrize("edges,rows", [(None, None), (8, 40), (3, 10)])
def test_snapshots_by_forests(spark, edges, rows):
    """Many snapshots in a round, repeats, self-loops, resets, two logs and a
    null one; rounds in one task, cut into chunks, and as a distributed job."""
    import random

    from conftest import union_find

    rnd = random.Random(4)
    logs, want = [], {}
    for name in ("a", "b", None):
        own = []
        for r in range(3):
            own += ["c1"] + [rnd.choice(["c2", f"{rnd.randrange(40)} {rnd.randrange(40)}",
                                         f"{rnd.randrange(40)} {rnd.randrange(12)};{k} {k}"]) for k in range(50)]
        logs += [(name, i, s) for i, s in enumerate(own)]
        seen = []
        for i, s in enumerate(own):
            if s == "c1":
                seen = []
            elif s == "c2":
                want |= {(name, i, v): c for v, c in union_find(seen).items()}
            else:
                seen += [tuple(map(int, p.split())) for p in s.split(";")]
    d = spark.createDataFrame(logs, "log_id string, line_no bigint, line string").repartition(3)
    got = snapshot_components(d, round_edges=edges, round_rows=rows).collect()
    assert {(r.log_id, r.snapshot_line, r.id): r.cmp for r in got} == want and len(got) == len(want)


def test_snapshots_do_not_multiply_edges(spark):
    """A path that grows by one edge a snapshot: the solver takes each edge once."""
    lines = log(spark, ["c1"] + [x for i in range(200) for x in (f"{i} {i + 1}", "c2")])
    df = snapshot_components(lines)
    rows = df.collect()
    assert len(rows) == sum(range(2, 202)) and {r.cmp for r in rows} == {0}
    edges = [p for p in df._stellate_steps if "snapshot-edges" in p]
    assert [spark.read.parquet(p).count() for p in edges] == [200]


def test_asks_are_counted_over_chunks(spark):
    lines = log(spark, ["c1", "1 2", "c2", "3 4", "c2", "c1", "5 6", "c2", "c4", "7 8"])
    for chunk in (2, 100):
        got = assign_rounds(lines, chunk_size=chunk, keep_stopped=True).orderBy("line_no").collect()
        assert [r.asks for r in got] == [0, 0, 0, 1, 1, 2, 2, 2, 3, 3]
        assert [r.stopped for r in got] == [False] * 9 + [True]
