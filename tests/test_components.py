"""Connected components: golden graphs, brute-force properties, edge cases."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import PROTOCOL_EDGES, union_find
from stellate.operators.components import connected_components, vertices_from_edges
from stellate.operators.report import attach_attributes, format_components
from stellate.sources.attributes import read_attributes
from stellate.sources.edges import edges_from_rows, empty_edges, read_edge_list, union_edges

DATA = __file__.rsplit("/", 1)[0] + "/data"


def labels(df):
    return {r["id"]: r["cmp"] for r in df.collect()}


def test_message_graph_g1(spark):
    e = edges_from_rows(spark, PROTOCOL_EDGES)
    got = labels(connected_components(e))
    assert len(got) == 10
    assert {v: got[v] for v in (1, 3, 5, 6)} == {1: 1, 3: 1, 5: 1, 6: 1}
    assert {got[v] for v in (2, 4, 7, 10)} == {2}
    assert got[8] == got[9] == 8


def test_followers_g2_with_users(spark):
    f = read_edge_list(spark, f"{DATA}/followers.txt")
    assert f.quarantine.count() == 0
    got = connected_components(f.edges)
    assert labels(got) == {11: 11, 12: 11, 14: 11, 13: 13, 16: 13, 17: 13}
    users = read_attributes(spark, f"{DATA}/users.txt")
    joined = {(r["username"], r["cmp"]) for r in
              attach_attributes(got, users, columns=["username"]).collect()}
    assert joined == {("ash", 11), ("birch", 11), ("doum", 11),
                      ("cedar", 13), ("elder", 13), ("fir", 13)}


def test_g3_and_format(spark):
    e = edges_from_rows(spark, [(1, 2), (1, 3), (3, 4), (6, 7)])
    got = connected_components(e)
    assert labels(got) == {1: 1, 2: 1, 3: 1, 4: 1, 6: 6, 7: 6}
    lines = {r["line"] for r in format_components(got).collect()}
    assert "(4,1)" in lines and "(7,6)" in lines and len(lines) == 6


def test_empty_and_self_loops(spark):
    assert connected_components(empty_edges(spark)).count() == 0
    e = edges_from_rows(spark, [(5, 5), (7, 7), (7, 8), (1, 2), (2, 1), (2, 1)])
    assert labels(connected_components(e)) == {5: 5, 7: 7, 8: 7, 1: 1, 2: 1}


def test_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(0, 400)]
    hub = [(10_000, 10_001 + i) for i in range(500)]
    got = labels(connected_components(edges_from_rows(spark, path + hub)))
    assert all(got[i] == 0 for i in range(401))
    assert all(got[10_001 + i] == 10_000 for i in range(500))


def test_grouped_components(spark):
    rows = [("a", 1, 2), ("a", 2, 3), ("b", 2, 3), ("b", 5, 6)]
    e = spark.createDataFrame(rows, "g string, src bigint, dst bigint")
    got = {(r["g"], r["id"]): r["cmp"] for r in
           connected_components(e, group_by=["g"]).collect()}
    assert got == {("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("b", 2): 2, ("b", 3): 2,
                   ("b", 5): 5, ("b", 6): 5}


def test_union_and_vertices(spark):
    a = edges_from_rows(spark, [(1, 2), (1, 2)])
    b = edges_from_rows(spark, [(2, 3)])
    u = union_edges(a, b)
    assert u.count() == 3  # bag union keeps repeats
    assert sorted(r["id"] for r in vertices_from_edges(u).collect()) == [1, 2, 3]


def test_edge_list_quarantine(spark, scratch):
    p = f"{scratch}/edges.txt"
    with open(p, "w") as fh:
        fh.write("1 2\n3 4 99\nx 5\n6\n")
    f = read_edge_list(spark, p)
    assert sorted(map(tuple, f.edges.collect())) == [(1, 2), (3, 4)]
    assert sorted(r["line"] for r in f.quarantine.collect()) == ["6", "x 5"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=80))
def test_matches_union_find(spark, edges):
    got = labels(connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")))
    assert got == union_find(edges)


def test_order_and_direction_do_not_matter(spark):
    rnd = random.Random(7)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(400)]
    flipped = [(b, a) for a, b in reversed(edges)] + edges[:50]
    a = labels(connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")))
    b = labels(connected_components(spark.createDataFrame(flipped, "src bigint, dst bigint")))
    assert a == b == union_find(edges)
    assert all(v <= k for k, v in a.items())
    assert all(a[v] == v for v in a.values())  # a label is a vertex of its component


def test_order_part_graph_against_brute_force(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    e = li.select((F.col("l_orderkey") * 3).alias("src"), (F.col("l_partkey") * 3 + 1).alias("dst"))
    exp = union_find([(r.src, r.dst) for r in e.collect()])
    assert labels(connected_components(e)) == exp


def test_file_components(spark):
    from stellate.plans.rounds import file_components

    labels, bad = file_components(spark, f"{DATA}/followers.txt")
    assert labels.count() == 6 and bad.count() == 0


def test_iteration_cap_raises_instead_of_partial_labels(spark):
    import pytest

    from stellate.operators.components import ComponentsDidNotConverge

    path = edges_from_rows(spark, [(i, i + 1) for i in range(64)])
    with pytest.raises(ComponentsDidNotConverge):
        connected_components(path, max_iterations=2)
    assert set(labels(connected_components(path)).values()) == {0}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 25), st.integers(0, 25)),
                max_size=60))
def test_grouped_matches_union_find_per_group(spark, rows):
    df = spark.createDataFrame(rows, "g string, src bigint, dst bigint")
    got = {(r.g, r.id): r.cmp for r in connected_components(df, group_by=["g"]).collect()}
    exp = {}
    for grp in {r[0] for r in rows}:
        for v, lab in union_find([(a, b) for gg, a, b in rows if gg == grp]).items():
            exp[(grp, v)] = lab
    assert got == exp


def test_successor_edges_have_the_neighbour_components(spark):
    """Shared successors against neighbour candidates, on a part of the codes
    and on ones of several lengths."""
    import random

    from stellate.operators.neighbors import neighbor_edges, successor_edges, successor_keys
    from stellate.sources.codes import enumerate_codes

    rnd = random.Random(2)
    uids = rnd.sample([f"{i:04d}" for i in range(10000)], 900) + ["9", "8", "90", "09", "99x", ""]
    t = spark.createDataFrame(list(enumerate(uids)), "cmp bigint, uid string")

    def labels(edges):
        return {r.id: r.cmp for r in connected_components(edges).collect()}

    assert labels(successor_edges(t)) == labels(neighbor_edges(t)) != {}
    every = enumerate_codes(spark, 3)
    keys = successor_keys(every).count()
    assert keys == 3 * 900 and successor_edges(every).count() <= keys  # at most L rows a code


def test_contraction_before_the_stars(spark):
    """Repeats and edges inside a partition's components do not reach the
    first shuffle; small lots give the same components."""
    import glob
    import random

    from conftest import union_find
    from stellate.operators import forest

    rnd = random.Random(3)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] * 20 + [(900, 900), (901, 901)]
    want = union_find(pairs)
    d = spark.createDataFrame(pairs, "src bigint, dst bigint").repartition(4)
    stats: dict = {}
    assert {r.id: r.cmp for r in connected_components(d, stats=stats).collect()} == want
    assert stats["edges"] == len(pairs)
    for limit in (7, 64, 1 << 20):
        rows = d.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).mapInArrow(
            forest.star_forest(limit), "u bigint, v bigint").collect()
        assert union_find([tuple(r) for r in rows]) == want
        if limit > 64:
            assert len(rows) <= 4 * len(want)


def test_steps_write_fewer_rows_than_edges(spark, monkeypatch):
    """A graph whose tasks can tell little by themselves (random pairs, dealt
    at random): the steps link what meets and write less than they were given."""
    from stellate.operators import components as cc
    from stellate.session import materialize

    n, written = 120000, []

    def counted(df, name):
        out = materialize(df, name)
        if name != "cc-min":
            written.append(out.count())
        return out

    monkeypatch.setattr(cc, "materialize", counted)
    e = (spark.range(0, n, 1, 8).select((F.xxhash64("id") % 30000).alias("a"), (F.hash("id") % 4000).alias("b"))
         .select((F.abs("a") * 3).alias("src"), (F.abs("b") * 3 + 1).alias("dst")))
    got = {r["id"]: r["cmp"] for r in cc.connected_components(e).collect()}
    assert got == union_find([(r["src"], r["dst"]) for r in e.collect()])
    assert sum(written) < 2 * n


def test_repeats_in_several_tasks_and_paths(spark):
    """Without groups an edge may be left in several tasks; the loop still ends."""
    rows = [(i, i + 1) for i in range(300)] * 2 + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (1399, 1000)]
    e = spark.createDataFrame(rows, "src bigint, dst bigint").repartition(7)
    stats = {}
    got = {r["id"]: r["cmp"] for r in connected_components(e, stats=stats).collect()}
    assert got == union_find(rows)
    assert stats["edges"] == len(rows)


def test_memory_of_a_contracting_task_is_bounded():
    """However many edges a task reads, it holds one lot of them."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from stellate.operators.forest import star_forest

    rnd = np.random.default_rng(1)

    def batches(n):
        for _ in range(n):
            yield pa.RecordBatch.from_arrays([pa.array(rnd.integers(1 << 30, 1 << 31, 10000)),
                                              pa.array(rnd.integers(0, 1 << 30, 10000))], names=["u", "v"])

    tracemalloc.start()
    try:
        assert sum(len(b) for b in star_forest()(batches(120))) <= 1200000
        assert tracemalloc.get_traced_memory()[1] < 140 << 20
    finally:
        tracemalloc.stop()
