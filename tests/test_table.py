"""Component table: dense ids, populate, lookup, relabel, contraction, store rounds."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import union_find
from stellate.operators.table import (assign_dense_ids, component_members, contract_edges,
                                      lookup_uid, populate, progress_rows, relabel)
from stellate.plans.rounds import merge_rounds
from stellate.plans.store import ComponentStore, UidNotUnique
from stellate.sources.codes import enumerate_codes


def test_dense_ids(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = assign_dense_ids(df, ["k"], "seq", num_partitions=7).orderBy("k").collect()
    assert [r.seq for r in got] == list(range(5000))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_populate_lookup_members_progress(spark):
    uids = spark.createDataFrame([(f"{i:05d}",) for i in range(2500, 0, -1)], "uid string")
    t = populate(uids)
    row = lookup_uid(t, "00010").collect()
    assert len(row) == 1 and row[0].cmp == 9 and row[0].shard == 0 and row[0].mapped is False
    assert [r.uid for r in component_members(t, 9).collect()] == ["00010"]
    assert sorted(r.cmp for r in progress_rows(t).collect()) == [0, 1000, 2000]


def test_relabel_keeps_isolated_and_is_idempotent(spark):
    t = enumerate_codes(spark, 2)
    labels = spark.createDataFrame([(5, 1), (1, 1), (9, 0), (0, 0)], "id bigint, cmp bigint")
    once = relabel(t, labels)
    twice = relabel(once, labels)
    a = {r.uid: r.cmp for r in once.collect()}
    assert a["05"] == 1 and a["09"] == 0 and a["42"] == 42
    assert a == {r.uid: r.cmp for r in twice.collect()}


def test_contract_edges_with_unknown(spark):
    t = spark.createDataFrame([("a", 1, False, 0), ("b", 1, False, 0), ("c", 3, False, 0)],
                              "uid string, cmp bigint, mapped boolean, shard int")
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "zz")], "src string, dst string")
    c = contract_edges(e, t)
    assert sorted(map(tuple, c.edges.collect())) == [(1, 3)]
    assert [tuple(r) for r in c.unknown.collect()] == [("c", "zz")]


def test_a_placed_edge_is_written_as_its_labels(spark, monkeypatch):
    """Uids are written for unknown edges only, edges inside a component not
    at all; repeats go only when they are not asked for."""
    from stellate.operators import table as tb

    written = {}
    real = tb.materialize

    def kept(df, name):
        out = real(df, name)
        written[name] = sorted(map(tuple, out.select("_s", "_d", "_sc", "_dc").collect()), key=str) if (
            name == "contract-placed") else None
        return out

    monkeypatch.setattr(tb, "materialize", kept)
    t = spark.createDataFrame([("a", 1, False, 0), ("b", 1, False, 0), ("c", 3, False, 0), ("d", 3, False, 0)],
                              "uid string, cmp bigint, mapped boolean, shard int")
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("zz", "a"), ("c", "yy"), ("c", None), ("c", "yy")],
                              "src string, dst string")
    lost = [("c", None), ("c", "yy"), ("c", "yy"), ("zz", "a")]
    for repeats in (False, True):
        con = contract_edges(e, t, **({"repeats": True} if repeats else {}))
        assert list(map(tuple, con.edges.collect())) == [(1, 3)] * (2 if repeats else 1)
        assert sorted(map(tuple, con.unknown.collect()), key=str) == sorted(lost, key=str)
        rows = written["contract-placed"]
        assert [r for r in rows if r[:2] == (None, None)] == [(None, None, 1, 3)] * 2
        assert len(rows) == 2 + len(lost)


def _random_rounds(seed, n=60, m=80, k=3):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
    return n, edges, [edges[i::k] for i in range(k)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_rounds_equals_one_shot(spark, seed):
    n, edges, parts = _random_rounds(seed)
    t = spark.createDataFrame([(str(i), i, False, 0) for i in range(n)],
                              "uid string, cmp bigint, mapped boolean, shard int")
    rounds = [spark.createDataFrame([(str(a), str(b)) for a, b in p] or [("0", "0")],
                                    "src string, dst string") for p in parts]
    got = {int(r.uid): r.cmp for r in merge_rounds(t, rounds).collect()}
    uf = union_find(edges)
    assert got == {i: uf.get(i, i) for i in range(n)}


def test_store_rounds(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl", uid_width=3)
    store.create()
    assert store.read().count() == 0
    store.populate(enumerate_codes(spark, 3).select("uid"))
    assert store.current_version() == 1
    assert store.lookup("042").first().cmp == 42
    rows = store.layer_of_shards()
    n, edges, parts = _random_rounds(5, n=1000, m=600)
    for i, p in enumerate(parts):
        e = spark.createDataFrame(p, "src bigint, dst bigint")   # numbers, padded to width 3
        store.merge_round(e, batch_id=i, source="test")
    # a replayed batch is skipped
    assert store.merge_round(spark.createDataFrame([(1, 2)], "src bigint, dst bigint"),
                             batch_id=0, source="test").skipped
    uf = union_find(edges)
    got = {int(r.uid): r.cmp for r in store.read().collect()}
    assert got == {i: uf.get(i, i) for i in range(1000)}
    log = store.rounds().orderBy("round").collect()
    assert [r.message for r in log] == ["c3"] * 3 and [r.batch_id for r in log] == [0, 1, 2]
    # shard partitions are pruned for a lookup
    plan = store.lookup("042")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shard" in plan
    members = {r.uid for r in store.members(got[7]).collect()}
    assert members == {f"{i:03d}" for i in range(1000) if uf.get(i, i) == got[7]}
    # a round writes only the label history; compaction folds it into the rows
    assert store.layer_of_shards() == rows
    before = sorted(map(tuple, store.read().collect()))
    store.compact()
    assert store.current_version() == 5 and store.history().count() == 0
    assert sorted(map(tuple, store.read().collect())) == before
    assert {r.uid for r in store.members(got[7]).collect()} == members
    store.drop(shard=9)
    assert store.read().where("shard = 9").count() == 0 and store.read().count() == 900
    assert store.at(5).read().count() == 1000  # the version before the drop
    with pytest.raises(ValueError):
        store.drop(shard=9)
    store.drop()
    assert not store.exists()


def test_store_cmp_edges_use_history(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(spark.createDataFrame([(str(i),) for i in range(10, 20)], "uid string"))
    # rows now have cmp 0..9; round 1 merges 5-6, round 2 names 6 (already merged away)
    store.merge_round(spark.createDataFrame([(5, 6)], "src bigint, dst bigint"), on="cmp")
    store.merge_round(spark.createDataFrame([(6, 7)], "src bigint, dst bigint"), on="cmp")
    got = {r.uid: r.cmp for r in store.read().collect()}
    assert got["15"] == got["16"] == got["17"] == 5 and got["18"] == 8


def test_store_rejects_duplicate_uids(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    with pytest.raises(UidNotUnique):
        store.populate(spark.createDataFrame([("1",), ("1",)], "uid string"))


def test_map_round_full_domain(spark, scratch):
    """Load all codes of length 3, map neighbours, merge: the digit-sum classes."""
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 3).select("uid"))
    r = store.map_round(batch_id=0)
    assert r.unknown.count() == 0
    t = store.read()
    per = (t.withColumn("s", F.aggregate(F.transform(F.split("uid", ""), lambda c: c.cast("int")),
                                         F.lit(0), lambda a, b: a + b))
           .groupBy("s").agg(F.countDistinct("cmp").alias("k"), F.min("cmp").alias("c"),
                             F.min(F.col("uid").cast("bigint")).alias("m")).collect())
    assert len(per) == 28 and all(p.k == 1 and p.c == p.m for p in per)


def test_scratch_rows_append(spark, scratch):
    from stellate.schemas import SCRATCH_ROWS

    p = f"{scratch}/scratch"
    for i in range(11):
        spark.createDataFrame([(f"entry {i}", i)], SCRATCH_ROWS).write.mode("append").parquet(p)
    got = sorted((r.a, r.b) for r in spark.read.parquet(p).collect())
    assert got == sorted((f"entry {i}", i) for i in range(11))


def test_dense_ids_within_groups_hot_group(spark):
    """One group holds most rows; it is spread over range partitions and
    still numbered 0..n-1 in order."""
    hot = spark.range(0, 9000).select(F.lit("hot").alias("g"), (F.col("id") * 13 % 9001).alias("o"))
    cold = spark.range(0, 300).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("o"))
    df = hot.unionByName(cold)
    out = assign_dense_ids(df, ["o"], "k", num_partitions=8, partition_by=["g"]).collect()
    by = {}
    for r in out:
        by.setdefault(r.g, []).append((r.o, r.k))
    for g, rows in by.items():
        rows.sort()
        assert [k for _, k in rows] == list(range(len(rows))), g
    assert len(by["hot"]) == 9000


def test_round_never_rewrites_the_base(spark, scratch):
    from test_scale import conf

    store = ComponentStore(spark, f"{scratch}/tbl", uid_width=3)
    store.populate(enumerate_codes(spark, 3).select("uid"))
    rows = store.layer_of_shards()
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "100"}):
        store.merge_round(spark.createDataFrame([(i, i + 1) for i in range(0, 400, 2)],
                                                "src bigint, dst bigint"))
        assert store.layer_of_shards() == rows and store.history().count() == 200
        got = {int(r.uid): r.cmp for r in store.read().collect()}
    assert got[1] == 0 and got[399] == 398 and got[500] == 500
    assert store.members(1).count() == 0 and {r.uid for r in store.members(0).collect()} == {"000", "001"}


def test_batches_are_told_apart_by_source_and_load(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl", uid_width=2)
    store.populate(enumerate_codes(spark, 2).select("uid"))
    one = spark.createDataFrame([(20, 21)], "src bigint, dst bigint")
    two = spark.createDataFrame([(30, 31)], "src bigint, dst bigint")
    assert not store.merge_round(one, batch_id=0, source="a").skipped
    assert store.merge_round(one, batch_id=0, source="a").skipped
    assert not store.merge_round(two, batch_id=0, source="b").skipped
    store.populate(enumerate_codes(spark, 2).select("uid"))
    assert store.rounds().count() == 0
    assert not store.merge_round(one, batch_id=0, source="a").skipped


def test_lookup_shards_and_drop(spark, scratch):
    import os

    import pytest

    store = ComponentStore(spark, f"{scratch}/tbl", shard_fn=lambda c: c.substr(2, 1).try_cast("int"))
    store.populate(spark.createDataFrame([("abc",), ("100",), ("001",), ("010",)], "uid string"))
    assert [r.uid for r in store.lookup("abc").collect()] == ["abc"]
    assert {r.uid for r in store.neighbors_of("100", within_shard=True).collect()} == {"001"}
    other = ComponentStore(spark, f"{scratch}/other")
    os.makedirs(f"{scratch}/other")
    open(f"{scratch}/other/file", "w").close()
    with pytest.raises(ValueError):
        other.drop()
    assert os.path.exists(f"{scratch}/other/file")
    with pytest.raises(ValueError):
        store.populate(spark.createDataFrame([(None,)], "uid string"))


def test_null_groups_keep_their_rows(spark):
    from stellate.operators.messages import assign_rounds, format_messages, parse_edges

    e = spark.createDataFrame([(None, 1, 1, 2), (5, 1, 3, 4)], "g int, o int, src int, dst int")
    assert {r["line"] for r in format_messages(e, ["g"], "o").collect()} == {"1 2", "3 4"}
    lines = spark.createDataFrame([("a", 0, "c1"), ("a", None, "1 2")], "log_id string, line_no bigint, line string")
    bad = parse_edges(assign_rounds(lines)).quarantine.collect()
    assert [(r["line"], r["reason"]) for r in bad] == [("1 2", "no line number")]


def test_dense_ids_ties_keep_input_order(spark):
    df = spark.range(0, 3000, numPartitions=1).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    got = [r.x for r in assign_dense_ids(df, ["k"], "seq", num_partitions=6).orderBy("seq").collect()]
    assert got == list(range(3000))


def test_sql_over_registered_table(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 2).select("uid"))
    spark.catalog.setCurrentDatabase("default")
    view = store.register("components")
    rows = spark.sql(f"SELECT shard, count(*) AS n FROM {view} WHERE shard < 3 "
                     "GROUP BY shard ORDER BY shard").collect()
    assert [(r.shard, r.n) for r in rows] == [(0, 10), (1, 10), (2, 10)]
    plan = spark.sql(f"SELECT * FROM {view} WHERE shard = 4")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_round_on_empty_table_reports_unknown(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.create()
    r = store.merge_round(spark.createDataFrame([("1", "2"), ("3", "4")], "src string, dst string"))
    assert sorted(map(tuple, r.unknown.collect())) == [("1", "2"), ("3", "4")]
    assert store.read().count() == 0
    assert store.rounds().first().n_unknown == 2


def test_neighbors_of_one_code(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 3).where(F.col("uid") != "011").select("uid"))
    got = {r.uid for r in store.neighbors_of("010").collect()}
    assert got == {"100", "001"}
    assert {r.uid for r in store.neighbors_of("010", within_shard=True).collect()} == {"001"}
    assert store.neighbors_of("000").count() == 0
    plan = store.neighbors_of("123")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan and "In(uid" in plan


def test_populate_with_given_numbers(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(spark.createDataFrame([("42", 7), ("17", 3)], "uid string, cmp bigint"))
    got = sorted(map(tuple, store.read().collect()))
    assert got == [("17", 3, False, 1), ("42", 7, False, 4)]
