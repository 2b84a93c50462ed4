"""The stored table: manifests, crashes, writers, added items, clean-up, indexes."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stellate.plans import store as store_module
from stellate.plans.store import ComponentStore, ConcurrentUpdate, UidNotUnique, VersionExpired
from stellate.sources.codes import enumerate_codes


def uids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "uid string")


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src string, dst string")


def table(store):
    return sorted(map(tuple, store.read().collect()))


def files(scratch):
    return {p for p in glob.glob(f"{scratch}/tbl/data/**/*.parquet", recursive=True)}


@pytest.fixture()
def codes(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 2).select("uid"))
    return store


# ------------------------------------------------------------------ commits
def test_settings_are_stored(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl", n_shards=4, prefix="items", shard_by="hash")
    store.create()
    again = ComponentStore(spark, f"{scratch}/tbl")
    again.populate(uids(spark, "007", "042", "100"))
    assert again.shard_names() == ["items_0", "items_1", "items_2", "items_3"]
    assert {r.shard for r in again.read().collect()} <= {0, 1, 2, 3}
    assert ComponentStore(spark, f"{scratch}/tbl").uid_width == 3  # noted from the items
    again.merge_round(spark.createDataFrame([(7, 42)], "src bigint, dst bigint"))
    assert {r.uid: r.cmp for r in store.read().collect()} == {"007": 0, "042": 0, "100": 2}
    with pytest.raises(ValueError, match="prefix"):
        ComponentStore(spark, f"{scratch}/tbl", prefix="other")
    with pytest.raises(ValueError, match="shard_by"):
        ComponentStore(spark, f"{scratch}/new", shard_by="uid; drop")
    own = ComponentStore(spark, f"{scratch}/own", shard_fn=lambda c: F.lit(5))
    own.populate(uids(spark, "1"))
    with pytest.raises(ValueError, match="shard_fn"):
        ComponentStore(spark, f"{scratch}/own").lookup("1")


@pytest.mark.parametrize("change", ["populate", "add", "round", "compact", "drop"])
def test_a_crash_before_the_manifest_changes_nothing(spark, codes, monkeypatch, change):
    codes.merge_round(edges(spark, ("01", "10"), ("30", "31")))
    before, log = table(codes), codes.rounds().collect()

    def crash(*_):
        raise OSError("the driver died")

    with monkeypatch.context() as m:
        m.setattr(store_module, "create_file", crash)
        with pytest.raises(OSError):
            {"populate": lambda: codes.populate(uids(spark, "5", "6")),
             "add": lambda: codes.add(uids(spark, "101", "5")),
             "round": lambda: codes.merge_round(edges(spark, ("50", "51"))),
             "compact": codes.compact,
             "drop": lambda: codes.drop(shard=3)}[change]()
    again = ComponentStore(spark, codes.path)
    assert table(again) == before and again.rounds().collect() == log
    assert {r.uid for r in again.members(1).collect()} == {"01", "10"}
    again.merge_round(edges(spark, ("50", "51")))  # and writing goes on
    assert again.lookup("51").first().cmp == 50


def test_a_crash_inside_a_write_changes_nothing(spark, codes, monkeypatch):
    """The process ends after any one of the writes that a change makes."""
    before = table(codes)
    whole = ComponentStore._write
    for stop_after in range(3):
        left = [stop_after]

        def write(self, *a, left=left, **k):
            if not left[0]:
                raise OSError("the driver died")
            left[0] -= 1
            return whole(self, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(ComponentStore, "_write", write)
            try:
                codes.populate(uids(spark, "5", "6"))
                done = True
            except OSError:
                done = False
        assert done == (stop_after == 2)  # rows, index
        if not done:
            assert table(ComponentStore(spark, codes.path)) == before


def test_one_of_two_writers_wins(spark, codes, scratch):
    other = ComponentStore(spark, codes.path)
    seen = other._need()
    codes.merge_round(edges(spark, ("01", "10")))
    kept = files(scratch)
    # The other one read the manifest before that round and commits after it.
    other._manifest = lambda version=None: seen
    with pytest.raises(ConcurrentUpdate):
        other.merge_round(edges(spark, ("20", "21")))
    assert files(scratch) == kept  # the loser's data are gone, nothing else is
    assert not [d for d in os.listdir(f"{codes.path}/manifests") if not d.startswith(("v=", ".v="))]
    fresh = ComponentStore(spark, codes.path)
    assert fresh.lookup("10").first().cmp == 1 and fresh.lookup("21").first().cmp == 21
    fresh.merge_round(edges(spark, ("20", "21")))
    assert fresh.lookup("21").first().cmp == 20 and fresh.rounds().count() == 2


def test_readers_keep_their_version(spark, codes):
    v = codes.current_version()
    rows = codes.read()  # planned before the round
    codes.merge_round(edges(spark, ("01", "10")))
    codes.compact()
    assert rows.where("uid = '10'").first().cmp == 10
    old = codes.at(v)
    assert old.lookup("10").first().cmp == 10 and codes.lookup("10").first().cmp == 1
    with pytest.raises(ValueError, match="pinned"):
        old.drop(shard=3)
    with pytest.raises(ValueError):
        codes.at(99)


def test_batches_need_a_source(spark, codes):
    with pytest.raises(ValueError, match="source"):
        codes.merge_round(edges(spark, ("01", "10")), batch_id=0)


# -------------------------------------------------------------- added items
def test_add_items(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.add(uids(spark, "20", "10", "30"))  # the first load
    store.merge_round(edges(spark, ("10", "30")))
    kept = files(scratch)
    store.add(uids(spark, "30", "05", "40", "10"))
    assert kept <= files(scratch)  # nothing rewritten
    assert table(store) == [("05", 3, False, 0), ("10", 0, False, 1), ("20", 1, False, 2), ("30", 0, False, 3),
                            ("40", 4, False, 4)]
    assert {r.uid for r in store.members(0).collect()} == {"10", "30"}
    store.add(uids(spark, "30", "50"), existing="replace")
    want = [("05", 3, False, 0), ("10", 0, False, 1), ("20", 1, False, 2), ("30", 5, False, 3), ("40", 4, False, 4),
            ("50", 6, False, 5)]
    assert table(store) == want and [tuple(r) for r in store.lookup("30").collect()] == [want[3]]
    assert [r.uid for r in store.members(0).collect()] == ["10"]
    store.merge_round(edges(spark, ("30", "05"), ("50", "99")))
    want[3] = ("30", 3, False, 3)
    assert table(store) == want
    store.compact()
    assert table(store) == want and {r.uid for r in store.members(3).collect()} == {"05", "30"}
    with pytest.raises(UidNotUnique):
        store.add(uids(spark, "7", "7"))
    with pytest.raises(ValueError):
        store.add(uids(spark, "7"), existing="both")
    store.add(uids(spark))
    store.add(uids(spark, "10"))
    assert table(store) == want
    assert store.uid_width == 2
    store.add(uids(spark, "100"))
    assert store.uid_width is None and store.lookup("100").first().cmp == 7


def test_add_keeps_numbers_apart_after_a_given_load(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(spark.createDataFrame([("42", 70), ("17", 3)], "uid string, cmp bigint"))
    store.add(uids(spark, "99"))
    assert {r.uid: r.cmp for r in store.read().collect()} == {"42": 70, "17": 3, "99": 71}


# ----------------------------------------------------- compaction, clean-up
def test_compaction_leaves_unchanged_shards_alone(spark, codes, scratch):
    kept = files(scratch)
    codes.merge_round(edges(spark, ("71", "72"), ("73", "74")))
    before = codes.layer_of_shards()
    codes.compact()
    after = codes.layer_of_shards()
    assert [s for s in after if after[s] != before[s]] == [7]
    new = [f for f in files(scratch) - kept if "/rows-" in f]
    assert new and all("/shard=7/" in f for f in new)
    assert codes.lookup("72").first().cmp == 71 and codes.lookup("12").first().cmp == 12
    plan = codes.lookup("12")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    v = codes.current_version()
    assert codes.compact() == v  # nothing to do


def test_vacuum_counts_references(spark, codes, scratch):
    codes.merge_round(edges(spark, ("71", "72")))
    codes.compact()
    codes.merge_round(edges(spark, ("11", "12")))
    want, log = table(codes), codes.rounds().collect()
    os.makedirs(f"{scratch}/tbl/data/rows-unfinished")
    gone = codes.vacuum(keep=2)
    assert gone and all(g.startswith("history") for g in gone)  # the rows of shards 0 to 6, 8 and 9 are still named
    assert os.path.isdir(f"{scratch}/tbl/data/rows-unfinished")  # perhaps still being written
    assert table(codes) == want and codes.rounds().collect() == log
    assert codes.at(codes.current_version() - 1).lookup("12").first().cmp == 12
    with pytest.raises(VersionExpired):
        codes.at(1)
    first = codes.populate(uids(spark, "1", "2"))
    codes.vacuum(grace_seconds=-1)
    assert not os.path.isdir(f"{scratch}/tbl/data/rows-unfinished")
    assert len(os.listdir(f"{scratch}/tbl/data")) == 2 and codes.current_version() == first  # rows, index
    assert [r.uid for r in codes.read().orderBy("uid").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        codes.vacuum(keep=0)


# -------------------------------------------------------------------- plans
def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_members_read_their_buckets(spark, scratch):
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 4).select("uid"))
    n = store.settings()["buckets"]
    assert n > 1
    one = store.members(4321)
    plan = final_plan(one)
    pruned = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "bucket#" in pruned and str(4321 % n) in pruned
    assert "index-" in plan and "/rows-" not in plan
    assert [r.uid for r in one.collect()] == ["4321"]
    store.merge_round(edges(spark, ("4321", "0007")))
    plan = final_plan(store.members(7))
    assert "bucket#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {r.uid for r in store.members(7).collect()} == {"0007", "4321"}


def test_members_of_a_large_component(spark, scratch, monkeypatch):
    monkeypatch.setattr(store_module, "MAX_LITERALS", 3)
    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 2).select("uid"))
    store.merge_round(edges(spark, *[(f"{i:02d}", f"{i + 1:02d}") for i in range(40)]))
    assert {int(r.uid) for r in store.members(0).collect()} == set(range(41))
    plain = ComponentStore(spark, f"{scratch}/plain", member_index=False)
    plain.populate(enumerate_codes(spark, 2).select("uid"))
    plain.merge_round(edges(spark, *[(f"{i:02d}", f"{i + 1:02d}") for i in range(40)]))
    assert {int(r.uid) for r in plain.members(0).collect()} == set(range(41))
    assert {r.uid for r in plain.members(50).collect()} == {"50"}


def test_lookup_reads_few_row_groups(spark, scratch):
    """Files sorted by uid: a lookup reads one row group of many."""
    from test_scale import conf

    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 << 10))
    try:
        with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}):
            store = ComponentStore(spark, f"{scratch}/tbl", shard_fn=lambda c: F.lit(0), member_index=False)
            store.populate(spark.range(0, 300000).select(F.format_string("%08d", F.col("id") * 7).alias("uid")),
                           check_unique=False)
    finally:
        hadoop.unset("parquet.block.size")
    groups = []
    for f in glob.glob(f"{scratch}/tbl/data/rows-*/shard=0/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        groups += [(meta.row_group(i).column(0).statistics, meta.row_group(i).num_rows)
                   for i in range(meta.num_row_groups)]
    assert len(groups) > 8
    spans = sorted((s.min, s.max) for s, _ in groups)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # no two overlap
    rows = store.base().where("uid = '00700000'")
    rows.collect()
    leaf = rows._jdf.queryExecution().executedPlan()
    while leaf.children().size():
        leaf = leaf.children().apply(0)
    read = leaf.metrics().apply("numOutputRows").value()
    assert 0 < read <= max(n for _, n in groups) < 300000 / 4
