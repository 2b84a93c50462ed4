"""Scale behaviour checked on small data: hub keys, pushdown, no wide windows."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from stellate.operators.components import _large_star, _small_star, connected_components
from stellate.operators.messages import assign_rounds
from stellate.operators.table import lookup_uid
from stellate.session import materialize

NO_BROADCAST_LOW_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _ancestors(lines, idx):
    """Lines of the plan nodes above line ``idx`` (by tree indentation)."""
    def depth(ln):
        return len(ln) - len(ln.lstrip(" :+-|"))
    out, d = [], depth(lines[idx])
    for j in range(idx - 1, -1, -1):
        if lines[j].strip() and depth(lines[j]) < d:
            out.append(lines[j])
            d = depth(lines[j])
    return out


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hub_vertex_is_split_by_aqe(spark):
    """One vertex holds most edges; with the minima written, both star joins
    are split by AQE's skew join, and the labels stay exact."""
    with conf(spark, NO_BROADCAST_LOW_SKEW):
        hub = spark.range(1, 40001).select(F.col("id").alias("u"), F.lit(0).cast("bigint").alias("v"))
        tail = spark.range(40001, 45000).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
        e = materialize(hub.unionByName(tail).repartition(8), "hub")
        large, _ = _large_star(e, [])
        assert "skew=true" in _final_plan(large)
        rev = materialize(spark.range(1, 40001).select(F.lit(10 ** 6).cast("bigint").alias("u"),
                                                       F.col("id").alias("v")), "hub2")
        small, _ = _small_star(rev, [])
        assert "skew=true" in _final_plan(small)
        labels = connected_components(hub.unionByName(tail).select(F.col("u").alias("src"),
                                                                   F.col("v").alias("dst")))
        row = labels.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cmp").alias("k"),
                         F.max("cmp").alias("mx")).first()
        assert (row.n, row.k, row.mx) == (45000, 1, 0)  # the tail hangs on leaf 40000


def test_lookup_prunes_and_pushes(spark, scratch):
    t = spark.range(0, 2000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("uid"),
                                    F.col("id").alias("cmp"), F.lit(False).alias("mapped"),
                                    F.substring(F.lpad(F.col("id").cast("string"), 4, "0"), 1, 1)
                                    .cast("int").alias("shard"))
    t.write.partitionBy("shard").parquet(f"{scratch}/t")
    plan = lookup_uid(spark.read.parquet(f"{scratch}/t"), "1234")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "(shard#" in plan
    assert "PushedFilters: [IsNotNull(uid), EqualTo(uid,1234)]" in plan


def test_round_windows_are_per_chunk(spark):
    lines = spark.range(0, 100).select(F.lit("L").alias("log_id"), F.col("id").alias("line_no"),
                                       F.when(F.col("id") % 10 == 0, "c1").otherwise("1 2").alias("line"))
    df = assign_rounds(lines, chunk_size=16)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the window runs per (log, chunk), never over a whole log
    assert "Window" in plan and "_chunk" in plan
    got = {r.line_no: r["round"] for r in df.collect()}
    assert all(got[i] == i // 10 + 1 for i in range(100))


def test_small_round_does_not_shuffle_the_table(spark, scratch):
    from stellate.operators.table import contract_edges, known_ends
    from stellate.plans.store import ComponentStore
    from stellate.sources.codes import enumerate_codes

    store = ComponentStore(spark, f"{scratch}/tbl")
    store.populate(enumerate_codes(spark, 4).select("uid"))
    e = materialize(spark.createDataFrame([("0001", "0010"), ("0100", "1000")],
                                          "_s string, _d string"), "ends")
    # The table (10,000 rows) is over the threshold, the round's ends are not.
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "8k"}):
        plan = _final_plan(known_ends(e, store.base(), store._resolve))
    final = plan.split("== Initial Plan ==")[0].split("\n")
    scan = next(i for i, ln in enumerate(final) if "FileScan parquet [uid" in ln)
    assert not any("Exchange" in ln for ln in _ancestors(final, scan))  # streamed, not shuffled
    assert "BroadcastHashJoin" in plan
    con = contract_edges(e.toDF("src", "dst"), store.base(), resolve=store._resolve)
    assert sorted(map(tuple, con.edges.collect())) == [(1, 10), (100, 1000)]


def test_scale_conf_sizes():
    from stellate.session import scale_conf

    c = scale_conf(100 << 40, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(409600)
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_base_write_splits_a_large_shard(spark, scratch):
    """All rows in one shard: the write is still spread over several tasks."""
    from stellate.plans.store import ComponentStore

    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        store = ComponentStore(spark, f"{scratch}/tbl", shard_fn=lambda c: F.lit(0))
        store.populate(spark.range(0, 200000).select(F.format_string("%06d", "id").alias("uid")),
                       check_unique=False)
    import glob
    files = glob.glob(f"{scratch}/tbl/data/rows-*/shard=0/*.parquet")
    assert len(files) > 1
    assert store.read().count() == 200000


def test_neighbours_are_never_broadcast(spark):
    """The estimate of the exploded neighbours is that of the codes, far under
    the threshold: the joins must not build a broadcast from them."""
    from stellate.operators.neighbors import neighbor_edges, stored_neighbors
    from stellate.operators.table import populate
    from stellate.sources.codes import enumerate_codes

    t = populate(enumerate_codes(spark, 4).select("uid"))
    for df, rows in ((stored_neighbors(t, t), 97200), (stored_neighbors(t, t, within_shard=True), 97200 - 2 * 24300),
                     (neighbor_edges(t), 48600)):
        final = _final_plan(df).split("== Initial Plan ==")[0].split("\n")
        for i, ln in enumerate(final):
            if "Generate explode(array(" in ln:
                assert not any("BroadcastExchange" in a for a in _ancestors(final, i))
        assert df.count() == rows
