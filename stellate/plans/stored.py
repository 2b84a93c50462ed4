"""Queries that go through stored tables, files and a stream.

Each writes what it derives from the given tables (whole) under the checkpoint
folder, as a component table, an edge or attribute file, or message logs of one
file each, and answers from there.  ``ORACLE_SQL`` holds the same answers in SQL
for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components, vertices_from_edges
from ..operators.messages import assign_rounds, parse_edges
from ..operators.neighbors import stored_neighbors
from ..operators.report import attach_attributes
from ..operators.table import lookup_uids
from ..functions.codes import code_of_number
from ..session import scratch_path, tidy
from ..sources.attributes import read_attributes
from ..sources.messages import read_log_parts, read_messages, stream_messages
from ..streaming.rounds import run_components_stream, run_rounds_stream
from . import catalog as c
from .rounds import file_components
from .store import ComponentStore


def _second_digit(uid: Column) -> Column:
    return F.substring(uid, 2, 1).cast("int")


def _code_store(spark: SparkSession, d: str, **options) -> ComponentStore:
    store = ComponentStore(spark, scratch_path(spark, "store"), **options)
    store.populate(c.customer_codes(spark, d).select("uid"))
    return store


def _mapped_store(spark: SparkSession, d: str) -> ComponentStore:
    store = _code_store(spark, d)
    store.map_round().release()
    return store


def _number_store(spark: SparkSession, vertices: DataFrame) -> ComponentStore:
    """A table whose items are numbers ``id``, each its own component."""
    store = ComponentStore(spark, scratch_path(spark, "store"))
    store.populate(vertices.select(F.col("id").cast("string").alias("uid"), F.col("id").alias("cmp")))
    return store


def _log_files(spark: SparkSession, d: str) -> str:
    """The event logs as text files, one per log, lines in order."""
    path = scratch_path(spark, "logs")
    lines = c.event_lines(spark, d).select(F.col("log_id").cast("bigint").alias("log"), "line_no", "line")
    (lines.repartition("log").sortWithinPartitions("log", "line_no").select("log", "line")
     .write.partitionBy("log").text(path))
    return path


#: Three files a log; none of the cuts falls on a control line.
PIECE = 334
PARTS = "log=([0-9]+)/piece=([0-9]+)/"


def _log_pieces(spark: SparkSession, d: str) -> tuple[str, int]:
    """The event logs as text files, each log cut into three; the folder and
    the number of files."""
    path = scratch_path(spark, "log-pieces")
    lines = c.event_lines(spark, d).select(F.col("log_id").cast("bigint").alias("log"),
                                           F.expr(f"line_no % 1000 div {PIECE}").alias("piece"), "line_no", "line")
    # One task writes all files of a log, so its folder is made and moved once.
    (lines.repartition("log").sortWithinPartitions("log", "piece", "line_no").select("log", "piece", "line")
     .write.partitionBy("log", "piece").text(path))
    return path, lines.select("log", "piece").distinct().count()


def q_store_map_round(spark, d):
    return _mapped_store(spark, d).read()


def q_store_compacted(spark, d):
    store = _mapped_store(spark, d)
    store.compact()
    return store.read()


def q_store_lookup(spark, d):
    w = c.customer_width(spark, d)
    keys = c._t(spark, d, "orders").select(code_of_number("o_custkey", w).alias("uid"))
    return lookup_uids(_mapped_store(spark, d).read(), keys)


def q_store_point_lookup(spark, d):
    last = c.customer_codes(spark, d).agg(F.max("uid")).first()[0]
    return _mapped_store(spark, d).lookup(last or "")


def q_store_members(spark, d):
    return _mapped_store(spark, d).members(1)


def q_store_neighbors_within_shard(spark, d):
    t = _code_store(spark, d, shard_fn=_second_digit).read()
    return stored_neighbors(t, t, within_shard=True, shard_fn=_second_digit)


def q_map_round_edge_rule(spark, d):
    """The edge rule links every customer to the first of its nation."""
    codes = c.customer_codes(spark, d)

    def same_nation(table: DataFrame) -> DataFrame:
        stored = table.join(codes, "uid").select("uid", "c_nationkey")
        first = stored.groupBy("c_nationkey").agg(F.min("uid").alias("dst"))
        return stored.join(first, "c_nationkey").select(F.col("uid").alias("src"), "dst")

    store = _code_store(spark, d)
    store.map_round(edge_fn=same_nation).release()
    return store.read()


def q_store_rounds(spark, d):
    e = c.order_part_edges(spark, d).withColumn("_r", (F.col("src") / 3).cast("bigint") % 3)
    store = _number_store(spark, vertices_from_edges(e))
    for k in range(3):  # three rounds that together hold every edge
        store.merge_round(e.where(F.col("_r") == k).select("src", "dst")).release()
    return store.read().select(F.col("uid").cast("bigint").alias("id"), "cmp")


def q_edge_file_components(spark, d):
    path = scratch_path(spark, "edge-file")
    c.order_part_edges(spark, d).select(F.concat_ws(" ", "src", "dst").alias("value")).write.text(path)
    return file_components(spark, path)[0]


def q_attribute_file_join(spark, d):
    path = scratch_path(spark, "attributes")
    (c._t(spark, d, "orders").select(F.col("o_orderkey") * 3, "o_orderstatus", "o_orderpriority")
     .write.option("header", "false").csv(path))
    return attach_attributes(connected_components(c.order_customer_edges(spark, d)), read_attributes(spark, path))


def q_message_files_rounds(spark, d):
    r = assign_rounds(read_messages(spark, _log_files(spark, d)))
    return r.select(F.regexp_extract("log_id", "log=([0-9]+)", 1).alias("log_id"), "line_no", "kind", "round")


def q_message_files_sequence(spark, d):
    """The same from logs that go on in another file."""
    path, _ = _log_pieces(spark, d)
    return assign_rounds(read_log_parts(spark, path, PARTS).lines).select("log_id", "line_no", "kind", "round")


def q_stream_rounds(spark, d):
    """The logs streamed into a table that holds every number they name."""
    edges = parse_edges(assign_rounds(c.event_lines(spark, d))).edges
    store = _number_store(spark, vertices_from_edges(edges))
    lines = stream_messages(spark, _log_files(spark, d))
    run_rounds_stream(lines, store, scratch_path(spark, "stream")).awaitTermination()
    return store.read().select(F.col("uid").cast("bigint").alias("id"), "cmp")


def q_stream_rounds_parts(spark, d):
    """The same with every log cut over three files, read in three batches:
    rounds and their c2 lie in different files and batches."""
    edges = parse_edges(assign_rounds(c.event_lines(spark, d))).edges
    store = _number_store(spark, vertices_from_edges(edges))
    path, files = _log_pieces(spark, d)
    lines = stream_messages(spark, path, max_files_per_trigger=-(-files // 3), parts=PARTS)
    run_rounds_stream(lines, store, scratch_path(spark, "stream")).awaitTermination()
    return store.read().select(F.col("uid").cast("bigint").alias("id"), "cmp")


def q_stream_components(spark, d):
    """The components of every snapshot, handed to a sink that writes a table;
    the logs come cut over three files, in three batches."""
    out = scratch_path(spark, "sink")
    path, files = _log_pieces(spark, d)
    lines = stream_messages(spark, path, max_files_per_trigger=-(-files // 3), parts=PARTS)
    run_components_stream(lines, lambda labels, batch: labels.write.mode("overwrite").parquet(f"{out}/batch={batch}"),
                          scratch_path(spark, "stream")).awaitTermination()
    return (spark.read.schema("log_id string, snapshot_line bigint, id bigint, cmp bigint").parquet(out)
            .select("log_id", "snapshot_line", "id", "cmp"))


def _active_codes(spark: SparkSession, d: str) -> DataFrame:
    """The codes of the customers that have orders."""
    w = c.customer_width(spark, d)
    return c._t(spark, d, "orders").select(code_of_number("o_custkey", w).alias("uid")).distinct()


def q_store_add_items(spark, d):
    """Two loads: the customers with orders, then all; known ones keep their rows."""
    store = ComponentStore(spark, scratch_path(spark, "store"))
    store.add(_active_codes(spark, d))
    store.add(c.customer_codes(spark, d).select("uid"))
    return store.read()


def q_store_replace_items(spark, d):
    """All customers, a mapping round, and those with orders loaded anew: they
    take new numbers and leave their components."""
    store = _mapped_store(spark, d)
    store.add(_active_codes(spark, d), existing="replace")
    return store.read()


def q_store_drop_shard(spark, d):
    store = _code_store(spark, d)
    store.drop(shard=0)
    return store.read()


def q_store_settings(spark, d):
    """Shard names from the settings that the table was made with."""
    path = _code_store(spark, d, prefix="items", shard_by="digit:2").path
    return ComponentStore(spark, path).with_shard_names()


def q_store_compact_shards(spark, d):
    """Only the last shard's items are linked, so only its files are rewritten."""
    store = _code_store(spark, d)
    before = store.layer_of_shards()

    def last_shard(table: DataFrame) -> DataFrame:
        last = table.agg(F.max("shard").alias("shard"))
        rows = table.join(F.broadcast(last), "shard")  # one row
        first = rows.groupBy("shard").agg(F.min("uid").alias("dst"))
        return rows.join(first, "shard").select(F.col("uid").alias("src"), "dst")

    store.map_round(edge_fn=last_shard).release()
    store.compact()
    moved = [(s, before.get(s) != name) for s, name in store.layer_of_shards().items()]
    changed = spark.createDataFrame(moved, "shard int, rewritten boolean")  # one row a shard
    counts = store.read().groupBy("shard").agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("cmp").alias("n_labels"))
    return counts.join(changed, "shard").select("shard", "n_items", "n_labels", "rewritten")


QUERIES = {
    "store_map_round": q_store_map_round,
    "store_compacted": q_store_compacted,
    "store_lookup": q_store_lookup,
    "store_point_lookup": q_store_point_lookup,
    "store_members": q_store_members,
    "store_neighbors_within_shard": q_store_neighbors_within_shard,
    "map_round_edge_rule": q_map_round_edge_rule,
    "store_rounds": q_store_rounds,
    "edge_file_components": q_edge_file_components,
    "attribute_file_join": q_attribute_file_join,
    "store_add_items": q_store_add_items,
    "store_replace_items": q_store_replace_items,
    "store_drop_shard": q_store_drop_shard,
    "store_settings": q_store_settings,
    "store_compact_shards": q_store_compact_shards,
    "message_files_rounds": q_message_files_rounds,
    "message_files_sequence": q_message_files_sequence,
    "stream_rounds": q_stream_rounds,
    "stream_rounds_parts": q_stream_rounds_parts,
    "stream_components": q_stream_components,
}

QUERIES = {name: tidy(query) for name, query in QUERIES.items()}

_REL = f"""WITH RECURSIVE {c._CODES}, {c._TABLE}, {c._CODE_EDGES}, {c._cc('ce')},
rel AS (SELECT t.uid, coalesce(cc.lbl, t.cmp) AS cmp, t.mapped, t.shard
        FROM tbl t LEFT JOIN cc ON cc.v = t.cmp)"""

ORACLE_SQL = {
    "store_map_round": f"{_REL} SELECT * FROM rel",
    "store_compacted": f"{_REL} SELECT * FROM rel",
    "store_lookup": f"""{_REL} SELECT * FROM rel WHERE uid IN (
  SELECT lpad(CAST(o_custkey AS VARCHAR), (SELECT max(width) FROM codes), '0') FROM orders)""",
    "store_point_lookup": f"{_REL} SELECT * FROM rel WHERE uid = (SELECT max(uid) FROM codes)",
    "store_members": f"{_REL} SELECT uid FROM rel WHERE cmp = 1",
    "store_neighbors_within_shard": f"""WITH {c._CODES}, {c._TABLE}, nb AS ({c._nbrs('tbl')})
SELECT nb.uid, nb.nbr, t.cmp AS nbr_cmp, CAST(substr(nb.nbr, 2, 1) AS INTEGER) AS nbr_shard
FROM nb JOIN tbl t ON t.uid = nb.nbr WHERE substr(nb.nbr, 2, 1) = substr(nb.uid, 2, 1)""",
    "map_round_edge_rule": f"""WITH {c._CODES}, {c._TABLE}
SELECT t.uid, CASE WHEN k.c_nationkey IS NULL THEN t.cmp
                   ELSE min(t.cmp) OVER (PARTITION BY k.c_nationkey) END AS cmp, t.mapped, t.shard
FROM tbl t JOIN codes k USING (uid)""",
    "store_rounds": c.ORACLE_SQL["merge_rounds"],
    "edge_file_components": c.ORACLE_SQL["components_order_part"],
    "attribute_file_join": f"""WITH RECURSIVE {c._OC_EDGES}, {c._cc('oce')}
SELECT o.o_orderstatus AS username, o.o_orderpriority AS full_name, cc.lbl AS cmp
FROM cc JOIN orders o ON cc.v = o.o_orderkey * 3""",
    "message_files_rounds": f"""WITH {c._EVENT_LINES}, {c._CLASSIFIED}, {c._ROUNDS},
places AS (SELECT log_id, line_no AS event, row_number() OVER (PARTITION BY log_id ORDER BY line_no) - 1 AS place
           FROM lines)
SELECT rnd.log_id, CAST(p.place AS BIGINT) AS line_no, rnd.kind, rnd.round
FROM rnd JOIN places p ON p.log_id = rnd.log_id AND p.event = rnd.line_no""",
    "stream_rounds": f"""WITH RECURSIVE {c._EVENT_LINES}, {c._CLASSIFIED}, {c._ROUNDS}, {c._PARTS}, {c._SNAPSHOTS},
se AS (SELECT DISTINCT src AS s, dst AS d FROM snaps), {c._cc('se')},
vs AS (SELECT src AS id FROM parsed WHERE src IS NOT NULL AND dst IS NOT NULL
       UNION SELECT dst FROM parsed WHERE src IS NOT NULL AND dst IS NOT NULL)
SELECT vs.id, coalesce(cc.lbl, vs.id) AS cmp FROM vs LEFT JOIN cc ON cc.v = vs.id""",
    "stream_components": f"""WITH RECURSIVE {c._EVENT_LINES}, {c._CLASSIFIED}, {c._ROUNDS}, {c._PARTS}, {c._SNAPSHOTS},
se AS (SELECT log_id, snapshot_line, src AS s, dst AS d FROM snaps),
{c._cc('se', ('log_id', 'snapshot_line'))},
places AS (SELECT log_id, line_no AS event, row_number() OVER (PARTITION BY log_id ORDER BY line_no) - 1 AS place
           FROM lines)
SELECT cc.log_id, CAST(p.place AS BIGINT) AS snapshot_line, cc.v AS id, cc.lbl AS cmp
FROM cc JOIN places p ON p.log_id = cc.log_id AND p.event = cc.snapshot_line""",
    "store_add_items": f"""WITH {c._CODES},
active AS (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), (SELECT max(width) FROM codes), '0') AS uid FROM orders),
every AS (SELECT uid, 0 AS load FROM active UNION ALL
          SELECT uid, 1 FROM codes WHERE uid NOT IN (SELECT uid FROM active))
SELECT uid, CAST(row_number() OVER (ORDER BY load, uid) - 1 AS BIGINT) AS cmp, false AS mapped,
       CAST(substr(uid, 1, 1) AS INTEGER) AS shard FROM every""",
    "store_replace_items": f"""{_REL},
active AS (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), (SELECT max(width) FROM codes), '0') AS uid FROM orders)
SELECT * FROM rel WHERE uid NOT IN (SELECT uid FROM active) UNION ALL
SELECT uid, CAST((SELECT count(*) FROM tbl) + row_number() OVER (ORDER BY uid) - 1 AS BIGINT), false,
       CAST(substr(uid, 1, 1) AS INTEGER) FROM active""",
    "store_drop_shard": f"WITH {c._CODES}, {c._TABLE} SELECT uid, cmp, mapped, shard FROM tbl WHERE shard <> 0",
    "store_settings": f"""WITH {c._CODES}, {c._TABLE}
SELECT uid, cmp, mapped, CAST(substr(uid, 2, 1) AS INTEGER) AS shard, concat('items_', substr(uid, 2, 1)) AS shard_name
FROM tbl""",
    "store_compact_shards": f"""WITH {c._CODES}, {c._TABLE}, top AS (SELECT max(shard) AS shard FROM tbl)
SELECT t.shard, count(*) AS n_items,
       CASE WHEN t.shard = top.shard THEN 1 ELSE count(DISTINCT t.cmp) END AS n_labels,
       t.shard = top.shard AND count(*) > 1 AS rewritten
FROM tbl t, top GROUP BY t.shard, top.shard""",
}
ORACLE_SQL["message_files_sequence"] = ORACLE_SQL["message_files_rounds"]
ORACLE_SQL["stream_rounds_parts"] = ORACLE_SQL["stream_rounds"]
