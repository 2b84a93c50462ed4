"""The query catalogue: every operator run on the given tables, whole.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE_SQL``
holds the same query in SQL for DuckDB, with the same column names.

Derived inputs (built by Spark from the tables, so the work grows with them):

* customer codes ``C``: ``c_custkey`` zero padded to the digits of the
  largest key (the code length grows with the data);
* the code table: ``C`` numbered in uid order, sharded by first digit;
* graphs on tables, vertex ids kept apart by type:
  order ``3*k``, part ``3*k+1``, customer ``3*k+2``;
* message logs from ``events``: one log per thousand events, the event id as
  line number, and control / data / malformed lines made from the ids.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import (code_of_number, code_string, digit_sum, digits, is_valid,
                               shard_name, shard_of)
from ..operators.components import connected_components, vertices_from_edges
from ..operators.messages import (assign_rounds, classify_messages, format_messages,
                                  parse_edges, round_snapshots)
from ..operators.neighbors import neighbor_edges, neighbors, stored_neighbors, successor_edges
from ..operators.report import attach_attributes, format_components
from ..operators.table import (assign_dense_ids, component_members, contract_edges,
                               lookup_uids, populate, progress_rows, relabel)
from ..session import materialize, tidy
from ..sources.codes import code_width, enumerate_codes
from ..sources.edges import union_edges
from .rounds import acknowledgements, merge_rounds, snapshot_components

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- inputs
def customer_width(spark: SparkSession, d: str) -> int:
    return int(code_width(_t(spark, d, "customer"), "c_custkey").first()["width"])


def customer_codes(spark: SparkSession, d: str) -> DataFrame:
    w = customer_width(spark, d)
    c = _t(spark, d, "customer")
    return c.select(code_of_number("c_custkey", w).alias("uid"), "c_custkey", "c_nationkey")


def code_table(spark: SparkSession, d: str) -> DataFrame:
    return populate(customer_codes(spark, d))


def order_part_edges(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.select((F.col("l_orderkey") * 3).alias("src"),
                     (F.col("l_partkey") * 3 + 1).alias("dst"))


def order_customer_edges(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.select((F.col("o_orderkey") * 3).alias("src"),
                    (F.col("o_custkey") * 3 + 2).alias("dst"))


def event_lines(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    i = F.col("event_id")
    u = F.col("user_id").cast("string")
    a = (F.lit(1000) + i % 97).cast("string")
    b = (F.lit(2000) + i % 89).cast("string")
    line = (F.when(i % 1000 == 0, "c1")
            .when(i % 1000 == 600, "c1")
            .when(i % 250 == 249, "c2")
            .when(i % 1000 == 998, "c4")
            .when(i % 1000 == 250, "c3")
            .when(i % 1000 == 251, "c9")
            .when(i % 1000 == 252, "cX")
            .when(i % 1000 == 253, "")
            .when(F.col("event_type") == "error", F.concat(u, F.lit(" x;"), u, F.lit(" "), a))
            .otherwise(F.concat(u, F.lit(" "), a, F.lit(";"), u, F.lit(" "), b, F.lit(";"))))
    return e.select(F.expr("cast(event_id div 1000 as string)").alias("log_id"),
                    i.alias("line_no"), line.alias("line"))


# ---------------------------------------------------------------- queries
def q_code_functions(spark, d):
    ds = digits("uid")
    return customer_codes(spark, d).select(
        "uid", digit_sum(ds).alias("digit_sum"), shard_of("uid").alias("shard"),
        shard_name(shard_of("uid")).alias("shard_name"), is_valid(ds).alias("valid"),
        (code_string(ds) == F.col("uid")).alias("roundtrip_ok"))


def q_code_enumerate(spark, d):
    return enumerate_codes(spark, customer_width(spark, d))


def q_code_neighbors(spark, d):
    return neighbors(customer_codes(spark, d))


def q_stored_neighbors(spark, d):
    t = code_table(spark, d)
    return stored_neighbors(t, t)


def q_stored_neighbors_within_shard(spark, d):
    t = code_table(spark, d)
    return stored_neighbors(t, t, within_shard=True)


def q_populate_table(spark, d):
    return code_table(spark, d)


def q_shard_summary(spark, d):
    t = code_table(spark, d)
    return t.groupBy("shard").agg(F.count(F.lit(1)).alias("n_items"),
                                  F.min("uid").alias("first_uid")) \
        .select("shard", shard_name("shard").alias("shard_name"), "n_items", "first_uid")


def q_lookup_uids(spark, d):
    w = customer_width(spark, d)
    keys = _t(spark, d, "orders").select(code_of_number("o_custkey", w).alias("uid"))
    return lookup_uids(code_table(spark, d), keys)


def q_progress_rows(spark, d):
    return progress_rows(code_table(spark, d), 1000)


def _code_labels(spark, d):
    t = code_table(spark, d)
    return t, connected_components(neighbor_edges(t), edges_distinct=True)


def q_components_codes(spark, d):
    return _code_labels(spark, d)[1]


def q_components_codes_by_successor(spark, d):
    """The same components from shared successors: no neighbour candidates."""
    return connected_components(successor_edges(code_table(spark, d)))


def q_relabel(spark, d):
    t, labels = _code_labels(spark, d)
    return relabel(t, labels)


def q_component_members(spark, d):
    t, labels = _code_labels(spark, d)
    rel = relabel(t, labels)
    sizes = rel.groupBy("cmp").agg(F.count(F.lit(1)).alias("n"))
    # The largest component (least label on ties): a one-row result.
    top = sizes.orderBy(F.desc("n"), "cmp").limit(1).select(F.col("cmp").alias("top"))
    return component_members(rel.join(F.broadcast(top), rel["cmp"] == top["top"], "left_semi"),
                             F.col("cmp")).select("uid")


def q_contract_edges(spark, d):
    codes = customer_codes(spark, d)
    t = populate(codes.select("uid"))
    prior = codes.select("uid", F.col("c_nationkey").cast("bigint").alias("cmp"))
    nb = stored_neighbors(t, t).select(F.col("uid").alias("src"), F.col("nbr").alias("dst"))
    return contract_edges(nb, prior).edges


def q_message_format(spark, d):
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 3).alias("src"),
        (F.col("l_partkey") * 3 + 1).alias("dst"))
    return format_messages(li, ["l_orderkey"], "l_linenumber")


def q_message_roundtrip(spark, d):
    lines = q_message_format(spark, d)
    return parse_edges(lines, keep=("l_orderkey", "chunk")).edges


def q_message_classify(spark, d):
    return classify_messages(event_lines(spark, d))


def q_message_rounds(spark, d):
    return assign_rounds(event_lines(spark, d)).select("log_id", "line_no", "kind", "round")


def q_message_quarantine(spark, d):
    return parse_edges(event_lines(spark, d)).quarantine


def q_round_snapshots(spark, d):
    return round_snapshots(event_lines(spark, d))


def q_snapshot_components(spark, d):
    return snapshot_components(event_lines(spark, d))


def q_acknowledgements(spark, d):
    return acknowledgements(event_lines(spark, d))


def q_edge_union(spark, d):
    return union_edges(order_part_edges(spark, d), order_customer_edges(spark, d))


def q_edge_vertices(spark, d):
    return vertices_from_edges(q_edge_union(spark, d))


def q_vertex_count(spark, d):
    e = q_edge_union(spark, d)
    ends = e.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.agg(F.count_distinct("id").alias("n_vertices"),
                    (F.count(F.lit(1)) / 2).cast("bigint").alias("n_edges"))


def q_components_order_part(spark, d):
    return connected_components(order_part_edges(spark, d))


def q_components_order_customer(spark, d):
    return connected_components(order_customer_edges(spark, d))


def q_components_all(spark, d):
    return connected_components(q_edge_union(spark, d))


def q_attach_attributes(spark, d):
    labels = connected_components(order_customer_edges(spark, d))
    attrs = _t(spark, d, "orders").select((F.col("o_orderkey") * 3).alias("id"), "o_orderkey",
                                          "o_orderstatus", "o_orderpriority")
    return attach_attributes(labels, attrs)


def q_merge_rounds(spark, d):
    e = order_part_edges(spark, d).withColumn("_r", (F.col("src") / 3).cast("bigint") % 3)
    v = vertices_from_edges(e)
    # The items exist before any round: a stored table, written once.
    table = materialize(v.select(F.col("id").cast("string").alias("uid"), F.col("id").alias("cmp"),
                                 F.lit(False).alias("mapped"),
                                 shard_of(F.col("id").cast("string")).alias("shard")), "items")
    # Three rounds that together hold every edge (a split, nothing dropped).
    rounds = [e.where(F.col("_r") == k).select("src", "dst") for k in range(3)]
    out = merge_rounds(table, rounds)
    return out.select(F.col("uid").cast("bigint").alias("id"), "cmp")


def q_format_components(spark, d):
    return format_components(connected_components(order_customer_edges(spark, d)))


def q_domain_components(spark, d):
    """The full code domain at the customer-key width, relabelled by the
    components of its neighbour graph (the digit-sum classes)."""
    t = enumerate_codes(spark, customer_width(spark, d))
    return relabel(t, connected_components(neighbor_edges(t), edges_distinct=True)) \
        .select("uid", "cmp")


def q_dense_order_ids(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey")
    return assign_dense_ids(o, ["o_orderkey"], "seq")


QUERIES: dict[str, Query] = {
    "code_functions": q_code_functions,
    "code_enumerate": q_code_enumerate,
    "code_neighbors": q_code_neighbors,
    "stored_neighbors": q_stored_neighbors,
    "stored_neighbors_within_shard": q_stored_neighbors_within_shard,
    "populate_table": q_populate_table,
    "shard_summary": q_shard_summary,
    "lookup_uids": q_lookup_uids,
    "progress_rows": q_progress_rows,
    "components_codes": q_components_codes,
    "components_codes_by_successor": q_components_codes_by_successor,
    "relabel": q_relabel,
    "component_members": q_component_members,
    "contract_edges": q_contract_edges,
    "message_format": q_message_format,
    "message_roundtrip": q_message_roundtrip,
    "message_classify": q_message_classify,
    "message_rounds": q_message_rounds,
    "message_quarantine": q_message_quarantine,
    "round_snapshots": q_round_snapshots,
    "snapshot_components": q_snapshot_components,
    "acknowledgements": q_acknowledgements,
    "edge_union": q_edge_union,
    "edge_vertices": q_edge_vertices,
    "vertex_count": q_vertex_count,
    "components_order_part": q_components_order_part,
    "components_order_customer": q_components_order_customer,
    "components_all": q_components_all,
    "attach_attributes": q_attach_attributes,
    "merge_rounds": q_merge_rounds,
    "format_components": q_format_components,
    "dense_order_ids": q_dense_order_ids,
    "domain_components": q_domain_components,
}


# Steps that a query has written and that its result does not read are gone
# when it returns.
QUERIES = {name: tidy(query) for name, query in QUERIES.items()}


# ---------------------------------------------------------------- oracle SQL
_CODES = """codes AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), w.width, '0') AS uid, c_custkey, c_nationkey, w.width
  FROM customer, (SELECT CAST(greatest(1, length(CAST(max(c_custkey) AS VARCHAR))) AS INTEGER) AS width
                  FROM customer) w)"""

_TABLE = """tbl AS (
  SELECT uid, CAST(row_number() OVER (ORDER BY uid) - 1 AS BIGINT) AS cmp, false AS mapped,
         CAST(substr(uid, 1, 1) AS INTEGER) AS shard, width FROM codes)"""


def _nbrs(src: str) -> str:
    """Neighbour codes of the rows of ``src`` (which has ``uid`` and ``width``)."""
    return f"""SELECT s.uid, array_to_string(list_transform(range(1, s.width + 1), lambda i:
             CAST(CAST(substr(s.uid, i, 1) AS INTEGER) + (CASE WHEN i = x THEN 1 ELSE 0 END)
                  - (CASE WHEN i = y THEN 1 ELSE 0 END) AS VARCHAR)), '') AS nbr
  FROM {src} s, range(1, s.width + 1) a(x), range(1, s.width + 1) b(y)
  WHERE x <> y AND CAST(substr(s.uid, x, 1) AS INTEGER) < 9
    AND CAST(substr(s.uid, y, 1) AS INTEGER) > 0"""


def _cc(edges: str, keys: tuple[str, ...] = ()) -> str:
    """CTEs ``ue`` and ``cc(*keys, v, lbl)``: min-label components of ``edges``
    (a CTE with ``*keys, s, d``) by a keyed recursive CTE."""
    k = "".join(f"{c}, " for c in keys)
    kj = "".join(f"ue.{c} = cc.{c} AND " for c in keys)
    kr = "".join(f"r.{c} = ue.{c} AND " for c in keys)
    kue = "".join(f"ue.{c}, " for c in keys)
    return f"""ue AS (
  SELECT {k}s, d FROM {edges} WHERE s IS NOT NULL AND d IS NOT NULL
  UNION SELECT {k}d, s FROM {edges} WHERE s IS NOT NULL AND d IS NOT NULL),
cc({k}v, lbl) USING KEY ({k}v) AS (
  SELECT {k}s, least(s, min(d)) FROM ue GROUP BY {k}s
  UNION
  (SELECT {kue}ue.d, min(cc.lbl) FROM cc JOIN ue ON {kj}ue.s = cc.v
   JOIN recurring.cc r ON {kr}r.v = ue.d
   GROUP BY {kue}ue.d HAVING min(cc.lbl) < min(r.lbl)))"""


_CODE_EDGES = f"""nb AS ({_nbrs('tbl')}),
ce AS (SELECT t1.cmp AS s, t2.cmp AS d FROM nb JOIN tbl t1 ON t1.uid = nb.uid
       JOIN tbl t2 ON t2.uid = nb.nbr WHERE nb.uid < nb.nbr)"""

_EVENT_LINES = """lines AS (
  SELECT CAST(event_id // 1000 AS VARCHAR) AS log_id, event_id AS line_no,
    CASE WHEN event_id % 1000 = 0 THEN 'c1'
         WHEN event_id % 1000 = 600 THEN 'c1'
         WHEN event_id % 250 = 249 THEN 'c2'
         WHEN event_id % 1000 = 998 THEN 'c4'
         WHEN event_id % 1000 = 250 THEN 'c3'
         WHEN event_id % 1000 = 251 THEN 'c9'
         WHEN event_id % 1000 = 252 THEN 'cX'
         WHEN event_id % 1000 = 253 THEN ''
         WHEN event_type = 'error' THEN concat(user_id, ' x;', user_id, ' ', 1000 + event_id % 97)
         ELSE concat(user_id, ' ', 1000 + event_id % 97, ';', user_id, ' ', 2000 + event_id % 89, ';')
    END AS line
  FROM events)"""

_CLASSIFIED = """cls AS (
  SELECT log_id, line_no, line,
    CASE WHEN line IS NULL OR line = '' THEN 'invalid'
         WHEN line = 'cTEST_EXIT' THEN 'exit'
         WHEN starts_with(line, 'c') AND regexp_full_match(substr(line, 2), '[+-]?[0-9]+')
              AND TRY_CAST(substr(line, 2) AS INTEGER) BETWEEN 1 AND 4 THEN 'control'
         WHEN starts_with(line, 'c') THEN 'invalid'
         ELSE 'data' END AS kind,
    CASE WHEN starts_with(line, 'c') AND regexp_full_match(substr(line, 2), '[+-]?[0-9]+')
              AND TRY_CAST(substr(line, 2) AS INTEGER) BETWEEN 1 AND 4
         THEN TRY_CAST(substr(line, 2) AS INTEGER) END AS control,
    CASE WHEN line IS NULL OR line = '' THEN 'empty line'
         WHEN line = 'cTEST_EXIT' THEN NULL
         WHEN starts_with(line, 'c') AND NOT coalesce(regexp_full_match(substr(line, 2), '[+-]?[0-9]+')
              AND TRY_CAST(substr(line, 2) AS INTEGER) IS NOT NULL, false)
           THEN 'control is not a number'
         WHEN starts_with(line, 'c') AND NOT TRY_CAST(substr(line, 2) AS INTEGER) BETWEEN 1 AND 4
           THEN 'unknown control message' END AS reason
  FROM lines)"""

_ROUNDS = """flagged AS (
  SELECT *, CAST(kind = 'control' AND control = 1 AS INTEGER) AS st,
         CAST(kind = 'exit' OR (kind = 'control' AND control = 4) AS INTEGER) AS sp FROM cls),
rnd AS (
  SELECT * EXCLUDE (st, sp, stopped) FROM (
    SELECT *, CAST(sum(st) OVER (PARTITION BY log_id ORDER BY line_no
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS round,
           coalesce(max(sp) OVER (PARTITION BY log_id ORDER BY line_no
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
    FROM flagged) WHERE stopped = 0)"""

_PARTS = """parts AS (
  SELECT p.*, string_split(part, ' ') AS toks FROM (
    SELECT log_id, round, line_no, line, CAST(unnest(generate_series(0, len(ps) - 1)) AS INTEGER) AS pos,
           unnest(ps) AS part
    FROM (SELECT *, CASE WHEN regexp_replace(line, ';+$', '') = '' THEN []::VARCHAR[]
                         ELSE string_split(regexp_replace(line, ';+$', ''), ';') END AS ps
          FROM rnd WHERE kind = 'data')) p),
parsed AS (
  SELECT *, CASE WHEN regexp_full_match(toks[1], '[+-]?[0-9]+') THEN TRY_CAST(toks[1] AS BIGINT) END AS src,
            CASE WHEN len(toks) >= 2 AND regexp_full_match(toks[2], '[+-]?[0-9]+')
                 THEN TRY_CAST(toks[2] AS BIGINT) END AS dst
  FROM parts)"""

_SNAPSHOTS = """snaps AS (
  SELECT e.log_id, e.round, c.line_no AS snapshot_line, e.line_no, e.pos, e.src, e.dst
  FROM parsed e JOIN rnd c ON c.kind = 'control' AND c.control = 2
    AND c.log_id = e.log_id AND c.round = e.round AND e.line_no < c.line_no
  WHERE e.src IS NOT NULL AND e.dst IS NOT NULL)"""

_OP_EDGES = "ope AS (SELECT l_orderkey * 3 AS s, l_partkey * 3 + 1 AS d FROM lineitem)"
_OC_EDGES = "oce AS (SELECT o_orderkey * 3 AS s, o_custkey * 3 + 2 AS d FROM orders)"
_ALL_EDGES = f"{_OP_EDGES}, {_OC_EDGES}, ae AS (SELECT s, d FROM ope UNION ALL SELECT s, d FROM oce)"

_MSG_EDGES = """me AS (
  SELECT l_orderkey, l_linenumber, l_orderkey * 3 AS src, l_partkey * 3 + 1 AS dst,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_orderkey * 3, l_partkey * 3 + 1) - 1 AS k
  FROM lineitem)"""

_MSG_LINES = f"""{_MSG_EDGES}, ml AS (
  SELECT l_orderkey, CAST(k // 1000 AS BIGINT) AS chunk,
         string_agg(concat(src, ' ', dst), ';' ORDER BY k) AS line
  FROM me GROUP BY l_orderkey, CAST(k // 1000 AS BIGINT))"""

ORACLE_SQL: dict[str, str] = {
    "code_functions": f"""WITH {_CODES}
SELECT uid, CAST(list_sum(list_transform(string_split(uid, ''), lambda c: CAST(c AS INTEGER))) AS INTEGER) AS digit_sum,
       CAST(substr(uid, 1, 1) AS INTEGER) AS shard,
       concat('connector_', CAST(substr(uid, 1, 1) AS INTEGER)) AS shard_name,
       regexp_full_match(uid, '[0-9]+') AS valid, true AS roundtrip_ok
FROM codes""",
    "code_enumerate": f"""WITH {_CODES}, w AS (SELECT DISTINCT width FROM codes)
SELECT lpad(CAST(i AS VARCHAR), w.width, '0') AS uid, i AS cmp, false AS mapped,
       CAST(substr(lpad(CAST(i AS VARCHAR), w.width, '0'), 1, 1) AS INTEGER) AS shard
FROM w, range(0, CAST(pow(10, w.width) AS BIGINT)) t(i)""",
    "code_neighbors": f"WITH {_CODES}\n{_nbrs('codes')}",
    "stored_neighbors": f"""WITH {_CODES}, {_TABLE}, nb AS ({_nbrs('tbl')})
SELECT nb.uid, nb.nbr, t.cmp AS nbr_cmp, t.shard AS nbr_shard FROM nb JOIN tbl t ON t.uid = nb.nbr""",
    "stored_neighbors_within_shard": f"""WITH {_CODES}, {_TABLE}, nb AS ({_nbrs('tbl')})
SELECT nb.uid, nb.nbr, t.cmp AS nbr_cmp, t.shard AS nbr_shard FROM nb JOIN tbl t ON t.uid = nb.nbr
WHERE substr(nb.nbr, 1, 1) = substr(nb.uid, 1, 1)""",
    "populate_table": f"WITH {_CODES}, {_TABLE} SELECT uid, cmp, mapped, shard FROM tbl",
    "shard_summary": f"""WITH {_CODES}, {_TABLE}
SELECT shard, concat('connector_', shard) AS shard_name, count(*) AS n_items, min(uid) AS first_uid
FROM tbl GROUP BY shard""",
    "lookup_uids": f"""WITH {_CODES}, {_TABLE}
SELECT uid, cmp, mapped, shard FROM tbl WHERE uid IN (
  SELECT lpad(CAST(o_custkey AS VARCHAR), (SELECT max(width) FROM codes), '0') FROM orders)""",
    "progress_rows": f"""WITH {_CODES}, {_TABLE}
SELECT uid, cmp, mapped, shard FROM tbl WHERE cmp % 1000 = 0""",
    "components_codes": f"""WITH RECURSIVE {_CODES}, {_TABLE}, {_CODE_EDGES}, {_cc('ce')}
SELECT v AS id, lbl AS cmp FROM cc""",
    "relabel": f"""WITH RECURSIVE {_CODES}, {_TABLE}, {_CODE_EDGES}, {_cc('ce')}
SELECT t.uid, coalesce(cc.lbl, t.cmp) AS cmp, t.mapped, t.shard FROM tbl t LEFT JOIN cc ON cc.v = t.cmp""",
    "component_members": f"""WITH RECURSIVE {_CODES}, {_TABLE}, {_CODE_EDGES}, {_cc('ce')},
rel AS (SELECT t.uid, coalesce(cc.lbl, t.cmp) AS cmp FROM tbl t LEFT JOIN cc ON cc.v = t.cmp),
top AS (SELECT cmp FROM rel GROUP BY cmp ORDER BY count(*) DESC, cmp LIMIT 1)
SELECT uid FROM rel WHERE cmp = (SELECT cmp FROM top)""",
    "contract_edges": f"""WITH {_CODES}, {_TABLE}, nb AS ({_nbrs('tbl')}),
se AS (SELECT nb.uid AS s, nb.nbr AS d FROM nb JOIN tbl t ON t.uid = nb.nbr)
SELECT DISTINCT CAST(a.c_nationkey AS BIGINT) AS src, CAST(b.c_nationkey AS BIGINT) AS dst
FROM se JOIN codes a ON a.uid = se.s JOIN codes b ON b.uid = se.d
WHERE a.c_nationkey <> b.c_nationkey""",
    "message_format": f"WITH {_MSG_LINES} SELECT l_orderkey, chunk, line FROM ml",
    "message_roundtrip": f"""WITH {_MSG_EDGES}
SELECT l_orderkey, CAST(k // 1000 AS BIGINT) AS chunk, CAST(k % 1000 AS INTEGER) AS pos, src, dst
FROM me""",
    "message_classify": f"WITH {_EVENT_LINES}, {_CLASSIFIED} SELECT * FROM cls",
    "message_rounds": f"""WITH {_EVENT_LINES}, {_CLASSIFIED}, {_ROUNDS}
SELECT log_id, line_no, kind, round FROM rnd""",
    "message_quarantine": f"""WITH {_EVENT_LINES}, {_CLASSIFIED},
rnd AS (SELECT *, 0 AS round FROM cls), {_PARTS}
SELECT log_id, line_no, line, reason FROM cls WHERE kind = 'invalid'
UNION ALL
SELECT log_id, line_no, part AS line,
  CASE WHEN part = '' THEN 'empty part'
       WHEN len(toks) < 2 OR toks[2] = '' THEN 'missing token'
       ELSE 'bad token' END AS reason
FROM parsed WHERE src IS NULL OR dst IS NULL""",
    "round_snapshots": f"""WITH {_EVENT_LINES}, {_CLASSIFIED}, {_ROUNDS}, {_PARTS}, {_SNAPSHOTS}
SELECT * FROM snaps""",
    "snapshot_components": f"""WITH RECURSIVE {_EVENT_LINES}, {_CLASSIFIED}, {_ROUNDS}, {_PARTS}, {_SNAPSHOTS},
se AS (SELECT log_id, snapshot_line, src AS s, dst AS d FROM snaps),
{_cc('se', ('log_id', 'snapshot_line'))}
SELECT log_id, snapshot_line, v AS id, lbl AS cmp FROM cc""",
    "acknowledgements": f"""WITH {_EVENT_LINES}, {_CLASSIFIED}, {_ROUNDS}
SELECT log_id, line_no AS snapshot_line, round, 'c3' AS message FROM rnd
WHERE kind = 'control' AND control = 2""",
    "edge_union": f"WITH {_ALL_EDGES} SELECT s AS src, d AS dst FROM ae",
    "edge_vertices": f"WITH {_ALL_EDGES} SELECT s AS id FROM ae UNION SELECT d FROM ae",
    "vertex_count": f"""WITH {_ALL_EDGES}
SELECT (SELECT count(*) FROM (SELECT s FROM ae UNION SELECT d FROM ae)) AS n_vertices,
       (SELECT count(*) FROM ae) AS n_edges""",
    "components_order_part": f"""WITH RECURSIVE {_OP_EDGES}, {_cc('ope')}
SELECT v AS id, lbl AS cmp FROM cc""",
    "components_order_customer": f"""WITH RECURSIVE {_OC_EDGES}, {_cc('oce')}
SELECT v AS id, lbl AS cmp FROM cc""",
    "components_all": f"""WITH RECURSIVE {_ALL_EDGES}, {_cc('ae')}
SELECT v AS id, lbl AS cmp FROM cc""",
    "attach_attributes": f"""WITH RECURSIVE {_OC_EDGES}, {_cc('oce')}
SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, cc.lbl AS cmp
FROM cc JOIN orders o ON cc.v = o.o_orderkey * 3""",
    "merge_rounds": f"""WITH RECURSIVE {_OP_EDGES}, {_cc('ope')}
SELECT v AS id, lbl AS cmp FROM cc""",
    "format_components": f"""WITH RECURSIVE {_OC_EDGES}, {_cc('oce')}
SELECT printf('(%d,%d)', v, lbl) AS line FROM cc""",
    "domain_components": f"""WITH RECURSIVE {_CODES}, w AS (SELECT DISTINCT width FROM codes),
tbl AS (SELECT lpad(CAST(i AS VARCHAR), w.width, '0') AS uid, i AS cmp, w.width
        FROM w, range(0, CAST(pow(10, w.width) AS BIGINT)) t(i)),
{_CODE_EDGES}, {_cc('ce')}
SELECT t.uid, coalesce(cc.lbl, t.cmp) AS cmp FROM tbl t LEFT JOIN cc ON cc.v = t.cmp""",
    "dense_order_ids": """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS seq
FROM orders""",
}
ORACLE_SQL["components_codes_by_successor"] = ORACLE_SQL["components_codes"]
