"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf.  The leaves of a group (``lang``), in ascending key
order, are the units of one tree: while several nodes remain, every ``arity``
consecutive ones become their digest.  What remains is the group's subroot;
the subroots, in ascending group order, are the units of the top tree.

A digest H is SHA-256 over the concatenated inputs, in lowercase hex, digests
as hex text.  A leaf is H of the row's fields, each ``-`` if null, else its
length in UTF-8 bytes, ``:`` and the value.

Time-forward processing: a node's label is (last unit below it, level), so
every child comes before its parent.  A sweep takes the nodes in label order;
a node's digest is put into a priority queue under its parent's label, and the
parent, when its label is reached, takes all that the queue holds for it.  The
reversed sweep takes the labels in descending order: a parent puts under each
child's label the child's siblings followed by the parent's own proof, so
every unit receives its proof as it is reached.

The queue is external: a sweep covers ``height`` levels over blocks of
``arity ** height`` consecutive units; Spark's shuffle and sort bring the rows
of a block together in label order, and what leaves a block (one digest going
up, one proof suffix coming down) is a message in a written table, which the
next sweep sorts by label again.  Inside a task only the messages that cross
the current label are held, at most ``(arity - 1) * height``.  A tree of n
units takes ``log(n) / (height * log(arity))`` sweeps each way, over tables
that shrink by the block's size; no task reads more than its blocks, however
large a group is.

Defined cases: a null key comes first, a null group is a group of its own and
comes first, null fields count as ``-``; rows with one key follow each other
in the order of their leaves (equal rows have equal proofs up to their place);
a lone leaf is its group's subroot, a lone subroot is the root; a row without
siblings has the digest of no text as proof digest; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.table import assign_dense_ids
from ..session import join_on, materialize, release
from .common import shuffle_parts, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """H of the fields of a row (hex)."""
    def part(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def _h(parts: bytes) -> bytes:
    """H of digests that stand one after the other."""
    return hashlib.sha256(parts.hex().encode()).digest()


# ------------------------------------------------------------- upward sweep
_UP = pa.schema([("g", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("n", pa.int64()),
                 ("kids", pa.binary()), ("digest", pa.binary()), ("top", pa.bool_())])
_UP_SQL = "g bigint, level int, idx bigint, n bigint, kids binary, digest binary, top boolean"


def _levels(n: int, arity: int, height: int) -> int:
    """Levels that a sweep climbs in a tree of n units."""
    k = 0
    while k < height and n > arity ** k:
        k += 1
    return k


def _sweep_up(arity: int, height: int):
    """Rows (g, idx, n, digest), the units of whole blocks in label order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[tuple[int, int, int, bytes]] = []  # (last unit, level, child, digest): by label, then child
        for batch in batches:
            out: list[tuple] = []
            for g, idx, n, digest in zip(*(c.to_pylist() for c in batch.columns)):
                top = _levels(n, arity, height)
                heapq.heappush(queue, (idx, 0, idx, digest))
                # Nodes whose last unit is this one have all they wait for.
                while queue and queue[0][0] == idx:
                    last, level, child, digest = heapq.heappop(queue)
                    kids = digest
                    while queue and queue[0][:2] == (last, level):
                        kids += heapq.heappop(queue)[3]
                    node = last // arity ** level
                    if level:
                        digest = _h(kids)
                    if level or top == 0:
                        out.append((g, level, node, n, kids, digest, level == top))
                    if level < top:
                        above = node // arity
                        end = min((above + 1) * arity ** (level + 1), n) - 1
                        heapq.heappush(queue, (end, level + 1, node, digest))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _UP)], schema=_UP)

    return run


def _sweeps(units: DataFrame, most: int, arity: int, height: int) -> list[DataFrame]:
    """The node tables of the upward sweeps, written; the last one holds the
    roots (``top``).  ``units``: (g, idx, n, digest); ``most``: the greatest n."""
    span, tables = arity ** height, []
    cur = units.select("g", "idx", "n", "digest")
    while True:
        rows = (cur.withColumn("block", F.expr(f"idx div {span}"))
                .repartition(shuffle_parts(units.sparkSession), "g", "block")
                .sortWithinPartitions("g", "block", "idx").select("g", "idx", "n", "digest"))
        nodes = materialize(rows.mapInArrow(_sweep_up(arity, height), _UP_SQL), "manifest-up")
        tables.append(nodes)
        most = -(-most // span)
        if most <= 1:
            return tables
        # The top of a block is one unit of the next sweep.
        cur = nodes.where("top").select(
            "g", F.expr(f"idx * cast(power({arity}, level) as bigint) div {span}").alias("idx"),
            F.expr(f"(n + {span - 1}) div {span}").alias("n"), "digest")


# ----------------------------------------------------------- reversed sweep
_DOWN = pa.schema([("g", pa.int64()), ("idx", pa.int64()), ("proof", pa.binary()), ("subroot", pa.binary()),
                   ("root", pa.binary())])
_DOWN_SQL = "g bigint, idx bigint, proof binary, subroot binary, root binary"


def _step(kids: bytes, at: int) -> bytes:
    """One level of a proof: the node's place among the children, their
    number, and the digests of the others from left to right."""
    return bytes((at, len(kids) // 32)) + kids[:32 * at] + kids[32 * at + 32:]


def _sweep_down(arity: int, height: int):
    """Rows (g, block, idx, level, n, kids, proof, subroot, root): of each
    block the message to its top, then its nodes in descending label order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[tuple[int, int, bytes]] = []
        message: tuple = ()
        for batch in batches:
            out: list[tuple] = []
            for g, block, idx, level, n, kids, proof, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
                if kids is None:  # the message that begins a block
                    queue = []
                    message = (proof, subroot, root)
                    continue
                end = min((idx + 1) * arity ** level, n) - 1
                if queue:
                    last, depth, proof = heapq.heappop(queue)
                    assert (-last, -depth) == (end, level)
                else:  # the block's top
                    proof = message[0]
                first = idx * arity
                for at in range(len(kids) // 32):
                    below = (_step(kids, at) if level else b"") + proof
                    child = first + at
                    if level <= 1:  # a unit: its message goes on by way of the table
                        out.append((g, child if level else idx, below, *message[1:]))
                    else:
                        last = min((child + 1) * arity ** (level - 1), n) - 1
                        heapq.heappush(queue, (-last, 1 - level, below))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _DOWN)], schema=_DOWN)

    return run


def _proofs(tables: list[DataFrame], roots: DataFrame, arity: int, height: int) -> DataFrame:
    """The proof of every unit, (g, idx, proof, subroot, root), written.
    ``roots``: (g, proof, subroot, root), the messages to the trees' roots."""
    span = arity ** height
    cur = roots.select("g", F.lit(0).cast("bigint").alias("block"), "proof", "subroot", "root")
    for nodes in reversed(tables):
        records = nodes.select("g", F.expr(f"idx * cast(power({arity}, level) as bigint) div {span}").alias("block"),
                               "idx", "level", "n", "kids", *[F.lit(None).cast("binary").alias(c)
                                                              for c in ("proof", "subroot", "root")])
        messages = cur.select("g", "block", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("idx", "bigint"), ("level", "int"), ("n", "bigint"), ("kids", "binary"))], "proof", "subroot", "root")
        end = F.least((F.col("idx") + 1) * F.pow(F.lit(arity), F.col("level")).cast("bigint"), F.col("n")) - 1
        rows = (records.unionByName(messages)
                .repartition(shuffle_parts(nodes.sparkSession), "g", "block")
                .sortWithinPartitions("g", "block", F.col("kids").isNotNull(), end.desc(), F.col("level").desc()))
        step = materialize(rows.mapInArrow(_sweep_down(arity, height), _DOWN_SQL), "manifest-down")
        release(cur)
        cur = step.withColumnRenamed("idx", "block")
        cur._stellate_path = step._stellate_path
    return step


# ------------------------------------------------------------- verification
def _fold(digest: bytes, proof: bytes) -> bytes:
    at = 0
    while at < len(proof):
        place, size = proof[at], proof[at + 1]
        rest = proof[at + 2:at + 2 + 32 * (size - 1)]
        digest = _h(rest[:32 * place] + digest + rest[32 * place:])
        at += 2 + len(rest)
    return digest


def _siblings(proof: bytes) -> bytes:
    out, at = [], 0
    while at < len(proof):
        size = 32 * (proof[at + 1] - 1)
        out.append(proof[at + 2:at + 2 + size])
        at += 2 + size
    return b"".join(out)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the proof's digest and the root folded from the checked leaf."""
    for batch in batches:
        col = {f.name: c for f, c in zip(batch.schema, batch.columns)}
        proofs = col["proof"].to_pylist()
        folded = [_fold(d, p) for d, p in zip(col["checked"].to_pylist(), proofs)]
        yield pa.RecordBatch.from_arrays(
            [col["key"], col["digest"], col["subroot"], col["root"],
             pa.array([_h(_siblings(p)) for p in proofs], pa.binary()), pa.array(folded, pa.binary())],
            names=["key", "digest", "subroot", "root", "proof", "folded"])


def dataset_manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang",
                     fields: tuple[str, ...] = FIELDS, altered: dict[str, Column] | None = None,
                     arity: int = 2, height: int = 8) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` for
    every row of ``docs``.

    The tree is built from the rows as they are.  ``folded_root`` folds the
    proof onto the leaf of the row with the fields in ``altered`` replaced
    (null: unchanged), so a row that differs from the manifest is found out:
    ``verified`` tells whether the root comes out.
    """
    if not 2 <= arity <= 255:
        raise ValueError("arity must be from 2 to 255")
    now = [F.col(f) for f in fields]
    then = [F.coalesce(altered[f], F.col(f)) if altered and f in altered else F.col(f) for f in fields]
    same = F.lit(True)
    for a, b in zip(now, then):
        same = same & a.eqNullSafe(b)
    leaf = leaf_digest(now)
    leaves = materialize(docs.select(
        F.col(key).alias("key"), F.col(group).alias("grp"), F.unhex(leaf).alias("digest"),
        F.unhex(F.when(same, leaf).otherwise(leaf_digest(then))).alias("checked")), "manifest-leaves")
    groups = materialize(assign_dense_ids(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), ["grp"], "g"),
                         "manifest-groups")
    sizes = groups.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("groups")).first()
    placed = join_on(leaves, groups, ["grp"], null_safe=("grp",))
    placed = materialize(assign_dense_ids(placed.select("key", "g", "n", "digest", "checked"),
                                          ["key", "digest"], "idx", partition_by=["g"]), "manifest-units")
    up = _sweeps(placed, sizes["n"] or 0, arity, height)
    subroots = up[-1].where("top").select("g", "digest")
    over = materialize(subroots.select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("idx"),
                                       F.lit(sizes["groups"]).cast("bigint").alias("n"), "digest"), "manifest-subroots")
    top = _sweeps(over, sizes["groups"], arity, height)
    none = F.lit(b"").cast("binary")
    high = _proofs(top, top[-1].where("top").select("g", none.alias("proof"), F.col("digest").alias("subroot"),
                                                    F.col("digest").alias("root")), arity, height)
    start = over.select(F.col("idx").alias("g"), "digest").join(
        high.select(F.col("idx").alias("g"), "proof", "root"), "g").select(
        "g", "proof", F.col("digest").alias("subroot"), "root")
    low = _proofs(up, materialize(start, "manifest-start"), arity, height)
    rows = placed.select("g", "idx", "key", "digest", "checked").join(low, ["g", "idx"])
    rows = rows.select("key", "digest", "checked", "proof", "subroot", "root")
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(_verify, f"key {kind}, digest binary, subroot binary, root binary, proof binary, folded binary")
    for t in (*up, *top, high, over, groups, leaves):
        release(t)

    def text(c: str) -> Column:
        return F.lower(F.hex(c))

    return out.select(F.col("key").alias(key), text("digest").alias("leaf"), text("subroot").alias("subroot"),
                      text("root").alias("root"), text("proof").alias("proof_sha256"),
                      text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op12_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marked = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return dataset_manifest(docs, altered={"n_chars": F.when(marked, F.col("n_chars") + 1)})


#: The same in DuckDB: CRC-32 byte by byte, one recursion step per level.
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, source, n_chars, text, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, pre, post, sha256(pre || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || post) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN
      sha256(pre || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || post) END AS other
  FROM (SELECT doc_id, lang, crc, n_chars,
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS pre,
          coalesce(strlen(text) || ':' || text, '-') AS post FROM docs)
), units AS (
  SELECT doc_id, leaf, coalesce(other, leaf) AS checked, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), tree AS (
  SELECT g, 0 AS lev, i, leaf AS d, count(*) OVER (PARTITION BY g) AS n FROM units
  UNION ALL
  SELECT g, lev + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), max((n + 1) // 2)
  FROM tree WHERE n > 1 GROUP BY g, lev, i // 2
), subroots AS (SELECT g, d FROM tree WHERE n = 1
), high AS (
  SELECT 0 AS lev, g AS i, d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lev + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), max((n + 1) // 2)
  FROM high WHERE n > 1 GROUP BY lev, i // 2
), low_steps AS (
  SELECT u.doc_id, u.leaf, u.checked, u.g, u.i, t.lev, (u.i >> t.lev) & 1 AS place, s.d AS sib
  FROM units u JOIN tree t ON t.g = u.g AND t.i = u.i >> t.lev AND t.n > 1
  LEFT JOIN tree s ON s.g = t.g AND s.lev = t.lev AND s.i = xor(t.i, 1)
), high_steps AS (
  SELECT u.doc_id, u.leaf, u.checked, u.g, u.i, 1000 + t.lev AS lev, (u.g >> t.lev) & 1 AS place, s.d AS sib
  FROM units u JOIN high t ON t.i = u.g >> t.lev AND t.n > 1
  LEFT JOIN high s ON s.lev = t.lev AND s.i = xor(t.i, 1)
), proofs AS (
  SELECT g, i, string_agg(sib, '' ORDER BY lev) AS sibs, list({'place': place, 'sib': coalesce(sib, '')} ORDER BY lev) AS steps
  FROM (SELECT * FROM low_steps UNION ALL SELECT * FROM high_steps) GROUP BY g, i
)
SELECT u.doc_id, u.leaf, r.d AS subroot, h.d AS root, sha256(coalesce(p.sibs, '')) AS proof_sha256, f AS folded_root,
  f = h.d AS verified
FROM (SELECT *, CASE WHEN p.steps IS NULL THEN u.checked ELSE list_reduce(list_prepend(u.checked, list_transform(p.steps,
    lambda x: x.place || x.sib)), lambda a, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || a ELSE a || s[2:] END)) END AS f
  FROM units u LEFT JOIN proofs p USING (g, i)) u
LEFT JOIN proofs p USING (g, i) JOIN subroots r USING (g) CROSS JOIN (SELECT d FROM high WHERE n = 1) h
"""
