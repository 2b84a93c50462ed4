"""Ranked lexical search with a document FP-tree.

A document's vector holds its term counts, restricted to the terms of the
items.  Terms are ordered by document frequency, most frequent first; a tree
holds the vectors sorted in that order, so documents with the same frequent
terms share the path from the root.  Unary paths are one node, and siblings
with few documents share a leaf.  Every node knows, for its subtree, the
greatest tf of each term, the least m and the least id.

A term's share of a score grows with tf and falls with m, so the shares at a
subtree's greatest tf and least m, summed over an item's terms, bound the
scores of all documents below.  Each item is searched by itself: depth first,
the child with the greatest bound first, leaving out every subtree whose bound
is below the item's k-th best score so far (or equal to it, when no id below
is less).  Leaves are scored exactly, in 64-bit integers.

On Spark: one pass over the texts writes the vectors and yields N, L and the
document frequencies; a second one builds trees of a bounded number of cells,
one after the other, in every task, and searches them for all items of a
block, keeping the k best of each item from tree to tree; a window ranks the k
best of each task.  What is shipped to the tasks is the items' terms, in
blocks of ``block_items`` items (two passes a block).  No document is compared
with another one and no task holds more than one tree.

Defined cases: a null or empty text has no term, is not counted in N and is
never ranked; an item without terms, or whose terms no document has, has no
rows; items are ranked row by row, so repeated item rows give their rows as
often, a null item id stays null; repeated documents count and are ranked as
often as they stand there (equal ones in any order, with ranks of their own);
null document ids come after all others of the same score; an empty table on
either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, release
from .common import table

#: Bytes between terms become blanks, A-Z lower case; UTF-8 bytes from 0x80 on
#: belong to terms.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, in order."""
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    # split(b" ") would give empty terms; the blanks below are the only ones left.
    return (text or b"").translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# ------------------------------------------------------------------ vectors
_VECTORS = pa.schema([("key", pa.int64()), ("len", pa.int64()), ("terms", pa.list_(pa.int32())),
                      ("tfs", pa.list_(pa.int64()))])


def _vectors(vocabulary: dict[bytes, int]):
    """Rows (key, text) -> (key, len, terms, tfs) for texts with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            keys, sizes, counts, found, tfs = [], [], [0], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = terms(text.as_py())
                if not words:
                    continue
                tf = Counter(words)
                here = tf.keys() & known
                found.extend(vocabulary[w] for w in here)
                tfs.extend(tf[w] for w in here)
                keys.append(key)
                sizes.append(len(words))
                counts.append(len(found))
            at = pa.array(counts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], schema=_VECTORS)

    return run


# --------------------------------------------------------------------- tree
_NO_ID = (1 << 63) - 1


class Tree:
    """The FP-tree of documents given as flat arrays: ``term`` (numbers in
    order of frequency) and ``tf`` of document i at ``off[i]:off[i + 1]``,
    lengths ``m`` and ids ``doc``."""

    def __init__(self, term: np.ndarray, tf: np.ndarray, off: np.ndarray, m: np.ndarray, doc: np.ndarray,
                 w: np.ndarray, leaf: int = 32):
        docs, size = len(m), np.diff(off)
        row = np.repeat(np.arange(docs), size)
        by = np.lexsort((term, row))
        term, tf = term[by], tf[by]
        code = (term + 1).astype(">u4").tobytes()
        keys = [code[4 * a:4 * b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        order = sorted(range(docs), key=keys.__getitem__)
        keys = [keys[i] for i in order]
        order = np.array(order, np.int64)
        self.m, self.doc = m[order], doc[order]
        size = size[order]
        self.off = np.concatenate(([0], np.cumsum(size)))
        pick = np.repeat(off[:-1][order] - self.off[:-1], size) + np.arange(self.off[-1])
        self.term, self.tf = term[pick], tf[pick]
        self.share = _shares(w[self.term], self.tf, np.repeat(self.m, size))
        self.row = np.repeat(np.arange(docs), size)
        self._grow(keys, leaf)
        self._bound(len(w), w)

    def _grow(self, keys: list[bytes], leaf: int) -> None:
        """Nodes as ranges of the sorted documents; children follow parents."""
        self.span, self.kids = [(0, len(keys))], [[]]
        todo = [(0, 0)]  # node, bytes of the path that its documents share
        while todo:
            node, path = todo.pop()
            a, b = self.span[node]
            if b - a <= leaf:
                continue
            path = max(path, len(commonprefix((keys[a], keys[b - 1]))) // 4 * 4)
            ends, at = [], a
            while at < b:  # one run for each next term (or for no further one)
                key = keys[at]
                at = bisect_right(keys, key[:path + 4] + b"\xff" * 5 if len(key) > path else key, at, b)
                ends.append(at)
            if len(ends) == 1:  # equal vectors
                continue
            start, runs = a, 0
            for x, y in zip(ends, [*ends[1:], None]):
                runs += 1
                # Small siblings share a leaf.
                if y is None or x - start > leaf or y - start > leaf:
                    self.span.append((start, x))
                    self.kids.append([])
                    self.kids[node].append(len(self.span) - 1)
                    if runs == 1:
                        todo.append((len(self.span) - 1, path + 4))
                    start, runs = x, 0

    def _bound(self, size: int, w: np.ndarray) -> None:
        """For every node the greatest tf of each term, turned into the
        greatest share at the least m, and the least id."""
        top = np.zeros((len(self.span), size), np.int64)
        self.least_m = np.full(len(self.span), _NO_ID)
        self.least_id = np.full(len(self.span), _NO_ID)
        for v in range(len(self.span) - 1, -1, -1):
            if self.kids[v]:
                top[v] = top[self.kids[v]].max(axis=0)
                self.least_m[v] = self.least_m[self.kids[v]].min()
                self.least_id[v] = self.least_id[self.kids[v]].min()
            else:
                a, b = self.span[v]
                part = slice(self.off[a], self.off[b])
                np.maximum.at(top[v], self.term[part], self.tf[part])
                self.least_m[v], self.least_id[v] = self.m[a:b].min(), self.doc[a:b].min()
        at = top > 0
        top[at] = _shares(np.broadcast_to(w, top.shape)[at], top[at],
                          np.broadcast_to(self.least_m[:, None], top.shape)[at])
        self.top = top

    def search(self, own: np.ndarray, mask: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """Puts the documents that belong to the ``k`` best (a heap of (score,
        -id)) of an item into it; ``own``: the item's terms, ``mask``: the
        same as a flag for every term."""
        bound = self.top[:, own].sum(axis=1).tolist()

        def hopeless(v: int) -> bool:
            return bound[v] <= 0 or len(best) == k and (bound[v], -int(self.least_id[v])) <= best[0]

        todo = [0]
        while todo:
            v = todo.pop()
            if hopeless(v):
                continue
            if self.kids[v]:
                todo.extend(sorted((u for u in self.kids[v] if not hopeless(u)), key=bound.__getitem__))
                continue
            a, b = self.span[v]
            part = slice(self.off[a], self.off[b])
            score = np.zeros(b - a, np.int64)
            np.add.at(score, self.row[part] - a, self.share[part] * mask[self.term[part]])
            for i in np.flatnonzero(score >= (best[0][0] if len(best) == k else 1)).tolist():
                entry = (int(score[i]), -int(self.doc[a + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def _shares(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


# ------------------------------------------------------------------- search
_CELLS = 1 << 22  # of the nodes' tables in one tree, about


def _search(rank: list[int], weights: list[int], items: list[list[int]], n: int, total: int, k: int):
    """Vectors -> the k best (item, score, doc) of this task.  ``rank``: a
    term's place by frequency; ``weights`` and ``items`` by that place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, w = np.array(rank, np.int64), np.array(weights, np.int64)
        own = [np.array(x, np.int64) for x in items]
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        masks = np.zeros((len(items), len(w)), np.int64)
        for i, x in enumerate(own):
            masks[i, x] = 1
        leaf = 32
        most = max(leaf, _CELLS // len(w) * leaf // 4)  # documents in a tree

        def grow(parts: list[pa.RecordBatch]) -> None:
            term, tf, size, length, doc = [], [], [], [], []
            for p in parts:
                lists, counts = p.column(2), p.column(3)
                term.append(place[lists.flatten().to_numpy()])
                tf.append(counts.flatten().to_numpy())
                size.append(np.diff(lists.offsets.to_numpy()))
                length.append(p.column(1).to_numpy())
                doc.append(p.column(0).fill_null(_NO_ID).to_numpy())
            length = np.concatenate(length)
            # 64-bit integers; by Python's where 90 * n * N may not fit.
            m = (10 + 90 * n * length // total if 90 * n * int(length.max()) < 1 << 63
                 else np.array([10 + 90 * n * x // total for x in length.tolist()], np.int64))
            tree = Tree(np.concatenate(term), np.concatenate(tf), np.concatenate(([0], np.cumsum(np.concatenate(size)))),
                        m, np.concatenate(doc), w, leaf)
            for i, x in enumerate(own):
                tree.search(x, masks[i], best[i], k)

        parts, held, pairs = [], 0, 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, most - held)
                parts.append(part)
                at += len(part)
                held += len(part)
                pairs += len(part.column(2).flatten())
                if held == most or pairs >= _CELLS // 4:
                    grow(parts)
                    parts, held, pairs = [], 0, 0
        if parts:
            grow(parts)
        rows = [(i, s, -d) for i, heap in enumerate(best) for s, d in heap]
        if rows:
            item, score, doc = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(score, pa.int64()),
                 pa.array([None if d == _NO_ID else d for d in doc], pa.int64())], names=["item", "score", "doc"])

    return run


def _block(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame | None:
    """(item, rank, doc, score) for the items (number, terms) of one block."""
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, own in items for w in own))}
    if not vocabulary:
        return None
    vectors = materialize(docs.mapInArrow(
        _vectors(vocabulary), "key bigint, len bigint, terms array<int>, tfs array<bigint>"), "fptree-vectors")
    sums = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("total")).first()
    if not sums["n"]:
        release(vectors)
        return None
    rows = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = dict(rows.collect())  # one row for each term of the block at most
    order = sorted(range(len(vocabulary)), key=lambda i: (-df.get(i, 0), i))
    rank = [0] * len(order)
    for place, i in enumerate(order):
        rank[i] = place
    weights = [weight(sums["n"], df.get(i, 0)) for i in order]
    own = [[rank[vocabulary[w]] for w in dict.fromkeys(words) if vocabulary[w] in df] for _, words in items]
    best = vectors.where(F.size("terms") > 0).mapInArrow(
        _search(rank, weights, own, sums["n"], sums["total"], k), "item int, score bigint, doc bigint")
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = materialize(best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k), "fptree-best")
    release(vectors)
    return ranked


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", k: int = 10,
                  block_items: int = 1024) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: of every item the ``k`` documents of
    the highest score above 0 (all, if fewer), equal scores by ascending id.
    ``doc_id`` must be an integer column."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("key"), F.col(text).alias("text"))
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"{item_id} {kind}, rank int, {doc_id} bigint, score bigint")
    queue = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).toLocalIterator()
    while block := list(islice(queue, block_items)):
        found = _block(rows, [(i, terms(r["text"])) for i, r in enumerate(block)], k)
        if found is not None:
            ids = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(block)], f"item int, id {kind}")
            out = out.unionByName(found.join(F.broadcast(ids), "item").select(  # block_items rows
                F.col("id").alias(item_id), F.col("rank").cast("int").alias("rank"),
                F.col("doc").alias(doc_id), "score"))
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


#: The same in DuckDB, by scoring every document that holds a term.
ORACLE = r"""
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), docs AS (SELECT row_number() OVER () AS d, doc_id, w, len(w) AS n FROM folded WHERE len(w) > 0
), sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM docs
), tf AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM docs) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sums GROUP BY t, docs
), scores AS (
  SELECT a.item_id, d.doc_id, d.d, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (10 + (90 * d.n * s.docs) // s.total))))::BIGINT AS score
  FROM asked a JOIN tf f USING (t) JOIN weights w USING (t) JOIN docs d USING (d), sums s GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
