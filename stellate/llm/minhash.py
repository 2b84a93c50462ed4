"""MinHash near-dedup by fast similarity sketching.

A document's set holds the distinct word shingles of its whole text.  Its
sketch (Dahlgaard, Knudsen, Thorup 2017) has t coordinates that are filled in
rounds: in round i < t every element is placed in one bin by its hash, with
the value (i, rest of the hash), and a coordinate keeps the least value; in
round t + j all elements go to coordinate j.  A document is done as soon as
every coordinate is filled: after about ``t log t / n`` rounds for n elements,
and after 2 t rounds for certain.  Two sets agree in a coordinate with a
probability of their Jaccard similarity, and the number of agreeing
coordinates is concentrated about its mean as for independent samples.

1. Texts with the same set are one class from the start (a 128-bit sum of
   hashes over the set), so exact copies cost nothing further.
2. Banding: the coordinates are cut into bands; classes that agree in a whole
   band share a bucket.  With 48 bands of 5 a pair at similarity 0.8 shares
   no bucket with a probability of 5e-9.
3. Each bucket's members are verified against its leader on the full shingle
   sets, recomputed from the texts; what holds is a link.  A bucket of m
   members makes m - 1 pairs, not all.
4. Buckets of three or more that still hold several components of those links
   are compared member by member, in tiles of bounded memory: pairs of one
   component are skipped, also of components that have just met; others go by
   size, by sketch (a pair at the threshold lies seven standard deviations
   above the limit) and, each only in the first band that it shares, by the
   full sets as 64-bit hashes.  A tile gives a forest of its links.  So every
   pair of a bucket is verified, or in one component already, or excluded by
   its sketch, and no pairs are listed.

Hot spots: a leader's members are verified in chunks (the leader's text goes
to each), a large bucket is cut into chunks of which any two meet in a tile,
and joins have written sides, which adaptive execution splits.

Defined cases: a null or blank text has the empty set (0 shingles), is linked
with nothing and its component is its own id, kept; a text of fewer words than
a shingle has its whole sequence as the one shingle; the component is the
least id that is not null (null if there is none, then not kept); repeated
rows share a component and all rows that hold its least id are kept by
:func:`near_duplicates`, one of them by :func:`drop_near_duplicates`; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialize, tidy
from .common import fresh, keep_known, shuffle_parts, table

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(text: bytes, width: int) -> set[bytes]:
    """The distinct shingles of a text (A-Z in lower case, one space between)."""
    words = text.lower().split()  # bytes: only A-Z, only the ASCII blanks
    if len(words) <= width:
        return {b" ".join(words)} if words else set()
    if width == 2:
        return {a + b" " + b for a, b in zip(words, words[1:])}
    return {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixer (murmur's finaliser) under a seed."""
    x = x ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def fill(x: np.ndarray, doc: np.ndarray, docs: int, t: int) -> np.ndarray:
    """The sketches (docs, t) of the sets whose elements are ``x`` (hashes),
    ``doc`` telling whose; a document without elements stays full of ones."""
    s = np.full(docs * t, _FULL)
    for i in range(2 * t):
        if not len(x):
            break
        h = _mix(x, i)
        to = (h >> np.uint64(48)) * np.uint64(t) >> np.uint64(16) if i < t else np.uint64(i - t)
        np.minimum.at(s, doc * t + to.astype(np.int64), np.uint64(i << 48) | h & np.uint64((1 << 48) - 1))
        rows = np.unique(doc)
        open_ = rows[(s.reshape(docs, t)[rows] == _FULL).any(axis=1)]
        if len(open_) < len(rows):
            stays = np.zeros(docs, bool)
            stays[open_] = True
            x, doc = x[stays[doc]], doc[stays[doc]]
    return s.reshape(docs, t)


_SLICE = 1 << 19  # elements that are sketched together


def _sketch(width: int, t: int):
    """Rows (key, k1, k2, text) -> (key, k1, k2, n, h1, h2, sig)."""
    def rows(keys: list[pa.Array], sets: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array([len(s) for s in sets], np.int64)
        x = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets)), n)
        sums = []
        for seed in (1000, 1001):  # sums over the set: the same for any order
            total = np.zeros(len(sets), np.uint64)
            np.add.at(total, doc, _mix(x, seed))
            sums.append(pa.array(total.view(np.int64)))
        sig = (_mix(fill(x, doc, len(sets), t), 2000) >> np.uint64(48)).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [*keys, pa.array(n), *sums, pa.array([r.tobytes() for r in sig], pa.binary())],
            names=["key", "k1", "k2", "n", "h1", "h2", "sig"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            *keys, texts = batch.columns
            texts = texts.cast(pa.binary())
            start, sets, held = 0, [], 0
            for i, text in enumerate(texts):
                found = shingles(text.as_py() or b"", width)
                sets.append(np.fromiter(map(digest, found), np.uint64, len(found)))
                held += len(found)
                if held >= _SLICE or i == len(texts) - 1:
                    yield rows([k.slice(start, len(sets)) for k in keys], sets)
                    start, sets, held = i + 1, [], 0

    return run


# ------------------------------------------------------------- verification
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs_batch(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_PAIR)


def _confirm(width: int, percent: int):
    """Rows (a, chunk, sid, text) with the leader's text first in its chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, set()
        for batch in batches:
            got = []
            texts = batch.column(3).cast(pa.binary())
            for a, chunk, sid, text in zip(*(c.to_pylist() for c in batch.columns[:3]), texts):
                found = shingles(text.as_py() or b"", width)
                if (a, chunk) != at:
                    at, own = (a, chunk), found  # the leader
                    continue
                both = len(own & found)
                if 100 * both >= percent * (len(own) + len(found) - both):
                    got.append(sid)
                    got.append(a)
            if got:
                yield _pairs_batch(got[1::2], got[::2])

    return run


_MEMBERS = 64  # of one leader, in a chunk


def _texts(docs: DataFrame, need: DataFrame) -> DataFrame:
    """(k1, k2, text), once each, of the rows in ``need`` and few others:
    only texts that a filter of fixed size lets through are moved."""
    some = keep_known(docs.select("k1", "k2", "text"), "k1", need.select("k1"))
    return some.groupBy("k1", "k2").agg(F.first("text").alias("text"))


@tidy
def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold."""
    spark = docs.sparkSession
    crowd = materialize(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _MEMBERS).cast("int").alias("chunks")),
                        "minhash-leaders")
    many = crowd.where(F.col("chunks") > 1)
    cut = pairs.join(many, "a", "left").select(
        "a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"), F.lit(0)).alias("chunk"))
    members = cut.select("a", "chunk", F.col("b").alias("sid"))
    leaders = crowd.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                           F.col("a").alias("sid"))
    need = (members.unionByName(leaders)
            .join(classes.select("sid", "k1", "k2"), "sid").select("a", "chunk", "sid", "k1", "k2"))
    need = materialize(need, "minhash-need")
    rows = (_texts(docs, need).join(need, ["k1", "k2"]).repartition(shuffle_parts(spark), "a", "chunk")
            .sortWithinPartitions("a", "chunk", F.col("sid") != F.col("a"), "sid")
            .select("a", "chunk", "sid", "text"))
    return materialize(rows.mapInArrow(_confirm(width, percent), "a bigint, b bigint").distinct(), "minhash-links")


# ------------------------------------------------------- members of a bucket
def _hashed_sets(width: int):
    """Rows (sid, text) -> (sid, items): the sorted 64-bit hashes of the
    whole set, so that sets can be compared over and over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(batch), 256):
                items = []
                for text in texts.slice(at, 256):
                    found = shingles(text.as_py() or b"", width)
                    items.append(np.sort(np.fromiter(map(digest, found), np.uint64, len(found))).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(items, pa.binary())],
                                                 names=["sid", "items"])

    return run


_TILE_BYTES = 32 << 20  # of sets that are held in one tile


def _tiles(t: int, rows: int, percent: int):
    """Rows (bucket, i, j, band, side, sid, cmp, sig, items): tile (i, j) of a
    bucket compares its chunks i (side 0, held) and j (side 1, streamed), or
    chunk i with itself.  Gives a forest of the links between components."""
    sure = percent / 100
    limit = math.floor(t * sure - 7 * math.sqrt(t * sure * (1 - sure)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        parent: dict[int, int] = {}
        sids: list[int] = []
        items: list[np.ndarray] = []
        roots, sizes, sigs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, t), np.uint16)

        def find(c: int) -> int:
            while (p := parent.get(c, c)) != c:
                parent[c] = c = parent.get(p, p)
            return c

        for batch in batches:
            got = []
            heads = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 5, 6)))
            for r, (bucket, i, j, band, side, sid, cmp) in enumerate(heads):
                if (bucket, i, j) != key:
                    key = (bucket, i, j)
                    parent, sids, items = {}, [], []
                    roots, sizes, sigs = np.zeros(64, np.int64), np.zeros(64, np.int64), np.zeros((64, t), np.uint16)
                sig = np.frombuffer(batch.column(7)[r].as_py(), "<u2")
                own = np.frombuffer(batch.column(8)[r].as_py(), np.uint64)
                n, held = len(own), len(sids)
                root = find(cmp)
                if held and (i == j or side):
                    size = sizes[:held]
                    at = np.flatnonzero((roots[:held] != root)
                                        & (100 * np.minimum(size, n) >= percent * np.maximum(size, n)))
                    same = sigs[at] == sig
                    count = same.sum(axis=1)
                    whole = same[:, :t // rows * rows].reshape(len(at), t // rows, rows).all(axis=2)
                    # Only in the first band that they share.
                    good = np.flatnonzero((count >= limit) & (whole.argmax(axis=1) == band))
                    for x in at[good[np.argsort(-count[good], kind="stable")]].tolist():
                        if roots[x] == root:
                            continue
                        a, b = (own, items[x]) if n <= sizes[x] else (items[x], own)
                        place = np.searchsorted(b, a)
                        both = int((b[np.minimum(place, len(b) - 1)] == a).sum())
                        if 100 * both >= percent * (n + int(sizes[x]) - both):
                            other = int(roots[x])
                            parent[other] = root
                            roots[:held][roots[:held] == other] = root
                            got.append((sid, sids[x]))
                if i == j or not side:
                    if held == len(sigs):
                        roots, sizes, sigs = (np.concatenate((z, np.zeros_like(z))) for z in (roots, sizes, sigs))
                    roots[held], sizes[held], sigs[held] = root, n, sig
                    sids.append(sid)
                    items.append(own)
            if got:
                yield _pairs_batch(*zip(*got))

    return run


def _bands(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, band, sid, n): one row for each class and band."""
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    piece = F.expr(f"substring(sig, band * {2 * rows} + 1, {2 * rows})")
    return (classes.where("n > 0").select("sid", "n", "sig", band.alias("band"))
            .select(F.xxhash64("band", piece).alias("bucket"), "band", "sid", "n"))


@tidy
def _left_over(shared: DataFrame, classes: DataFrame, links: DataFrame, docs: DataFrame, width: int, t: int,
               rows: int, percent: int) -> DataFrame | None:
    """Links between members of one bucket that lie in different components."""
    labels = materialize(connected_components(links, "a", "b", edges_distinct=True), "minhash-labels-1")
    members = shared.where("members > 2").join(labels.withColumnRenamed("id", "sid"), "sid", "left").select(
        "bucket", "band", "leader", "sid", "n", F.coalesce("cmp", "sid").alias("cmp"))
    members = materialize(members, "minhash-members")
    split = materialize(members.groupBy("bucket").agg(
        F.min("cmp").alias("x"), F.max("cmp").alias("y"),
        F.ceil(F.sum(8 * F.col("n") + 2 * t) / _TILE_BYTES).cast("int").alias("chunks"))
        .where("x <> y").select("bucket", "chunks"), "minhash-split")
    if split.isEmpty():
        return None
    # The leader has been verified with everyone.
    open_ = materialize(members.join(split, "bucket").where(F.col("sid") != F.col("leader"))
                        .select("bucket", "chunks", "band", "sid", "cmp"), "minhash-open")
    need = open_.select("sid").distinct().join(classes.select("sid", "k1", "k2", "sig"), "sid")
    need = materialize(need, "minhash-need")
    texts = _texts(docs, need).join(need.select("sid", "k1", "k2"), ["k1", "k2"]).select("sid", "text")
    sets = texts.mapInArrow(_hashed_sets(width), "sid bigint, items binary")
    sets = materialize(sets.join(need.select("sid", "sig"), "sid"), "minhash-sets")
    # Chunk c of a bucket is in the tiles (c, j) and (i, c).
    c, last = F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int"), F.col("chunks") - 1
    tile = F.transform(F.sequence(F.lit(0), last), lambda o: F.struct(
        F.least(c, o).alias("i"), F.greatest(c, o).alias("j"), (o < c).cast("int").alias("side")))
    tiles = open_.select("bucket", "band", "sid", "cmp", F.explode(tile).alias("x")).join(sets, "sid")
    tiles = (tiles.select("bucket", F.col("x.i").alias("i"), F.col("x.j").alias("j"), "band",
                          F.col("x.side").alias("side"), "sid", "cmp", "sig", "items")
             .repartition(shuffle_parts(docs.sparkSession), "bucket", "i", "j")
             .sortWithinPartitions("bucket", "i", "j", "side"))
    return materialize(tiles.mapInArrow(_tiles(t, rows, percent), "a bigint, b bigint").distinct(), "minhash-more")


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(key, k1, n, cmp, component_id) for every row."""
    t = bands * rows
    keyed = docs.select(F.col(doc_id).alias("key"), F.xxhash64(doc_id, text).alias("k1"),
                        F.xxhash64(text, doc_id, F.lit(1)).alias("k2"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    made = materialize(keyed.mapInArrow(
        _sketch(width, t), f"key {kind}, k1 bigint, k2 bigint, n bigint, h1 bigint, h2 bigint, sig binary"),
        "minhash-rows")
    first = F.min(F.struct(F.col("key").isNull().alias("a"), "key", "k1", "k2"))
    reps = made.where("n > 0").groupBy("h1", "h2").agg(
        F.min("key").alias("least"), first.alias("w"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = materialize(reps.select(
        F.monotonically_increasing_id().alias("sid"), "h1", "h2", "least", F.col("w.k1").alias("k1"),
        F.col("w.k2").alias("k2"), "n", "sig"), "minhash-classes")
    buckets = materialize(
        _bands(classes, bands, rows).groupBy("bucket")
        .agg(F.min("sid").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1"), "minhash-buckets")
    shared = materialize(_bands(classes, bands, rows).join(buckets, "bucket"), "minhash-shared")
    sizes = classes.select(F.col("sid").alias("leader"), F.col("n").alias("leader_n"))
    stars = shared.where("sid <> leader").select("leader", "sid", "n").distinct().join(sizes, "leader")
    stars = stars.where(100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n"))
    stars = materialize(stars.select(F.col("leader").alias("a"), F.col("sid").alias("b")), "minhash-stars")
    links = _verified(stars, classes, keyed, width, percent)
    more = _left_over(shared, classes, links, keyed, width, t, rows, percent)
    found = links if more is None else links.unionByName(more)
    labels = connected_components(found, "a", "b", edges_distinct=True)
    labelled = materialize(classes.select("sid", "h1", "h2", "least").join(
        labels.withColumnRenamed("id", "sid"), "sid", "left").select(
        "h1", "h2", "least", F.coalesce("cmp", "sid").alias("cmp")), "minhash-labels")
    lowest = materialize(labelled.groupBy("cmp").agg(F.min("least").alias("component_id")), "minhash-components")
    by_set = materialize(labelled.join(lowest, "cmp").select("h1", "h2", "cmp", "component_id"), "minhash-result")
    # Plain scans on both sides: a set that very many rows have is split.
    return made.drop("sig").join(by_set, ["h1", "h2"], "left")


@tidy
def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle_words: int = 2,
                    percent: int = 80, bands: int = 48, rows: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row: rows whose
    sets have ``percent`` or more of their union in common are linked."""
    got = _grouped(docs, doc_id, text, shingle_words, percent, bands, rows)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    got = got.select(F.col("key").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return got.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(False)))


@tidy
def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle_words: int = 2,
                         percent: int = 80, bands: int = 48, rows: int = 5) -> DataFrame:
    """One row of each component stays: the one with the least id (null ids
    last, then the least hash of id and text).  Rows without words all stay."""
    got = _grouped(docs, doc_id, text, shingle_words, percent, bands, rows)
    key, empty = fresh(docs, "_key"), F.col("n") == 0
    group = F.struct(empty.alias("e"), F.when(empty, F.col("k1")).otherwise(F.col("cmp")).alias("c"))
    first = got.groupBy(group.alias("g")).agg(
        F.min(F.struct(F.col("key").isNull().alias("a"), "key", "k1")).alias("w"), F.first(empty).alias("empty"))
    keep = materialize(first.select(F.col("w.k1").alias(key), "empty"), "minhash-keep")
    marked = docs.withColumn(key, F.xxhash64(doc_id, text))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    blank = marked.join(keep.where("empty").select(key), key, "left_semi").select(*cols)
    rest = marked.join(keep.where("not empty").select(key), key, "left_semi").dropDuplicates([key]).select(*cols)
    return rest.unionByName(blank)


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


#: The same in DuckDB, by counting the shingles that two sets share.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), classes AS (
  SELECT min(doc_id) AS id, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL
), items AS (SELECT id, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.id AS a, b.id AS b FROM items a JOIN items b ON a.x = b.x AND a.id <> b.id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), cc(id, c) USING KEY (id) AS (
  SELECT id, id FROM classes
  UNION
  (SELECT l.a, min(cc.c) FROM cc JOIN links l ON l.b = cc.id JOIN recurring.cc r ON r.id = l.a
   GROUP BY l.a HAVING min(cc.c) < min(r.c))
)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(cc.c, d.doc_id) AS component_id,
  coalesce(cc.c, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes k ON k.s = list_sort(d.s) LEFT JOIN cc ON cc.id = k.id
"""
