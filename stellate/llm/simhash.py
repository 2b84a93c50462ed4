"""SimHash near-dedup by anchor-point covering.

Fingerprints: 64 bits, bit ``j`` set if it is set in over half of the XXH64
hashes (seed 42) of the text's word shingles.  Two fingerprints are linked at
``max_bits`` or fewer differing bits.

Anchors: the 64 bits are cut into blocks, and the threshold is shared out so
that fingerprints within ``max_bits`` differ in at most ``t_i`` bits in some
block ``i`` (the ``t_i`` add up to ``max_bits - blocks + 1``; with 4 bits and
3 blocks they are 1, 1, 0).  The anchors of a block are the words of a
covering code: the Hamming code on the first ``2^r - 1`` bits, times all
values of the other bits, with covering radius 1.  Every fingerprint has one
home anchor per block (the nearest code word) and is copied to every anchor
within the covering radius plus ``t_i``.  If x and y are within ``t_i`` in
block ``i``, y is within ``1 + t_i`` of x's home, so the two meet there: no
link is lost.  (A covering code over all 64 bits would need 130,000 copies
per fingerprint at this threshold.)

The number of blocks follows from the number n of distinct fingerprints
(:func:`covering_blocks`): a fingerprint has a fixed number of copies, and meets
n times a fixed share of the others, so few wide blocks (many copies, fine
anchors) pay when there are many.  At 4 bits: three blocks (36 copies) up to
some 500 million fingerprints, then two (234 copies, 1 / 170 of the pairs).

Compare per anchor: home rows against copied rows, by exact bit distance.
Equal fingerprints are one row from the start, so groups of exact copies cost
one comparison.  An anchor with many home rows is cut into chunks; the copied
rows of that anchor go to each chunk and are streamed through it, so memory
is bounded by the chunk.  A crowded group (many near copies) gives a spanning
forest of its links, not all its pairs: the components stay the same.

Defined cases: a null or blank text has fingerprint zero and is linked like
any other; the component is the least id that is not null (null if there is
none); repeated rows share a component; an empty table gives an empty table;
other columns pass through :func:`near_duplicates`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.components import connected_components
from ..session import materialize, tidy
from .common import fresh, shuffle_parts, table

SEED = 42
BITS = 64


def simhash(text: str | None, shingle_words: int) -> int:
    """Fingerprint of one text (signed 64-bit)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lower(): A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprint_udf(shingle_words: int):
    @arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py(), shingle_words) for t in texts], pa.int64())

    return fp.asNondeterministic()  # evaluated once, never pushed or repeated


# ------------------------------------------------------------- covering code
class Block:
    """Anchors of one block of bits: a Hamming code on its low bits times all
    values of the rest; covering radius 1."""

    radius = 1

    def __init__(self, number: int, low: int, width: int, threshold: int):
        self.number, self.low, self.width, self.threshold = number, low, width, threshold
        self.r = max(2, (width + 1).bit_length() - 1)
        self.coded = (1 << self.r) - 1  # bits under the Hamming code
        reach = self.radius + threshold
        errors = [0]
        layer = {0}
        for _ in range(reach):  # all patterns of at most ``reach`` bits
            layer = {e ^ (1 << j) for e in layer for j in range(width)} - set(errors)
            errors += sorted(layer)
        err = np.array(errors, np.uint64)
        s = self.syndrome(err)
        #: By syndrome of the value: the changes that lead to a code word.
        self.moves = [err[s == v] for v in range(1 << self.r)]

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros(v.shape, np.int64)
        for j in range(self.r):  # parity of the coded bits whose number has bit j
            mask = sum(1 << (i - 1) for i in range(1, self.coded + 1) if i >> j & 1)
            out |= (np.bitwise_count(v & np.uint64(mask)).astype(np.int64) & 1) << j
        return out

    def value(self, fp: np.ndarray) -> np.ndarray:
        return (fp >> np.uint64(self.low)) & np.uint64((1 << self.width) - 1)

    def home(self, v: np.ndarray) -> np.ndarray:
        s = self.syndrome(v).astype(np.uint64)
        return np.where(s > 0, v ^ (np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1))), v)

    def anchors(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, fingerprint, is home) arrays covering all rows."""
        v = self.value(fp)
        s, home = self.syndrome(v), self.home(v)
        tag = np.uint64(self.number << 58)
        for k, moves in enumerate(self.moves):
            rows = np.flatnonzero(s == k)
            if len(rows):
                a = (v[rows, None] ^ moves[None, :])
                yield ((a | tag).ravel(), np.repeat(fp[rows], len(moves)),
                       (a == home[rows, None]).ravel())


def _layouts(max_bits: int, bits: int) -> Iterator[list[tuple[int, int]]]:
    """(width, threshold) of the blocks, for one to three blocks (more of
    them compare far more pairs)."""
    for k in range(1, min(3, max_bits + 1) + 1):
        share, over = divmod(max_bits - k + 1, k)
        thresholds = [share + (i < over) for i in range(k)]
        # Blocks with a higher threshold are wider: they need finer anchors.
        wide = [i < over for i in range(k)] if over else [False] * k
        width = [bits // k + 2 * w for w in wide]
        width[-1] = bits - sum(width[:-1])
        if min(width) >= 3:
            yield list(zip(width, thresholds))


def layout_work(layout: list[tuple[int, int]], n: int) -> tuple[float, float]:
    """Copies of a fingerprint, and pairs that it is compared in, among n
    random ones."""
    copies = pairs = 0.0
    for width, threshold in layout:
        near = sum(math.comb(width, j) for j in range(Block.radius + threshold + 1))
        copies += near / 2 ** max(2, (width + 1).bit_length() - 1)
        pairs += n * near / 2 ** width
    return copies, pairs


#: A copied row costs about as much as so many comparisons.
_ROW_COST = 500


def covering_blocks(max_bits: int, n: int = 0, bits: int = BITS) -> list[Block]:
    """The blocks with the least work for n distinct fingerprints."""
    def cost(layout: list[tuple[int, int]]) -> float:
        copies, pairs = layout_work(layout, n)
        return _ROW_COST * copies + pairs

    layout = min(_layouts(max_bits, bits), key=cost)
    low = [sum(w for w, _ in layout[:i]) for i in range(len(layout))]
    return [Block(i, at, width, t) for i, (at, (width, t)) in enumerate(zip(low, layout))]


# ---------------------------------------------------------- compare per anchor
def _forest(home: np.ndarray, copied: np.ndarray, bits: int, parent: list[int]):
    """Links between home and copied rows, at most one per copied row and one
    per join of two home rows.  ``parent`` joins the home rows."""
    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.full(len(copied), -1, np.int64)
    for j, x in enumerate(home):
        near = np.flatnonzero(np.bitwise_count(copied ^ x) <= bits)
        if not len(near):
            continue
        known = first[near]
        new = near[known < 0]
        for i in new:
            yield x, copied[i]
        first[new] = j
        old, at = np.unique(known[known >= 0], return_index=True)
        where = near[known >= 0]
        for k, i in zip(old.tolist(), at.tolist()):
            a, b = find(k), find(j)
            if a != b:
                parent[a] = b
                yield x, copied[where[i]]


_TILE = 1 << 16
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    keep = a != b
    a, b = a[keep].view(np.int64), b[keep].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], schema=_EDGES)


def _compare(bits: int, small: int = 1024):
    """Streams rows sorted by (anchor, chunk, copied after home)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, parent = None, np.zeros(0, np.uint64), []
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            chunk = batch.column(1).to_numpy()
            fp = batch.column(2).to_numpy().view(np.uint64)
            copied = batch.column(3).to_numpy(zero_copy_only=False)
            n = len(fp)
            if not n:
                continue
            cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            starts = np.concatenate(([0], cut))
            ends = np.concatenate((cut, [n]))
            total = np.concatenate(([0], np.cumsum(copied)))
            n_copied = total[ends] - total[starts]
            n_home = ends - starts - n_copied
            pairs = n_home * n_copied
            # Whole groups with few pairs are expanded together.
            whole = np.ones(len(starts), bool)
            whole[[0, -1]] = False  # may go on in another batch
            quick = np.flatnonzero(whole & (pairs > 0) & (pairs <= small))
            if len(quick):
                group = np.repeat(np.arange(len(quick)), pairs[quick])
                nth = np.arange(len(group)) - np.repeat(np.cumsum(pairs[quick]) - pairs[quick], pairs[quick])
                width = n_copied[quick][group]
                x = fp[starts[quick][group] + nth // width]
                y = fp[starts[quick][group] + n_home[quick][group] + nth % width]
                hit = np.bitwise_count(x ^ y) <= bits
                yield _edge_batch(x[hit], y[hit])
            for g in np.flatnonzero(~whole | (pairs > small)):
                a, b = starts[g], ends[g]
                if (anchor[a], chunk[a]) != key:
                    key, home, parent = (anchor[a], chunk[a]), np.zeros(0, np.uint64), []
                mid = b - n_copied[g]
                if mid > a:
                    home = np.concatenate((home, fp[a:mid]))
                    parent = list(range(len(home)))
                for at in range(mid, b, _TILE):
                    got = list(_forest(home, fp[at:min(b, at + _TILE)], bits, parent))
                    if got:
                        e = np.array(got, np.uint64)
                        yield _edge_batch(np.ascontiguousarray(e[:, 0]), np.ascontiguousarray(e[:, 1]))

    return run


def _replicate(max_bits: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = covering_blocks(max_bits, n)
        for batch in batches:
            all_fp = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(all_fp), 8192):
                for block in blocks:
                    for anchor, fp, is_home in block.anchors(all_fp[at:at + 8192]):
                        # A home row stands twice: as home and as copied row.
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.concatenate((anchor, anchor[is_home])).view(np.int64)),
                            pa.array(np.concatenate((fp, fp[is_home])).view(np.int64)),
                            pa.array(np.concatenate((np.ones(len(fp), bool),
                                                     np.zeros(int(is_home.sum()), bool))))],
                            names=["anchor", "fp", "copied"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int, chunk_rows: int = 4096) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of written column
    ``fp`` that keep every component at ``max_bits`` whole."""
    spread = fps.mapInArrow(_replicate(max_bits, fps.count()), "anchor bigint, fp bigint, copied boolean")
    crowded = (spread.where(~F.col("copied")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > chunk_rows)
               .select("anchor", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks")))
    crowded = materialize(crowded, "simhash-crowded")
    rows = spread.select("anchor", "fp", "copied")
    if not crowded.isEmpty():
        rows = (rows.join(crowded, "anchor", "left")
                .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
                .withColumn("chunk", F.explode(F.when(F.col("copied"), F.sequence(F.lit(0), F.col("chunks") - 1))
                                               .otherwise(F.array(F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))))))
    else:
        rows = rows.withColumn("chunk", F.lit(0))
    rows = (rows.select("anchor", "chunk", "fp", "copied")
            .repartition(shuffle_parts(fps.sparkSession), "anchor", "chunk")
            .sortWithinPartitions("anchor", "chunk", "copied"))
    return rows.mapInArrow(_compare(max_bits), "a bigint, b bigint").distinct()


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle_words: int, max_bits: int) -> DataFrame:
    """``(doc_id, row_key, fp, cmp, component_id)`` for every row; ``cmp``
    is the component's least fingerprint, ``row_key`` a hash of id and text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row_key"),
                       _fingerprint_udf(shingle_words)(F.col(text)).alias("fp"))
    rows = materialize(rows, "simhash-rows")
    least = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    links = fingerprint_links(least.select("fp"), max_bits)
    labels = connected_components(links, "a", "b", edges_distinct=True)
    labelled = least.join(labels.withColumnRenamed("id", "fp"), "fp", "left")
    labelled = materialize(labelled.select("fp", "least", F.coalesce("cmp", "fp").alias("cmp")), "simhash-labels")
    lowest = materialize(labelled.groupBy("cmp").agg(F.min("least").alias("component_id")), "simhash-components")
    by_fp = materialize(labelled.join(lowest, "cmp").select("fp", "cmp", "component_id"), "simhash-result")
    # Both sides are plain scans, so a fingerprint with very many rows is split.
    return rows.join(by_fp, "fp")


@tidy
def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                    shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: the signed fingerprint
    and the least id reachable over links."""
    return _grouped(docs, doc_id, text, shingle_words, max_bits).select("doc_id", "fp", "component_id")


@tidy
def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                         shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component stays: the one with the least id (null ids
    last, then the least hash of id and text; rows equal in both: one)."""
    got = _grouped(docs, doc_id, text, shingle_words, max_bits)
    key = fresh(docs, "_key")
    first = got.groupBy("cmp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "row_key")).alias("w"))
    keep = materialize(first.select(F.col("w.row_key").alias(key)), "simhash-keep")
    kept = docs.withColumn(key, F.xxhash64(doc_id, text)).join(keep, key, "left_semi")
    return kept.dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
