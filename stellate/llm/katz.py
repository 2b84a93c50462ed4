"""Language-model scoring with Katz backoff.

Order 2: the probability of a word after its context is ``d(c) c / c(h)`` for
a pair seen ``c`` times in training, else ``alpha(h) p(w)``; after a context
that training lacks it is ``p(w)``.  ``d`` is the Good-Turing discount
of counts up to 5 (Katz's form, from the counts of counts of all pairs; where
they are too thin for it, ``(r - D) / r`` with ``D = n1 / (n1 + 2 n2)``);
``alpha(h)`` is computed from the very sums that it normalises, so the
probabilities after every context add up to 1.  A context whose pairs leave no
mass over gets one more in its denominator.  ``p`` is the discounted unigram
distribution; its leftover is the probability of one unknown word.

A text is its words, then an end; its first context is a start mark.  Words
are known by their 64-bit hash.

Steps, each over all documents:

1. Unigrams: counted per batch, then combined (``katz-words``).
2. Pairs: every token goes to the partition of its context, packed with its
   word, the word's count and its document.  The counts of the
   ``frequent`` most frequent words (a bounded number) are sent along with the
   task; the tokens of the other words get theirs by a join.  A context that
   holds more than 4 times a partition's share of the tokens is spread by
   word over all partitions, and a pair of two such words, which may hold as
   many tokens itself, by document as well.  There are so many partitions that
   none has more than about ``partition_tokens`` tokens.
3. ``katz-pairs``: each partition is sorted by (context, word) and written
   with its counts of counts: the partitioned n-gram table.
4. Scores: each partition computes its discounted counts, backoff weights and
   the tokens' probabilities, adds them up per document, and the documents'
   sums are added over the partitions.  The few spread contexts (at most a
   quarter of the number of partitions) and split pairs get their sums first.

Defined cases: a null text counts as empty (one end token); a null id is
training; rows that agree in id and text each count in training and each get
the row's score; an empty table, or one without training rows, gives scores
from the unknown word alone; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, tidy
from .common import Shipped, even_keys, shuffle_parts, table

Batches = Iterator[pa.RecordBatch]
K = 5  # counts up to K are discounted
# Hashes of strings that no word can be (they hold a line end).
START = xxhash.xxh3_64_intdigest(b"\n<s>")
END = xxhash.xxh3_64_intdigest(b"\n</s>")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(1 << 63)


# ------------------------------------------------------------------- discounts
def discounts(n: list[int]) -> np.ndarray:
    """Factor for counts 0..K (0 unused) from ``n[r]``, the number of things
    seen ``r`` times (r = 1..K+1 at index r)."""
    d = np.ones(K + 1)
    if n[1] > 0:
        rest = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r] > 0 and rest < 1:
                d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
        if not all(0 < x < 1 for x in d[1:]):
            cut = n[1] / (n[1] + 2 * n[2])
            d[1:] = [(r - cut) / r for r in range(1, K + 1)]
            if cut >= 1:
                d[1:] = [(r - 0.5) / r for r in range(1, K + 1)]
    return d


@dataclass
class Unigrams:
    """Totals of the training words, and the counts of the frequent ones."""

    total: int
    distinct: int
    counts: list[int]  # counts of counts, 0..K+1
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted
    number: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  # of each hash, by falling count
    freq: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of each number

    def __post_init__(self):
        self.discount = discounts(self.counts)
        kept = self.total - sum(self.counts[r] * r * (1 - self.discount[r]) for r in range(1, K + 1))
        left = self.total - kept
        self.scale = self.total if left > 1e-9 else self.total + 1
        self.unknown = (self.scale - kept) / self.scale if self.scale else 1.0

    def keys(self, words: np.ndarray) -> np.ndarray:
        """A word's key: its number if it is frequent, else its hash with the
        top bit set."""
        other = words | _OTHER
        if not len(self.hashes):
            return other
        i = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[i] == words, self.number[i].astype(np.uint64), other)

    def probability(self, count: np.ndarray) -> np.ndarray:
        d = self.discount[np.minimum(count, K)]
        return np.where(count > 0, np.where(count <= K, d, 1.0) * count / max(self.scale, 1), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.distinct + 1))


# ---------------------------------------------------------------------- tokens
class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _words(text) -> list[bytes]:
    return (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()  # lower(): A-Z only


@dataclass
class _Tokens:
    """Tokens of some documents, in order: contexts and words as indexes into
    ``vocab`` (hashes), and the documents they belong to."""

    vocab: np.ndarray
    context: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    ids: list
    keys: np.ndarray
    train: np.ndarray


def _documents(batches: Batches, most: int) -> Iterator[_Tokens]:
    """Rows ``(doc_id, key, train, text)`` in groups of about ``most`` tokens."""
    marks = {b"\n<s>": 0, b"\n</s>": 1}
    number, flat, sizes, rows = _Numbers(marks), [], [], []

    def group() -> _Tokens:
        vocab = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
        word, size = np.array(flat, np.int64), np.array(sizes)
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[np.cumsum(size) - size] = 0
        ids, keys, train = zip(*rows)
        return _Tokens(vocab, context, word, np.repeat(np.arange(len(rows)), size), list(ids),
                       np.array(keys, np.int64), np.array(train, bool))

    for batch in batches:
        for *row, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                           batch.column(2).to_pylist(), batch.column(3)):
            words = _words(x)
            flat.extend(map(number.__getitem__, words))
            flat.append(1)
            sizes.append(len(words) + 1)
            rows.append(row)
            if len(flat) >= most:
                yield group()
                number, flat, sizes, rows = _Numbers(marks), [], [], []
    if rows:
        yield group()


def _word_counts(most: int):
    def run(batches: Batches) -> Batches:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for train, x in zip(batch.column(2).to_pylist(), batch.column(3)):
                if train:
                    counts.update(_words(x))
                    counts[b"\n</s>"] += 1
                    if len(counts) >= most:
                        yield out()
                        counts.clear()
        yield out()

    return run


# ----------------------------------------------------------------- packed pairs
#: Arrays of a packed block: per token the context's and the word's key, the
#: word's count (0 if its number tells it) and the number of its document in
#: the block; per document id, valid, key, train.
_FIELDS = [np.uint64, np.uint64, np.int64, np.uint32, np.int64, np.uint8, np.int64, np.uint8]


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays byte by byte (all first bytes, then all second ones, ...), which
    compresses small numbers and runs well."""
    head = np.array([len(a) for a in arrays], np.int64)
    parts = [head.tobytes()]
    for a, t in zip(arrays, _FIELDS):
        parts.append(np.ascontiguousarray(a, t).view(np.uint8).reshape(len(a), -1).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(_FIELDS))
    out, at = [], 8 * len(_FIELDS)
    for n, t in zip(sizes.tolist(), _FIELDS):
        width = np.dtype(t).itemsize
        cells = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(cells.T).view(t).reshape(n))
        at += n * width
    return out


def _split(context: np.ndarray, word: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Pairs of two hot words may hold a large share of all tokens themselves."""
    return np.isin(context, hot) & np.isin(word, hot) if len(hot) else np.zeros(len(context), bool)


def _shard_of(context: np.ndarray, word: np.ndarray, salt: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a token: by context; for a hot context by word as
    well; for a pair of hot words by document as well."""
    key = context.copy()
    if len(hot):
        spread = np.isin(context, hot)
        key[spread] = context[spread] * _MIX + word[spread]
        pairs = _split(context, word, hot)
        key[pairs] = (key[pairs] ^ (key[pairs] >> np.uint64(29))) * _MIX + salt[pairs]
    key = (key ^ (key >> np.uint64(32))) * _MIX
    return ((key >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


def _blocks(context, word, count, doc, ids, keys, train, hot, shards: list[int]) -> pa.RecordBatch:
    """One packed block per partition that has tokens.  Tokens come sorted by
    (context, word)."""
    valid = np.array([i is not None for i in ids], np.uint8)
    number = np.array([0 if i is None else i for i in ids], np.int64)
    salt = keys.view(np.uint64) ^ number.view(np.uint64) * _MIX  # copies of a text differ by their ids
    to = _shard_of(context, word, salt[doc], hot, len(shards))
    order = np.argsort(to.astype(np.uint16) if len(shards) < 1 << 16 else to, kind="stable")
    context, word, count, doc = (x[order] for x in (context, word, count, doc))
    cut = np.concatenate(([0], np.cumsum(np.bincount(to, minlength=len(shards)))))
    at = np.zeros(len(ids), np.int64)
    rows = []
    for k in range(len(shards)):
        a, b = cut[k], cut[k + 1]
        if a < b:
            own = np.flatnonzero(np.bincount(doc[a:b], minlength=len(ids)))
            at[own] = np.arange(len(own))
            rows.append((shards[k], _pack([context[a:b], word[a:b], count[a:b], at[doc[a:b]], number[own],
                                           valid[own], keys[own], train[own]])))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])


_PACKED = "shard int, data binary"
_RARE = "word bigint, context bigint, doc_id bigint, key bigint, train boolean"


def _frequent_pairs(uni, hot: np.ndarray, shards: list[int], most: int):
    def run(batches: Batches) -> Batches:
        for t in _documents(batches, most):
            keys = uni.value.keys(t.vocab)
            at = np.flatnonzero((keys < _OTHER)[t.word])
            at = at[np.argsort(t.context[at] * len(t.vocab) + t.word[at])]
            yield _blocks(keys[t.context[at]], keys[t.word[at]], np.zeros(len(at), np.int64), t.doc[at],
                          t.ids, t.keys, t.train, hot, shards)

    return run


def _other_tokens(uni, most: int):
    """Rows of the tokens whose word is not frequent."""
    def run(batches: Batches) -> Batches:
        for t in _documents(batches, most):
            keys = uni.value.keys(t.vocab)
            at = np.flatnonzero((keys >= _OTHER)[t.word])
            doc = t.doc[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(t.vocab[t.word[at]].view(np.int64)), pa.array(keys[t.context[at]].view(np.int64)),
                 pa.array([t.ids[i] for i in doc.tolist()], pa.int64()), pa.array(t.keys[doc]),
                 pa.array(t.train[doc])], [c.split()[0] for c in _RARE.split(", ")])

    return run


def _pack_rows(hot: np.ndarray, shards: list[int], most: int):
    """Rows of the other words, with their counts, as packed blocks."""
    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            word, context, key, count = (rows.column(c).to_numpy() for c in ("word", "context", "key", "n"))
            word, context = word.view(np.uint64) | _OTHER, context.view(np.uint64)
            order = np.lexsort((word, context))
            return _blocks(context[order], word[order], count.astype(np.int64)[order], order,
                           rows.column("doc_id").to_pylist(), key, rows.column("train").to_numpy(), hot, shards)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= most:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


class _Pairs:
    """A partition of the pair table, sorted by (context, word)."""

    def __init__(self, parts: list[list[np.ndarray]]):
        docs = np.cumsum([0] + [len(p[4]) for p in parts])
        context, word, count = (np.concatenate([p[i] for p in parts]) for i in range(3))
        doc = np.concatenate([p[3] + np.uint32(n) for p, n in zip(parts, docs)])
        self.id, self.valid, self.key, self.train = (np.concatenate([p[i] for p in parts]) for i in range(4, 8))
        if len(parts) > 1:
            parts.clear()
            order = np.lexsort((word, context))
            context, word, count, doc = context[order], word[order], count[order], doc[order]
        self.context, self.word, self.count, self.doc = context, word, count, doc
        n = len(context)
        new_context = np.concatenate(([True], context[1:] != context[:-1]))[:n]
        new_pair = new_context | np.concatenate(([True], word[1:] != word[:-1]))[:n]
        self.first = np.flatnonzero(new_pair)  # of each pair
        self.pair = np.cumsum(new_pair, dtype=np.int32) - 1  # of each token
        self.seen = np.bincount(self.pair, weights=self.train[doc], minlength=len(self.first)).astype(np.int64)
        self.of = (np.cumsum(new_context, dtype=np.int32) - 1)[self.first]  # context of each pair
        self.contexts = context[new_context]

    def split(self, hot: np.ndarray) -> np.ndarray:
        """Which pairs have tokens in other partitions too."""
        return _split(self.context[self.first], self.word[self.first], hot)

    def pieces(self, most: int, hot: np.ndarray) -> Iterator[tuple[list[int], list[dict], bytes]]:
        """Counts of counts (of whole pairs), the split pairs with their
        counts here, and packed arrays, of parts of about ``most`` tokens; a
        context is never cut."""
        split = self.split(hot)
        starts = np.flatnonzero(np.concatenate(([True], self.context[1:] != self.context[:-1])))
        cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(self.context), most)).clip(
            max=len(starts) - 1))]
        at = np.zeros(len(self.id), np.uint32)
        for a, b in zip(cuts, np.append(cuts[1:], len(self.context))):
            own = np.flatnonzero(np.bincount(self.doc[a:b], minlength=len(self.id)))
            at[own] = np.arange(len(own))
            pairs = slice(self.pair[a], self.pair[b - 1] + 1)
            seen, cut = self.seen[pairs], split[pairs]
            n = np.bincount(np.minimum(seen[~cut], K + 2), minlength=K + 3)[:K + 2]
            at_pair = self.first[pairs][cut]
            shared = [{"context": int(c), "word": int(w), "n": int(k)} for c, w, k in zip(
                self.context[at_pair].view(np.int64), self.word[at_pair].view(np.int64), seen[cut])]
            yield n.tolist(), shared, _pack([self.context[a:b], self.word[a:b], self.count[a:b], at[self.doc[a:b]],
                                     self.id[own], self.valid[own], self.key[own], self.train[own]])

    def counts(self, uni: Unigrams) -> np.ndarray:
        """How often the word of each pair occurs in training."""
        word, count = self.word[self.first], self.count[self.first].astype(np.int64)
        known = word < _OTHER
        count[known] = uni.freq[word[known].astype(np.int64)]
        return count

    def share(self, hot: np.ndarray, counts: dict[tuple[int, int], int]) -> np.ndarray:
        """Gives the split pairs their counts over all partitions; returns
        which pairs those are."""
        split = self.split(hot)
        for i in np.flatnonzero(split).tolist():
            at = self.first[i]
            self.seen[i] = counts[int(self.context[at]), int(self.word[at])]
        return split

    def sums(self, discount: np.ndarray, uni: Unigrams):
        """Per context: training tokens, discounted tokens, unigram mass of
        the seen words; per pair: discounted count."""
        kept = np.where(self.seen <= K, discount[np.minimum(self.seen, K)], 1.0) * self.seen
        p = uni.probability(self.counts(uni))
        m = len(self.contexts)
        return (np.bincount(self.of, weights=self.seen, minlength=m), np.bincount(self.of, weights=kept, minlength=m),
                np.bincount(self.of, weights=np.where(self.seen > 0, p, 0.0), minlength=m), kept, p)


_SHARED = pa.list_(pa.struct([("context", pa.int64()), ("word", pa.int64()), ("n", pa.int64())]))


def _sorted_pairs(hot: np.ndarray):
    """Streams blocks sorted by partition; writes each partition as rows of
    bounded size."""
    def run(batches: Batches) -> Batches:
        shard, parts = None, []

        def rows() -> Batches:
            for counts, shared, data in _Pairs(parts).pieces(1 << 19, hot):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([counts], pa.list_(pa.int64())), pa.array([shared], _SHARED),
                     pa.array([data], pa.binary())], ["shard", "counts", "shared", "data"])

        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if s != shard and parts:
                    yield from rows()
                    parts = []
                shard = s
                parts.append(_unpack(data.as_py()))
        if parts:
            yield from rows()

    return run


def _hot_sums(uni, discount: np.ndarray, hot: np.ndarray):
    """Sums of the hot contexts over their whole pairs; the split pairs are
    added once, by the driver."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for data in batch.column("data"):
                pairs = _Pairs([_unpack(data.as_py())])
                pairs.seen[pairs.split(hot)] = 0
                total, kept, mass, _, _ = pairs.sums(discount, uni.value)
                at = np.isin(pairs.contexts, hot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs.contexts[at].view(np.int64)), pa.array(total[at]), pa.array(kept[at]),
                     pa.array(mass[at])], ["context", "total", "kept", "mass"])

    return run


_PART = "doc_id bigint, key bigint, train boolean, n_tokens bigint, n_known bigint, rows bigint, base double, score double"


def _scores(uni, discount: np.ndarray, hot: dict[int, tuple[float, float, float]], words: np.ndarray,
            shared: dict[tuple[int, int], int]):
    """Sums per document of each partition; ``words`` are the hot ones."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for data in batch.column("data"):
                u, pairs = uni.value, _Pairs([_unpack(data.as_py())])
                pairs.share(words, shared)
                total, kept, mass, pair_kept, p = pairs.sums(discount, u)
                for i in np.flatnonzero(np.isin(pairs.contexts, np.array(list(hot), np.uint64))) if hot else ():
                    total[i], kept[i], mass[i] = hot[int(pairs.contexts[i])]
                none_left = total - kept <= 1e-9
                below = np.maximum(total + none_left, 1)
                with np.errstate(divide="ignore"):
                    alpha = np.log10((below - kept) / below) - np.log10(1 - mass)
                alpha = np.where(total > 0, alpha, 0.0)
                log = np.where(pairs.seen > 0, np.log10(np.maximum(pair_kept, 1e-300) / below[pairs.of]),
                               alpha[pairs.of] + np.log10(p))
                count = pairs.counts(u)
                end = pairs.word[pairs.first] == u.keys(np.array([END], np.uint64))[0]
                m = len(pairs.id)

                def by_doc(per_pair: np.ndarray) -> np.ndarray:
                    return np.bincount(pairs.doc, weights=per_pair[pairs.pair], minlength=m)

                sums = [np.bincount(pairs.doc, minlength=m), by_doc(count > 0), by_doc(end)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs.id, mask=pairs.valid == 0), pa.array(pairs.key), pa.array(pairs.train.astype(bool))]
                    + [pa.array(s.astype(np.int64)) for s in sums]
                    + [pa.array(by_doc(u.base(count))), pa.array(by_doc(log))],
                    [c.split()[0] for c in _PART.split(", ")])

    return run


# ------------------------------------------------------------------- operators
def _unigrams(words: DataFrame, frequent: int) -> Unigrams:
    """Totals and the ``frequent`` most frequent words (whole counts only:
    the least count whose words all fit).  The counts of counts have at most
    sqrt(2 N) rows."""
    by_count = words.groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect()
    counts = [0] * (K + 2)
    total = distinct = 0
    for r in by_count:
        total, distinct = total + r["n"] * r["m"], distinct + r["m"]
        if r["n"] <= K + 1:
            counts[r["n"]] = r["m"]
    least, fit = math.inf, 0
    for r in sorted(by_count, key=lambda r: -r["n"]):
        if (fit := fit + r["m"]) > frequent:
            break
        least = r["n"]
    out = Unigrams(total, distinct, counts)
    if least < math.inf:
        top = words.where(F.col("n") >= least).toArrow()
        h = top.column("word").to_numpy().view(np.uint64)
        order = np.argsort(h)
        n = top.column("n").to_numpy()[order].astype(np.int64)
        by_count = np.argsort(-n, kind="stable")
        number = np.empty(len(n), np.uint32)
        number[by_count] = np.arange(len(n), dtype=np.uint32)
        out.hashes, out.number, out.freq = h[order], number, n[by_count]
    return out


@tidy
def katz_scores(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", *,
                frequent: int = 1 << 20, group_tokens: int = 1 << 19, partition_tokens: int = 1 << 22) -> DataFrame:
    """Learns from the rows where ``train`` holds and scores every row:
    ``(doc_id, train, n_tokens, n_known, train_tokens, base_score, score)``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"),
                       F.coalesce(train, F.lit(True)).alias("train"), F.col(text).alias("text"))
    words = rows.mapInArrow(_word_counts(group_tokens), "word bigint, n bigint")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "katz-words")
    u = _unigrams(words, frequent)
    uni = Shipped(spark, u)
    # Partitions are sorted in memory: so many that none has to hold more.
    parts = max(shuffle_parts(spark), -(-u.total // partition_tokens))
    shards = even_keys(spark, parts)
    # As contexts: a word stands before something as often as it occurs; the
    # start mark as often as there are documents, that is as the end.
    hot = np.flatnonzero(u.freq > 4 * u.total / len(shards)).astype(np.uint64)
    marks = u.keys(np.array([START, END], np.uint64))
    if marks[1] in hot:
        hot = np.append(hot, marks[0])

    other = rows.mapInArrow(_other_tokens(uni, group_tokens), _RARE).join(words, "word", "left")
    other = other.withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    packed = rows.mapInArrow(_frequent_pairs(uni, hot, shards, group_tokens), _PACKED).unionByName(
        other.mapInArrow(_pack_rows(hot, shards, group_tokens), _PACKED))
    packed = packed.repartition(parts, "shard").sortWithinPartitions("shard")
    pairs = materialize(packed.mapInArrow(
        _sorted_pairs(hot), "shard int, counts array<bigint>, shared array<struct<context:bigint,word:bigint,n:bigint>>, data binary"),
        "katz-pairs")
    got = pairs.select(F.posexplode("counts").alias("r", "m")).groupBy("r").agg(F.sum("m").alias("m")).collect()
    n = [0] * (K + 2)
    for r in got:
        n[r["r"]] = r["m"]
    # At most as many as the square of the number of hot words.
    split = pairs.select(F.explode("shared").alias("s")).groupBy("s.context", "s.word").agg(F.sum("s.n").alias("n")).collect()
    shared = {(r["context"] % (1 << 64), r["word"] % (1 << 64)): r["n"] for r in split}
    for c in shared.values():
        if c <= K + 1:
            n[c] += 1
    discount = discounts(n)
    sums: dict[int, tuple[float, float, float]] = {}
    if len(hot):
        each = pairs.mapInArrow(_hot_sums(uni, discount, hot), "context bigint, total double, kept double, mass double")
        for r in each.groupBy("context").agg(*[F.sum(c).alias(c) for c in ("total", "kept", "mass")]).collect():
            sums[r["context"] % (1 << 64)] = (r["total"], r["kept"], r["mass"])
        freq = u.freq
        for (context, word), c in shared.items():  # hot words are frequent ones (the start mark is never a word)
            total, kept, mass = sums.get(context, (0.0, 0.0, 0.0))
            p = float(u.probability(freq[[word]])[0]) if c else 0.0
            sums[context] = (total + c, kept + (discount[c] * c if c <= K else c), mass + p)
    # A task takes some partitions, so that a document's sums are added up
    # before they are shuffled.
    done = pairs.coalesce(max(1, len(shards) // 4)).mapInArrow(_scores(uni, discount, sums, hot, shared), _PART)
    done = done.groupBy("doc_id", "key", "train").agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "rows", "base", "score")])
    # Rows that agree in id and text were added up: each gets its share.
    k = F.col("rows")
    out = done.withColumn("_copy", F.explode(F.sequence(F.lit(1), k.cast("int"))))
    return out.select("doc_id", "train", *[F.expr(f"{c} div rows").alias(c) for c in ("n_tokens", "n_known")],
                      F.lit(u.total).cast("bigint").alias("train_tokens"),
                      (F.col("base") / k).alias("base_score"), (F.col("score") / k).alias("score"))


def op5_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = katz_scores(docs, ~held_out)
    return got.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")
