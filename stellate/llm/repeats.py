"""Substring dedup with automata over repeated phrases.

A window is ``window`` consecutive words of one document.  Every word covered
by a window whose word sequence also starts in a document with a smaller id is
removed; windows are judged on the input.

1. Confirm recurring passages.  From every window the phrase (``phrase``
   consecutive words) with the least hash is chosen, so equal windows choose
   equal phrases.  The windows of a document that choose one occurrence of a
   phrase form a run (at most ``window - phrase + 1`` windows); its digest
   covers all its words.  A phrase chosen in two documents or more recurs;
   it is mixed if its runs differ.  The words of each recurring phrase are
   taken from the first document that has it: that is the dictionary.
2. Automata.  The documents are dealt to shards of about ``shard_words`` words.
   A shard gets the part of the dictionary that the run table names for its
   documents, compiled into one Aho-Corasick automaton, and all its documents
   are streamed through it whole.  Its hits alone say where passages occur:
   the runs whose phrase is hit are the only ones that can lose words.
3. Judge.  Runs are aggregated by (phrase, digest) to their least document:
   equal runs hold equal windows, so a group of copies is one row here.  Only
   the different runs of a mixed phrase are compared window by window.
4. The windows to remove are joined to the documents by (id, text hash).

No step brings the occurrences of a phrase together: they are combined on
the map side, or joined to one row per key with skewed keys split.

Defined cases: a null text has no words; documents with fewer than ``window``
words keep all; a document with a null id neither owns a window nor loses
one; documents with one id do not count against each other; repeated rows get
equal results; texts of any length are taken whole; an empty table gives an
empty table; other columns pass through, and input columns called like an
output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release, tidy
from .common import Shipped, bit_filter, fresh, keep_known, shuffle_parts, table

Batches = Iterator[pa.RecordBatch]
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(31))) * _K1 + b * _K2
    return h ^ (h >> np.uint64(29))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, by doubling."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, covered, power, size = None, 0, words, 1
    while True:
        if length & size:
            part = power[covered:covered + n]
            out = part if out is None else _mix(out, part)
            covered += size
        if covered == length:
            return out
        power = _mix(power[:-size], power[size:])
        size *= 2


class Plan:
    """Window and phrase lengths, and what they mean for a document."""

    def __init__(self, window: int, phrase: int):
        self.window, self.phrase = window, phrase
        self.inside = window - phrase + 1  # phrases in a window
        if not 0 < phrase <= window or self.inside > 63:
            raise ValueError("a window may hold 1 to 63 phrases")

    def chosen(self, phrases: np.ndarray) -> np.ndarray:
        """For every window, the place of its first phrase with the least hash."""
        n = len(phrases) - self.inside + 1
        if n <= 0:
            return np.zeros(0, np.int64)

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.where(phrases[a] <= phrases[b], a, b)

        # By doubling, as the hashes: a few numbers a word, whatever the text.
        at, size = np.arange(len(phrases)), 1
        while 2 * size <= self.inside:
            at, size = least(at[:-size], at[size:]), 2 * size
        return least(at[:n], at[self.inside - size:])


class _Shard:
    """Documents of one shard with their words numbered."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.docs: list[tuple] = []  # (id, text hash, word numbers)
        self.words = 0

    def add(self, doc_id: int, text_hash: int, text: str) -> None:
        words = text.encode("utf-8", "surrogatepass").split()
        number = self.number
        self.docs.append((doc_id, text_hash, [number.setdefault(w, len(number)) for w in words]))
        self.words += len(words)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.number), np.uint64, len(self.number))


def _shards(batches: Batches, shard_words: int) -> Iterator[_Shard]:
    shard = _Shard()
    for batch in batches:
        for i, h, t in zip(batch.column(0), batch.column(1), batch.column(2)):
            if i.is_valid and t.is_valid:
                shard.add(i.as_py(), h.as_py(), t.as_py())
                if shard.words >= shard_words:
                    yield shard
                    shard = _Shard()
    if shard.docs:
        yield shard


def _runs(words: np.ndarray, plan: Plan):
    """Phrase keys and window hashes of a document, and per run: its first
    window, its number of windows, the place of its phrase, its digest."""
    p, w = run_hashes(words, plan.phrase), run_hashes(words, plan.window)
    chosen = plan.chosen(p)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    size = np.diff(np.append(first, len(chosen)))
    at = chosen[first]
    # The first and the last window together cover all words of the run.
    shape = (size * plan.inside + (at - first)).astype(np.uint64)
    # Chosen hashes are small ones; as keys they are spread over all values.
    return _mix(p, p), w, first, size, at, _mix(_mix(w[first], w[first + size - 1]), shape)


_RUNS = "phrase bigint, digest bigint, doc_id bigint, key bigint, at int"


def _phrases(plan: Plan, shard_words: int):
    """``(phrase, digest, doc_id, key, at)`` of every run: ``at`` is the place
    of its phrase among the words."""
    def run(batches: Batches) -> Batches:
        for shard in _shards(batches, shard_words):
            hashes = shard.hashes()
            cols: list[list[np.ndarray]] = [[] for _ in range(5)]
            for doc_id, key, numbers in shard.docs:
                if len(numbers) >= plan.window:
                    p, _, _, _, at, digest = _runs(hashes[numbers], plan)
                    for col, v in zip(cols, (p[at].view(np.int64), digest.view(np.int64), np.full(len(at), doc_id, np.int64),
                                             np.full(len(at), key, np.int64), at.astype(np.int32))):
                        col.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 [f.split()[0] for f in _RUNS.split(", ")])

    return run


def _spelled_out(plan: Plan):
    """Rows (text, places of phrases) -> (phrase, words): the dictionary."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, len(batch), 64):
                phrases, words = [], []
                for t, places in zip(batch.column(0).slice(at, 64), batch.column(1).slice(at, 64).to_pylist()):
                    w = t.as_py().encode("utf-8", "surrogatepass").split()
                    for x in places:
                        phrases.append(x["phrase"])
                        words.append(b" ".join(w[x["at"]:x["at"] + plan.phrase]))
                yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.int64()), pa.array(words, pa.binary())],
                                                 ["phrase", "words"])

    return run


#: A word number is written as so many letters, each from a range of its own,
#: so that no node of an automaton has more than 32 branches and a match
#: always starts at a word.
_LETTERS, _LETTER_BITS = 4, 5


def _spell(numbers: list[int]) -> str:
    v = np.array(numbers, np.uint32)[:, None] >> np.arange(0, _LETTERS * _LETTER_BITS, _LETTER_BITS, np.uint32)
    v &= (1 << _LETTER_BITS) - 1
    v += 0x100 + (np.arange(_LETTERS, dtype=np.uint32) << _LETTER_BITS)
    return v.astype("<u4").tobytes().decode("utf-32-le")


class _Dictionary:
    """The automaton of one shard: its words numbered, its phrases spelled."""

    def __init__(self, phrases: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        number = self.number
        for words in phrases:
            self.automaton.add_word(_spell([number.setdefault(w, len(number) + 1) for w in words.split(b" ")]))
        if phrases:
            self.automaton.make_automaton()

    def places(self, words: list[bytes], length: int) -> np.ndarray:
        """Where a phrase of ``length`` words starts among the words."""
        if not len(self.automaton):
            return np.zeros(0, np.int64)
        get = self.number.get  # words of no phrase are all alike
        ends = np.fromiter((end for end, _ in self.automaton.iter(_spell([get(w, 0) for w in words]))), np.int64)
        return (ends + 1) // _LETTERS - length


_RUN_ROWS = ("phrase bigint, digest bigint, doc_id bigint, text_hash bigint, start int, size int, "
             "windows array<bigint>")


def _located(plan: Plan, mixed):
    """Rows (shard, kind, doc_id, key, text), a shard's phrases (kind 0) before
    its documents -> the runs at located phrases; the first of equal runs that
    may be mixed brings its windows' hashes along."""
    def rows_of(found: list[tuple], seen: set) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(6)]
        lists = []
        for doc_id, key, phrase, digest, first, size, w in found:
            n = len(phrase)
            for col, v in zip(cols, (phrase.view(np.int64), digest.view(np.int64), np.full(n, doc_id, np.int64),
                                     np.full(n, key, np.int64), first.astype(np.int32), size.astype(np.int32))):
                col.append(v)
            for m, d, a, k in zip(mixed.value.may_hold(phrase), digest.tolist(), first.tolist(), size.tolist()):
                new = m and d not in seen
                if new:
                    seen.add(d)
                lists.append(w[a:a + k].view(np.int64) if new else None)
        sizes = np.cumsum([0] + [0 if x is None else len(x) for x in lists])
        full = [x for x in lists if x is not None]
        windows = pa.ListArray.from_arrays(
            pa.array(sizes, pa.int32()), pa.array(np.concatenate(full) if full else np.zeros(0, np.int64)),
            mask=pa.array([x is None for x in lists]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols] + [windows],
                                          [f.split()[0] for f in _RUN_ROWS.split(", ")])

    def run(batches: Batches) -> Batches:
        shard, phrases, dictionary, seen, last = None, [], None, set(), None
        for batch in batches:
            found: list[tuple] = []
            held = 0
            heads = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for r, (s, kind, doc_id, key) in enumerate(heads):
                text = batch.column(4)[r].as_py().encode("utf-8", "surrogatepass")
                if s != shard:
                    shard, phrases, dictionary, seen = s, [], None, set()
                if kind == 0:
                    phrases.append(text)
                    continue
                if dictionary is None:
                    dictionary, phrases = _Dictionary(phrases), []
                if (doc_id, key) == last:  # a repeated row gives the same
                    continue
                last = doc_id, key
                words = text.split()
                if len(words) < plan.window:  # let through by the filter alone: it has no run
                    continue
                places = dictionary.places(words, plan.phrase)
                if not len(places):
                    continue
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                p, w, first, size, at, digest = _runs(hashes, plan)
                hit = np.isin(at, places)
                if hit.any():
                    found.append((doc_id, key, p[at[hit]], digest[hit], first[hit], size[hit], w))
                    held += len(words)
                    if held >= 1 << 19:
                        yield rows_of(found, seen)
                        found, held = [], 0
            if found:
                yield rows_of(found, seen)

    return run


def _cover(text_col: str, runs_col: str, drop: list[str], window: int, names: list[str]):
    """Replaces text and runs by the kept text and its counts."""
    def run(batches: Batches) -> Batches:
        for batch in _parts(batches):
            kept, total, gone = [], [], []
            for t, m in zip(batch.column(text_col), batch.column(runs_col)):
                words = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if m.is_valid and len(m):
                    mark = np.zeros(n + 1, np.int32)
                    for x in m.as_py():
                        for a, b in [(0, x["size"])] if x["gone"] is None else [(i, i + 1) for i in x["gone"]]:
                            mark[x["start"] + a] += 1
                            mark[x["start"] + b - 1 + window] -= 1
                    free = np.flatnonzero(np.cumsum(mark[:n]) == 0).tolist()
                    words = [words[i] for i in free]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                total.append(n)
                gone.append(n - len(words))
            cols = [(x, batch.column(i)) for i, x in enumerate(batch.schema.names) if x not in drop]
            new = [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays([c for _, c in cols] + new, names=[x for x, _ in cols] + names)

    return run


def _first_owners(batches: Batches) -> Batches:
    """Streams the different runs of each phrase, least document first: the
    first run that has a window is its owner."""
    phrase, owner = None, {}
    for batch in batches:
        lists = []
        for p, a, windows in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if p != phrase:
                phrase, owner = p, {}
            lists.append([owner.setdefault(w, a) for w in windows])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))],
                                         ["phrase", "digest", "owners"])


def _owners(runs: DataFrame, crowd: int) -> DataFrame:
    """Per (phrase, digest): the least document ``a`` of the run and, for a
    run of a mixed phrase, the least document of each of its windows.

    The different runs of a phrase meet in one task if they are at most
    ``crowd``; those of a more crowded phrase are compared as single rows,
    combined on the map side, so that no task holds them."""
    one = runs.groupBy("phrase", "digest").agg(F.min("doc_id").alias("a"),
                                               F.first("windows", ignorenulls=True).alias("windows"))
    one = materialize(one, "repeats-runs")
    mixed = one.where(F.col("windows").isNotNull())
    many = materialize(mixed.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd)
                       .select("phrase"), "repeats-crowded")
    few = (mixed.join(many, "phrase", "left_anti").select("phrase", "digest", "a", "windows")
           .repartition(shuffle_parts(runs.sparkSession), "phrase").sortWithinPartitions("phrase", "a"))
    back = few.mapInArrow(_first_owners, "phrase bigint, digest bigint, owners array<bigint>")
    each = mixed.join(many, "phrase", "left_semi").select(
        "phrase", "digest", "a", F.posexplode("windows").alias("i", "w"))
    # Written, so that a window that very many runs share is split in the join.
    least = materialize(each.groupBy("phrase", "w").agg(F.min("a").alias("o")), "repeats-windows")
    crowded = each.join(least, ["phrase", "w"]).groupBy("phrase", "digest").agg(
        F.collect_list(F.struct("i", "o")).alias("owned"))
    crowded = crowded.select("phrase", "digest", F.transform(F.array_sort("owned"), lambda x: x["o"]).alias("owners"))
    back = back.unionByName(crowded)
    out = materialize(one.drop("windows").join(back, ["phrase", "digest"], "left"), "repeats-owners")
    release(one)
    release(least)
    return out


def _dictionary(cols: DataFrame, recurring: DataFrame, plan: Plan) -> DataFrame:
    """``(phrase, words)`` of the confirmed phrases, from the first document of each."""
    places = recurring.groupBy("doc_id", "key").agg(F.collect_list(F.struct("phrase", "at")).alias("places"))
    places = materialize(places, "repeats-places")
    texts = keep_known(cols, "key", places.select("key")).dropDuplicates(["doc_id", "key"])  # repeated rows
    j = texts.join(places, ["doc_id", "key"]).select("text", "places")
    return j.mapInArrow(_spelled_out(plan), "phrase bigint, words binary")


def _shard_rows(cols: DataFrame, seen: DataFrame, dictionary: DataFrame, shard_words: int) -> DataFrame:
    """Documents and their part of the dictionary, shard by shard, as
    ``(shard, kind, doc_id, key, text)`` with the phrases first.  Copies of
    one text go to different shards by their ids."""
    size = seen.agg(F.count(F.lit(1))).first()[0]
    # A run has about half a window's words of its own; only the balance depends on it.
    shards = max(shuffle_parts(cols.sparkSession), size * 17 // shard_words)
    shard = F.pmod(F.xxhash64("doc_id", "key"), F.lit(shards)).cast("int").alias("shard")
    none = F.lit(None).cast("bigint")
    own = seen.select("phrase", shard).distinct().join(dictionary, "phrase").select(
        "shard", F.lit(0).alias("kind"), none.alias("doc_id"), none.alias("key"), F.col("words").cast("string").alias("text"))
    # Documents without a run of the dictionary need no automaton.
    known = keep_known(cols, "key", seen.join(dictionary.select("phrase"), "phrase", "left_semi").select("key"))
    rows = own.unionByName(known.select(shard, F.lit(1).alias("kind"), "doc_id", "key", "text"))
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "doc_id", "key")


@tidy
def repeated_windows(docs: DataFrame, doc_id: str, text: str, text_hash: str, *, window: int = 50,
                     phrase: int = 16, shard_words: int = 1 << 19, filter_bits: int = 24, crowd: int = 2048) -> DataFrame:
    """``(doc_id, text_hash, start, size, gone)`` per run with a window to
    remove: the offsets of those windows from word ``start``, or null for all
    ``size`` windows."""
    spark = docs.sparkSession
    plan = Plan(window, phrase)
    cols = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text_hash).alias("key"),
                       F.col(text).alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    seen = materialize(cols.mapInArrow(_phrases(plan, shard_words), _RUNS), "repeats-seen")
    recurring = seen.groupBy("phrase").agg(
        F.min(F.struct("doc_id", "key", "at")).alias("f"), F.max("doc_id").alias("b"),
        (F.min("digest") != F.max("digest")).alias("mixed")).where("f.doc_id < b").select("phrase", "mixed", "f.*")
    recurring = materialize(recurring, "repeats-phrases")
    dictionary = materialize(_dictionary(cols, recurring, plan), "repeats-dictionary")
    mixed = Shipped(spark, bit_filter(recurring.where("mixed"), "phrase", filter_bits))
    runs = materialize(_shard_rows(cols, seen, dictionary, shard_words)
                       .mapInArrow(_located(plan, mixed), _RUN_ROWS), "repeats-located")
    owners = _owners(runs, crowd)
    j = runs.drop("windows").join(owners, ["phrase", "digest"])
    gone = F.filter(F.sequence(F.lit(0), F.col("size") - 1),
                    lambda i: F.element_at("owners", i + 1) < F.col("doc_id"))
    j = j.select("doc_id", "text_hash", "start", "size", "a", F.when(F.col("owners").isNotNull(), gone).alias("gone"))
    return (j.where(F.when(F.col("gone").isNull(), F.col("a") < F.col("doc_id")).otherwise(F.size("gone") > 0))
            .drop("a"))


def _parts(batches: Batches, rows: int = 512) -> Batches:
    """The rows in small batches, so that few texts are held twice."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _held(batch: pa.RecordBatch, hit, h: str) -> np.ndarray:
    return hit.value.may_hold(batch.column(h).to_numpy(zero_copy_only=False).view(np.uint64))


def _rows_in(hit, h: str):
    def run(batches: Batches) -> Batches:
        for batch in _parts(batches):
            yield batch.filter(pa.array(_held(batch, hit, h)))

    return run


def _untouched(hit, text: str, h: str, drop: list[str], names: list[str]):
    """The rows outside the filter, with all their words."""
    def run(batches: Batches) -> Batches:
        for batch in _parts(batches):
            batch = batch.filter(pa.array(~_held(batch, hit, h)))
            kept, total = [], []
            for t in batch.column(text):  # one text's words at a time
                words = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                total.append(len(words))
            cols = [(x, batch.column(i)) for i, x in enumerate(batch.schema.names) if x not in drop]
            new = [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array([0] * len(kept), pa.int64())]
            yield pa.RecordBatch.from_arrays([c for _, c in cols] + new, names=[x for x, _ in cols] + names)

    return run


@tidy
def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, window: int = 50,
                   filter_bits: int = 24, **opts) -> DataFrame:
    """``docs`` with ``kept_text`` (the kept words, one blank between),
    ``n_words`` and ``n_removed`` for every row."""
    spark = docs.sparkSession
    names = ["kept_text", "n_words", "n_removed"]
    h, i, found = (fresh(docs, x) for x in ("_hash", "_id", "_runs"))
    keyed = docs.withColumn(h, F.xxhash64(text))
    got = repeated_windows(keyed, doc_id, text, h, window=window, filter_bits=filter_bits, **opts)
    got = got.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "size", "gone")).alias(found))
    got = materialize(got.select(F.col("doc_id").alias(i), F.col("text_hash").alias(h), found), "repeats-removed")
    # Documents that lose nothing are written where they are read; only those
    # that may lose words (a filter of fixed size, exact after the join) move.
    hit = Shipped(spark, bit_filter(got.select(h), h, filter_bits))
    moved = keyed.mapInArrow(_rows_in(hit, h), keyed.schema)
    j = moved.join(got, (moved[doc_id].cast("bigint") == got[i]) & (moved[h] == got[h]), "left")
    j = j.select(*[moved[c] for c in docs.columns], found)
    drop = [found] + [c for c in docs.columns if c.lower() in names]
    schema = T.StructType([f for f in docs.schema if f.name not in drop]
                          + [T.StructField(names[0], T.StringType())]
                          + [T.StructField(n, T.LongType()) for n in names[1:]])
    rest = keyed.mapInArrow(_untouched(hit, text, h, [h, *drop], names), schema)
    return rest.unionByName(j.mapInArrow(_cover(text, found, drop, window, names), schema))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
