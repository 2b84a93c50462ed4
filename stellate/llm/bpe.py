"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

1. Every text's UTF-8 bytes are cut where a rolling hash (the last 8 bytes
   times an odd constant) has its ten high bits zero: about 1 KB apart, 256
   bytes at least, 8 KB at most, so equal passages give equal chunks
   wherever they stand.
2. Chunk digests (128 bits) that occur in two documents or more are the
   shared chunks.  Each is encoded once.
3. A document takes the ids of its shared chunks and repairs the joins:
   around each join, the bytes from the last safe point of one chunk to the
   first safe point of the next are encoded again, together with the parts
   that are not shared.  A safe point is a blank right after a printable
   ASCII character: no word of the tokenizer's pattern, and no special token,
   runs across it, so the ids on both sides are the ids of the whole text.
   The reused ids must agree exactly: if a chunk's ids have no token border
   at the safe point, the chunk is encoded again with its surroundings.

Documents without shared chunks are encoded where they are read and never
shuffled.  Which those are is told by a filter of ``2^filter_bits`` bits (a
fixed size) over the shared digests; a false hit costs a shuffle, never a
wrong id.  Only digests, shared chunks and documents that hold some travel.

The ids are those of the tokenizers library for the same file (no special
tokens added, none skipped in decoding).

Defined cases: a null text counts as empty (no ids); equal texts get equal
ids, repeated rows stay repeated; texts of any length are encoded whole; an
empty table gives an empty table; other columns pass through, and an input
column called like the output column is replaced.

The tokenizer's pattern keeps a place for every blank of a run, and its
matcher ends at about a million of them.  Runs of ``RUN`` blanks or more are
therefore cut out of the text just where the pattern would cut them (before
their last blank, or whole at the end of the text or before a special token)
and merged as the one word that they are.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import materialize
from .common import Shipped, fresh, table

DEFAULT_FILE = "byte_bpe_50k.json"
FILTER_BITS = 24
# Fixed value: how the byte-level pre-tokenizer cuts words.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# What ``\s`` is in the pattern (Python's own ``\s`` holds more).
_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUN = 1 << 16
_LONG_RUN = re.compile(f"(?<!{_SPACE}){_SPACE}{{{RUN},}}+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


# ------------------------------------------------------------------ tokenizer
class Coder:
    """A byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Bytes that are not printable stand for themselves from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(map(byte_of.__getitem__, k)): v
                 for k, v in spec["model"]["vocab"].items() if k not in special}
        order = [ranks[bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))]
                 for m in spec["model"]["merges"]]
        if order != sorted(order):
            raise ValueError(f"{path}: ids don't follow the merges")
        self.special = set(special)
        self.cut = re.compile("(" + ("|".join(map(re.escape, special)) or r"(?!)") + ")")
        self.encoding = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        texts = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for b, i in ranks.items():
            texts[i] = b
        for s, i in special.items():
            texts[i] = s.encode()
        self.lengths = np.array([len(b) for b in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(texts), np.uint8)

    def encode(self, raw: bytes) -> np.ndarray:
        if not raw:
            return np.zeros(0, np.int32)
        text = raw.decode("utf-8")
        if len(text) >= RUN and _LONG_RUN.search(text):
            return np.concatenate([x for part in self.cut.split(text) for x in self._cut_runs(part)])
        return self._whole(text)

    def _whole(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special=self.special, disallowed_special=()).astype(np.int32)

    def _cut_runs(self, part: str) -> Iterator[np.ndarray]:
        """Ids of a text that is a special token or holds none."""
        done = 0
        for run in _LONG_RUN.finditer(part):
            end = run.end() if run.end() == len(part) else run.end() - 1
            yield self._whole(part[done:run.start()])
            yield np.array(self.encoding._encode_single_piece(part[run.start():end]), np.int32)
            done = end
        yield self._whole(part[done:])

    def decode(self, ids: np.ndarray) -> str:
        size = self.lengths[ids]
        # Where each byte of the text stands in ``pool``.
        at = np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.pool[at].tobytes().decode("utf-8", "replace")


def coder(path: str | None) -> Coder:
    """Read once per Python worker."""
    cache = sys.modules.setdefault("_bpe_coders", types.ModuleType("_bpe_coders"))
    path = path or default_path()
    if not hasattr(cache, path):
        setattr(cache, path, Coder(path))
    return getattr(cache, path)


# --------------------------------------------------------------------- chunks
WINDOW, CUT_BITS, LEAST, MOST = 8, 10, 256, 8192
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20


def cut_points(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``, the last one being its length."""
    n = len(raw)
    found = []
    for at in range(0, n - WINDOW + 1, _SLICE):
        last = np.ndarray(min(_SLICE, n - WINDOW + 1 - at), "<u8", raw, at, (1,))  # 8 bytes at every place
        found += (np.flatnonzero((last * _FACTOR) >> np.uint64(64 - CUT_BITS) == 0) + (at + WINDOW)).tolist()
    ends, start = [], 0
    for p in [*found, n]:
        while p - start > MOST:
            start = _char_start(raw, start + MOST)
            ends.append(start)
        if p - start >= LEAST or p == n:
            q = _char_start(raw, p)
            if q > start:
                ends.append(q)
                start = q
    return ends


def _char_start(raw: bytes, at: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def chunks(raw: bytes) -> list[tuple[int, int, bytes]]:
    """``(start, end, digest)`` of every chunk."""
    out, a = [], 0
    for b in cut_points(raw):
        out.append((a, b, xxhash.xxh3_128_digest(raw[a:b])))
        a = b
    return out


def first_safe(raw: bytes, a: int, b: int) -> int:
    """First safe point inside ``raw[a:b]`` (not ``a``), or -1."""
    p = raw.find(b" ", a + 1, b)
    while p >= 0 and not 33 <= raw[p - 1] <= 126:
        p = raw.find(b" ", p + 1, b)
    return p


def last_safe(raw: bytes, a: int, b: int) -> int:
    p = raw.rfind(b" ", a + 1, b)
    while p >= 0 and not 33 <= raw[p - 1] <= 126:
        p = raw.rfind(b" ", a + 1, p)
    return p


def encode_document(raw: bytes, pieces: list[tuple[int, int, bytes]], shared: dict[bytes, np.ndarray],
                    c: Coder) -> np.ndarray:
    """Ids of ``raw`` from the ids of its shared chunks, joins repaired."""
    out, done = [], 0
    for a, b, digest in pieces:
        ids = shared.get(digest)
        if ids is None:
            continue
        f, g = first_safe(raw, a, b), last_safe(raw, a, b)
        if f < 0 or g <= f:
            continue
        border = np.cumsum(c.lengths[ids])
        i, j = np.searchsorted(border, [f - a, g - a])
        if border[i] != f - a or border[j] != g - a:
            continue  # no agreement here: encode the chunk with its surroundings
        out += [c.encode(raw[done:f]), ids[i + 1:j + 1]]
        done = g
    out.append(c.encode(raw[done:]))
    return np.concatenate(out)


# ------------------------------------------------------------------ operators
class _Filter:
    """Which digests may be shared: one bit for each value of their first bits."""

    def __init__(self, bits: int, words: list[tuple[int, int]]):
        self.shift = 64 - bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        if words:
            at, mask = zip(*words)
            self.words[list(at)] = np.array(mask, np.int64).view(np.uint64)

    def may_hold(self, digest: bytes) -> bool:
        v = int.from_bytes(digest[:8], "big") >> self.shift
        return bool(int(self.words[v >> 6]) >> (v & 63) & 1)


def _raws(texts: pa.Array) -> Iterator[bytes]:
    for t in texts:
        yield (t.as_py() or "").encode("utf-8")


_IDS_AT_ONCE = 1 << 20


def _with_ids(batch: pa.RecordBatch, drop: list[str], out: str,
              encoded: Iterator[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
    """The batch's rows with ids, in parts of about a million ids; rows whose
    ids are None are left out."""
    rows, ids, held = [], [], 0

    def part() -> pa.RecordBatch:
        cols = [(n, batch.column(i).take(pa.array(rows, pa.int32())))
                for i, n in enumerate(batch.schema.names) if n not in drop]
        ends = np.cumsum([0, *map(len, ids)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        return pa.RecordBatch.from_arrays([c for _, c in cols] + [lists], names=[n for n, _ in cols] + [out])

    for row, got in enumerate(encoded):
        if got is None:
            continue
        rows.append(row)
        ids.append(got)
        held += len(got)
        if held >= _IDS_AT_ONCE:
            yield part()
            rows, ids, held = [], [], 0
    if rows:
        yield part()


Batches = Iterator[pa.RecordBatch]


def _cut(batches: Batches) -> Batches:
    for batch in batches:
        found = [(xxhash.xxh3_128_digest(r), list({d for _, _, d in chunks(r)})) for r in _raws(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()),
                                          pa.array([d for _, d in found], pa.list_(pa.binary()))],
                                         ["text_key", "digests"])


def _candidates(shared):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found: dict[bytes, bytes] = {}
            for raw in _raws(batch.column(0)):
                for a, b, d in chunks(raw):
                    if d not in found and shared.value.may_hold(d):
                        found[d] = raw[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()),
                                              pa.array(list(found.values()), pa.binary())], ["digest", "part"])

    return run


def _encode_chunks(path):
    def run(batches: Batches) -> Batches:
        c = coder(path)
        for batch in batches:
            ids = [c.encode(p.as_py()).tobytes() for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["digest", "ids"])

    return run


def _encode_own(path, shared, text: str, drop: list[str], out: str):
    """Rows without a shared chunk, encoded."""
    def run(batches: Batches) -> Batches:
        c = coder(path)
        for batch in batches:
            yield from _with_ids(batch, drop, out, (
                None if any(shared.value.may_hold(d) for _, _, d in chunks(raw)) else c.encode(raw)
                for raw in _raws(batch.column(text))))

    return run


def _sharing_rows(shared, text: str, key: str):
    """Rows that may hold a shared chunk, with the key of their text."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = [xxhash.xxh3_128_digest(raw) if any(shared.value.may_hold(d) for _, _, d in chunks(raw)) else None
                    for raw in _raws(batch.column(text))]
            new = batch.append_column(key, pa.array(keys, pa.binary()))
            yield new.filter(new.column(key).is_valid())

    return run


def _encode_sharing(path, text: str, known: str, drop: list[str], out: str):
    def run(batches: Batches) -> Batches:
        c = coder(path)
        for batch in batches:
            def encoded(batch=batch):
                for raw, k in zip(_raws(batch.column(text)), batch.column(known)):
                    ids = {x["digest"]: np.frombuffer(x["ids"], np.int32) for x in k.as_py() or ()}
                    yield encode_document(raw, chunks(raw) if ids else [], ids, c)

            yield from _with_ids(batch, drop, out, encoded())

    return run


def _shared_filter(shared: DataFrame, bits: int) -> _Filter:
    """At most ``2^bits / 64`` rows come to the driver, whatever the table."""
    v = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("bigint")
    v = F.shiftright(v, 48 - bits)
    words = shared.select(F.shiftright(v, 6).alias("w"), F.expr("1L").alias("one"), (v % 64).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.expr("bit_or(shiftleft(one, b))").alias("m"))
    return _Filter(bits, [(r["w"], r["m"]) for r in words.collect()])


def encode_documents(docs: DataFrame, text: str = "text", out: str = "ids", *, path: str | None = None,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with the array of token ids as column ``out``."""
    spark = docs.sparkSession
    held = materialize(docs.select(F.col(text)).mapInArrow(_cut, "text_key binary, digests array<binary>"),
                       "bpe-digests")
    shared = (held.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= 2).select("digest"))
    shared = materialize(shared, "bpe-shared")
    found = Shipped(spark, _shared_filter(shared, filter_bits))

    # Each shared chunk is encoded once.
    parts = docs.select(F.col(text)).mapInArrow(_candidates(found), "digest binary, part binary")
    parts = parts.groupBy("digest").agg(F.first("part").alias("part")).join(shared, "digest", "left_semi")
    encoded = materialize(parts.mapInArrow(_encode_chunks(path), "digest binary, ids binary"), "bpe-chunks")
    # The shared chunks of every different text.
    uses = held.select("text_key", F.explode("digests").alias("digest")).distinct().join(encoded, "digest")
    uses = uses.groupBy("text_key").agg(F.collect_list(F.struct("digest", "ids")).alias("known"))
    key, known = fresh(docs, "_key"), fresh(docs, "_known")
    uses = materialize(uses.select(F.col("text_key").alias(key), F.col("known").alias(known)), "bpe-uses")

    drop = [c for c in docs.columns if c.lower() == out.lower()]
    result = T.StructType([f for f in docs.schema if f.name not in drop]
                          + [T.StructField(out, T.ArrayType(T.IntegerType()))])
    own = docs.mapInArrow(_encode_own(path, found, text, drop, out), result)
    sharing = docs.mapInArrow(_sharing_rows(found, text, key),
                              T.StructType([*docs.schema, T.StructField(key, T.BinaryType())]))
    sharing = sharing.join(uses, key, "left")
    rest = sharing.mapInArrow(_encode_sharing(path, text, known, [*drop, key, known], out), result)
    return own.unionByName(rest)


def decode_documents(rows: DataFrame, ids: str = "ids", out: str = "text", *, path: str | None = None) -> DataFrame:
    """``rows`` with the decoded text as column ``out`` (null ids: null)."""
    @arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        c = coder(path)
        return pa.array([c.decode(x.values.to_numpy()) if x.is_valid else None for x in lists], pa.string())

    return rows.withColumn(out, decode.asNondeterministic()(F.col(ids)))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def digests(batches: Batches) -> Batches:
        c = coder(None)
        for batch in batches:
            lists = [x.values.to_numpy() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, lists), pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists]),
                pa.array([hashlib.sha256(c.decode(x).encode("utf-8")).hexdigest() for x in lists])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode_documents(docs).select("doc_id", "ids").mapInArrow(
        digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
