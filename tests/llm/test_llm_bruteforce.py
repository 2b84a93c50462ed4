"""The registered queries against brute force, round trips and the library."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import union_find

from stellate.llm import katz, queries, repeats, simhash

SF = "/root/testdata/sf0.001"


def sha(s) -> str:
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows, key=lambda r: r["doc_id"])}


def result(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF).collect()}


def fingerprint(text):
    w = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op1(spark, docs):
    got, fp = result(spark, "op1_simhash_near_dedup"), {i: fingerprint(t) for i, t in docs.items()}
    edges = [(a, b) for a in fp for b in fp if a <= b and (fp[a] ^ fp[b]).bit_count() <= 4]
    part = union_find(edges)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{fp[i]:016x}", part[i]) for i in fp}


def test_op1_crowded_anchors(spark):
    rng = np.random.default_rng(3)
    near = [int(x) for x in rng.integers(0, 1 << 62, 3)]
    fps = {b ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), False)) for b in near for _ in range(150)}
    fps = [int(np.uint64(x).view(np.int64)) for x in fps]
    want = union_find([(a, b) for a in fps for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    for rows in (4096, 8):
        links = [(r["a"], r["b"]) for r in simhash.fingerprint_links(df, 4, rows).collect()]
        assert union_find([*links, *((f, f) for f in fps)]) == want


@pytest.mark.parametrize("n", [1000, 10 ** 10])
@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_op1_every_layout_meets_every_link(spark, monkeypatch, n, bits):
    """The blocks chosen for few and for very many fingerprints lose no link."""
    rng = np.random.default_rng(bits)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    fps = {b ^ sum(1 << int(k) for k in rng.choice(64, bits + rng.integers(0, 2), False)) for b in base for _ in range(6)}
    fps = [int(np.uint64(x).view(np.int64)) for x in fps | set(base)]
    want = union_find([(a, b) for a in fps for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits])
    chosen = simhash.covering_blocks(bits, n)
    monkeypatch.setattr(simhash, "covering_blocks", lambda *_: chosen)
    d = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = [(r["a"], r["b"]) for r in simhash.fingerprint_links(d, bits).collect()]
    assert union_find([*links, *((f, f) for f in fps)]) == want


def test_op1_work_by_size():
    """Copies and pairs per fingerprint for the production threshold."""
    def work(n):
        blocks = simhash.covering_blocks(4, n)
        return simhash.layout_work([(b.width, b.threshold) for b in blocks], n)

    small, large = work(10 ** 5), work(10 ** 10)
    assert [len(simhash.covering_blocks(4, n)) for n in (10 ** 5, 10 ** 8, 10 ** 9, 10 ** 11)] == [3, 3, 2, 2]
    assert small[0] < 40 and small[1] < 20 and large[0] < 250 and large[1] < 10 ** 10 / 10 ** 6
    # Counted on random fingerprints: the estimate holds.
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    copies = sum(len(a) for b in simhash.covering_blocks(4, 20_000) for a, _, _ in b.anchors(fp))
    assert abs(copies / len(fp) - work(20_000)[0]) < 0.1 * work(20_000)[0]


def test_op2(spark):
    """Digests recomputed from the table, and the formatted texts themselves."""
    from stellate.llm import chat

    hostile = "\\### Assistant: </turn> ok"
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()] + [(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)]
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text or ""))
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.QUERIES["op2_chat_format"](spark, SF).collect()}
    want = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    assert got == want and len(got) > 10


def test_op2_long_conversation(spark):
    """One conversation over many ranges, ties and repeated rows: the pieces
    join to one text, which a plain parser of the template takes apart."""
    from pyspark.sql import functions as F

    from stellate.llm import chat

    texts = ["### User: x", "\\</turn>", "", None, "a\n</turn>\n### ", "ok \\\\### ", "plain é漢"]
    rows = [(None if i % 3 == 0 else 5, i // 4, ["user", "assistant", "tool:", None][i % 4], texts[i % 7] and texts[i % 7] + str(i % 50))
            for i in range(3000)]
    d = spark.createDataFrame(rows * 2, "conv_id bigint, turn int, role string, text string").repartition(7)
    formatted = chat.format_chat(d.withColumn("pos", F.lit(1)))
    assert formatted.groupBy("conv_id").count().count() == 2
    for conv in (None, 5):
        mine = formatted.where(F.col("conv_id").eqNullSafe(F.lit(conv))).orderBy("pos").collect()
        whole = "".join(r["formatted"] for r in mine)
        own = sorted(((t, r is not None, r or "", x is not None, x or "") for c, t, r, x in rows * 2 if c == conv))
        assert [r["pos"] for r in mine] == list(range(len(own)))
        at = 0
        for r, (_, _, role, _, text) in zip(mine, own):
            assert r["start"] == at and whole[at:at + len(r["formatted"])] == r["formatted"]
            got_role, a, b, end = chat.parse_turn(whole, at)
            assert (got_role, chat.unescape(whole[a:b])) == (role, text)
            assert (r["loss_start"], r["loss_end"]) == ((a, b) if role == "assistant" else (None, None))
            at = end
        assert at == len(whole)


def test_op3(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in result(spark, "op3_bpe_round_trip").items():
        ids = t.encode(docs[i], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False))


def plain_discounts(n):
    """Good-Turing factors for counts 1 to 5, from the formulas: n[r] things
    were seen r times."""
    rest = 6 * n[6] / n[1] if n[1] else 1
    d = {r: 1.0 for r in range(1, 6)}
    if n[1]:
        for r in d:
            if n[r] and rest < 1:
                d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
        if not all(0 < x < 1 for x in d.values()):
            cut = n[1] / (n[1] + 2 * n[2])
            cut = 0.5 if cut >= 1 else cut
            d = {r: (r - cut) / r for r in d}
    return d


def check_katz(got, texts, held):
    """Scores against a plain model with dictionaries."""
    tok = {i: t.encode().lower().split() + ["</s>"] for i, t in texts.items()}
    c = collections.Counter(w for i in tok if not held[i] for w in tok[i])
    pairs = collections.Counter(p for i in tok if not held[i] for p in zip(["<s>", *tok[i]], tok[i]))
    n, v = sum(c.values()), len(c)
    d1, d2 = (plain_discounts(collections.Counter(x.values())) for x in (c, pairs))

    def cut(d, x):
        return d.get(x, 1) * x

    kept = sum(cut(d1, x) for x in c.values())
    whole = n + (n - kept <= 1e-9)
    unknown = 1 - kept / whole
    after = collections.defaultdict(dict)
    for (h, w), x in pairs.items():
        after[h][w] = x

    def one(w):
        return cut(d1, c[w]) / whole if w in c else unknown

    alpha = {}
    for h, x in after.items():
        total, left = sum(x.values()), sum(cut(d2, k) for k in x.values())
        below = total + (total - left <= 1e-9)
        alpha[h] = below, (below - left) / below / (1 - sum(map(one, x)))

    def p(h, w):
        if h not in after:
            return one(w)
        return cut(d2, after[h][w]) / alpha[h][0] if w in after[h] else alpha[h][1] * one(w)

    for h in list(after)[:10]:
        assert abs(sum(p(h, w) for w in c) + p(h, None) - 1) < 1e-9
    for i, r in got.items():
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[i], len(tok[i]), sum(w in c for w in tok[i]), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok[i]), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(*x)) for x in zip(["<s>", *tok[i]], tok[i])), rel_tol=1e-9)


def test_op5(spark, docs):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    check_katz(result(spark, "op5_katz_scoring"), docs, held)


def test_op5_hot_pairs(spark):
    """One pair is half of all tokens, another one a fifth: both are spread
    over the partitions, and the scores are those of the plain model."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(1)
    texts = {i: " ".join(rnd.choices(["tick"] * 20 + ["so", "no"] + [f"w{k}" for k in range(30)], k=60))
             + " ha" * 40 + " ha ho" * 15 for i in range(120)}
    held = {i: i % 5 == 0 for i in texts}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
        rows = katz.katz_scores(d, F.col("doc_id") % 5 != 0, partition_tokens=500).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    check_katz({r["doc_id"]: {**r.asDict(), "held_out": not r["train"]} for r in rows}, texts, held)
    hot = np.array([7], np.uint64)
    many = np.full(60_000, 7, np.uint64)
    to = katz._shard_of(many, many, np.arange(60_000, dtype=np.uint64) // np.uint64(20), hot, 16)
    assert np.bincount(to, minlength=16).max() < 1.2 * 60_000 / 16


def test_op5_counts_beyond_32_bits(spark):
    words = spark.createDataFrame([(1, 2 ** 32 + 5), (2, 3)], "word bigint, n bigint")
    u = katz._unigrams(words, 10)
    assert u.freq.tolist() == [2 ** 32 + 5, 3] and u.total == 2 ** 32 + 8
    packed = katz._unpack(katz._pack([np.zeros(1, np.uint64)] * 2 + [np.array([2 ** 33])] + [np.zeros(1, np.int64)] * 5))
    assert packed[2].tolist() == [2 ** 33]


def leaves_of(text):
    import regex

    cuts = regex.finditer(r"(?V1)(?<=\n)|(?<=[.!?,;:] )|(?<=\p{L}{6}[aeiou][^ \p{L}]{0,3} )", text)
    at = sorted({0, len(text), *(m.start() for m in cuts)})
    return [text[i:j] for i, j in zip(at, at[1:])]


def tree_of(text):
    """(root, section digests, leaf digests by section), built from below."""
    digests = [sha(x)[:12] for x in leaves_of(text)]
    groups, cur = [], []
    for k, d in enumerate(digests):
        cur.append(d)
        if d[-1] in "08" and k < len(digests) - 1:
            groups, cur = groups + [cur], []
    groups.append(cur)
    sections = [sha(",".join(g))[:12] for g in groups]
    return sha(".".join(sections))[:32], sections, groups


def alike(a, b):
    x, y = ({d for g in tree_of(t)[2] for d in g} for t in (a, b))
    return 1.0 if a == b else 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_op6(spark, docs):
    got, ids = result(spark, "op6_document_fingerprints"), list(docs)

    def written(text):
        root, sections, groups = tree_of(text)
        return ":".join((root, ".".join(sections), "|".join(",".join(g) for g in groups)))

    for k, i in enumerate(ids):
        t, nxt = docs[i], docs[ids[(k + 1) % len(ids)]]
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == sha(edited)
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (written(t), written(edited))
        assert math.isclose(got[i]["near_edited"], alike(t, edited)) and math.isclose(got[i]["near_next"], alike(t, nxt))
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.6 > np.mean([r["near_next"] for r in got.values()])
    low = [i for i, r in got.items() if r["near_edited"] < 0.3 and len(docs[i]) > 400]
    assert len(low) <= 0.04 * len(got)


def test_changed_branches(spark, docs):
    from pyspark.sql import functions as F

    from stellate.llm import merkle

    texts = [t for t in docs.values() if len(t) > 300][:40]
    pairs = [(t, t[:100] + " An inserted, longer remark. " + t[100:250] + t[280:]) for t in texts] + [(t, t) for t in texts[:3]]
    d = spark.createDataFrame(pairs, "a string, b string")
    d = merkle.with_fingerprint(merkle.with_fingerprint(d, "a", "fa"), "b", "fb")
    for r in d.select("a", "b", merkle.changed_branches(F.col("fa"), F.col("fb")).alias("x")).collect():
        _, s, g = tree_of(r["a"])
        _, t, k = tree_of(r["b"])
        have = {x for group in k for x in group}
        numbered, n = [], 0
        for section, group in zip(s, g):
            for x in group:
                if section not in t and x not in have:
                    numbered.append((n, section, x))
                n += 1
        assert list(r["x"]["sections"]) == list(dict.fromkeys(x for x in s if x not in t))
        assert [tuple(x) for x in r["x"]["leaves"]] == numbered


def test_ranges_do_not_grow_the_plan(spark):
    """100,000 ranges are as quick to plan as a few, in order and even."""
    import time

    from pyspark.sql import functions as F

    from stellate.llm import merkle

    d = spark.range(200_000).select((F.col("id") * F.col("id")).alias("k")).repartition(4)
    start = time.time()
    r = d.withColumn("r", merkle._ranges(d, "k", 100_000))
    assert time.time() - start < 20
    rows = r.groupBy("r").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("r").collect()
    assert all(x.b < y.a for x, y in zip(rows, rows[1:])) and len(rows) > 30_000 and max(x.n for x in rows) < 200
    nulls = spark.createDataFrame([(None,), (3,), (1,)], "k bigint")
    assert nulls.withColumn("r", merkle._ranges(nulls, "k", 8)).where("k is null").first()["r"] == 0


def test_op7(spark, docs):
    got = result(spark, "op7_mix_sources")
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    target, taken, size = {}, collections.Counter(), collections.Counter()
    for i, r in got.items():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[i])) and 0 <= r["taken"] <= 3 * r["size"]
        target[source[i]] = r["target"]
        taken[source[i]] += r["taken"]
        size[source[i]] += r["size"]
    assert all(r["source_size"] == size[source[i]] for i, r in got.items())
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    want: dict = {}
    while True:  # share by weight, stop sources at three times their size, share the rest again
        free = [s for s in size if s not in want]
        left, w = sum(size.values()) - sum(want.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        want |= {s: 3 * size[s] for s in over}
    want |= share
    assert all(math.isclose(target[s], want[s]) for s in size)
    print({s: (taken[s], target[s]) for s in target if abs(taken[s] - target[s]) > 0.03 * target[s]})
    assert all(abs(taken[s] - target[s]) <= 0.03 * target[s] + 30 for s in target)


@pytest.mark.parametrize("crowd", [2048, 0])
def test_op8(spark, docs, crowd):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(df, crowd=crowd).collect()}
    owner: dict = {}
    for i, t in docs.items():
        w = t.encode().split()
        gone = set()
        for k in range(len(w) - 49):
            if owner.setdefault(tuple(w[k:k + 50]), i) < i:
                gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"].encode()) == (len(w), len(gone), kept)


def test_op8_the_automata_decide(spark, monkeypatch):
    """Without the phrases of one passage in the dictionary, that passage stays."""
    from pyspark.sql import functions as F

    p, q = (" ".join(f"{c}{i}" for i in range(80)) for c in "pq")
    rows = [(1, f"{p} one {q}"), (2, f"{p} two {q} two"), (3, f"three {q} {p}"), (4, p)]
    d = spark.createDataFrame(rows * 2, "doc_id bigint, text string").repartition(3)
    whole = repeats._dictionary

    def removed():
        return {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in repeats.remove_repeats(d).collect()}

    assert removed() == {1: (0, rows[0][1]), 2: (160, "two two"), 3: (160, "three"), 4: (80, "")}
    monkeypatch.setattr(repeats, "_dictionary", lambda *a: whole(*a).where(~F.decode("words", "utf-8").contains("q")))
    assert removed() == {1: (0, rows[0][1]), 2: (80, f"two {q} two"), 3: (80, f"three {q}"), 4: (80, "")}
    monkeypatch.setattr(repeats, "_dictionary", lambda *a: whole(*a).where("false"))
    assert all(n == 0 for n, _ in removed().values())


def test_op9(spark, docs):
    for i, r in result(spark, "op9_quality_rules").items():
        w = docs[i].encode().split()
        grams = list(zip(w, w[1:], w[2:]))
        n = collections.Counter(grams)
        cover = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in docs[i].split("\n") if x.encode().split()]
        want = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", docs[i])),
                len(lines) - len(set(lines)), len(cover))
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_op10_base(spark):
    """Base spans against Python's patterns; the others only add spans."""
    import hashlib
    import re

    from stellate.llm.pii import op10_pii_spans

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = {  # fixed values: the base patterns of the contract
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(p) <= 255 for p in v.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda v, d: 12 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 9 <= len(d) <= 15),
    }
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op10_pii_spans(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows) > 0
    for r in rows:
        spans, counts = [], []
        for i, (pattern, ok) in enumerate(kinds.values()):
            hits = [m for m in re.finditer(pattern, r["text"] or "") if ok(m[0], re.sub("[^0-9]", "", m[0]))]
            counts.append(len(hits))
            spans += [(m.start(), i, m.end()) for m in hits]
        names = list(kinds)
        written = [f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        g = got[r["doc_id"]]
        assert [g[f"n_{k}"] for k in names] == counts
        assert g["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(g["spans"].split(","))
    assert any(g["n_email"] for g in got.values())


def test_pipeline(spark, docs):
    """Survivors of the rules and of the near-copies by brute force, their
    texts without emails, the ids by the library."""
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    good = [i for i, r in result(spark, "op9_quality_rules").items() if r["kept"]]
    fp = {i: fingerprint(docs[i]) for i in good}
    part = union_find([(a, b) for a in fp for b in fp if a <= b and (fp[a] ^ fp[b]).bit_count() <= 4])
    left = {i for i in good if part[i] == i}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r["doc_id"] for r in rows} <= left
    assert max(collections.Counter(r["doc_id"] for r in rows).values()) <= 3
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        assert not re.search(email, r["text"])
        assert r["text"] == docs[r["doc_id"]] or "[" in r["text"]
        assert list(r["ids"]) == t.encode(r["text"], add_special_tokens=False).ids
