"""Quality rules with adaptive thresholds.

Every document gets counts (words, their characters, symbols, repeated lines,
words in repeated three-word windows, distinct words, capitals, punctuation).
From them come shares whose distribution is kept, per language and source, in
mergeable quantile sketches: logarithmic buckets with counts (the DDSketch
layout; relative error at most ``accuracy``).  Sketches merge by adding counts,
in any order, so the sketch of a language or of all documents is the sum of its
sources' sketches and a rerun gives the same thresholds.

Quantiles of a (language, source) of n documents are pooled with its language's
by weight ``n / (n + pool)``, and those with the ones of all documents the same
way; no size of a group switches anything.  A share is too high above ::

    centre + spread * width + noise

``centre`` is the language's median, moved into the group's own [q25, q75].
``width`` is the smaller of the group's and the language's width (twice the
smaller half of [q25, q75] about the median), but at least the group's
``q25 - q05``: a source in which many symbols are normal has its lower tail
there too.  Up to half of a group may be junk, above the clean documents or
below them: the quantiles on the clean side stay clean, and the language holds
the centre there.  (Of a whole language, less than half may be junk.)  Small
groups have wider fences, by ``1 + 3 / sqrt(n)``.  Lower fences mirror this with
``q95 - q75``; word length, distinct words, capitals and punctuation have both.

``noise`` follows from the length of the document: a share c of N pieces varies
by ``sqrt(c / N)``, and three such deviations, of one piece at least, are
allowed.  (For the exponent of the distinct words this is the variation of the
number of repeats; the word length, a mean, varies with the length already.)
Repeats come in runs, which this does not cover, so a sentence said
twice (``CREDIT`` words) and ``RUNS`` of the words are free.  The thresholds (one
row per group) are joined to the documents, null-safe on both keys.

Defined cases: a null text counts as empty (all counts 0, base rule fails);
null ``lang`` or ``source`` is a group of its own; repeated rows are judged
each by itself; an empty table gives an empty table; other columns pass
through, and input columns called like an output column are replaced by it
(:func:`quality_filter` keeps every input column).
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from ..session import materialize, tidy
from .common import fresh, table

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
          "n_capitals", "n_points"]
#: Metric -> (count whose pieces it is a share of, if it is one, fenced below too).
METRICS = {"symbols": ("word_chars", False), "dup_lines": ("n_lines", False), "repeats": ("n_words", False),
           "word_len": (None, True), "variety": (None, True), "capitals": ("word_chars", True),
           "points": ("word_chars", True)}
#: Repeated words that any document may have: so many, and this share.
CREDIT, RUNS = 20, 0.05
LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95)
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_POINTS = b",.;:!?"


def measure(text: str | None) -> tuple[int, ...]:
    """Counts of one text, in the order of ``COUNTS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(grams)) < len(grams):
        times = Counter(grams)
        covered = bytearray(len(words))
        for i, g in enumerate(grams):
            if times[g] > 1:
                covered[i:i + 3] = b"\1\1\1"
        repeat = sum(covered)
    return (len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeat, len(lines),
            len(set(words)), len(raw) - len(raw.translate(None, _CAPITALS)), len(raw) - len(raw.translate(None, _POINTS)))


_RESULT = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


@arrow_udf(_RESULT)
def _measure(texts: pa.Array) -> pa.Array:
    got = [measure(t.as_py()) for t in texts]
    cols = list(zip(*got)) or [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], COUNTS)


_MEASURE = _measure.asNondeterministic()  # evaluated once, never pushed or repeated


def _shares(q: Column) -> dict[str, Column]:
    def part(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    n = q["n_words"]
    return {"symbols": part(q["n_symbols"], q["word_chars"]),
            "dup_lines": part(q["n_dup_lines"], q["n_lines"]),
            "repeats": part(F.greatest(q["n_repeat_words"] - CREDIT - RUNS * n, F.lit(0)), n),
            "word_len": part(q["word_chars"], n),
            # Distinct words grow with a power of the length: the exponent.
            "variety": F.when(n > 1, F.log(q["n_distinct"]) / F.log(n)).otherwise(F.lit(0.0)),
            "capitals": part(q["n_capitals"], q["word_chars"]),
            "points": part(q["n_points"], q["word_chars"])}


def quantile_sketch(scores: DataFrame, q: str, lang: str, source: str,
                    accuracy: float) -> DataFrame:
    """Sketch rows ``(lang, source, metric, bucket, n)``: bucket ``b`` counts
    the values in ``(gamma^(b-1), gamma^b]``; zero has a bucket of its own."""
    log_gamma = math.log((1 + accuracy) / (1 - accuracy))
    vals = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value"))
                               for m, v in _shares(F.col(q)).items()])).alias("m")
    flat = scores.select(F.col(lang).alias("lang"), F.col(source).alias("source"), vals)
    bucket = F.when(F.col("m.value") <= 1e-9, F.lit(-(1 << 30))).otherwise(
        F.ceil(F.log(F.col("m.value")) / log_gamma).cast("int"))
    return (flat.select("lang", "source", "m.metric", bucket.alias("bucket"))
            .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def _quantiles(sketch: DataFrame, keys: list[str], accuracy: float) -> DataFrame:
    """``LEVELS`` and number of documents of merged sketches, one row per
    ``keys`` and metric."""
    gamma = (1 + accuracy) / (1 - accuracy)
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "metric")
    run = merged.select("*", F.sum("n").over(by.orderBy("bucket")).alias("upto"),
                        F.sum("n").over(by).alias("total"))
    value = F.when(F.col("bucket") == -(1 << 30), F.lit(0.0)).otherwise(
        2 * F.pow(F.lit(gamma), F.col("bucket")) / (gamma + 1))
    at = [F.min(F.when(F.col("upto") >= p * F.col("total"), value)) for p in LEVELS]
    return run.groupBy(*keys, "metric").agg(F.array(*at).alias("q"), F.first("total").alias("total"))


def _pooled(own: Column, other: Column, pool: float) -> Column:
    """Quantiles of a group drawn towards those of a larger one."""
    w = own["total"] / (own["total"] + pool)
    return F.zip_with(own["q"], other, lambda a, b: w * a + (1 - w) * b)


def thresholds(scores: DataFrame, q: str, lang: str = "lang", source: str = "source", *,
               accuracy: float = 0.002, spread: float = 6.0, pool: float = 10.0) -> DataFrame:
    """One row per (lang, source) of ``scores`` with a centre and, without the
    noise of a document's length, a lower and an upper fence for every
    metric, as ``(lang, source, mid_<m>, lo_<m>, hi_<m>, ...)``."""
    sketch = materialize(quantile_sketch(scores, q, lang, source, accuracy), "quality-sketch")
    own = _quantiles(sketch, ["lang", "source"], accuracy).select(
        "lang", "source", "metric", F.struct("q", "total").alias("g0"))
    by_lang = _quantiles(sketch, ["lang"], accuracy).select(
        F.col("lang").alias("_l"), F.col("metric").alias("_m"), F.struct("q", "total").alias("g1"))
    overall = _quantiles(sketch, [], accuracy).select(F.col("metric").alias("_a"), F.col("q").alias("g2"))
    j = (own.join(by_lang, own["lang"].eqNullSafe(by_lang["_l"]) & (own["metric"] == by_lang["_m"]))
         .join(overall, F.col("metric") == F.col("_a")))
    j = j.withColumn("r", _pooled(F.col("g1"), F.col("g2"), pool))
    j = j.withColumn("g", _pooled(F.col("g0"), F.col("r"), pool))
    g, r = F.col("g"), F.col("r")

    def middle(x: Column) -> Column:
        return 2 * F.least(x[2] - x[1], x[3] - x[2])

    mid = F.greatest(g[1], F.least(g[3], r[2]))
    width, reach = F.least(middle(g), middle(r)), spread * (1 + 3 / F.sqrt(F.col("g0.total")))
    j = j.select("lang", "source", "metric", mid.alias("mid"),
                 (mid + reach * F.greatest(width, g[1] - g[0])).alias("hi"),
                 (mid - reach * F.greatest(width, g[4] - g[3])).alias("lo"))
    each = [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{c}_{m}") for m in METRICS for c in ("mid", "lo", "hi")]
    return j.groupBy("lang", "source").agg(*each)


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def _apply(scores: DataFrame, limits: DataFrame, q: str, verdict: str, lang: str,
           source: str) -> DataFrame:
    """``scores`` with a boolean ``verdict``.  The written thresholds are
    broadcast only if Spark finds them small, else shuffled with skew split."""
    one, ll, ls = (fresh(scores, x) for x in ("_limits", "_lang", "_source"))
    keyed = limits.select(F.struct(*limits.columns).alias(one), F.col("lang").alias(ll),
                          F.col("source").alias(ls))
    lim = F.col(one)
    ok = ~base_failed(F.col(q))
    for m, v in _shares(F.col(q)).items():
        pieces, below = METRICS[m]
        n, mid = F.greatest(F.col(q)[pieces or "n_words"], F.lit(1)), lim[f"mid_{m}"]
        noise = 3 * F.sqrt(F.greatest(mid, 1 / n) / n) if pieces else F.lit(0.0)
        if m == "variety":
            words = F.pow(n, mid)  # so many distinct ones, and n - words repeats
            noise = F.when(n > 1, 3 * F.sqrt(F.greatest(n - words, F.lit(1))) / words / F.log(n)).otherwise(1.0)
        ok = ok & (v <= lim[f"hi_{m}"] + noise)
        if below:
            ok = ok & (v >= lim[f"lo_{m}"] - noise)
    j = scores.join(keyed, F.col(lang).eqNullSafe(F.col(ll)) & F.col(source).eqNullSafe(F.col(ls)))
    return j.select(*scores.columns, F.coalesce(ok, F.lit(False)).alias(verdict))


@tidy
def quality_scores(docs: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source", **opts) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row; the text itself is
    left out, all other columns stay.  The measured rows are written once."""
    q = fresh(docs, "_q")
    scores = materialize(docs.withColumn(q, _MEASURE(F.col(text))).drop(text), "quality-scores")
    verdict = fresh(scores, "_kept")
    limits = materialize(thresholds(scores, q, lang, source, **opts), "quality-limits")
    out = _apply(scores, limits, q, verdict, lang, source)
    new = {c: F.col(f"{q}.{c}") for c in COUNTS}
    new |= {"base_failed": base_failed(F.col(q)), "kept": F.col(verdict)}
    taken = {c.lower() for c in new}
    keep = [c for c in docs.columns if c != text and c.lower() not in taken]
    return out.select(*keep, *[v.alias(c) for c, v in new.items()])


@tidy
def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source", **opts) -> DataFrame:
    """The rows that pass, with the columns of ``docs``.  Texts are measured
    once for the thresholds and once when they are filtered, so that they
    are neither written nor shuffled."""
    q = fresh(docs, "_q")
    measured = docs.select(F.col(lang), F.col(source), F.col(text))
    scores = docs.withColumn(q, _MEASURE(F.col(text)))
    verdict = fresh(scores, "_kept")
    small = materialize(measured.withColumn(q, _MEASURE(F.col(text))).drop(text), "quality-scores")
    limits = materialize(thresholds(small, q, lang, source, **opts), "quality-limits")
    return (_apply(scores, limits, q, verdict, lang, source)
            .where(F.col(verdict)).select(*docs.columns))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_scores(docs).select("doc_id", *COUNTS[:5], "base_failed", "kept")
