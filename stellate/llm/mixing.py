"""Mixing sources to target weights by entropy balancing.

Every document gets a rate ``r``: how often the mix takes it.  The rates are
the ones nearest to 1 in relative entropy, within ``0 <= r <= cap``, for which
each source's words add up to its target; they are
``min(cap, exp(lambda_s * x))`` with ``x`` the document's size over the
source's word-weighted mean size.  The dual is convex and splits by source;
all sources are solved together by safeguarded Newton steps, each one
aggregate over the size classes (source, size, number of documents).

Rounding is exact per source up to a few words: a class takes the
difference of the rounded running sums of its copies (in size order, so the
error stays below one document), then greedy corrections give or take whole
copies of the largest class that fits into what is left, until none does.
Rows that are equal in all columns are one unit with a multiplicity.  Inside a
class every row gets the same copies, and the remainder goes to units in the
order of their hashes, by running sums of the multiplicities, so a unit may get
it for some of its rows only; classes are cut into hash buckets of about
``bucket_rows`` units first, so a class with very many is spread over tasks.

Targets: sources in code point order, null last, weigh 5, 2, 1 and again;
they share all words by weight, a source stops at ``cap`` times its size and
what is over is shared again by weight (water level, found by one window).

Defined cases: a null or blank text has size 0, stays once and counts for
nothing; a null source is a source of its own; a source without words has
target 0; equal rows get copies that differ by one at most; an empty table
gives an empty table; other columns pass through :func:`mix_documents`.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, release, tidy
from .common import WORD, fresh, keep_known, table, tell_known

WEIGHTS = (5, 2, 1)


class MixDidNotConverge(RuntimeError):
    pass


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _source_key(source: str) -> Column:
    """Never null, different for null and every string."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def _hash(docs: DataFrame) -> Column:
    """Equal for rows that are equal in all columns (that can be hashed)."""
    maps = {f.name for f in docs.schema if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()}
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c not in maps])


def source_targets(classes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """``(sk, source_size, target)`` from size classes ``(sk, size, n)``."""
    per = classes.groupBy("sk").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("sk") == "n", "sk")
    nth = (F.row_number().over(order) - 1) % len(weights) + 1
    per = per.select("*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth).alias("w"))
    # The water level: sources fill up in the order of cap * size / w.
    ratio = cap * F.col("source_size") / F.col("w")
    every = Window.partitionBy(F.lit(1))
    before = Window.orderBy("ratio", "sk").rowsBetween(Window.unboundedPreceding, -1)
    f = per.select("*", ratio.alias("ratio"), F.sum("source_size").over(every).alias("total"),
                   F.sum("w").over(every).alias("all_w"))
    level = ((F.col("total") - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
             / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    f = f.select("*", level.alias("level"))
    f = f.select("*", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "sk", "level")))
                 .over(every).alias("cut"))
    target = F.least(cap * F.col("source_size").cast("double"), F.col("cut.level") * F.col("w"))
    return f.select("sk", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _rate(cap: int) -> Column:
    """Rate of a size class under its source's multiplier (null: at the cap)."""
    power = F.col("lam") * F.col("size") / F.col("scale")
    return F.when(F.col("size") == 0, 1.0).when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(power, F.lit(50.0)))))


def solve_rates(classes: DataFrame, targets: DataFrame, cap: int = 3, tolerance: float = 1e-7,
                max_iterations: int = 60) -> DataFrame:
    """Newton iterations on the dual; ``(sk, target, scale, lam)`` per source.

    The step is taken on the logarithm of the source's words, which is near
    linear in the multiplier, and falls back to halving the bracket.  Each
    state (a row per source) is written under the checkpoint folder, and
    only the largest error comes to the driver.
    """
    m = F.col("size") * F.col("n")
    scale = (classes.groupBy("sk").agg(F.try_divide(F.sum(m * F.col("size")), F.sum(m)).alias("scale"))
             .join(targets, "sk"))
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = materialize(scale.select(
        "sk", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.when(~full, F.log(F.try_divide(F.col("target"), F.col("source_size")))).alias("lam"),
        F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"), F.lit(1.0).alias("err")), "mix-state")
    for _ in range(max_iterations):
        x = F.col("size") / F.col("scale")
        r = _rate(cap)
        j = classes.where(F.col("size") > 0).join(state, "sk").where(F.col("lam").isNotNull())
        got = j.groupBy("sk").agg(
            F.sum(m * r).alias("words"),
            F.sum(F.when(r < cap, m * x * r).otherwise(0.0)).alias("slope"))
        s = state.join(got, "sk", "left")
        lo = F.when(F.col("words") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("words") < F.col("target"), F.col("hi")).otherwise(F.col("lam"))
        step = F.try_divide(F.log(F.try_divide(F.col("target"), F.col("words"))) * F.col("words"), F.col("slope"))
        newton = F.col("lam") + step
        half = (F.when(F.col("hi") >= 1e9, F.greatest(F.lit(1.0), 2 * F.abs("lam")))
                .when(F.col("lo") <= -1e9, -F.greatest(F.lit(1.0), 2 * F.abs("lam")))
                .otherwise((F.col("lo") + F.col("hi")) / 2))
        s = s.select("sk", "target", "scale", "lam", lo.alias("lo"), hi.alias("hi"), newton.alias("nw"),
                     F.coalesce(F.try_divide(F.abs(F.col("words") - F.col("target")), F.col("target")),
                                F.lit(0.0)).alias("err"))
        inside = F.col("slope_ok") & (F.col("nw") > F.col("lo")) & (F.col("nw") < F.col("hi"))
        s = s.withColumn("slope_ok", F.col("nw").isNotNull() & ~F.isnan("nw"))
        nxt = F.when(F.col("err") <= tolerance, F.col("lam")).when(inside, F.col("nw")).otherwise(half)
        new = materialize(s.select("sk", "target", "scale",
                                   F.when(F.col("lam").isNotNull(), nxt).alias("lam"),
                                   "lo", "hi", "err"), "mix-state")
        worst = new.agg(F.max("err")).first()[0]
        release(state)
        state = new
        if worst is None or worst <= tolerance:
            return state
    raise MixDidNotConverge(f"no balance in {max_iterations} iterations, error {worst}")


def round_copies(classes: DataFrame, state: DataFrame, cap: int = 3) -> DataFrame:
    """Whole copies per size class: ``(sk, size, n, copies)``.  Every
    correction brings each source that it changes nearer to its target."""
    run = Window.partitionBy("sk").orderBy(F.desc("size"))
    c = classes.join(state.select("sk", "target", "scale", "lam"), "sk")
    c = c.select("sk", "size", "n", "target", F.sum(F.col("n") * _rate(cap)).over(run).alias("upto"))
    c = c.select("sk", "size", "n", "target",
                 (F.round("upto") - F.coalesce(F.lag(F.round("upto")).over(run), F.lit(0.0)))
                 .cast("bigint").alias("copies"))
    cur = materialize(c, "mix-copies")
    while True:
        err = cur.groupBy("sk").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("err"))
        j = cur.where(F.col("size") > 0).join(err, "sk")
        room = F.when(F.col("err") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") <= F.abs("err")) & (room > 0)
        best = (j.where(fits).groupBy("sk").agg(F.max("size").alias("size"), F.first("err").alias("err")))
        best = materialize(best, "mix-best")
        if best.isEmpty():
            release(best)
            break
        k = F.least(F.floor(F.abs(F.col("err")) / F.col("size")),
                    F.when(F.col("err") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies")))
        new = materialize(
            cur.join(best, ["sk", "size"], "left")
            .select("sk", "size", "n", "target",
                    (F.col("copies") + F.coalesce(F.signum("err") * k, F.lit(0.0))).cast("bigint").alias("copies")),
            "mix-copies")
        release(cur)
        release(best)
        cur = new
    return cur


@dataclass
class _Plan:
    units: DataFrame    # one row for each unit of equal rows (doc_id, sk, size, h): ``mult`` (how many they are),
    #                     ``source_size``, ``target``, ``base`` (copies of each row), ``extra`` (rows that get one more)
    classes: DataFrame  # (sk, size, base, buckets)
    cuts: DataFrame     # (sk, size, bucket, cut): the units up to hash ``cut`` get one more


def _plan(sizes: DataFrame, weights: tuple[int, ...], cap: int, bucket_rows: int) -> _Plan:
    """Copies for rows ``(doc_id, sk, size, h)``."""
    units = materialize(sizes.groupBy("sk", "size", "h").agg(
        F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("mult")), "mix-units")
    classes = materialize(units.groupBy("sk", "size").agg(F.sum("mult").alias("n"), F.count(F.lit(1)).alias("units")),
                          "mix-classes")
    targets = materialize(source_targets(classes, weights, cap), "mix-targets")
    copies = round_copies(classes, solve_rates(classes, targets, cap), cap)
    base = F.floor(F.col("copies") / F.col("n"))
    per_class = materialize(
        copies.join(targets.select("sk", "source_size"), "sk").join(classes.select("sk", "size", "units"), ["sk", "size"])
        .select("sk", "size", "n", "source_size", "target", base.alias("base"),
                (F.col("copies") - base * F.col("n")).alias("left"),
                F.ceil(F.col("units") / bucket_rows).alias("buckets")), "mix-plan")
    rows = materialize(units.join(per_class, ["sk", "size"])
                       .withColumn("bucket", F.pmod(F.col("h"), F.col("buckets"))), "mix-rows")
    key = ["sk", "size", "bucket"]
    part = rows.where(F.col("left") > 0).groupBy(*key).agg(
        F.sum("mult").alias("m"), F.first("n").alias("n"), F.first("left").alias("left"))
    upto = F.sum("m").over(Window.partitionBy("sk", "size").orderBy("bucket"))
    share = F.floor(F.col("left") * F.col("upto") / F.col("n"))
    part = part.select("*", upto.alias("upto"))
    part = part.select(*key, (share - F.floor(F.col("left") * (F.col("upto") - F.col("m")) / F.col("n")))
                       .alias("take"))
    before = F.coalesce(F.sum("mult").over(
        Window.partitionBy(*key).orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = rows.where(F.col("left") > 0).select(*key, "h", "mult", before.alias("before")).join(part, key)
    extra = F.greatest(F.lit(0), F.least("mult", F.col("take") - F.col("before")))
    more = materialize(ranked.select(*key, "h", extra.alias("extra")).where("extra > 0"), "mix-extra")
    out = rows.join(more.drop("bucket"), ["sk", "size", "h"], "left").select(
        "doc_id", "sk", "size", "h", "mult", "source_size", "target", "base",
        F.coalesce("extra", F.lit(0)).cast("bigint").alias("extra"))
    return _Plan(out, per_class.select("sk", "size", "base", "buckets"),
                 more.groupBy(*key).agg(F.max("h").alias("cut")))


#: Rows of one unit that a task makes.
_RUN = 1 << 16


def _repeated(df: DataFrame, times: Column, nth: str) -> DataFrame:
    """Every row ``times`` times, numbered from 1 in column ``nth``; rows with
    very many repeats are dealt to several tasks."""
    n, run = fresh(df, "_times"), fresh(df, "_run")
    df = df.withColumn(n, times.cast("bigint")).where(F.col(n) > 0)
    few = df.where(F.col(n) <= _RUN).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n)
    runs = df.where(F.col(n) > _RUN).withColumn(run, F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / _RUN))))
    first = F.col(run) * _RUN
    many = (runs.repartition(run).withColumn(nth, F.explode(F.sequence(
        first + 1, F.least(first + _RUN, F.col(n))))).drop(n, run))
    return few.unionByName(many)


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return materialize(docs.select(F.col(doc_id).alias("doc_id"), _source_key(source).alias("sk"),
                                   _words(text).alias("size"), _hash(docs).alias("h")), "mix-sizes")


@tidy
def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *,
             weights: tuple[int, ...] = WEIGHTS, cap: int = 3, bucket_rows: int = 256) -> DataFrame:
    """``(doc_id, sk, size, h, source_size, target, copies)`` for every row;
    ``sk`` and ``h`` stand for the source and the whole row."""
    units = _plan(_sizes(docs, doc_id, text, source), weights, cap, bucket_rows).units
    rows = _repeated(units, F.col("mult"), "nth")
    copies = F.col("base") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
    return rows.select("doc_id", "sk", "size", "h", "source_size", "target", copies.alias("copies"))


@tidy
def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *,
                  weights: tuple[int, ...] = WEIGHTS, cap: int = 3, bucket_rows: int = 256) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    A row without an equal one is taken as often as its class tells, once more
    up to the cut of its bucket: two tables that are small beside the rows, so
    the texts stay where they are read.  Only rows that may have an equal one
    (told by a filter of a fixed size) are shuffled."""
    plan = _plan(_sizes(docs, doc_id, text, source), weights, cap, bucket_rows)
    sk, h, size, bucket, cut, base, buckets, mult, copies, equal = (fresh(docs, x) for x in (
        "_sk", "_h", "_size", "_bucket", "_cut", "_base", "_buckets", "_mult", "_copies", "_equal"))
    columns = [F.col(f"`{x}`") for x in docs.columns]
    taken = plan.units.select(F.col("sk").alias(sk), F.col("h").alias(h), F.col("mult").alias(mult),
                              (F.col("base") * F.col("mult") + F.col("extra")).alias(copies))
    taken = materialize(taken, "mix-taken")
    classes = plan.classes.select(F.col("sk").alias(sk), F.col("size").alias(size), F.col("base").alias(base),
                                  F.col("buckets").alias(buckets))
    cuts = materialize(plan.cuts.select(F.col("sk").alias(sk), F.col("size").alias(size), F.col("bucket").alias(bucket),
                                        F.col("cut").alias(cut)), "mix-cuts")
    keyed = docs.withColumns({sk: _source_key(source), h: _hash(docs)})
    several = taken.where(F.col(mult) > 1).select(h)
    keyed = tell_known(keyed, h, several, equal)
    alone = (keyed.where(~F.col(equal)).withColumn(size, _words(text)).join(classes, [sk, size])
             .withColumn(bucket, F.pmod(F.col(h), F.col(buckets))).join(cuts, [sk, size, bucket], "left")
             .select(*columns, (F.col(base) + F.when(F.col(h) <= F.col(cut), 1).otherwise(0)).alias(copies)))
    # Equal rows cannot be told apart: one of them stands for all.
    one = (keyed.where(equal).join(keep_known(taken, h, several), [sk, h]).dropDuplicates([sk, h]).select(*columns, copies))
    out = _repeated(alone.unionByName(one), F.col(copies), fresh(docs, "_nth"))
    return out.select(*columns)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    p = mix_plan(docs)
    return p.select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies")
