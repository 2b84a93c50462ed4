"""Connected components as an iterative DataFrame job.

Alternating large-star / small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014).  Every edge is kept as
``(u, v)`` with ``u > v``.

* large-star: each edge ``(u, v)`` becomes ``(u, m(v))`` where ``m(v)`` is the
  least of ``v`` and the smaller neighbours of ``v``;
* small-star: each ``u`` with least smaller neighbour ``m`` links ``u`` and its
  other smaller neighbours to ``m``.

The loop stops exactly when the edge set is a forest of stars (every ``u``
has one ``v`` and no ``v`` is also a ``u``); the star centres are then the
least vertex of each component.  The test comes from the large-star step
itself (a flag per edge and a count per vertex), so it costs no shuffle of
the edges.

Without groups, every task replaces the edges that it holds by the stars of
their components: where they are read, behind the large star, and where they
come together by their larger end, which links all that the small star links
with one shuffle.  So repeats, and edges inside what a task can already tell to
be one component, never reach a shuffle.  Such a replacement keeps the
components wherever the partitions are cut, so AQE may deal the edges of a hub
vertex to many tasks.

Scale notes: the minima are ``groupBy`` aggregates (partial aggregation on the
map side, so a hub vertex is combined before the shuffle); the joins are
many-to-one on a key with one row on the small side, which AQE's skew-join
split handles when one vertex holds a large share of the edges; each step is
written under ``spark.checkpoint.dir`` so the plan stays short and a lost
executor only costs the current step.  Above the broadcast threshold the
per-vertex minima and the final labels are written too (see
:func:`stellate.session.join_input`), so AQE's skew split applies to hub
keys in the joins against them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import join_input, materialize, release, tidy
from .forest import star_forest


class ComponentsDidNotConverge(RuntimeError):
    pass


def vertices_from_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct endpoints of an edge set, as column ``id``."""
    return (edges.select(F.col(src).alias("id"))
            .unionByName(edges.select(F.col(dst).alias("id")))
            .where(F.col("id").isNotNull())
            .distinct())


def _minima(e: DataFrame, g: list[str], key: str, counts: bool = False) -> DataFrame:
    """Least smaller neighbour of every ``u`` (and, with ``counts``, how many
    smaller neighbours it has), as ``(*g, key, m[, n])``.

    Too large to broadcast, the minima are written out (see
    :func:`stellate.session.join_input`), so the join with the edges is two
    plain shuffle stages and AQE splits the edges of a hub vertex.
    """
    aggs = [F.min("v").alias("m")] + ([F.count(F.lit(1)).alias("n")] if counts else [])
    m = e.groupBy(*g, "u").agg(*aggs).withColumnRenamed("u", key)
    return join_input(m, "cc-min")


def _large_star(e: DataFrame, g: list[str]):
    """Returns the step's edges with a flag ``hit`` (the edge's ``v`` has a
    smaller neighbour, i.e. is also a ``u``) and the minima with counts;
    together they tell whether ``e`` was already a forest of stars."""
    m = _minima(e, g, "v", counts=True)
    # Output has one row per input edge; repeats are removed by the small
    # star that follows (its minima do not depend on them).
    out = (e.join(m.select(*g, "v", "m"), [*g, "v"], "left")
           .select(*g, "u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("hit")))
    return out, m


def _small_star(e: DataFrame, g: list[str]):
    m = _minima(e, g, "u")
    # Both outputs come from the one join: (v, m) for the other smaller
    # neighbours and (u, m) for u itself (repeated per edge, removed by the
    # distinct, which combines them before its shuffle).
    j = e.join(m, [*g, "u"])
    out = F.explode(F.array(
        F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
        F.when(F.col("v") != F.col("m"),
               F.struct(F.col("v").alias("a"), F.col("m").alias("b")))))
    res = (j.select(*g, out.alias("p"))
           .where(F.col("p").isNotNull())
           .select(*g, F.col("p.a").alias("u"), F.col("p.b").alias("v"))
           .distinct())
    return res, m


def _was_star_forest(hit: bool | None, m: DataFrame) -> bool:
    """Exact stop test from the large-star step, with no shuffle of edges:
    the input was a forest of stars when no ``v`` is also a ``u`` (no
    ``hit``) and every ``u`` has one ``v`` (all counts 1)."""
    if hit:
        return False
    most = m.agg(F.max("n")).first()[0]
    return most is None or most <= 1


def _by_larger_end(e: DataFrame) -> DataFrame:
    """Stars of partitions that hold the edges of a ``u`` together (a very
    large one is cut, what is left of it meets in the next step), side by
    side, so they are in one lot of the task."""
    return e.hint("rebalance", F.col("u")).sortWithinPartitions("u").mapInArrow(star_forest(), "u bigint, v bigint")


def _stars(cur: DataFrame, max_iterations: int, stats: dict) -> DataFrame:
    """The steps without groups, from written edges to a forest of stars in
    which an edge may be repeated.  The large star goes on into the tasks that
    contract its edges, and only what comes out is written."""
    given = cur
    stats["steps"] += 2  # the edges were contracted where they are read and by their larger end
    for _ in range(2, max_iterations):
        stats["steps"] += 1
        least = (cur.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"))
                 .withColumnRenamed("u", "v"))
        m = join_input(least, "cc-min")
        # Every u has one v, and no v is also a u: stars (the centres are few).
        if (m.where(F.col("m") != F.col("most")).isEmpty()
                and cur.select("v").distinct().join(m, "v", "left_semi").isEmpty()):
            return cur
        large = cur.join(m.select("v", "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        nxt = materialize(_by_larger_end(large.mapInArrow(star_forest(), "u bigint, v bigint")), "cc-step")
        for t in (m, cur if cur is not given else None):
            release(t)
        cur = nxt
    raise ComponentsDidNotConverge(
        f"connected components did not converge in {max_iterations} iterations")


@tidy
def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         group_by: list[str] | None = None,
                         max_iterations: int = 200,
                         edges_distinct: bool = False,
                         stats: dict | None = None) -> DataFrame:
    """Label every vertex that occurs in ``edges`` with the least vertex id of
    its component.  Edges are undirected; repeats and self-loops are allowed
    (a vertex with only a self-loop is its own component).

    ``group_by`` names columns that split the edges into independent graphs
    (for example one graph per round snapshot); all of them are solved in the
    same job, the group columns being part of every key (NULL is a group of
    its own).

    Without ``group_by`` every partition contracts its edges to stars
    (:func:`stellate.operators.forest.star_forest`) at every step.  With it,
    ``edges_distinct=True`` tells that no unordered pair occurs twice, which
    saves the shuffle that removes repeats; a wrong claim costs time, not
    correctness.  A ``stats`` dict receives the number of edges given (with
    both ends) and of steps.

    Returns ``(*group_by, id BIGINT, cmp BIGINT)``, one row per vertex.
    """
    groups = list(group_by or [])
    # The group columns travel as one struct key: one column to hash, and
    # struct equality matches NULL fields, so a NULL group is a group too.
    g = ["_g"] if groups else []
    gsel = [F.struct(*groups).alias("_g")] if groups else []
    pairs = (edges.select(*gsel, F.col(src).cast("bigint").alias("a"),
                          F.col(dst).cast("bigint").alias("b"))
             .where(F.col("a").isNotNull() & F.col("b").isNotNull())
             .select(*g, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    given = Observation()
    pairs = pairs.observe(given, F.count(F.lit(1)).alias("n"))
    if not groups:
        # Each partition's edges become stars of their components where they
        # are read: no shuffle sees more than a partition's vertices.
        pairs = _by_larger_end(pairs.mapInArrow(star_forest(), "u bigint, v bigint"))
    elif not edges_distinct:
        pairs = pairs.distinct()
    canon = materialize(pairs, "cc-canon")
    selfs = canon.where(F.col("u") == F.col("v")).select(*g, F.col("u").alias("id"),
                                                         F.col("u").alias("cmp"))
    cur = canon.where(F.col("u") != F.col("v"))
    stats = {} if stats is None else stats
    # Adaptive execution drops the count from a plan that gives no row.
    stats["edges"] = 0 if canon.isEmpty() else given.get["n"]
    stats["steps"] = 0
    if not groups:
        cur = _stars(cur, max_iterations, stats)
    for _ in range(max_iterations if groups else 0):
        stats["steps"] += 1
        large, m1 = _large_star(cur, g)
        # Written once, as the small star reads it twice; the flag is
        # observed on the way.
        seen = Observation()
        large = materialize(large.observe(seen, F.max("hit").alias("hit")).drop("hit"), "cc-large")
        if _was_star_forest(seen.get.get("hit"), m1):
            for t in (large, m1):
                release(t)
            break
        small, m2 = _small_star(large, g)
        nxt = materialize(small, "cc-step")
        release(large)
        for t in (m1, m2, cur if cur is not canon else None):
            release(t)
        cur = nxt
    else:
        if groups:
            raise ComponentsDidNotConverge(
                f"connected components did not converge in {max_iterations} iterations")
    # Star leaves point at their centre; the centres and self-loop-only
    # vertices label themselves.  One aggregate, combined map-side.
    cands = (cur.select(*g, F.col("u").alias("id"), F.col("v").alias("cmp"))
             .unionByName(cur.select(*g, F.col("v").alias("id"), F.col("v").alias("cmp")))
             .unionByName(selfs))
    # Large labellings are written, so that a relabel join against them can
    # have its giant-component key split by AQE; the steps behind a written
    # labelling go at once, those that a small one reads go with it.
    agg = cands.groupBy(*g, "id").agg(F.min("cmp").alias("cmp"))
    if groups:
        agg = agg.select(*[F.col("_g")[c].alias(c) for c in groups], "id", "cmp")
    return join_input(agg, "cc-labels")
