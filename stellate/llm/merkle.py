"""Document fingerprints: a Merkle tree over paragraphs and sections.

Leaves are paragraphs: a line with its newline, cut again after a sentence or
clause end followed by a blank, and after a blank behind a word of seven
letters or more that ends in a vowel (and some signs), so that a very long line, with or without
punctuation, still locates its edits.  The cuts depend on the nearby text only.
The leaves put together are the text.  A section is a run of leaves up to and
including one whose digest ends in 0 or 8 (one in eight on average): the
content sets the borders, so an insertion moves no later section.  The digest
of a leaf is cut from SHA-256 of its text, that of a section from SHA-256 of
its leaves' digests, and the root is SHA-256 over the sections' digests.

The fingerprint is the tree as text::

    root:section.section...:leaf,leaf|leaf|...

with the leaves of a section between bars.  Equal texts have equal
fingerprints, equal roots mean equal texts, and
:func:`changed_branches` names the sections and leaves of one tree that the
other lacks.  :func:`likeness` is 1 for equal roots, else the Dice share of
distinct leaves (0: no paragraph in common).

Defined cases: a null text is empty; the empty text has no leaf, and is like
another empty text (1) and unlike all else (0); repeated rows, and rows with
one id, follow each other in the order of (id, text), null ids first; one row
alone is its own next document; an empty table gives an empty table.

Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, shuffle_parts, table, text_or_empty

LEAF_DIGITS = 12
#: Between these characters a paragraph ends (Java regular expression).
_CUT = r"(?<=[\n ])(?:(?<=\n)|(?<=[.!?,;:] )|(?<=\p{L}{6}[aeiou][^ \p{L}]{0,3} ))"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of column ``text`` as column ``name``."""
    tmp = fresh(df, f"_{name}_tree")
    digest = F.transform(F.filter(F.split(F.col(text), _CUT, -1), lambda x: x != ""),
                         lambda x: F.substring(F.sha2(x, 256), 1, LEAF_DIGITS))
    # A leaf that ends a section is followed by a bar, the others by a comma.
    joined = F.regexp_replace(F.array_join(digest, ","), "([08]),", "$1|")
    df = df.withColumn(tmp, joined)
    sections = F.transform(F.split(F.col(tmp), r"\|", -1),
                           lambda s: F.substring(F.sha2(s, 256), 1, LEAF_DIGITS))
    nodes = fresh(df, f"_{name}_nodes")
    df = df.withColumn(nodes, F.array_join(sections, "."))
    root = F.substring(F.sha2(F.col(nodes), 256), 1, 32)
    return df.withColumn(name, F.concat_ws(":", root, F.col(nodes), F.col(tmp))).drop(tmp, nodes)


def _leaves(fp: Column) -> Column:
    return F.filter(F.split(F.substring_index(fp, ":", -1), "[,|]", -1), lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    same_root = F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)
    x, y = F.array_distinct(_leaves(a)), F.array_distinct(_leaves(b))
    return F.when(same_root, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)), F.lit(0.0)))


def changed_branches(a: Column, b: Column) -> Column:
    """Where ``a`` differs from ``b``: struct of the sections of ``a`` that
    ``b`` lacks and, inside those only, the positions (from 0, in ``a``) and
    digests of the leaves that ``b`` lacks."""
    def sections(fp: Column) -> Column:
        return F.split(F.split_part(fp, F.lit(":"), F.lit(2)), r"\.", -1)

    def groups(fp: Column) -> Column:
        return F.split(F.substring_index(fp, ":", -1), r"\|", -1)

    lost = F.array_except(sections(a), sections(b))
    flat = F.flatten(F.transform(F.arrays_zip(sections(a).alias("s"), groups(a).alias("g")), lambda z: F.transform(
        F.split(z["g"], ",", -1), lambda leaf: F.struct(z["s"].alias("section"), leaf.alias("digest")))))
    numbered = F.transform(flat, lambda x, i: F.struct(i.alias("leaf"), x["section"].alias("section"),
                                                       x["digest"].alias("digest")))
    gone = F.filter(numbered, lambda x: F.array_contains(lost, x["section"])
                    & ~F.array_contains(_leaves(b), x["digest"]))
    return F.struct(lost.alias("sections"), gone.alias("leaves"))


def _ranges(docs: DataFrame, key: str, n: int) -> Column:
    """The number of a key's range among about ``n`` (nulls: 0), in order.

    Cuts are quantiles on two levels, about sqrt(n) each: first of all keys,
    then inside each first range.  A key is compared with the cuts of one
    range per level; the cuts are constants of the plan, parsed from text,
    so the plan's size does not grow with their number."""
    wide = max(1, math.isqrt(n - 1) + 1)
    at = [i / wide for i in range(1, wide)]
    quantiles = F.percentile_approx(key, at, 20 * wide) if at else F.array()
    kind = docs.schema[key].dataType.simpleString()

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c < F.col(key)))

    def constant(value: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), kind)

    first = sorted(set((docs.agg(quantiles.alias("q")).first()["q"] if at else None) or []))
    top = F.coalesce(below(constant(first, f"array<{kind}>")), F.lit(0))
    rows = docs.groupBy(top.alias("t")).agg(quantiles.alias("q")).collect() if at else []  # sqrt(n) rows
    inner: list[list] = [[] for _ in range(len(first) + 1)]
    for r in rows:
        inner[r["t"]] = sorted(set(r["q"] or []))
    low = below(F.element_at(constant(inner, f"array<array<{kind}>>"), top + 1))
    return top * wide + F.coalesce(low, F.lit(0))


def with_next_text(docs: DataFrame, doc_id: str, text: str, carry: list[str],
                   names: list[str]) -> DataFrame:
    """Adds, as ``names``, the ``carry`` columns of the next document in
    ascending (id, text) order; after the last comes the first.

    Ids are cut into ranges of about equal size (:func:`_ranges`), one
    shuffle brings each range together, and ``lead`` finds the next row
    inside it.  The first row of each range joins the range before it as a
    marked extra row (one per range), so the border pairs are whole.  No
    range is the whole table, whatever its size.
    """
    rng, extra = fresh(docs, "_range"), fresh(docs, "_extra")
    placed = docs.withColumn(rng, _ranges(docs, doc_id, 4 * shuffle_parts(docs.sparkSession)))
    placed = placed.withColumn(extra, F.lit(0))
    whole = F.struct(F.col(doc_id), F.col(text), F.struct(*docs.columns).alias("row"))
    firsts = placed.groupBy(rng).agg(F.min(whole).alias("w"))
    # One row per range: the range that comes before it (the last one for the first).
    before = F.lag(rng).over(Window.orderBy(rng))
    last = F.max(rng).over(Window.partitionBy(F.lit(1)))
    marked = firsts.select("w", F.coalesce(before, last).alias(rng))
    marked = marked.select(*[F.col("w.row")[c].alias(c) for c in docs.columns], F.col(rng),
                           F.lit(1).alias(extra))
    both = placed.unionByName(marked)
    by = Window.partitionBy(rng).orderBy(extra, doc_id, text)
    nxt = both.select("*", *[F.lead(c).over(by).alias(x) for c, x in zip(carry, names)])
    return nxt.where(F.col(extra) == 0).drop(rng, extra)


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its fingerprint, its edited text (the last quarter
    replaced from the next document), the edited text's fingerprint and the
    likeness to it and to the next document's fingerprint."""
    d = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    d = with_fingerprint(d, "text", "fingerprint")
    d = with_next_text(d, "doc_id", "text", ["text", "fingerprint"], ["next_text", "next_fingerprint"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    d = d.select("doc_id", n.cast("bigint").alias("n_chars"), "fingerprint", "next_fingerprint",
                 F.concat(F.substring(F.col("text"), F.lit(1), n - quarter),
                          F.substring(F.col("next_text"), F.lit(1), quarter)).alias("edited_text"))
    d = with_fingerprint(d, "edited_text", "edited_fingerprint")
    return d.select("*", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = document_fingerprints(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next")
