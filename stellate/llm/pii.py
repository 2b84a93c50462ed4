r"""Personal data by bootstrapped contextual extraction.

Seeds are what the base patterns find (email, ip, card, phone, with their
checks).  Identifier-like words (with a digit or an ``@``) and groups of digits
with blanks between them that no seed covers are candidates; a word inside such
groups is not one by itself.  The word before and the word after an entity are
its lexical patterns, so seeds and candidates make a bipartite graph of
patterns and values.  Every round Spark scores it:

* a pattern is used for a kind if it has ``support`` known values of the kind
  and these are ``confidence`` or more of the values that speak for or against
  it: against it speak values known to be of another kind only and values that
  lack the kind's shape (dates, prices and years after a word show that the
  word means nothing);
* its reliability is the share of known values among all its different values
  of the kind's shape: unseen ones count against it.  Only for a pattern that
  names identifiers, one whose word stands beside an identifier in at least
  half of all its places in the texts (``phone:``, not ``at``), unseen values
  are what it is there to find, and it is reliable;
* a candidate value of the kind's shape is accepted if the used patterns that
  bring it are reliable together, ``1 - prod(1 - reliability) >= 0.5``, and
  counts as known in the next round.

The rounds end when no value is new.  Every candidate place of an accepted
value becomes a span, whatever its patterns, beside all base spans.  A span is
the value without the punctuation and the unpaired or enclosing brackets around
it.

Shapes: an email has an ``@`` inside; an ip four numbers with dots (and a port or
mask) or four groups or more with colons; a card 12 to 19 digits, blanks and
dashes; a phone 7 to 15 digits with signs between them, or all digits behind
a ``+`` or ``0``, but neither a date nor a span of years nor a decimal number.

The word before and after an entity is looked for in the 256 code points beside
it; a longer word counts by the part nearby, and behind more blanks there is
none.

Base spans are the leftmost non-overlapping matches of each kind's pattern
that pass its check.  Groups are possessive where nothing follows them, which
changes no match and keeps Java's matcher from recursing on long texts.
Offsets are code points, ends exclusive.

Defined cases: a null text is empty and has no span; repeated rows get equal
spans; texts of any length are searched whole; rows are told apart by id and
text, so a null or repeated id is no trouble; an empty table gives an empty
table; other columns pass through, and input columns called like an output
column are replaced.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release, tidy
from .common import fresh, keep_known, table, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
# The base patterns, in Java's notation.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before its pattern is worth trying.
_HINT = {"email": "@", "ip": ".", "phone": "+"}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"
#: A word with a digit or an at sign, tried at word starts only.
_CANDIDATE = (r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]++")
#: Groups of digits with blanks, dots or dashes between them.
_GROUPS = (r"(?<![^\x20\x09-\x0D])(?:\([0-9]{1,4}\)|[0-9]{1,6})(?:[\x20.-]{1,2}[0-9]{2,6}){1,9}(?![0-9])")
_BLANK = r"[\x20\x09-\x0D]"
_CONTEXT = 256  # code points around an entity that are searched for a word
_PIECE = 10    # texts are cut into pieces of 2^10 code points to reach a place
_BLOCK = 7     # running values are combined in blocks of 2^7


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(_OCTETS)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often (and in
    whatever lambda) ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of a non-empty array of numbers from 0 up:
    block totals first, then within blocks, so time grows with the array and
    not with its square."""
    def block(v: Column, first: Column, last: Column) -> Column:
        return F.aggregate(F.sequence(first, last), F.lit(0), lambda a, i: combine(a, F.get(v, i)))

    def before(v: Column) -> Column:
        def step(acc: Column, b: Column) -> Column:
            first = F.shiftleft(b, _BLOCK)
            last = F.least(first + (1 << _BLOCK), F.size(v)) - 1
            return F.concat(acc, F.array(combine(F.element_at(acc, -1), block(v, first, last))))

        return F.aggregate(F.sequence(F.lit(0), F.shiftright(F.size(v) - 1, _BLOCK)), F.array(F.lit(0)), step)

    def scan(v: Column) -> Column:
        return _let(before(v), lambda p: F.transform(v, lambda _, i: combine(
            F.get(p, F.shiftright(i, _BLOCK)), block(v, i - i % (1 << _BLOCK), i))))

    return _let(values, scan)


def _matches(df: DataFrame, text: str, pattern: str, name: str, when: Column | None = None) -> DataFrame:
    """Adds column ``name``: array of (start, end, value) of the pattern's
    matches, left to right."""
    hits = fresh(df, f"_{name}_hits")
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    df = df.withColumn(hits, found if when is None else F.when(when, found).otherwise(none))
    gaps = F.transform(F.split(F.col(text), pattern, -1), F.length)
    steps = _let(gaps, lambda g: F.transform(F.col(hits), lambda v, i: F.get(g, i) + F.length(v)))
    spans = _let(_running(steps, lambda a, x: a + x), lambda ends: F.transform(F.col(hits), lambda v, i: F.struct(
        (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"))))
    return df.withColumn(name, F.when(F.size(hits) > 0, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))).drop(hits)


def _with_base(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Adds the checked base spans of each kind."""
    def passing(kind: str) -> Column:
        return F.filter(F.col(names[kind]), lambda s: _passes(kind, s["value"]))

    for kind in KINDS:
        hint = F.contains(F.col(text), F.lit(_HINT[kind])) if kind in _HINT else None
        df = _matches(df, text, PATTERNS[kind], names[kind], hint).withColumn(names[kind], passing(kind))
    return df


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _PIECE}}}"), F.lit(0))


def _near(pieces: Column, start: Column, n: Column) -> Column:
    """``n`` code points (at most a piece) from ``start`` on."""
    k = F.shiftright(start, _PIECE)
    two = F.concat(F.coalesce(F.get(pieces, k), F.lit("")), F.coalesce(F.get(pieces, k + 1), F.lit("")))
    return F.substring(two, start % (1 << _PIECE) + 1, n)


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end``, however many."""
    k = F.shiftright(start, _PIECE)
    some = F.slice(pieces, k + 1, F.shiftright(end, _PIECE) - k + 1)
    return (F.when(end - start <= 1 << _PIECE, _near(pieces, start, end - start))
            .otherwise(F.substring(F.array_join(some, ""), start % (1 << _PIECE) + 1, end - start)))


def _sides(pieces: Column, start: Column, end: Column) -> Column:
    """The lexical patterns of an entity: the word before it and after it."""
    before = _near(pieces, F.greatest(start - _CONTEXT, F.lit(0)), F.least(start, F.lit(_CONTEXT)))
    after = _near(pieces, end, F.lit(_CONTEXT))
    left = F.regexp_extract(before, rf"([^\x20\x09-\x0D]+){_BLANK}*$", 1)
    right = F.regexp_extract(after, rf"^{_BLANK}*([^\x20\x09-\x0D]+)", 1)
    both = F.array(F.concat(F.lit("<"), F.lower(left)), F.concat(F.lit(">"), F.lower(right)))
    return F.filter(both, lambda p: F.length(p) > 1)


def _tagged(names: dict[str, str]) -> Column:
    """All base spans as (start, kind number, end), sorted."""
    def numbered(i: int) -> Column:
        return F.transform(F.col(names[KINDS[i]]), lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))

    return F.array_sort(F.concat(*map(numbered, range(len(KINDS)))))


def _ends(spans: Column) -> Column:
    """The greatest end up to each of the sorted spans (none: empty)."""
    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, _running(ends, F.greatest)).otherwise(F.array().cast("array<int>"))


def _free(words: Column, spans: str) -> Column:
    """The words that no span of the sorted column overlaps: a binary search
    counts the spans that start before a word's end; none of them may end
    after its start."""
    powers = F.array(*[F.lit(1 << b) for b in range(30, -1, -1)])

    def starting(w: Column) -> Column:
        return F.aggregate(powers, F.lit(0), lambda n, p: F.when(
            (p <= F.size(spans) - n) & (F.get(F.col(spans), n + p - 1)["start"] < w["end"]), n + p).otherwise(n))

    return _let(_ends(F.col(spans)), lambda ends: F.filter(words, lambda w: F.coalesce(
        F.get(ends, starting(w) - 1) <= w["start"], F.lit(True))))


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Numbers that are no phone: dates (with or without a time), spans of years,
#: decimal numbers and thousands.
_NO_PHONE = "|".join([
    r"[12][0-9]{3}[./ -](?:0?[1-9]|1[0-2])[./ -](?:0?[1-9]|[12][0-9]|3[01])(?:[T ].*)?",
    r"(?:0?[1-9]|[12][0-9]|3[01])[./ -](?:0?[1-9]|[12][0-9]|3[01])[./ -](?:[12][0-9]{3}|[0-9]{2})(?:[T ].*)?",
    r"[12][0-9]{3} ?[/-] ?[12][0-9]{3}", r"[0-9]+\.[0-9]+", r"[0-9]{1,3}(?:[. ][0-9]{3})+(?:,[0-9]+)?"])


def _shape(kind: Column, value: Column) -> Column:
    """Whether a candidate looks like the kind (numbers as in ``KINDS``)."""
    n = F.length(_digits(value))
    phone = (n.between(7, 15) & value.rlike(r"^\+?[0-9() ./-]+$")
             & value.rlike(r"^[+0]|[0-9)][ ()./-]+[0-9(]") & ~value.rlike(f"^(?:{_NO_PHONE})$"))
    return (F.when(kind == 0, value.rlike(r"[^@]@[^@]"))
            .when(kind == 1, value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?:[:/][0-9]{1,5})?$"
                                         r"|^(?=.*[0-9])[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){3,7}$"))
            .when(kind == 2, n.between(12, 19) & value.rlike("^[0-9 -]+$")).otherwise(phone))


def _core(value: Column) -> Column:
    """A value without the punctuation and the brackets around it that do not
    belong to it."""
    bare = F.regexp_replace(value, r"^[^\p{L}\p{N}+(]+|[^\p{L}\p{N})]+$", "")
    return _let(bare, lambda v: F.when(v.rlike(r"^\([^()]*\)$"), F.regexp_replace(v, "[()]", ""))
                .when(~F.contains(v, F.lit(")")), F.regexp_replace(v, r"^\(+", ""))
                .when(~F.contains(v, F.lit("(")), F.regexp_replace(v, r"[)\p{P}]+$", "")).otherwise(v))


def extract_entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the texts: ``(doc_id, key, base, seeds, candidates)``
    with the sorted base spans, and per seed and candidate its value, kind
    (seeds), place and lexical patterns.  ``key`` is a hash of id and text."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("key"),
                    text_or_empty(text).alias("text"))
    names = {k: f"_{k}" for k in KINDS}
    d = _with_base(d, "text", names)
    d = d.withColumn("base", _tagged(names))
    d = _matches(d, "text", _CANDIDATE, "_words", F.col("text").rlike("[0-9@]"))
    d = _matches(d, "text", _GROUPS, "_groups", F.col("text").rlike("[0-9)] [0-9]"))
    d = d.withColumn("_groups", _free(F.filter("_groups", lambda g: F.contains(g["value"], F.lit(" ")) & F.length(
        _digits(g["value"])).between(7, 19)), "base"))
    d = d.withColumn("_words", F.concat(_free(_free(F.col("_words"), "base"), "_groups"), F.col("_groups")))
    d = d.withColumn("_pieces", F.when(
        (F.size("base") > 0) | (F.size("_words") > 0),
        _pieces(F.col("text"))))
    t = F.col("_pieces")

    def seeds_of(i: int) -> Column:
        return F.transform(F.col(names[KINDS[i]]), lambda s: F.struct(
            F.lit(i).alias("kind"), s["value"].alias("value"), _sides(t, s["start"], s["end"]).alias("patterns")))

    seeds = F.concat(*map(seeds_of, range(len(KINDS))))
    def candidate(w: Column) -> Column:
        def placed(v: Column) -> Column:
            start = w["start"] + F.instr(w["value"], v) - 1
            return F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value"),
                            _sides(t, w["start"], w["end"]).alias("patterns"))

        return _let(_core(w["value"]), placed)

    candidates = F.transform("_words", candidate)
    return d.select("doc_id", "key", "base", seeds.alias("seeds"), candidates.alias("candidates"))


def _unlike(every: DataFrame) -> DataFrame:
    """How many values of a pattern lack a kind's shape: ``(pattern, kind, unlike)``."""
    kinds = F.explode(F.array(*map(F.lit, range(len(KINDS))))).alias("kind")
    return (every.select("pattern", "value", kinds).where(~_shape(F.col("kind"), F.col("value")))
            .groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("unlike")))


def _named(places: DataFrame, frequent: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The patterns that name identifiers, ``(pattern)``: of those in
    ``frequent``, whose word stands beside one in at least half its places."""
    of = F.substring("pattern", F.lit(2), F.length("pattern")).alias("word")
    frequent = materialize(frequent.select("pattern", of), "pii-frequent")
    word = F.explode(F.split(F.lower(F.col(text)), f"{_BLANK}+")).alias("word")
    # Only words of these patterns (by a filter of fixed size) are counted.
    total = (keep_known(docs.select(word), "word", frequent.select("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("total")))
    beside = places.groupBy("pattern").agg(F.count(F.lit(1)).alias("beside")).join(frequent, "pattern")
    j = beside.join(total, "word")
    return j.where(2 * F.col("beside") >= F.col("total")).select("pattern")


def _used(known: DataFrame, shaped: DataFrame, unlike: DataFrame, named: DataFrame, support: int,
          confidence: float) -> DataFrame:
    """The patterns to use: ``(pattern, kind, reliability)``."""
    kinds = F.explode(F.array(*map(F.lit, range(len(KINDS))))).alias("kind")
    each = known.groupBy("pattern", "value").agg(F.collect_set("kind").alias("of")).select("pattern", "value", "of", kinds)
    good = F.array_contains("of", F.col("kind"))
    count = each.groupBy("pattern", "kind").agg(
        F.count_if(good).alias("good"), F.count_if(~good & _shape(F.col("kind"), F.col("value"))).alias("bad"),
        F.count_if(good & ~_shape(F.col("kind"), F.col("value"))).alias("odd"))
    j = count.where(F.col("good") >= support).join(unlike, ["pattern", "kind"], "left")
    # Known values that lack the loose shape (base spans) speak for it.
    against = F.col("bad") + F.coalesce("unlike", F.lit(0)) - F.col("odd")
    j = j.where(F.col("good") >= confidence * (F.col("good") + against + 1))
    j = j.join(shaped, ["pattern", "kind"], "left").join(named.withColumn("named", F.lit(True)), "pattern", "left")
    share = F.col("good") / F.greatest(F.coalesce("shaped", F.lit(0)) + F.col("odd"), F.col("good"))
    return j.select("pattern", "kind", F.when(F.col("named"), 1.0).otherwise(share).alias("reliability"))


def discover(found: DataFrame, docs: DataFrame, text: str = "text", *, support: int = 5,
             confidence: float = 0.8) -> DataFrame:
    """New spans ``(key, start, kind, end)`` from written
    :func:`extract_entities` rows of ``docs``."""
    def edges(col: str, *fields: str) -> DataFrame:
        e = found.select("key", F.explode(col).alias("e"))
        return e.select("key", *[F.col(f"e.{f}").alias(f) for f in fields],
                        F.explode("e.patterns").alias("pattern"))

    # The graph has every (pattern, value) pair once, whatever its copies.
    seeds = edges("seeds", "kind", "value").select("pattern", "kind", "value").distinct()
    places = materialize(edges("candidates", "start", "end", "value").where(F.length("value") > 0), "pii-places")
    others = materialize(places.select("pattern", "value").distinct(), "pii-others")
    known = materialize(seeds, "pii-known")
    every = materialize(seeds.select("pattern", "value").union(others).distinct(), "pii-pairs")
    unlike = materialize(_unlike(every), "pii-unlike")
    kinds = F.explode(F.array(*map(F.lit, range(len(KINDS))))).alias("kind")
    shaped = materialize(every.select("pattern", "value", kinds).where(_shape(F.col("kind"), F.col("value")))
                         .groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("shaped")), "pii-shaped")
    frequent = every.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support).select("pattern")
    beside = places.select("pattern").union(edges("seeds", "value").select("pattern"))
    named = materialize(_named(beside, frequent, docs, text), "pii-named")
    size = known.count()
    while True:  # known values only grow
        used = materialize(_used(known, shaped, unlike, named, support, confidence), "pii-used")
        doubt = F.sum(F.log(F.greatest(1 - F.col("reliability"), F.lit(1e-9))))
        accepted = (others.join(used, "pattern").where(_shape(F.col("kind"), F.col("value")))
                    .groupBy("value", "kind").agg(doubt.alias("doubt"))
                    .where(F.exp("doubt") <= 0.5 + 1e-9).select("value", "kind"))
        # An accepted value is known at all its patterns.
        more = others.join(accepted, "value").select("pattern", "kind", "value")
        grown = materialize(known.union(more).distinct(), "pii-known")
        n = grown.count()
        release(known)
        release(used)
        known = grown
        if n == size:
            break
        size = n
    values = known.select("value", "kind").distinct()
    out = places.join(values, "value").where(_shape(F.col("kind"), F.col("value")))
    return out.select("key", "start", "kind", "end").distinct()


@tidy
def personal_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **opts) -> DataFrame:
    """``(doc_id, key, base, spans)`` for every row: arrays of (start, kind,
    end), sorted; ``spans`` holds the base spans and the discovered ones."""
    found = materialize(extract_entities(docs, doc_id, text), "pii-found")
    new = discover(found, docs, text, **opts).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("new"))
    new = materialize(new, "pii-new")
    j = found.join(new, "key", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("new", none)))
    return j.select("doc_id", "key", "base", spans.alias("spans"))


@tidy
def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **opts) -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in brackets;
    spans that overlap the one before extend it."""
    key, spans = fresh(docs, "_key"), fresh(docs, "_spans")
    per = personal_spans(docs, doc_id, text, **opts).where(F.size("spans") > 0)
    per = per.groupBy(F.col("key").alias(key)).agg(F.first("spans").alias(spans))
    per = materialize(per, "pii-spans")
    t, kinds = F.col(text), F.array(*map(F.lit, KINDS))

    def rewritten(pieces: Column, ends: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(ends, i - 1), F.lit(0))
            piece = F.concat(_between(pieces, at, s["start"]), F.lit("["), F.element_at(kinds, s["kind"] + 1), F.lit("]"))
            return F.when(s["start"] >= at, piece).otherwise(F.lit(""))

        return F.concat(F.array_join(F.transform(F.col(spans), part), ""),
                        _between(pieces, F.element_at(ends, -1), F.length(t)))

    whole = _let(_pieces(t), lambda p: _let(_ends(F.col(spans)), lambda e: rewritten(p, e)))
    j = docs.withColumn(key, F.xxhash64(doc_id, text)).join(per, key, "left")
    new = F.when(F.col(spans).isNull(), t).otherwise(whole)
    return j.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint").alias(f"n_{KINDS[i]}")

    return got.select("doc_id", *map(count, range(len(KINDS))), F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                      _written(F.col("spans")).alias("spans"))
