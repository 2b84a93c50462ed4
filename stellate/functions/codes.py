"""Column functions for fixed-length digit codes.

A code is a string of decimal digits (``'09999'``); leading zeros matter.
All functions are JVM-side expressions; none runs Python per row.  The
higher-order array functions among them are interpreted inside the row, not
part of the generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value of the data model: shards are named "<prefix>_<index>" and the
# default prefix is this one.
DEFAULT_PREFIX = "connector"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits(uid: Column | str) -> Column:
    """string -> array<int> of its digits; a non-digit character gives NULL."""
    chars = F.split(_col(uid), "")
    return F.transform(chars, lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")))


def code_string(ds: Column | str) -> Column:
    """array<int> -> code string (inverse of :func:`digits`)."""
    return F.array_join(_col(ds), "")


def digit_sum(ds: Column | str) -> Column:
    """Sum of the digits."""
    return F.aggregate(_col(ds), F.lit(0), lambda acc, d: acc + d)


def is_valid(ds: Column | str) -> Column:
    """Every digit is in 0..9 (a NULL digit makes the code invalid)."""
    return F.coalesce(F.forall(_col(ds), lambda d: d.between(0, 9)), F.lit(False))


def shard_of(uid: Column | str) -> Column:
    """Shard index of a code: its first digit."""
    return F.substring(_col(uid), 1, 1).try_cast("int")


def shard_name(shard: Column | str, prefix: str = DEFAULT_PREFIX) -> Column:
    """Name of a shard: ``<prefix>_<index>``."""
    return F.concat(F.lit(prefix), F.lit("_"), _col(shard).cast("string"))


def shard_names(n_shards: int, prefix: str = DEFAULT_PREFIX) -> Column:
    """Array of the names of all ``n_shards`` shards, in index order."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                       lambda i: shard_name(i, prefix))


def code_of_number(n: Column | str, width: Column | int) -> Column:
    """Number -> code of ``width`` digits (zero padded).

    ``lpad`` would cut a longer number, so a number that does not fit gives
    NULL instead of a wrong code.
    """
    s = _col(n).cast("string")
    w = width if isinstance(width, Column) else F.lit(width)
    return F.when(F.length(s) <= w, F.lpad(s, w, "0"))
