"""Column expressions for the message-line format.

A line is either a control message ``c<N>`` or a data message
``"u v;u v;...;u v"`` that lists edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the line format (must match the message protocol).
CONTROL_PREFIX = "c"
CONTROL_START = 1      # start listening for edges: a new round begins
CONTROL_FINISHED = 2   # round mapped: compute and write components
CONTROL_WRITTEN = 3    # components written: acknowledgement
CONTROL_SHUTDOWN = 4   # finished: stop
TEST_EXIT = "cTEST_EXIT"
EDGE_SEPARATOR = ";"
ID_SEPARATOR = " "

_INTEGER = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def integer_token(tok: Column) -> Column:
    """Token -> BIGINT, or NULL when it is not a plain integer that fits."""
    return F.when(tok.rlike(_INTEGER), tok.try_cast("bigint"))


def control_number(line: Column | str) -> Column:
    """The number after the control prefix, NULL when not a number."""
    rest = F.substring(_col(line), 2, 1 << 30)
    return F.when(rest.rlike(_INTEGER), rest.try_cast("int"))


def message_kind(line: Column | str) -> Column:
    """``data``, ``control``, ``exit`` (the test marker) or ``invalid``."""
    ln = _col(line)
    n = control_number(ln)
    is_c = ln.startswith(CONTROL_PREFIX)
    return (F.when(ln.isNull() | (ln == ""), F.lit("invalid"))
            .when(ln == TEST_EXIT, F.lit("exit"))
            .when(is_c & n.between(1, 4), F.lit("control"))
            .when(is_c, F.lit("invalid"))
            .otherwise(F.lit("data")))


def invalid_reason(line: Column | str) -> Column:
    ln = _col(line)
    n = control_number(ln)
    return (F.when(ln.isNull() | (ln == ""), F.lit("empty line"))
            .when(ln == TEST_EXIT, F.lit(None).cast("string"))
            .when(ln.startswith(CONTROL_PREFIX) & n.isNull(), F.lit("control is not a number"))
            .when(ln.startswith(CONTROL_PREFIX) & ~n.between(1, 4),
                  F.lit("unknown control message")))


def control_line(n: Column | int) -> Column:
    """Serialise a control message."""
    v = n if isinstance(n, Column) else F.lit(n)
    return F.concat(F.lit(CONTROL_PREFIX), v.cast("string"))


def edge_parts(line: Column | str) -> Column:
    """Edge parts of a data line.  Trailing separators are dropped, as the
    protocol's splitting does; an empty part elsewhere is kept (malformed)."""
    stripped = F.regexp_replace(_col(line), ";+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, EDGE_SEPARATOR))
