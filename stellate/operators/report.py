"""Reports on a labelling: attributes of components, printable lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_attributes(labels: DataFrame, attrs: DataFrame, key: str = "id",
                      columns: list[str] | None = None) -> DataFrame:
    """Inner equi-join of a labelling ``(id, cmp)`` with attribute rows on the
    vertex id; vertices or attribute rows without a partner drop out."""
    cols = columns if columns is not None else [c for c in attrs.columns if c != key]
    a = attrs.select(F.col(key).alias("id"), *cols)
    return labels.join(a, "id").select(*cols, "cmp")


def format_components(labels: DataFrame) -> DataFrame:
    """One printable line ``(vertex,component)`` per vertex."""
    return labels.select(F.format_string("(%d,%d)", F.col("id"), F.col("cmp")).alias("line"))
