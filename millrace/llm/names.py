"""Columns by names as they are, a dot in them included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed_row(docs: DataFrame, without: str | None = None) -> Column:
    """All columns of ``docs`` but one as a struct; a struct needs a field, so there may be one that says nothing."""
    rest = [named(c) for c in docs.columns if c != without]
    return F.struct(*(rest or [F.lit(1).alias("none")]))


def unpacked_row(docs: DataFrame, row: str = "row", **others: Column) -> list[Column]:
    """The columns of ``docs`` in their order from a packed row; ``others`` stand for those it lacks."""
    return [(others[c] if c in others else F.col(row).getField(c)).alias(c) for c in docs.columns]
