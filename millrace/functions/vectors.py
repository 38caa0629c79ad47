"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import let


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalise(vector: Column) -> Column:
    """Unit vector; the zero vector stays zero."""
    return let(
        l2_norm(vector),
        lambda n: F.transform(vector, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double"))),
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
