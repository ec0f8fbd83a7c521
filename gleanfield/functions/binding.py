"""Naming an intermediate value inside an expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once per row.

    A value used in several places of an expression, or inside a lambda, would be worked
    out again for each use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
