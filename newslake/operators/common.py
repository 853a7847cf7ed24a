"""Small helpers shared by the operators."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("source", "category")
ORDER = ("pos",)


def place(order) -> Column:
    """The listing order as one comparable value; smaller is newer."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def same(left: DataFrame, right: DataFrame, columns) -> Column:
    """Equality on ``columns``; a source without categories has NULL there, and NULLs match."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def attach(left: DataFrame, right: DataFrame, columns, how="left") -> DataFrame:
    """Join on ``columns`` (NULL-safe) and keep one copy of them."""
    joined = left.join(right, same(left, right, columns), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[right[c] for c in columns])
