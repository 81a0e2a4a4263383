"""Small numeric column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d in plain IEEE arithmetic.

    Used for presentation rounding of doubles: the same two operations give
    the same bits in every engine, unlike decimal-string based ``round``.
    """
    s = float(10 ** digits)
    return F.floor(col_(c).cast("double") * F.lit(s) + F.lit(0.5)) / F.lit(s)


def r6(c) -> Column:
    return round_half_up(c, 6)


def exact_mean(c, n=None) -> Column:
    """Mean of an exact (integer / decimal) column: exact sum, one division."""
    n = n if n is not None else F.count(col_(c))
    return F.sum(col_(c)).cast("double") / n


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(None)).otherwise(a / b)
