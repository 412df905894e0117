"""Rounding as the recorded tables have it."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2**27 + 1)


def round_half_even(x: Column, digits: int) -> Column:
    """Round the exact binary value of a double; true ties go to the even digit.

    Spark's own ``round`` looks at the shortest decimal text of a double, so
    2.675 (stored as 2.67499...) becomes 2.68 there and 2.67 here. The value
    is compared with the midpoint of its two neighbours without rounding
    error: a Veltkamp split leaves two halves whose products with the small
    scale are exact.
    """
    scale = float(10**digits)
    x = x.cast("double")
    below = F.floor(x * scale).cast("double")
    high = x * _SPLIT - (x * _SPLIT - x)
    beyond_midpoint = (high * (2 * scale) - (below * 2.0 + 1.0)) + (x - high) * (2 * scale)
    return F.rint(below + 0.5 + F.signum(beyond_midpoint) * 0.5) / scale
