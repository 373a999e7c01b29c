"""Numeric column helpers.

Rounding follows pandas/NumPy: ``round(x, d) == rint(x * 10**d) / 10**d`` (half to even
on the scaled value). Spark's ``round`` rounds half up on the decimal expansion and
``bround`` rounds the decimal value half-even, and both differ from NumPy on values
such as 417.985 (NumPy: 417.98, ``round``: 417.99).

Money is summed as DECIMAL so that totals do not depend on partitioning or on the
order in which partial aggregates are merged; it is turned into DOUBLE once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(15, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c: Column | str, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def round2(c: Column | str) -> Column:
    return round_to(c, 2)


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def ceil_div(a: Column, b: Column) -> Column:
    """Integer ceiling of a / b for a >= 0 and b > 0, as LONG.

    The quotient is taken in DOUBLE; operands stay far below 2**53 (ranks times the
    number of tiles), where the floor of the correctly rounded quotient is exact.
    """
    return F.floor((a.cast("long") + b.cast("long") - F.lit(1)) / b.cast("long")).cast("long")


def quantile_tile(rank: Column | str, n: Column | str, tiles: int = 5) -> Column:
    """Quantile bin (1..tiles) of a dense rank 1..n, equal to pandas ``qcut(rank, tiles)``.

    ``qcut`` puts the edges at ``1 + (n-1)*k/tiles``; rank r falls in bin
    ``ceil(tiles*(r-1)/(n-1))`` with r = 1 in bin 1. This is not ``ntile``: for n = 7
    ``qcut`` gives 1,1,2,3,4,5,5 and ``ntile(5)`` gives 1,1,2,2,3,4,5. For n <= 1
    (where ``qcut`` raises) every row gets bin 1.
    """
    r = _col(rank).cast("long")
    m = _col(n).cast("long") - F.lit(1)
    tile = F.greatest(F.lit(1).cast("long"), ceil_div(F.lit(tiles) * (r - F.lit(1)), m))
    return F.when(m > 0, tile).otherwise(F.lit(1)).cast("int")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (ANSI mode raises otherwise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def exact_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum of values with at most ``scale`` decimals, exact, returned as DOUBLE."""
    return F.sum(_col(c).cast(DecimalType(18, scale))).cast("double")


def exact_mean(c: Column | str, scale: int = 2) -> Column:
    """Mean from an exact decimal sum and a count: independent of partitioning."""
    return safe_ratio(F.sum(_col(c).cast(DecimalType(18, scale))), F.count(_col(c)))
