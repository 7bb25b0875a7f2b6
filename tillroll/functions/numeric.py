"""Numeric column functions (NUM-*, CND-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_numeric(c) -> Column:
    """NUM-1: coerce to double, unparseable -> NULL (ANSI-safe)."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def line_revenue(price="price", quantity="quantity") -> Column:
    """NUM-2: price x quantity, exact on DECIMAL prices."""
    return _col(price) * _col(quantity)


def ratio(num, den) -> Column:
    """NUM-4: double ratio of two aggregates; 0 denominator -> NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def sign_bucket(c) -> Column:
    """NUM-7: '< 0' / '= 0' / '> 0', NULL stays NULL."""
    x = _col(c)
    return F.when(x < 0, "< 0").when(x == 0, "= 0").when(x > 0, "> 0")


def r_round(c, digits: int = 0) -> Column:
    """NUM-6: R's round() is half-to-even, i.e. Spark ``bround``."""
    return F.bround(_col(c), digits)


def label_threshold(c, threshold, high="High", low="Normal", op: str = ">=") -> Column:
    """CND-1: two-way label by a threshold column or value."""
    x, t = _col(c), threshold if isinstance(threshold, Column) else F.lit(threshold)
    test = {">=": x >= t, ">": x > t, "<=": x <= t, "<": x < t}[op]
    return F.when(test, F.lit(high)).otherwise(F.lit(low))
