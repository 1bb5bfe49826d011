"""Numeric column helpers with engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col: Column | str, digits: int) -> Column:
    """Round like pandas/Python ``round``: scale, round half to even, unscale.

    ``rint`` works on the binary double, so the result does not depend on a
    decimal re-rendering of the value (``round``/``bround`` do).
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(col) * scale) / scale


def round_half_up(col: Column | str, digits: int) -> Column:
    """``ROUND`` for non-negative inputs the way SQLite does it."""
    c = _c(col)
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def exact_sum(col: Column | str, scale: int = 6) -> Column:
    """Sum as a decimal so the total is exact and independent of partitioning."""
    return F.sum(_c(col).cast(f"decimal(38,{scale})"))


def to_double(col: Column | str) -> Column:
    """Numeric coercion: anything unparsable and NaN become null."""
    return F.nanvl(_c(col).try_cast("double"), F.lit(None).cast("double"))
