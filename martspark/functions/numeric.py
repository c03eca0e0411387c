"""Rounding and safe arithmetic that agree across engines.

Money stays decimal while it is summed.  Ratios are taken in double and then
rounded through ``decimal(28,8)`` half-up, so Spark and any SQL engine that
follows the same recipe produce the same value bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def rnd(c: Column | str, scale: int) -> Column:
    """Half-up rounding of a double or decimal to ``scale`` places, as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(28,8)"), scale).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` in double, NULL when ``den`` is 0 or NULL."""
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def ratio_or(num: Column, den: Column, cond: Column, default: float, scale: int | None = None) -> Column:
    """``round(num/den)`` when ``cond`` holds, else ``default`` (pandas np.where)."""
    value = safe_div(num, den)
    if scale is not None:
        value = rnd(value, scale)
    return F.when(cond, value).otherwise(F.lit(float(default)))
