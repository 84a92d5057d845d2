"""Rounding and clamps."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from velocube.functions._util import col


def round_py(x, digits: int = 1) -> Column:
    """Half-to-even rounding (Python ``round``)."""
    return F.bround(col(x), digits)


def round_js(x, digits: int = 1) -> Column:
    """Half-up rounding as ``Math.round(x * 10**d) / 10**d``."""
    s = float(10 ** digits)
    return F.floor(col(x) * s + F.lit(0.5)) / F.lit(s)


def clamp0(x) -> Column:
    return F.greatest(col(x), F.lit(0.0))
