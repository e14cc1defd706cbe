"""Null-safe arithmetic used by the control limits and scores."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_LOG_2PI = 0.5 * math.log(2.0 * math.pi)


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(num, den)


def binomial_sigma(p: Column, n: Column) -> Column:
    """``sqrt(p(1-p)/n)``, NULL when ``n`` is zero."""
    return F.sqrt(safe_div(p * (F.lit(1.0) - p), n.cast("double")))


def z_score(pi: Column, p: Column, sigma: Column) -> Column:
    """``(pi-p)/sigma``; NULL when sigma is zero (p = 0 or 1)."""
    return safe_div(pi - p, sigma)
