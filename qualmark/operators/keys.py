"""Joins on key columns that treat NULL as a value, as grouping does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Like ``left.join(right, keys, how)``, but NULL keys meet NULL keys."""
    names = {k: f"__join{i}" for i, k in enumerate(keys)}
    on = F.lit(True)
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())
