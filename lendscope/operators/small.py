"""Joins with small sides.

A side whose size is not known beforehand carries no hint: adaptive execution
looks at its size at run time and broadcasts or shuffles it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def known(df: DataFrame, n_rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a table whose row count is already known."""
    return F.broadcast(df) if n_rows <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL meets NULL; the left side's keys are kept."""
    r = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(r, on, how).drop(*[f"_right_{k}" for k in keys])
