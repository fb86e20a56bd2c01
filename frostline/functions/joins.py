"""Joins that keep rows with NULL keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet; the columns of ``left`` come first, the keys once."""
    renamed = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns])
    matched = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(renamed, matched, how).drop(*[f"_on_{c}" for c in on])
