"""One row per label, the first in an order: the reduction behind duplicates and merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of every key that comes first; the order must be known and unique in a key.

    An aggregate rather than a ranking window: copies collapse inside the mappers, so a label
    repeated millions of times never meets in one task. With fixed-width columns and a single
    order column it is a hash aggregate; otherwise rows travel as structs, which Spark
    aggregates by sorting.
    """
    rest = [f for f in df.schema.fields if f.name not in key]
    hashed = len(order) == 1 and all(isinstance(f.dataType, _FIXED_WIDTH) for f in rest)
    if hashed:
        return df.groupBy(*key).agg(*[F.min_by(f.name, order[0]).alias(f.name) for f in rest])
    names = [f.name for f in rest]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_row"))
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in names])
