"""Registration helper and output form shared by all queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form: doubles rounded (sums depend on their order in the last bits), dates as text."""
    shaped = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind == "double":
            column = F.round(column, digits) + F.lit(0.0)
        elif kind == "date":
            column = column.cast("string")
        shaped.append(column.alias(field.name))
    return df.select(*shaped)


def query(name: str, sql: str | None = None, digits: int = 6) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return tidy(build(spark, sf_dir), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
