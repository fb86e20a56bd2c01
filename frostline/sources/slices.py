"""A few days of a stored series with what the ordered operators need to know around them.

A table stored by day (``d=...`` folders) is read for the wanted days and, to either side, folder by folder until
every series has a row and a known value there: first the next day, then twice as many at a time. A day is
thereby recomputed without reading its whole series, and dense series cost one more day on each side. Other columns
(``also``) go with the rows of the days; the rows around them have none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions.joins import join_null_safe
from frostline.session import Stage, materialise


def stored_days(spark: SparkSession, path: str, day: str = "d") -> list[dt.date]:
    """Days of the table from the names of its folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in system.listStatus(root) if entry.isDirectory()]
    return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{day}=") and n[len(day) + 1:len(day) + 2].isdigit())


class SliceReader:
    """Reads slices of one table; ``opened`` lists the days it has read."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], time: str, value: str, day: str = "d",
                 stage: Stage = materialise, also: Sequence[str] = ()):
        self.also = list(also)
        self.spark, self.path, self.keys, self.time, self.value, self.day, self.stage = spark, path, list(keys), time, value, day, stage
        self.schema = schema if day in schema.fieldNames() else T.StructType([*schema.fields, T.StructField(day, T.DateType())])
        self.opened: list[dt.date] = []

    def days(self, days: Sequence[dt.date]) -> DataFrame:
        self.opened += days
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col(self.day).isin(list(days)))

    def around(self, asked: DataFrame, days: list[dt.date], last: bool) -> list[DataFrame]:
        """Per series of ``asked`` the nearest row and the nearest known row in ``days``, which come nearest first."""
        pick = F.max_by if last else F.min_by
        row = F.struct(self.time, self.value, self.day)
        seen = F.when(F.col(self.value).isNotNull(), F.col(self.time))
        found, count = [], 1
        while days and not asked.isEmpty():
            some, days, count = days[:count], days[count:], 2 * count
            rows = join_null_safe(self.days(some).where(F.col(self.time).isNotNull()), asked, self.keys, "inner")
            near = rows.groupBy(*self.keys).agg(pick(row, F.col(self.time)).alias("any"), pick(row, seen).alias("known"))
            near = self.stage(near, "halo")
            found.append(near)
            asked = self.stage(join_null_safe(asked, near.where(F.col("known").isNotNull()).select(*self.keys), self.keys, "left_anti"), "halo-open")
        return found

    def read(self, first: dt.date, last: dt.date) -> DataFrame:
        """Rows of the days from ``first`` to ``last`` and, outside them, the rows that fill, derivative and interpolation there depend on."""
        stored = stored_days(self.spark, self.path, self.day)
        names = [*self.keys, self.time, self.value, *self.also, self.day]
        none = [F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.also]
        inside = self.days([d for d in stored if first <= d <= last]).select(*names)
        asked = self.stage(inside.select(*self.keys).distinct(), "halo-keys")
        sides = [self.around(asked, [d for d in reversed(stored) if d < first], True), self.around(asked, [d for d in stored if d > last], False)]
        out = inside
        for found, pick in zip(sides, (F.max_by, F.min_by)):
            if not found:
                continue
            every = found[0]
            for more in found[1:]:
                every = every.unionByName(more)
            nearest = every.groupBy(*self.keys).agg(pick("any", F.col(f"any.{self.time}")).alias("any"), pick("known", F.col(f"known.{self.time}")).alias("known"))
            rows = nearest.select(*self.keys, F.explode(F.array_distinct(F.array_compact(F.array("any", "known")))).alias("row"))
            out = out.unionByName(rows.select(*self.keys, "row.*", *none).select(*names))
        return out
