"""Climatology kept up to date: moments per (keys, day of year) that are merged, never read again from the series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline import session
from frostline.sources import tables


def day_moments(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """keys, doy, n, mean, m2 (sum of squares about the mean), lo and hi of the known values."""
    v = F.col(value)
    known = df.where(v.isNotNull()).groupBy(*keys, F.dayofyear(day).alias("doy"))
    return known.agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(F.lit(1))).alias("m2"), F.min(v).alias("lo"), F.max(v).alias("hi"))


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of disjoint parts as those of the whole, by pairwise updating; a group has a row per part."""
    part = F.struct("n", "mean", "m2")
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a, b):
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))

    merged = parts.groupBy(*keys, "doy").agg(F.aggregate(F.array_sort(F.collect_list(part)), zero, add).alias("_m"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.select(*keys, "doy", "_m.n", "_m.mean", "_m.m2", "lo", "hi")


def climatology_of(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of ``aggregate.climatology``: clim, sd, lo, hi and band."""
    return moments.select(*keys, "doy", F.col("mean").alias("clim"), F.sqrt(F.col("m2") / F.col("n")).alias("sd"), "lo", "hi", (F.col("hi") - F.col("lo")).alias("band"))


def mean_spread(moments: DataFrame, keys: Sequence[str], out: str = "mean_sd") -> DataFrame:
    """Mean of the days' spreads, as ``aggregate.mean_of_group_std`` gives for groups by day of year."""
    return climatology_of(moments, keys).groupBy(*keys).agg(F.avg("sd").alias(out))


def moments_table(path: str, keys: Sequence[str], day: str = "d", value: str = "t"):
    """Sink that adds a batch of new days to the stored moments. Each day must come in one batch only, as closed days do;
    a repeated batch starts again from the version before it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, fresh = batch.sparkSession, day_moments(batch, keys, day, value)
        if batch_id > 0:
            fresh = fresh.unionByName(tables.read_table(spark, path, fresh.schema, batch_id))
        tables.write_table(merge_moments(session.materialise(fresh, "moments"), keys), path, batch_id + 1)
        tables.keep_versions(spark, path, 2)

    return write
