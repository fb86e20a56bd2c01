"""Ensemble forecasts: splicing observations in, member fallback, member tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def splice_mean(forecast: DataFrame, observed: DataFrame, keys: Sequence[str], day: str = "d",
                value: str = "value", obs: str = "obs") -> DataFrame:
    """Every member takes the observed value on the observed days."""
    seen = observed.select(*keys, day, F.col(obs).alias("_obs"))
    joined = forecast.join(seen, [*keys, day], "left")
    return joined.withColumn(value, F.coalesce("_obs", value)).drop("_obs")


def splice_cumulative(forecast: DataFrame, observed: DataFrame, keys: Sequence[str], member: Sequence[str],
                      day: str = "d", value: str = "value", obs: str = "obs") -> DataFrame:
    """Replace the observed stretch of an accumulated forecast and carry the change onward.

    Up to the last observed day the member becomes its base plus the running observed sum;
    later days keep their daily increments. The base is the member's value on the day before
    the first observation, or 0 when the forecast starts in the month of the observations
    (their days before the first lead then count in the sum only).

    ``keys`` name the observed series, ``member`` the columns that make one forecast of it
    unique. A forecast has a few hundred leads, so the anchors are windows over one member.
    """
    by_key = Window.partitionBy(*keys).orderBy(day)
    running = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = observed.where(F.col(obs).isNotNull()).select(
        *keys, F.col(day).alias("_own"),
        F.sum(obs).over(running).alias("_sum"),
        F.coalesce(F.date_sub(F.lead(day).over(by_key), 1), F.col(day)).alias("_until"),
        F.min(day).over(Window.partitionBy(*keys)).alias("_i1"),
        F.max(day).over(Window.partitionBy(*keys)).alias("_i2"),
    )
    sums = steps.select(*keys, F.explode(F.sequence("_own", "_until")).alias(day), "_sum")
    ends = steps.groupBy(*keys).agg(F.min("_i1").alias("_i1"), F.max("_i2").alias("_i2"))

    one = Window.partitionBy(*keys, *member)
    d, v = F.col(day), F.col(value)
    joined = forecast.join(ends, list(keys), "left").join(sums, [*keys, day], "left")
    same_month = F.trunc(F.min(d).over(one), "month") >= F.trunc("_i1", "month")
    before = F.max_by(v, F.when(d < F.col("_i1"), d)).over(one)
    base = F.when(same_month, F.lit(0.0)).otherwise(F.coalesce(before, F.lit(0.0)))
    at_end = F.when(d <= F.col("_i2"), d)
    framed = joined.withColumn("_base", base).withColumn("_old", F.max_by(v, at_end).over(one)).withColumn(
        "_new", F.col("_base") + F.max_by(F.col("_sum"), at_end).over(one)
    )
    spliced = (
        F.when(d < F.col("_i1"), v)
        .when(d <= F.col("_i2"), F.coalesce(F.col("_base") + F.col("_sum"), v))
        .otherwise(F.coalesce(v - F.col("_old") + F.col("_new"), v))
    )
    return framed.withColumn(value, spliced).drop("_i1", "_i2", "_sum", "_base", "_old", "_new")


def widen(df: DataFrame, keys: Sequence[str], names: Sequence[str], variable: str = "variable",
          value: str = "value") -> DataFrame:
    """One column per variable, from given names: a conditional aggregate, one shuffle."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(variable) == n, F.col(value))).alias(n) for n in names])


def member_fallback(members: DataFrame, mean: DataFrame, keys: Sequence[str], names: Sequence[str],
                    number: str = "number") -> DataFrame:
    """Wide predictor rows, member 0 being the mean; what a member lacks comes from the mean."""
    wide = widen(members, [*keys, number], names)
    mean_wide = widen(mean, keys, names)
    fallback = mean_wide.select(*keys, *[F.col(n).alias(f"_mean_{n}") for n in names])
    filled = wide.join(fallback, list(keys), "left").select(
        *keys, number, *[F.coalesce(n, f"_mean_{n}").alias(n) for n in names]
    )
    return mean_wide.select(*keys, F.lit(0).cast(members.schema[number].dataType).alias(number), *names).unionByName(
        filled
    )


def pivot_members(log: DataFrame, keys: Sequence[str], numbers: Sequence[int], number: str = "number",
                  value: str = "fud") -> DataFrame:
    """Forecast log as a table with one column per member."""
    return log.groupBy(*keys).agg(*[
        F.max(F.when(F.col(number) == n, F.col(value))).alias(f"member_{n}") for n in numbers
    ])
