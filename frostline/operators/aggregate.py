"""Reductions over time, space and members.

All of them are hash aggregates with map-side combine, so a key holding a large share of
the rows is reduced inside its mappers before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions import calendar as cal


def fill_calendar(daily: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                  empty: float | None = None) -> DataFrame:
    """Emit the missing days between the first and last day of every series.

    Each stored day is stretched up to the day before its successor, so no grid is built
    and joined back; the input must hold one row per (keys, day). Where it does not, every
    row of the day stays and none is made up.
    """
    order = Window.partitionBy(*keys).orderBy(day)
    until = F.greatest(F.date_sub(F.lead(day).over(order), 1), F.col(day))
    stretched = daily.select(*keys, F.col(day).alias("_own"), F.col(value).alias("_value"), until.alias("_until"))
    days = stretched.select(*keys, "_own", "_value", F.explode(F.sequence("_own", "_until")).alias(day))
    filled = F.when(F.col(day) == F.col("_own"), F.col("_value"))
    if empty is not None:
        filled = filled.otherwise(F.lit(empty))
    return days.select(*keys, day, filled.alias(value))


def daily_reduce(df: DataFrame, keys: Sequence[str], time: str, value: str, how: str = "mean",
                 out: str = "t", day: str = "d") -> DataFrame:
    """Calendar-day mean or sum, missing values skipped, days without samples absent."""
    reduce = {"mean": F.avg, "sum": F.sum}[how]
    return df.groupBy(*keys, F.to_date(time).alias(day)).agg(reduce(value).alias(out))


def resample_daily(df: DataFrame, keys: Sequence[str], time: str, value: str, how: str = "mean",
                   out: str = "t", day: str = "d") -> DataFrame:
    """Calendar-day reduction on the full calendar; empty days are NULL (mean) or 0 (sum)."""
    daily = daily_reduce(df, keys, time, value, how, out, day)
    if how == "sum":
        daily = daily.withColumn(out, F.coalesce(out, F.lit(0.0)))
    return fill_calendar(daily, keys, day, out, 0.0 if how == "sum" else None)


def complete_days(df: DataFrame, keys: Sequence[str], time: str, value: str, expected_hours: int = 24,
                  how: str = "mean", out: str = "t", day: str = "d") -> DataFrame:
    """Daily reduction of the days that have all expected hourly slots.

    The hours seen are one bit each of an integer: a distinct count without a second shuffle.
    """
    reduce = {"mean": F.avg, "sum": F.sum}[how]
    hours = F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.hour(time))))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.to_date(time).alias(day))
        .agg(hours.alias("hours"), reduce(value).alias(out))
        .where(F.col("hours") == expected_hours)
    )


def spatial_mean(df: DataFrame, keys: Sequence[str], value: str = "value", out: str = "value") -> DataFrame:
    """Unweighted mean over the cells sharing the keys."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def monthly_mean(df: DataFrame, keys: Sequence[str], time: str, value: str, months: Sequence[int] | None = None,
                 out: str = "value") -> DataFrame:
    """Mean over time and space per calendar month; unwanted months never reach the shuffle."""
    if months:
        df = df.where(F.month(time).isin(list(months)))
    return df.groupBy(*keys, F.year(time).alias("y"), F.month(time).alias("m")).agg(F.avg(value).alias(out))


def monthly_sum(df: DataFrame, keys: Sequence[str], time: str, value: str, months: Sequence[int] | None = None,
                shift_minutes: int = -30, out: str = "value") -> DataFrame:
    """Mean over space per time stamp, then sum over the month.

    Accumulations are stamped at the end of their interval; the shift moves them into it.
    """
    shifted = df.withColumn("_t", cal.shift_minutes(F.col(time), shift_minutes) if shift_minutes else F.col(time))
    if months:
        shifted = shifted.where(F.month("_t").isin(list(months)))
    stamped = shifted.groupBy(*keys, "_t").agg(F.avg(value).alias("_v"))
    return stamped.groupBy(*keys, F.year("_t").alias("y"), F.month("_t").alias("m")).agg(F.sum("_v").alias(out))


def climatology(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """Mean, spread, minimum and band (max - min) per day of year, in one pass."""
    v = F.col(value)
    return (
        df.groupBy(*keys, F.dayofyear(day).alias("doy"))
        .agg(F.avg(v).alias("clim"), F.stddev_pop(v).alias("sd"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        .withColumn("band", F.col("hi") - F.col("lo"))
    )


def jump_threshold(value: Column) -> Column:
    """Aggregate: mean of the magnitude plus the spread of the signed value."""
    return F.avg(F.abs(value)) + F.stddev_pop(value)


def mean_of_group_std(df: DataFrame, keys: Sequence[str], group: Column, value: str, out: str = "mean_sd") -> DataFrame:
    """Spread per group, then its plain mean over the groups."""
    per_group = df.groupBy(*keys, group.alias("_g")).agg(F.stddev_pop(value).alias("_sd"))
    return per_group.groupBy(*keys).agg(F.avg("_sd").alias(out))


def seasonal_mean_djf(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                      label_days: int = 45, out: str = "t") -> DataFrame:
    """December-to-February mean per winter, labelled in the middle of the winter."""
    winter = df.where(F.month(day).isin(12, 1, 2))
    return winter.groupBy(*keys, F.date_add(cal.quarter_from_december(F.col(day)), label_days).alias("label")).agg(
        F.avg(value).alias(out)
    )


def ensemble_mean(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean over the members that share the keys."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def value_nearest(df: DataFrame, keys: Sequence[str], day: str, target: Column, value: str,
                  out: str = "value") -> DataFrame:
    """Per group the value whose label lies nearest to the target; ties take the earlier label."""
    rank = F.struct(F.abs(F.date_diff(F.col(day), target)).alias("gap"), F.col(day).alias("label"))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.col(value), rank).alias(out), F.min(rank)["label"].alias("label")
    )


def value_at_month_end(df: DataFrame, keys: Sequence[str], day: str, value: str, month_start: str,
                       out: str = "value") -> DataFrame:
    """Accumulated variable read at the label nearest to the last day of its target month."""
    return value_nearest(df, [*keys, month_start], day, F.last_day(F.col(month_start)), value, out)


def first_crossing(df: DataFrame, keys: Sequence[str], day: str, flag: Column) -> DataFrame:
    """First flagged day per winter (November 1, May 31]; NULL when a winter has none.

    Winters run from the year a series starts to the year before it ends.
    """
    whole = Window.partitionBy(*keys)
    rows = df.select(
        *keys, F.col(day).alias("_d"), flag.alias("_flag"), cal.winter_season(F.col(day)).alias("season"),
        F.min(F.year(day)).over(whole).alias("_first"), F.max(F.year(day)).over(whole).alias("_last"),
    )
    inside = rows.where((F.col("season") >= F.col("_first")) & (F.col("season") < F.col("_last")))
    return inside.groupBy(*keys, "season").agg(F.min(F.when(F.col("_flag") == 1, F.col("_d"))).alias("fud"))


def freeze_up_table(df: DataFrame, keys: Sequence[str], day: str, flag: Column,
                    fixed_year_length: bool = False) -> DataFrame:
    """First crossing per winter with its day number."""
    crossed = first_crossing(df, keys, day, flag)
    return crossed.withColumn("fudoy", cal.fudoy(F.col("fud"), F.col("season"), fixed_year_length))


def mean_freeze_up(fuds: DataFrame, keys: Sequence[str], fudoy: str = "fudoy") -> DataFrame:
    """Mean day number, rounded half to even, and its month and day."""
    mean = F.bround(F.avg(fudoy), 0).cast("int")
    return fuds.groupBy(*keys).agg(mean.alias("mean_fudoy")).withColumn(
        "monthday", cal.doy_to_monthday(F.col("mean_fudoy"))
    )


def series_summary(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """First and last label with their values, and the years spanned; no sort needed."""
    return df.groupBy(*keys).agg(
        F.min(day).alias("first_d"), F.min_by(value, day).alias("first_t"),
        F.max(day).alias("last_d"), F.max_by(value, day).alias("last_t"),
        F.min(F.year(day)).alias("min_year"), F.max(F.year(day)).alias("max_year"),
    )
