"""Outlier, jump and stuck-sensor masks.

Every mask of the daily chain is a window over the series' keys, so the chain needs one
exchange. A mask only ever removes values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions import values as val
from frostline.functions.joins import join_null_safe
from frostline.operators import ordered as o
from frostline.operators.first import first_rows
from frostline.session import Stage, materialise


@dataclass(frozen=True)
class DailyRules:
    """Defaults of the yearly quality chain (fixed values of the method)."""

    constant_eps: float = 0.1      # |dT| per derivative unit below which a sensor looks stuck
    constant_above: float = 2.0    # only above this temperature
    constant_min_len: int = 7      # days
    sigma: float = 5.0
    max_gap_days: int = 7
    unit_days: float = 2.0         # derivatives are per two days
    quiet_max: float = 2.0         # winter samples used for the sensor offset
    quiet_eps: float = 0.1
    threshold: float = 0.75        # freezing


@dataclass(frozen=True)
class RawRules:
    """Defaults of the high-rate chain (fixed values of the method)."""

    max_per_hour: float = 1.0
    upper: float = 30.0
    deviation: float = 3.0
    two_sided: bool = False


def derivatives(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                unit_days: float = 2.0) -> DataFrame:
    """First and second derivative of the forward-filled daily series, as dt and d2t."""
    framed, axis = o.with_axis(df, keys, day)
    hs, hd = o.spacing(axis, int(unit_days * o.MICROS[o.DAY]))
    out = framed.select("*", o.ffill(F.col(value), axis).alias("_filled"), hs.alias("_hs"), hd.alias("_hd"))
    for source, name in (("_filled", "dt"), ("dt", "d2t")):
        out = out.withColumn(name, o.differentiate(F.col(source), axis, F.col("_hs"), F.col("_hd")))
    return o.drop_axis(out).drop("_filled", "_hs", "_hd")


def mask_constant_runs(df: DataFrame, keys, day="d", source="t", value="t_processed", eps=0.1, above=2.0,
                       min_len=7) -> DataFrame:
    """Runs of at least min_len days with almost no change above a temperature become missing."""
    framed, axis = o.with_axis(df, keys, day)
    flag = F.coalesce((F.abs("dt") < eps) & (F.col(source) > above), F.lit(False))
    out = framed.withColumn("_flag", flag)
    run, length = o.run_length(F.col("_flag"), axis)
    out = out.withColumn("_run", run).withColumn("run_len", F.when(F.col("_flag"), length).otherwise(F.lit(0)))
    out = out.withColumn(value, val.drop_where(F.col(value), F.col("run_len") >= min_len))
    return o.drop_axis(out).drop("_flag", "_run")


def mask_jumps(df: DataFrame, keys, value="t_processed") -> DataFrame:
    """Drop values whose second derivative exceeds its mean magnitude plus one spread."""
    whole = Window.partitionBy(*keys)
    limit = F.avg(F.abs("d2t")).over(whole) + F.stddev_pop("d2t").over(whole)
    out = df.withColumn("_limit", limit)
    return out.withColumn(value, val.drop_where(F.col(value), F.abs("d2t") > F.col("_limit"))).drop("_limit")


def mask_sigma(df: DataFrame, keys, day="d", value="t_processed", sigma=5.0) -> DataFrame:
    """Drop values further from the day-of-year mean than sigma times the mean spread."""
    # (keys, doy) is clustered by the keys already, so these windows re-sort and do not shuffle;
    # one ordering serves all three.
    by_doy = Window.partitionBy(*keys, "_doy").orderBy(day)
    all_years = by_doy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    framed = df.withColumn("_doy", F.dayofyear(day))
    out = framed.select(
        "*", F.avg(value).over(all_years).alias("_mean"), F.stddev_pop(value).over(all_years).alias("_sd"),
        F.row_number().over(by_doy).alias("_nth"),
    )
    spread = F.avg(F.when(F.col("_nth") == 1, F.col("_sd"))).over(Window.partitionBy(*keys))
    out = out.withColumn("_spread", spread)
    far = F.abs(F.col(value) - F.col("_mean")) > sigma * F.col("_spread")
    return out.withColumn(value, val.drop_where(F.col(value), far)).drop("_doy", "_mean", "_sd", "_nth", "_spread")


def mask_spikes(df: DataFrame, keys, day="d", value="t", limit=6.0, upper=30.0, unit_days=2.0,
                out="t_masked", block: str | None = o.AUTO, stage: Stage = materialise) -> DataFrame:
    """Keep values that change at most ``limit`` per unit and stay within the upper bound.

    A missing derivative loses the value. Series of time stamps are read block by block.
    """
    framed, axis = o.with_axis(df, keys, day, o.block_for(df, day, block), stage=stage)
    framed = o.attach_carry(framed, axis, value, stage)
    hs, hd = o.spacing(axis, int(unit_days * o.MICROS[o.DAY]))
    framed = framed.select("*", o.ffill(F.col(value), axis).alias("_filled"), hs.alias("_hs"), hd.alias("_hd"))
    framed = framed.withColumn("_dt", o.differentiate(F.col("_filled"), axis, F.col("_hs"), F.col("_hd")))
    ok = (F.abs("_dt") <= limit) & val.within_upper(F.col(value), upper)
    return o.drop_axis(framed.withColumn(out, val.keep_where(F.col(value), ok))).drop(
        "_filled", "_hs", "_hd", "_dt")


def quality_chain(daily: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                  rules: DailyRules = DailyRules()) -> DataFrame:
    """The yearly chain on a full daily calendar; adds dt, d2t and t_processed.

    Derivatives come from the raw forward-filled series; the spread test sees the series
    already masked.
    """
    out = derivatives(daily, keys, day, value, rules.unit_days).withColumn("t_processed", F.col(value))
    out = mask_constant_runs(out, keys, day, value, "t_processed", rules.constant_eps, rules.constant_above,
                             rules.constant_min_len).drop("run_len")
    out = mask_jumps(out, keys)
    out = mask_sigma(out, keys, day, sigma=rules.sigma)
    out = out.withColumn("t_processed", val.clamp_min0(F.col("t_processed")))
    framed, axis = o.with_axis(out, keys, day)
    gap = rules.max_gap_days * o.MICROS[o.DAY]
    return o.drop_axis(framed.withColumn("t_processed", o.interpolate(F.col("t_processed"), axis, gap)))


# --- raw grain -------------------------------------------------------------------------


def dedupe_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order."""
    return first_rows(df, key, order)


def mask_own_day_deviation(df: DataFrame, keys: Sequence[str], time: str, value: str, limit: float = 3.0,
                           two_sided: bool = False, out: str = "t_kept", stage: Stage = materialise) -> DataFrame:
    """Keep samples less than ``limit`` above the mean of their own calendar day.

    The day means are an aggregate joined back, one row per (keys, day): a crowded day is
    combined in the mappers, and where the means are small the samples are never shuffled.
    """
    framed = df.withColumn("_day", F.to_date(time))
    means = framed.groupBy(*keys, "_day").agg(F.avg(value).alias("_day_mean"))
    gap = F.col(value) - F.col("_day_mean")
    ok = (F.abs(gap) if two_sided else gap) < limit
    joined = join_null_safe(framed, stage(means, "day-means"), [*keys, "_day"], "left")
    return joined.withColumn(out, val.keep_where(F.col(value), ok)).drop("_day", "_day_mean")


def mask_stuck_samples(df: DataFrame, keys: Sequence[str], time: str, value: str, eps: float, above: float, min_len: int,
                       out: str = "t_kept", block: str | None = o.AUTO, stage: Stage = materialise) -> DataFrame:
    """Runs of at least ``min_len`` samples that change less than ``eps`` per hour above a temperature become missing.

    The rate is the derivative of the forward-filled series. Adds ``out`` and run_len, the samples in the row's run,
    also where the run crosses blocks. Samples must have unique time stamps per series.
    """
    framed, axis = o.with_axis(df, keys, time, o.block_for(df, time, block), stage=stage)
    framed = o.attach_carry(framed, axis, value, stage)
    hs, hd = o.spacing(axis, o.MICROS[o.HOUR])
    framed = framed.select("*", o.ffill(F.col(value), axis).alias("_filled"), hs.alias("_hs"), hd.alias("_hd"))
    rate = o.differentiate(F.col("_filled"), axis, F.col("_hs"), F.col("_hd"))
    framed = framed.withColumn("_flag", (F.abs(rate) < eps) & (F.col(value) > above)).drop("_filled", "_hs", "_hd", "_carry")
    runs = o.stitched_runs(framed, "_flag", axis, "run_len", stage)
    kept = val.drop_where(F.col(value), F.col("run_len") >= min_len)
    return o.drop_axis(runs.withColumn(out, kept)).drop("_flag")


def raw_quality_chain(samples: DataFrame, keys: Sequence[str], time: str = "ts", value: str = "t",
                      rules: RawRules = RawRules(), block: str = "hour", stage: Stage = materialise) -> DataFrame:
    """Spike mask, own-day deviation and interpolation of a high-rate series, as t_clean.

    Samples must have unique time stamps per series. Two passes of windows over (keys,
    block), with the masked samples written out between them since the day means, the second
    carry table and the final pass all read them.
    """
    framed, axis = o.with_axis(samples, keys, time, block, stage=stage)
    out = o.attach_carry(framed, axis, value, stage)
    hs, hd = o.spacing(axis, o.MICROS[o.HOUR])
    out = out.select("*", o.ffill(F.col(value), axis).alias("_filled"), hs.alias("_hs"), hd.alias("_hd"))
    out = out.withColumn("_rate", o.differentiate(F.col("_filled"), axis, F.col("_hs"), F.col("_hd")))
    ok = (F.abs("_rate") < rules.max_per_hour) & val.within_upper(F.col(value), rules.upper, inclusive=False)
    calm = stage(out.withColumn("t_clean", val.keep_where(F.col(value), ok)).drop(
        "_filled", "_hs", "_hd", "_rate", "_carry"), "calm")
    near = mask_own_day_deviation(calm, keys, time, "t_clean", rules.deviation, rules.two_sided, "t_clean", stage)
    near = o.attach_carry(near, axis, "t_clean", stage)
    return o.drop_axis(near.withColumn("t_clean", o.interpolate(F.col("t_clean"), axis)))
