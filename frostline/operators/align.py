"""Merging and aligning labelled series.

Merges stack their inputs and reduce by label instead of joining them: the reduction
combines map-side, takes any number of inputs in one shuffle, and a crowded label does not
meet its copies in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.joins import join_null_safe
from frostline.operators import ordered as o
from frostline.operators.first import first_rows
from frostline.session import Stage, materialise


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def merge_no_conflict(frames: Sequence[DataFrame], on: Sequence[str], value: str = "t") -> DataFrame:
    """Outer merge by label; values given twice must agree, else the job fails."""
    both = stack(*[f.select(*on, value) for f in frames]).groupBy(*on).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    label = F.concat_ws(" ", *[F.col(c).cast("string") for c in on])
    clash = F.raise_error(F.concat(F.lit("conflicting values at "), label))
    agreed = F.when(F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi")), F.col("_lo"))
    return both.select(*on, agreed.otherwise(clash.cast("double")).alias(value))


def insert_only_merge(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union by label where the stored record wins, whatever its value."""
    both = stored.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    return first_rows(both, key, ["_rank"]).drop("_rank")


def rows_to_insert(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Only the new records whose label is not stored: what an append has to write."""
    return join_null_safe(new, stored.select(*key), list(key), "left_anti")


def prefer_source(sources: Sequence[tuple[str, DataFrame]], on: Sequence[str], value: str = "value") -> DataFrame:
    """Per label the value of the first listed source that has one, with that source's name."""
    ranked = [f.select(*on, value, F.lit(i).alias("_rank")) for i, (_, f) in enumerate(sources)]
    best = first_rows(stack(*ranked).where(F.col(value).isNotNull()), on, ["_rank"])
    names = F.array(*[F.lit(name) for name, _ in sources])
    return best.select(*on, value, F.get(names, F.col("_rank")).alias("source"))


def require_labels(df: DataFrame, required: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """Keep the required labels and fail the job on one without a value."""
    joined = required.select(*on).join(df, list(on), "left")
    label = F.concat_ws(" ", *[F.col(c).cast("string") for c in on])
    missing = F.raise_error(F.concat(F.lit("not found: "), label)).cast("double")
    return joined.withColumn(value, F.coalesce(F.col(value), missing))


def align_left(base: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Bring the other table onto the base's labels; labels it lacks are missing."""
    return base.join(other, list(on), "left")


def common_period(base: DataFrame, other: DataFrame, on: str, extra: int = 1) -> DataFrame:
    """Base labels in the shared period, reaching ``extra`` labels beyond its end, aligned left.

    The bounds are scalar subqueries: evaluated once, then pushed down as plain filters.
    """
    ours, theirs = (
        f.agg(F.struct(F.min(on).alias("lo"), F.max(on).alias("hi"))).scalar() for f in (base, other)
    )
    lo, hi = F.greatest(ours["lo"], theirs["lo"]), F.least(ours["hi"], theirs["hi"]) + extra
    return align_left(
        base.where((F.col(on) >= lo) & (F.col(on) <= hi)),
        other.where((F.col(on) >= lo) & (F.col(on) <= hi)), [on],
    )


def anomaly(df: DataFrame, keys: Sequence[str], group: Column, value: str, out: str = "anomaly") -> DataFrame:
    """Value minus the mean of its group, as an aggregate joined back."""
    framed = df.withColumn("_g", group)
    means = framed.groupBy(*keys, "_g").agg(F.avg(value).alias("_mean"))
    joined = join_null_safe(framed, means, [*keys, "_g"], "left")
    return joined.withColumn(out, F.col(value) - F.col("_mean")).drop("_g", "_mean")


def nearest_join(targets: DataFrame, data: DataFrame, keys: Sequence[str], time: str, value: str,
                 max_dist: float | None = None, unit: str = o.DAY, block: str | None = o.AUTO,
                 out: str = "nearest", stage: Stage = materialise) -> DataFrame:
    """For every target label the value at the nearest label of the same keys, looking both ways.

    Ties take the earlier label. Targets and data are stacked and each target reads its
    known neighbours, so no pair of rows is ever formed; with ``block`` long series are
    split in time like any other ordered operator (by default those of time stamps).
    """
    block = o.block_for(targets, time, block)
    known = data.where(F.col(value).isNotNull()).select(*keys, time, value, F.lit(False).alias("_target"))
    asked = targets.select(*keys, time, F.lit(None).cast("double").alias(value), F.lit(True).alias("_target"))
    stacked = known.unionByName(asked).groupBy(*keys, time).agg(
        F.min(value).alias(value), F.max("_target").alias("_target")
    )
    if block:
        stacked = stage(stacked, "stacked-labels")  # counted, summarised and read again below
    framed, axis = o.with_axis(stacked, keys, time, block, stage=stage)
    framed = o.attach_carry(framed, axis, value, stage)
    p0, v0, p1, v1 = o.bracket(F.col(value), axis)
    framed = framed.select(*keys, time, "_target", "_pos", p0.alias("p0"), v0.alias("v0"), p1.alias("p1"),
                           v1.alias("v1")).where("_target")
    pos = F.col("_pos")
    earlier = F.col("p1").isNull() | (pos - F.col("p0") <= F.col("p1") - pos)
    label_pos = F.when(earlier, F.col("p0")).otherwise(F.col("p1"))
    found = F.when(earlier, F.col("v0")).otherwise(F.col("v1"))
    if max_dist is not None:
        near = F.abs(label_pos - pos) <= int(max_dist * o.MICROS[unit])
        label_pos, found = F.when(near, label_pos), F.when(near, found)
    label = F.date_from_unix_date((label_pos / o.MICROS["day"]).cast("int")) \
        if targets.schema[time].dataType.typeName() == "date" else F.timestamp_micros(label_pos)
    return framed.select(*keys, time, label.alias("label"), found.alias(out))


def latest_of_feeds(feeds: Sequence[tuple[str, DataFrame]], keys: Sequence[str], issued: str = "issued",
                    value: str = "fud", number: str = "number", tie: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Newest ensemble-mean forecast over all feeds; on one date the first listed feed wins. ``carry``: further columns of it."""
    ranked = [
        f.where(F.col(number) == 0).select(*keys, issued, value, *tie, *carry, F.lit(name).alias("feed"),
                                          F.lit(len(feeds) - i).alias("_rank"))
        for i, (name, f) in enumerate(feeds)
    ]
    newest = F.max_by(F.struct(issued, "feed", value, *carry), F.struct(issued, "_rank", *tie)).alias("_row")
    best = stack(*ranked).groupBy(*keys).agg(newest)
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (issued, "feed", value, *carry)])
