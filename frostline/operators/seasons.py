"""Season-shaped views of a daily series: winter offsets, matrices, rotated climatologies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.functions import values as val
from frostline.functions.joins import join_null_safe
from frostline.operators import ordered as o
from frostline.operators.quality import DailyRules


def winter_offset(processed: DataFrame, keys: Sequence[str], day: str = "d",
                  rules: DailyRules = DailyRules()) -> DataFrame:
    """Per-winter sensor offset and the series without it.

    Quiet winter samples are averaged over December to February, the mean is assigned to
    December to April of the same winter, interpolated between winters and subtracted. All
    steps are windows on the keys, so this extends the quality chain without an exchange.
    Expects t_processed, dt and d2t.
    """
    t = F.col("t_processed")
    quiet = val.drop_where(val.drop_where(t, F.abs("dt") > rules.quiet_eps), F.abs("d2t") > rules.quiet_eps)
    quiet = val.drop_where(quiet, t > rules.quiet_max)
    month, year = F.month(day), F.year(day)
    framed = (
        processed.withColumn("_winter", cal.winter_year(F.col(day)))
        .withColumn("_quiet", F.when(month.isin(12, 1, 2), quiet))
        .withColumn("_last", F.max(year).over(Window.partitionBy(*keys)))
    )
    # The December after the last full year starts a winter nothing is known about yet.
    assigned = month.isin(12, 1, 2, 3, 4) & (F.col("_winter") <= F.col("_last"))
    mean = F.avg("_quiet").over(Window.partitionBy(*keys, "_winter"))
    framed = framed.withColumn("_offset", mean).withColumn("_offset", F.when(assigned, F.col("_offset")))
    framed, axis = o.with_axis(framed, keys, day)
    out = framed.withColumn("t_winter_offset", o.interpolate(F.col("_offset"), axis))
    out = out.withColumn("t_no_offset", val.clamp_min0(t - F.col("t_winter_offset")))
    return o.drop_axis(out).drop("_winter", "_quiet", "_last", "_offset")


def remove_mean_offset(current: DataFrame, offsets: DataFrame, keys: Sequence[str], value: str = "t",
                       offset: str = "t_winter_offset", out: str = "t_no_offset") -> DataFrame:
    """Running season: the mean of all known offsets is subtracted, negatives become 0."""
    mean = offsets.groupBy(*keys).agg(F.avg(offset).alias("_mean_offset"))
    joined = join_null_safe(current, mean, list(keys), "left")
    return joined.withColumn(out, val.clamp_min0(F.col(value) - F.col("_mean_offset"))).drop("_mean_offset")


def season_slice(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """Rows with their season and position; a season has 365 positions from July 1."""
    season = cal.season_of(F.col(day))
    placed = df.select(*keys, season.alias("season"), cal.season_position(F.col(day), season).alias("pos"),
                       F.col(value).alias(value))
    return placed.where(F.col("pos").between(0, cal.SEASON_DAYS - 1))


def pad_season(sliced: DataFrame, keys: Sequence[str], value: str = "t") -> DataFrame:
    """All 365 positions of every season present; positions without a day are missing.

    Each season is folded into a map of at most 365 entries and unfolded over the fixed
    positions: the padding needs no grid join.
    """
    days = F.map_from_entries(F.collect_list(F.struct("pos", value)))
    folded = sliced.groupBy(*keys, "season").agg(days.alias("_days"))
    positions = F.sequence(F.lit(0), F.lit(cal.SEASON_DAYS - 1))
    return folded.select(*keys, "season", F.explode(positions).alias("pos"), "_days").select(
        *keys, "season", "pos", F.try_element_at("_days", F.col("pos")).alias(value)
    )


def season_matrix(df: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """Long season matrix: one row per (season, position)."""
    return pad_season(season_slice(df, keys, day, value), keys, value)


def season_arrays(sliced: DataFrame, keys: Sequence[str], value: str = "t", out: str = "days") -> DataFrame:
    """One array of 365 values per season, missing positions NULL; the input has a row per position at most."""
    folded = sliced.groupBy(*keys, "season").agg(F.collect_list(F.struct("pos", value)).alias("_days"))
    array = by_position(F.col("_days"), value)
    return folded.select(*keys, cal.season_label(F.col("season")).alias("season_label"), "season", array.alias(out))


def by_position(entries: Column, field: str) -> Column:
    """Array of 365 values from structs (pos, field): each entry is stretched up to the next one's position.

    Linear in the positions: the sorted entries are bound once, as the only element of an array,
    since an expression used inside a lambda is evaluated for every element.
    """
    def place(s: Column) -> Column:
        missing = F.when(F.lit(False), F.get(s, F.lit(0))[field])

        def stretch(x: Column, i: Column) -> Column:
            until = F.coalesce(F.get(s, i + 1)["pos"], F.lit(cal.SEASON_DAYS))
            return F.concat(F.array(x[field]), F.array_repeat(F.when(F.lit(False), x[field]), (until - x["pos"] - 1).cast("int")))

        lead = F.array_repeat(missing, F.get(s, F.lit(0))["pos"].cast("int"))
        return F.concat(lead, F.flatten(F.transform(s, stretch)))

    return F.transform(F.array(F.sort_array(entries)), place)[0]


def rotate_climatology(clim: DataFrame, doy: str = "doy") -> DataFrame:
    """Climatology on the July-to-June axis; day 366 is dropped."""
    return clim.withColumn("pos", cal.climatology_position(F.col(doy))).where(F.col("pos").isNotNull())


def fill_with_climatology(series: DataFrame, keys: Sequence[str], first: str, last: str, day: str = "d",
                          value: str = "t") -> DataFrame:
    """Fill a stretch without data by the day-of-year mean; stored days win.

    The climatology has one row per (keys, day of year); the stretch is generated from it,
    so filling costs one aggregate of the data.
    """
    begin, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    # One day per year of the stretch and climatology row. Day 366 is dropped there and not by a
    # filter, so that both readings of the series stay the same plan and share its exchange.
    clim = series.groupBy(*keys, F.dayofyear(day).alias("_doy")).agg(F.avg(value).alias(value))
    own = F.transform(F.sequence(F.year(begin), F.year(end)), lambda y: F.date_add(F.make_date(y, F.lit(1), F.lit(1)), F.col("_doy") - 1))
    matching = F.filter(own, lambda d: d.between(begin, end) & (F.col("_doy") <= cal.SEASON_DAYS))
    stretch = clim.select(*keys, F.explode(matching).alias(day), value)
    both = series.select(*keys, day, value, F.lit(0).alias("_rank")).unionByName(
        stretch.withColumn("_rank", F.lit(1))
    )
    known = F.when(F.col(value).isNotNull(), F.col("_rank"))
    return both.groupBy(*keys, day).agg(F.min_by(value, known).alias(value))
