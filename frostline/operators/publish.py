"""Chart-ready views and JSON artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.operators import aggregate as agg
from frostline.operators import seasons


def climatology_arrays(series: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t") -> DataFrame:
    """Arrays clim, lo and band on the July-to-June axis (365 entries), with the date axis."""
    rotated = seasons.rotate_climatology(agg.climatology(series, keys, day, value))
    positions = F.sequence(F.lit(0), F.lit(cal.SEASON_DAYS - 1))
    folded = rotated.groupBy(*keys).agg(F.collect_list(F.struct("pos", "clim", "lo", "band")).alias("_m"))

    def column(name: str):
        return seasons.by_position(F.col("_m"), name).alias(name)

    dates = F.transform(positions, lambda p: cal.doy_to_monthday(p + cal.CLIMATOLOGY_FIRST_DOY))
    return folded.select(*keys, dates.alias("date"), column("clim"), column("lo"), column("band"))


def freeze_up_labels(fuds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Season label to MM-dd of the freeze-up."""
    return fuds.select(*keys, cal.season_label(F.col("season")).alias("season_label"),
                       F.date_format("fud", "MM-dd").alias("monthday"))


def series_json(series: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                shown: DataFrame | None = None) -> DataFrame:
    """One JSON object per series: date axis, climatology envelope and one array per season.

    The seasons come from ``shown`` (same columns) where given, the climatology always from
    ``series``. A document is bounded by the calendar (365 numbers per season), not by the
    sample count.
    """
    placed = seasons.season_slice(series if shown is None else shown, keys, day, value)
    per_season = seasons.season_arrays(placed, keys, value)
    by_season = per_season.groupBy(*keys).agg(
        F.sort_array(F.collect_list("season_label")).alias("years"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("season_label", "days")))).alias("seasons"),
    )
    document = climatology_arrays(series, keys, day, value).join(by_season, list(keys))
    body = F.to_json(
        F.struct("date", "years", "clim", F.col("lo").alias("clim-std"), F.col("band").alias("clim+std"), "seasons"),
        {"ignoreNullFields": "false"},
    )
    return document.select(*keys, body.alias("json"))


def freeze_up_json(fuds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON object per series: season label to MM-dd, plus the mean day under ``clim``.

    The mean is taken over common-year day numbers, as the labels carry no year.
    """
    known = fuds.where(F.col("fud").isNotNull())
    entries = F.collect_list(F.struct(cal.season_label(F.col("season")).alias("label"),
                                      F.date_format("fud", "MM-dd").alias("monthday")))
    mean = cal.doy_to_monthday(F.bround(F.avg(cal.common_year_number(F.col("fud"))), 0))
    folded = known.groupBy(*keys).agg(F.sort_array(entries).alias("_e"), mean.alias("_mean"))
    whole = F.concat("_e", F.array(F.struct(F.lit("clim").alias("label"), F.col("_mean").alias("monthday"))))
    return folded.select(*keys, F.to_json(F.map_from_entries(whole)).alias("json"))


def latest_json(latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Issue date and forecast date of the newest forecast; expects issued, season and fud."""
    body = F.to_json(F.struct(
        F.date_format("issued", "yyyy-MM-dd").alias("latestForecastIssued"),
        F.date_format(cal.fudoy_to_date(F.col("fud"), F.col("season")), "yyyy-MM-dd").alias("latestForecast"),
    ))
    return latest.select(*keys, body.alias("json"))


def export_json(documents: DataFrame, path: str) -> None:
    """Write one JSON document per line, in parallel."""
    documents.select("json").write.mode("overwrite").text(path)
