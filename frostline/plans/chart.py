"""Publication of the season chart: past seasons, the running season, freeze-up dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.operators import align, publish, seasons
from frostline.session import Stage, materialise


def shown_series(processed: DataFrame, updated: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """Past seasons without their own offset, the running season without the mean offset."""
    season = cal.season_of(F.lit(as_of).cast("date"))
    start = F.make_date(season, F.lit(cal.SEASON_START_MONTH), F.lit(1))
    past = processed.where(F.col("d") < start).select(*keys, "d", F.col("t_no_offset").alias("t"))
    running = updated.where((F.col("d") >= start) & (F.col("d") < F.lit(as_of).cast("date")))
    current = seasons.remove_mean_offset(running, processed, keys).select(*keys, "d", F.col("t_no_offset").alias("t"))
    return past.unionByName(current)


def chart_series(processed: DataFrame, updated: DataFrame, keys: Sequence[str], as_of: str,
                 stage: Stage = materialise) -> DataFrame:
    """JSON per series; the climatology ends with the June of the year before ``as_of``.

    The processed series is read three times, so it is written once.
    """
    processed = stage(processed, "processed")
    last = F.make_date(F.year(F.lit(as_of).cast("date")) - 1, F.lit(6), F.lit(30))
    known = processed.where(F.col("d") <= last).select(*keys, "d", F.col("t_no_offset").alias("t"))
    return publish.series_json(known, keys, shown=shown_series(processed, updated, keys, as_of))


def chart_freeze_up(observed: DataFrame, latched: DataFrame, forecast: DataFrame, keys: Sequence[str],
                    as_of: str) -> DataFrame:
    """Freeze-up per season: observed in the past; for the running season the latched date if
    the series is frozen, else the forecast. Columns of the result: keys, season, fud. In the first days of July the
    running season is still the old one."""
    running = cal.published_season(F.lit(as_of).cast("date"))
    past = observed.where(F.col("season") < running).select(*keys, "season", "fud")
    frozen = latched.where(F.col("season") == running).select(*keys, "season", F.col("frozen_date").alias("fud"))
    expected = forecast.where(F.col("season") == running).select(*keys, "season", F.col("fud_date").alias("fud"))
    now = align.prefer_source([("observed", frozen), ("forecast", expected)], [*keys, "season"], "fud")
    return past.unionByName(now.select(*keys, "season", "fud"))
