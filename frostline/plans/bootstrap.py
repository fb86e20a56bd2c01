"""First build of the permanent daily series from its historical pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.operators import aggregate as agg
from frostline.operators import align, quality, seasons
from frostline.operators.first import first_rows
from frostline.session import Stage, materialise
from frostline.sources import tables


def historical_daily(sheet: DataFrame, keys: Sequence[str], time: str = "ts", value: str = "t") -> DataFrame:
    """Daily means of the old record on the full calendar."""
    return agg.resample_daily(sheet, keys, time, value)


def bridge_gap(daily: DataFrame, keys: Sequence[str], first: str, last: str, limit: float = 6.0,
               upper: float = 30.0) -> DataFrame:
    """Fill a stretch without data by the climatology of the outlier-free record.

    The climatology is computed from the masked series, the stored series keeps its own values.
    """
    smooth = quality.mask_spikes(daily, keys, limit=limit, upper=upper).select(*keys, "d", F.col("t_masked").alias("t"))
    filled = seasons.fill_with_climatology(smooth, keys, first, last)
    extension = filled.where(F.col("d").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    # A known stored value comes first, then the climatology, then a stored missing day.
    stored = daily.select(*keys, "d", "t", F.when(F.col("t").isNotNull(), 0).otherwise(2).alias("_rank"))
    both = stored.unionByName(extension.select(*keys, "d", "t", F.lit(1).alias("_rank")))
    return first_rows(both, [*keys, "d"], ["_rank"]).drop("_rank")


def permanent_series(pieces: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Merge the pieces by day; two pieces may share a day only with the same value."""
    return align.merge_no_conflict(pieces, [*keys, "d"], "t")


def initial_series(sheet: DataFrame, logger: DataFrame, untimed: DataFrame, keys: Sequence[str],
                   gap: tuple[str, str], logger_period: tuple[str, str], stage: Stage = materialise) -> DataFrame:
    """Old record, bridged gap, logger export and untimed files as one daily series.

    All inputs have keys, ts and t. The old record is read for its climatology and for itself,
    so its daily form is written once.
    """
    old = stage(historical_daily(sheet, keys), "historical-daily")
    recent = agg.resample_daily(tables.slice_time(logger, "ts", *logger_period), keys, "ts", "t")
    newest = agg.resample_daily(untimed, keys, "ts", "t")
    return permanent_series([bridge_gap(old, keys, *gap), recent, newest], keys)
