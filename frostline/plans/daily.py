"""Daily ingestion: quality control of new samples, daily means, freeze-up latch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.operators import aggregate as agg
from frostline.operators import align, quality
from frostline.operators.quality import RawRules
from frostline.session import Stage, materialise


def clean_samples(samples: DataFrame, keys: Sequence[str], time: str, value: str, order: Sequence[str],
                  rules: RawRules = RawRules(), block: str = "hour", stage: Stage = materialise) -> DataFrame:
    """Deduplicated samples with their cleaned value t_clean.

    The deduplicated samples are written once; the block counts, the carry table and the
    windows read them from there.
    """
    unique = quality.dedupe_keep_first(samples.select(*keys, time, value, *order), [*keys, time], order)
    unique = stage(unique.select(*keys, time, value), "unique-samples")
    return quality.raw_quality_chain(unique, keys, time, value, rules, block, stage)


def daily_from_samples(samples: DataFrame, keys: Sequence[str], time: str, value: str, order: Sequence[str],
                       rules: RawRules = RawRules(), block: str = "hour") -> DataFrame:
    """Daily means of the cleaned samples; a day without samples between others is missing."""
    clean = clean_samples(samples, keys, time, value, order, rules, block)
    return agg.resample_daily(clean, keys, time, "t_clean", "mean")


def update_daily(stored: DataFrame, samples: DataFrame, keys: Sequence[str], time: str, value: str,
                 order: Sequence[str], rules: RawRules = RawRules()) -> DataFrame:
    """Stored daily series plus the new days; a stored day is never changed."""
    new = daily_from_samples(samples, keys, time, value, order, rules).select(*keys, "d", "t")
    return align.insert_only_merge(stored.select(*keys, "d", "t"), new, [*keys, "d"])


def frozen_latch(daily: DataFrame, keys: Sequence[str], day: str = "d", value: str = "t",
                 threshold: float = 0.75) -> DataFrame:
    """First day below the threshold per season: the date the frozen flag is set."""
    below = daily.where(F.col(value) < threshold)
    return below.groupBy(*keys, cal.season_of(F.col(day)).alias("season")).agg(F.min(day).alias("frozen_date"))
