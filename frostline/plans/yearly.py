"""Yearly preprocessing: quality control, winter offset, freeze-up dates, predictors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.functions.joins import join_null_safe
from frostline.functions import values as val
from frostline.operators import aggregate as agg
from frostline.operators import align, ensemble, quality, seasons
from frostline.operators.quality import DailyRules
from frostline.session import Stage, materialise
from frostline.sources import grid


def processed_series(daily: DataFrame, keys: Sequence[str], rules: DailyRules = DailyRules()) -> DataFrame:
    """Daily series with t_processed, t_winter_offset and t_no_offset.

    ``daily`` has one row per calendar day. Everything is a window on the keys: one exchange.
    """
    checked = quality.quality_chain(daily, keys, rules=rules)
    return seasons.winter_offset(checked, keys, rules=rules).drop("dt", "d2t")


def observed_freeze_up(processed: DataFrame, keys: Sequence[str], value: str = "t_no_offset",
                       rules: DailyRules = DailyRules()) -> DataFrame:
    flag = val.threshold_flag(F.col(value), rules.threshold)
    return agg.freeze_up_table(processed, keys, "d", flag)


# Predictor, its calendar month and its reduction.
PREDICTORS = (("t2m", 12, "mean"), ("sf", 11, "sum"), ("tcc", 9, "mean"))


def monthly_predictors(analysis: DataFrame, cell_keys: Sequence[str] = ()) -> DataFrame:
    """Long table (season, variable, value) from gridded analysis rows variable, valid_time, value.

    Space is averaged per time stamp first (the cells of one stamp may be incomplete), then
    time is averaged or summed. All predictors share one pass; rows outside a predictor's
    month are filtered before the first shuffle. Summed variables are accumulations stamped
    at the end of their interval and move half an hour back into it.
    """
    month_of, method_of = (
        F.create_map(*[F.lit(x) for row in PREDICTORS for x in (row[0], row[i])])[F.col("variable")] for i in (1, 2)
    )
    summed = method_of == "sum"
    rows = analysis.where(F.col("variable").isin([name for name, _, _ in PREDICTORS])).withColumn(
        "_t", F.when(summed, cal.shift_minutes(F.col("valid_time"), -30)).otherwise(F.col("valid_time"))
    )
    keys = [*cell_keys, "variable"]
    stamps = agg.spatial_mean(rows.where(F.month("_t") == month_of), [*keys, "_t"])
    folded = stamps.groupBy(*keys, F.year("_t").alias("season")).agg(
        F.avg("value").alias("_mean"), F.sum("value").alias("_sum")
    )
    return folded.select(*keys, "season", F.when(summed, F.col("_sum")).otherwise(F.col("_mean")).alias("value"))


def stored_predictors(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """monthly_predictors from a stored analysis, opening each predictor's own months only: its calendar month and, for
    accumulations, the one after, where the last stamp of the month lies."""
    branches = [grid.scan_analysis(spark, path, name, [month] if how == "mean" else [month, month % 12 + 1], years) for name, month, how in PREDICTORS]
    return monthly_predictors(grid.grid_in_celsius(grid.normalise_valid_time(align.stack(*branches))))


def training_table(predictors: DataFrame, freeze_up: DataFrame, keys: Sequence[str] = (), stage: Stage = materialise) -> DataFrame:
    """Wide predictors per season with the freeze-up day number, over the shared seasons.

    ``keys`` tell the freeze-up series apart; each gets the predictors of its own shared seasons.

    Both tables have one row per season but come from whole grids and series, so they are
    written before their bounds and rows are read.
    """
    wide = stage(ensemble.widen(predictors, ["season"], [name for name, _, _ in PREDICTORS]), "predictors")
    observed = stage(freeze_up.select(*keys, "season", "fudoy"), "freeze-up")
    if not keys:
        return align.common_period(wide, observed, "season")
    bounds = wide.agg(F.struct(F.min("season").alias("lo"), F.max("season").alias("hi"))).scalar()
    lo, hi = F.greatest("_lo", bounds["lo"]), F.least("_hi", bounds["hi"]) + 1
    spans = observed.groupBy(*keys).agg(F.min("season").alias("_lo"), F.max("season").alias("_hi"))
    spans = spans.where(lo <= hi).select(*keys, F.explode(F.sequence(lo, hi)).alias("season"))
    return join_null_safe(spans.join(wide, "season"), observed, [*keys, "season"], "left")
