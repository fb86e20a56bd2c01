"""From stored grids to the daily and monthly tables of a forecast, for many regions at once.

Two clocks are kept in one aggregate. Accumulations are stamped at the end of their interval, so for full
months a stamp belongs to half an hour before; partly observed months go by days as stamped. Both come
from the same rows per (region, variable, day): the part of a day's stamps that the other clock counts
to the day before is held beside the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions import calendar as cal
from frostline.operators import aggregate as agg
from frostline.operators.regions import assign_regions
from frostline.plans import forecast as fc
from frostline.plans.yearly import PREDICTORS
from frostline.session import Stage, materialise
from frostline.sources import grid

# Fixed values of the analysis.
HOURLY = 24         # stamps of a complete day
SHIFT_MINUTES = 30  # from the stamp at the end of an interval into it

FOLDER = ["variable", "year", "month"]


def method_of(variable: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for name, _, how in PREDICTORS for x in (name, how)]), variable)


def _folders(rows: DataFrame, day: Column) -> DataFrame:
    return rows.select("variable", F.year(day).alias("year"), F.month(day).alias("month"))


def analysis_folders(rules: DataFrame) -> DataFrame:
    """Folders of the analysis that the rules read: the target month where it is due or partly observed, and
    of accumulations the month after, which opens with the last stamp of the target month."""
    read = rules.where(F.col("variable").isin(list(fc.NAMES)) & (F.col("analysis_due") | F.col("observed_until").isNotNull()))
    after = read.where(F.col("method") == "sum")
    return _folders(read, F.col("target")).union(_folders(after, F.add_months("target", 1))).distinct()


def forecast_folders(rules: DataFrame) -> DataFrame:
    """Folders of the forecasts (by month of the issue) that the rules may read."""
    return _folders(rules.where(F.col("variable").isin(list(fc.NAMES))), F.col("forecast_issue")).distinct()


def read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: DataFrame) -> DataFrame:
    """Rows of the listed (variable, year, month) folders. The list is a staged table with a row per folder, so it is
    known only when the job runs; the scan then opens no other folder (dynamic partition pruning)."""
    wanted = folders.where(F.col("variable").isin(list(fc.NAMES)))
    return spark.read.schema(schema).parquet(path).join(wanted, FOLDER, "left_semi")


def region_stamps(cells: DataFrame, regions: DataFrame, keys: Sequence[str] = (), stage: Stage = materialise) -> DataFrame:
    """Mean over the cells of every region: region, variable, further keys, valid_time, value (in degrees Celsius where it was Kelvin)."""
    rows = grid.grid_in_celsius(grid.normalise_valid_time(cells))
    placed = assign_regions(rows.select("variable", *keys, "valid_time", "lat", "lon", "value"), regions, stage=stage)
    return agg.spatial_mean(placed, ["region", "variable", *keys, "valid_time"])


def two_clock_days(stamps: DataFrame, keys: Sequence[str], time: str = "valid_time", value: str = "value",
                   shift_minutes: int = SHIFT_MINUTES) -> DataFrame:
    """Per (keys, d): stamps and total of the day, and the part of them that the shifted clock counts to the day before."""
    early = F.to_date(cal.shift_minutes(F.col(time), -shift_minutes)) < F.to_date(time)
    known = stamps.where(F.col(value).isNotNull())
    return known.groupBy(*keys, F.to_date(time).alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.count_if(early).alias("early_n"), F.sum(F.when(early, F.col(value))).alias("early"))


def observed_days(days: DataFrame, keys: Sequence[str], per_day: int = HOURLY) -> DataFrame:
    """Daily mean or sum, by the variable's method, of the days as stamped that are complete: keys, d, value."""
    value = F.when(method_of(F.col("variable")) == "sum", F.col("total")).otherwise(F.col("total") / F.col("n"))
    return days.where(F.col("n") == per_day).select(*keys, "d", value.alias("value"))


def full_months(days: DataFrame, keys: Sequence[str], per_day: int = HOURLY) -> DataFrame:
    """Monthly mean of the stamped clock or sum of the shifted one, of months with all their stamps: keys, target, value."""
    summed = method_of(F.col("variable")) == "sum"
    here, before = F.trunc("d", "month").cast("date"), F.trunc(F.date_sub("d", 1), "month").cast("date")
    part = lambda month, n, total: F.struct(month.alias("target"), n.alias("n"), total.alias("total"))
    early = F.coalesce("early", F.lit(0.0))
    moved = F.array(part(here, F.col("n") - F.col("early_n"), F.col("total") - early), part(before, F.col("early_n"), early))
    parts = F.when(summed & (F.col("early_n") > 0), moved).otherwise(F.array(part(here, F.col("n"), F.col("total"))))
    months = days.select(*keys, F.explode(parts).alias("part")).select(*keys, "part.*")
    folded = months.groupBy(*keys, "target").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    complete = folded.where(F.col("n") == per_day * F.dayofmonth(F.last_day("target")))
    return complete.select(*keys, "target", F.when(summed, F.col("total")).otherwise(F.col("total") / F.col("n")).alias("value"))


def forecast_input(spark: SparkSession, rules: DataFrame, regions: DataFrame, analysis_path: str, forecast_path: str,
                   per_day: int = HOURLY, stage: Stage = materialise) -> DataFrame:
    """Predictor rows per region and issue from stored grids; only the folders that the rules name are read."""
    keys = ["region", "variable"]
    rules = stage(rules, "issue-rules")
    cells = read_folders(spark, analysis_path, grid.ANALYSIS_SCHEMA, stage(analysis_folders(rules), "analysis-folders"))
    days = stage(two_clock_days(region_stamps(cells, regions, stage=stage), keys), "region-days")
    cells = read_folders(spark, forecast_path, grid.FORECAST_SCHEMA, stage(forecast_folders(rules), "forecast-folders"))
    leads = region_stamps(cells, regions, ["issue_time", "number"], stage)
    leads = leads.select(*keys, F.to_date("issue_time").alias("issue"), "number", F.to_date("valid_time").alias("d"), "value")
    return fc.forecast_input(rules, observed_days(days, keys, per_day), leads, stage, ["region"], full_months(days, keys, per_day))
