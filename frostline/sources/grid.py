"""Gridded analysis and ensemble forecasts as long Parquet tables.

One row per (variable, valid time, cell[, member]); partitioned by variable, year and month
so that a request for one month of one variable opens one directory.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions import values as val

ANALYSIS_SCHEMA = T.StructType([
    T.StructField("variable", T.StringType()), T.StructField("ref_time", T.TimestampType()),
    T.StructField("step_h", T.IntegerType()), T.StructField("valid_time", T.TimestampType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("value", T.DoubleType()), T.StructField("units", T.StringType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
])
FORECAST_SCHEMA = T.StructType([
    *ANALYSIS_SCHEMA.fields[:-2], T.StructField("issue_time", T.TimestampType()),
    T.StructField("number", T.IntegerType()), *ANALYSIS_SCHEMA.fields[-2:],
])


@dataclass(frozen=True)
class Box:
    """Region of interest; the defaults are the fixed values of the original request."""

    lat_min: float = 43.25
    lat_max: float = 46.00
    lon_min: float = -77.25
    lon_max: float = -73.25


# Daily leads in hours.
LEADS = range(24, 5161, 24)


def write_grid(df: DataFrame, path: str, by: str = "valid_time") -> None:
    """Store a grid by variable, year and month (of the valid time, or of the issue)."""
    out = df.withColumn("year", F.year(by)).withColumn("month", F.month(by))
    # Rebalancing gathers the rows of a folder into few files and still splits a folder that is
    # too large for one task; writing as the rows come would make a file per task and folder.
    out.hint("rebalance", "variable", "year", "month").write.mode("overwrite").partitionBy("variable", "year", "month").parquet(path)


def scan_analysis(spark: SparkSession, path: str, variable: str, months: Sequence[int] | None = None,
                  years: Sequence[int] | None = None) -> DataFrame:
    grid = spark.read.schema(ANALYSIS_SCHEMA).parquet(path).where(F.col("variable") == variable)
    return _prune(grid, months, years)


def scan_forecast(spark: SparkSession, path: str, variable: str, issue_year: int, issue_month: int) -> DataFrame:
    grid = spark.read.schema(FORECAST_SCHEMA).parquet(path).where(F.col("variable") == variable)
    return _prune(grid, [issue_month], [issue_year])


def _prune(grid: DataFrame, months, years) -> DataFrame:
    if months:
        grid = grid.where(F.col("month").isin(list(months)))
    if years:
        grid = grid.where(F.col("year").isin(list(years)))
    return grid


def normalise_valid_time(df: DataFrame, out: str = "valid_time") -> DataFrame:
    """One time axis for both layouts: the stamped valid time, else reference time plus step."""
    built = F.col("ref_time") + F.make_dt_interval(hours=F.col("step_h"))
    return df.withColumn(out, F.coalesce("valid_time", built))


def grid_in_celsius(df: DataFrame) -> DataFrame:
    return df.withColumn("value", val.to_celsius(F.col("value"), F.col("variable"), F.col("units")))


def subset_request(df: DataFrame, box: Box | None = None, months: Sequence[int] | None = None,
                   max_day: int | None = None, hours: Sequence[int] | None = None,
                   leads: Sequence[int] | None = None, lat: str = "lat", lon: str = "lon",
                   time: str = "valid_time") -> DataFrame:
    """Region, months, leading days of the month, hours and leads as pushable filters."""
    if box:
        df = df.where(F.col(lat).between(box.lat_min, box.lat_max) & F.col(lon).between(box.lon_min, box.lon_max))
    if months:
        df = df.where(F.month(time).isin(list(months)))
    if max_day:
        df = df.where(F.dayofmonth(time) <= max_day)
    if hours:
        df = df.where(F.hour(time).isin(list(hours)))
    if leads:
        steps = list(leads)
        df = df.where(F.col("step_h").between(min(steps), max(steps)) & F.col("step_h").isin(steps))
    return df
