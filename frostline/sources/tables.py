"""Derived tables and the forecast log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions.joins import join_null_safe
from frostline.session import materialise

LOG_SCHEMA = T.StructType([
    T.StructField("issued", T.DateType()), T.StructField("number", T.IntegerType()),
    T.StructField("fud", T.IntegerType()), T.StructField("feed", T.StringType()),
    T.StructField("season", T.IntegerType()),
])


def write_table(df: DataFrame, path: str, version: int) -> None:
    """Store a table under a version; readers of older versions are not disturbed.

    A job may therefore read a table and replace it. Repeating a version overwrites it,
    which makes a retried batch harmless.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={int(version)}")


def read_table(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A version of a table, by default the newest."""
    wanted = version if version is not None else max(versions(spark, path))
    return spark.read.schema(schema).parquet(f"{path}/version={int(wanted)}")


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written to the path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file systems; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a table from the names of its folders; no file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(root) if entry.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("version="))


def keep_versions(spark: SparkSession, path: str, count: int) -> None:
    """Remove all but the newest ``count`` versions; keep at least two where a failed batch may read the one before again."""
    for version in versions(spark, path)[:-count]:
        remove_path(spark, f"{path}/version={version}")


def slice_time(df: DataFrame, time: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Label slice with both ends inside; a last day given for timestamps covers the whole day."""
    if first is not None:
        df = df.where(F.col(time) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(time) < F.date_add(F.lit(last).cast("date"), 1))
    return df


def complete_days_only(df: DataFrame, time: str, as_of: str, after: str | None = None) -> DataFrame:
    """Samples of finished days only, optionally from the day after the last stored one."""
    df = df.where(F.col(time) < F.lit(as_of).cast("date"))
    return df if after is None else df.where(F.col(time) >= F.date_add(F.lit(after).cast("date"), 1))


def append_forecast(forecast: DataFrame, path: str) -> None:
    """Add issues, each mean with its members, in one job; members without their mean fail it.

    The log has a folder per feed and season. Those that get new issues are written anew: stored issues that come again
    are replaced, so a retried job changes nothing, and the others are copied. A season of a feed is some dozen issues.
    """
    spark, key = forecast.sparkSession, ["feed", "season", "issued"]
    issue = Window.partitionBy(*key)
    has_mean = F.max(F.when(F.col("number") == 0, 1).otherwise(0)).over(issue)
    refused = F.raise_error(F.lit("ensemble mean missing, members not written")).cast("int")
    checked = forecast.withColumn("_ok", has_mean).withColumn(
        "fud", F.when(F.col("_ok") == 1, F.col("fud")).otherwise(refused)
    )
    rows = checked.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA.fields])
    if has_rows(spark, path):
        rows = materialise(rows, "new-issues")
        seasons, issues = rows.select("feed", "season").distinct(), rows.select(*key).distinct()
        stored = join_null_safe(read_forecast_log(spark, path), seasons, ["feed", "season"], "left_semi")
        rows = rows.unionByName(materialise(join_null_safe(stored, issues, key, "left_anti"), "stored-issues"))
    (rows.hint("rebalance", "feed", "season").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("feed", "season").parquet(path))


def read_forecast_log(spark: SparkSession, path: str, feed: str | None = None,
                      seasons: Sequence[int] | None = None) -> DataFrame:
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    if feed:
        log = log.where(F.col("feed") == feed)
    if seasons:
        log = log.where(F.col("season").isin(list(seasons)))
    return log


def feed_or_fallback(log: DataFrame, feed: str, fallback: str) -> DataFrame:
    """Rows of a feed; for a season where it has none, the other feed's rows stand in."""
    both = log.where(F.col("feed").isin(feed, fallback))
    present = log.where(F.col("feed") == feed).select("season").distinct().withColumn("_present", F.lit(True))
    marked = both.join(present, "season", "left")
    return marked.where((F.col("feed") == feed) | F.col("_present").isNull()).drop("_present")


def quality_gate(df: DataFrame, keys: Sequence[str], stage: str, day: str, min_rows: int, fresh_after: str) -> DataFrame:
    """Run-status rows: may the next stage use this series?"""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max(day).alias("last_d")).select(
        *keys, F.lit(stage).alias("stage"), "n_rows", "last_d",
        ((F.col("n_rows") >= min_rows) & (F.col("last_d") >= F.lit(fresh_after).cast("date"))).alias("ok"),
    )
