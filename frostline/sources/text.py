"""Sensor text files: four layouts, declared schemas, no inference."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions import values as val
from frostline.functions.joins import join_null_safe
from frostline.session import Stage, materialise

SENSOR_FIELDS = 6
LOGGER_FIELDS = 7


def _text_schema(fields: int, station_folders: bool = False) -> T.StructType:
    named = [T.StructField(f"c{i}", T.StringType()) for i in range(fields)]
    folders = [T.StructField("series_key", T.StringType())] if station_folders else []
    return T.StructType([*named, T.StructField("_corrupt", T.StringType()), *folders])


def _read_fields(spark: SparkSession, path: str, fields: int, station_folders: bool = False) -> DataFrame:
    return (
        spark.read.schema(_text_schema(fields, station_folders))
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    )


def file_number(name: Column) -> Column:
    """Number in ``<station>.dat<N>.dat`` (or of a part file); NULL where there is none."""
    return F.regexp_extract(name, r"(?:\.dat|part-)(\d+)", 1).try_cast("bigint")


def station_of(name: Column, station_folders: bool = False) -> Column:
    """Station named by its folder (``series_key=...``), else by the start of the file name."""
    return F.col("series_key") if station_folders else F.regexp_extract(name, r"^([^.]+)", 1)


def _sensor_columns(raw: DataFrame, bad: str, station_folders: bool) -> DataFrame:
    name, ts = F.col("_metadata.file_name"), F.try_to_timestamp("c0")
    return raw.select(
        "*",
        station_of(name, station_folders).alias("_station"), file_number(name).alias("file_seq"),
        ts.alias("ts"), val.parse_value(F.col("c2"), bad).alias("t"),
        F.when(ts.isNull(), F.coalesce("_corrupt", F.concat_ws(",", "c0", "c1", "c2"))).alias("corrupt"),
    )


def read_sensor_log(spark: SparkSession, path: str, bad: str = "Bad", station_folders: bool = False) -> DataFrame:
    """Headerless quoted log: field 0 the time, field 2 the value.

    ``file_seq`` then ``line`` give the arrival order that decides which duplicate is first.
    Unreadable lines keep their text in ``corrupt`` instead of failing the load.
    """
    rows = _sensor_columns(_read_fields(spark, path, SENSOR_FIELDS, station_folders), bad, station_folders)
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select(F.col("_station").alias("series_key"), "ts", "t", "file_seq", line.alias("line"), "corrupt")


def sensor_log_stream(spark: SparkSession, path: str, bad: str = "Bad", station_folders: bool = False,
                      files_per_trigger: int = 1000) -> DataFrame:
    """The same log as a stream of new files: series_key, ts, t, file_seq, corrupt."""
    raw = (
        spark.readStream.schema(_text_schema(SENSOR_FIELDS, station_folders)).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt").option("maxFilesPerTrigger", files_per_trigger).csv(path)
    )
    rows = _sensor_columns(raw, bad, station_folders)
    return rows.select(F.col("_station").alias("series_key"), "ts", "t", "file_seq", "corrupt")


def good_rows(log: DataFrame) -> DataFrame:
    return log.where(F.col("corrupt").isNull()).drop("corrupt")


def quarantine(log: DataFrame) -> DataFrame:
    return log.where(F.col("corrupt").isNotNull()).select("series_key", "file_seq", "corrupt")


def read_sheet(spark: SparkSession, path: str, columns: list[str], time: str = "Date",
               rename: Mapping[str, str] | None = None, bad: str = "Bad") -> DataFrame:
    """Headered sheet with a footer row: the footer is the row whose date cannot be read.

    ``columns`` lists the header in order; unnamed ones are dropped.
    """
    rename = dict(rename or {"T (oC)": "t"})
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(path)
    kept = [c for c in columns if c != time and not c.startswith("Unnamed")]
    return raw.select(
        F.try_to_timestamp(f"`{time}`").alias("ts"),
        *[val.parse_value(F.col(f"`{c}`"), bad).alias(rename.get(c, c)) for c in kept],
    ).where(F.col("ts").isNotNull())


def read_logger_with_preamble(spark: SparkSession, path: str, value_field: int = 3, bad: str = "Bad") -> DataFrame:
    """Logger export: preamble and header are the lines whose first field is not a time."""
    raw = _read_fields(spark, path, LOGGER_FIELDS)
    return raw.select(
        station_of(F.col("_metadata.file_name")).alias("series_key"),
        F.try_to_timestamp("c0").alias("ts"),
        val.parse_value(F.col(f"c{value_field}"), bad).alias("t"),
    ).where(F.col("ts").isNotNull())


def read_variant_width(spark: SparkSession, path: str, bad: str = "Bad", station_folders: bool = False) -> DataFrame:
    """Unquoted lines without a time: the value is field 1 of five or field 2 of six."""
    fields = F.split("value", ",")
    token = F.when(F.size(fields) == 5, fields[1]).when(F.size(fields) == 6, fields[2])
    name = F.col("_metadata.file_name")
    lines = T.StructType([T.StructField("value", T.StringType())])
    if station_folders:
        lines = lines.add("series_key", T.StringType())
    return spark.read.schema(lines).text(path).select(
        station_of(name, station_folders).alias("series_key"),
        file_number(name).alias("file_seq"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("_metadata.file_modification_time").alias("modified"),
        val.parse_value(token, bad).alias("t"),
    )


def assign_synthetic_time(lines: DataFrame, start: Column | None = None, step_seconds: int = 60,
                          stage: Stage = materialise) -> DataFrame:
    """Regular time axis over the concatenated files of a series, one step per line.

    Without ``start`` the axis begins at the hour of the first file's modification time. Files
    come by their number, those without one last, and by their path where numbers agree.
    A line's rank is its offset in its file block plus the sizes of all blocks before it;
    only the block sizes (one row per block) are ordered, never the lines. The lines are
    written first, so that sizes and ranks come from one reading of the files.
    """
    part = ["series_key", "file_seq", "path", "block"]
    framed = stage(lines, "untimed-lines")
    sizes = framed.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), F.min("row").alias("_row0"), F.min("modified").alias("_modified")
    )
    order = Window.partitionBy("series_key").orderBy(F.col("file_seq").asc_nulls_last(), "path", "block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("series_key")
    begin = F.date_trunc("hour", F.min("_modified").over(whole)) if start is None else start
    offsets = sizes.select(
        *part, "_row0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), begin.alias("_start")
    )
    joined = join_null_safe(framed, stage(offsets, "block-offsets"), part, "inner")
    rank = F.col("_before") + F.col("row") - F.col("_row0")
    ts = F.timestamp_micros(F.unix_micros(F.col("_start").cast("timestamp")) + rank * step_seconds * 1_000_000)
    return joined.select("series_key", ts.alias("ts"), "t", "file_seq")
