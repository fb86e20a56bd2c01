"""Incremental forms on Structured Streaming: new files, daily windows, insert-only tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline import session
from frostline.functions import calendar as cal
from frostline.functions.joins import join_null_safe
from frostline.operators import align
from frostline.operators.quality import RawRules
from frostline.plans import daily as daily_plan
from frostline.sources import tables


def tail_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               files_per_trigger: int = 1000, **options: str) -> DataFrame:
    """New files of a folder; the stream's checkpoint remembers what was consumed."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def daily_mean_stream(samples: DataFrame, keys: Sequence[str], time: str, value: str, late: str) -> DataFrame:
    """Daily means of the samples with repeated time stamps dropped.

    A day is final once the watermark passes its end; ``late`` is how far samples may lag.
    """
    marked = samples.withWatermark(time, late).dropDuplicatesWithinWatermark([*keys, time])
    days = marked.groupBy(F.window(time, "1 day"), *keys).agg(F.avg(value).alias("t"))
    return days.select(*keys, F.to_date("window.start").alias("d"), "t")


def latch_stream(samples: DataFrame, keys: Sequence[str], time: str, value: str, threshold: float = 0.75) -> DataFrame:
    """First day below the threshold per (keys, season).

    The latch is the minimum of the qualifying days, so a built-in aggregate holds it: it
    combines map-side, its state is one date per (keys, season), and a late sample moves the
    date back instead of being missed. A new season is a new state entry, which is the reset.
    """
    below = samples.where(F.col(value) < threshold)
    day = F.to_date(time)
    return below.groupBy(*keys, cal.season_of(day).alias("season")).agg(F.min(day).alias("frozen_date"))


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> None:
    """Process everything available, then stop. A failed run resumes from the checkpoint."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for complete mode: each batch is the whole result and becomes a new version."""
    return lambda batch, batch_id: tables.write_table(batch, path, batch_id + 1)


def inserted_rows(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Rows of an insert-only table, optionally only those of earlier batches."""
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    return (table if before is None else table.where(F.col("batch") < before)).drop("batch")


def insert_only_table(path: str, schema: T.StructType, key: Sequence[str], day: str = "d") -> Callable[[DataFrame, int], None]:
    """Sink for closed days: stored labels win, and nothing stored is rewritten.

    A batch adds one folder with the labels not stored before, so a repeated batch replaces
    its own folder. Only the stored days the batch touches are compared.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        new = session.materialise(batch.select(*schema.fieldNames()), "closed-days")
        if batch_id > 0:
            span = new.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
            stored = inserted_rows(batch.sparkSession, path, schema, batch_id).where(F.col(day).between(span.lo, span.hi))
            new = align.rows_to_insert(stored, new, key)
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def clean_daily_table(raw_path: str, path: str, keys: Sequence[str], time: str, value: str,
                      rules: RawRules = RawRules()) -> Callable[[DataFrame, int], None]:
    """Sink of the daily ingestion: keep the samples, clean the finished days, insert them.

    A batch writes its samples, its new days and the first open day of every series into
    folders of its own number, so a repeated batch replaces itself and nothing else is
    rewritten. Only the series of the batch are cleaned, from their first day not stored yet
    to the day before their newest, which is still open; later samples of stored days are
    kept but change nothing. The samples are stored by day and read from the earliest of
    those days on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the first of equal stamps is that of the earlier file, then of the earlier line
        sequence = F.col("file_seq") if "file_seq" in batch.columns else F.lit(0)
        kept = batch.select(*keys, time, value, F.to_date(time).alias("d"), sequence.cast("long").alias("file_seq"),
                            F.monotonically_increasing_id().alias("line"))
        kept.hint("rebalance", "d").write.mode("overwrite").partitionBy("d").parquet(f"{raw_path}/batch={batch_id}")
        raw = spark.read.schema(kept.schema.add("batch", T.LongType())).parquet(raw_path)

        state_schema = T.StructType([*[batch.schema[k] for k in keys], T.StructField("first_open", T.DateType())])
        seen = raw.where(F.col("batch") == batch_id).groupBy(*keys).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        if batch_id > 0:
            state = spark.read.schema(state_schema).parquet(f"{path}-state/version={batch_id}")
        else:
            state = spark.createDataFrame([], state_schema)
        bounds = session.materialise(join_null_safe(seen, state, list(keys), "left").select(
            *keys, F.coalesce("first_open", "lo").alias("first_open"), F.greatest("first_open", "hi").alias("still_open")
        ), "open-days")

        earliest = bounds.agg(F.min("first_open")).first()[0]
        todo = raw.where((F.col("batch") <= batch_id) & (F.col("d") >= F.lit(earliest)))
        todo = join_null_safe(todo, bounds, list(keys), "inner").where(
            (F.col("d") >= F.col("first_open")) & (F.col("d") < F.col("still_open"))
        )
        new = daily_plan.daily_from_samples(todo, keys, time, value, ["batch", "file_seq", "line"], rules)
        new.select(*keys, "d", "t").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        opened = bounds.select(*keys, F.col("still_open").alias("first_open")).unionByName(
            join_null_safe(state, bounds.select(*keys), list(keys), "left_anti")
        )
        tables.write_table(opened, f"{path}-state", batch_id + 1)

    return write


def streamed_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a complete-mode stream over everything available and return its final table."""
    spark = stream.sparkSession
    path = session.new_folder(spark, label)
    schema = stream.schema
    run_available(stream, replace_table(path), f"{path}-checkpoint", "complete")
    return tables.read_table(spark, path, schema)
