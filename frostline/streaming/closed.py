"""Days that close: first copies and daily means in append mode, with a state of the open days only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from frostline import session
from frostline.functions import calendar as cal
from frostline.sources import tables


def closed_days(samples: DataFrame, keys: Sequence[str], time: str, value: str, order: Sequence[str], late: str) -> DataFrame:
    """Daily means (keys, d, t, n) of the first copy of every stamp, each emitted once, when the watermark passes the day.

    Of copies of a stamp the first in ``order`` (file, then line) counts, in whatever order they arrive while the day is
    open. Both steps are aggregates over the day's window, so what a closed day held is forgotten; ``late`` is how
    far stations and files may lag behind the newest sample.
    """
    marked = samples.withWatermark(time, late)
    first = F.min_by(F.struct(F.col(value).alias("value")), F.struct(*order)).alias("first")
    copies = marked.groupBy(F.window(time, "1 day").alias("_day"), *keys, F.unix_micros(time).alias("_stamp")).agg(first)
    days = copies.groupBy(F.window(F.window_time("_day"), "1 day").alias("day"), *keys).agg(
        F.avg("first.value").alias("t"), F.count(F.lit(1)).alias("n"))
    return days.select(*keys, F.to_date("day.start").alias("d"), "t", "n")


def run_until_idle(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what is available, let the watermark close the days that are over, then stop.

    Sources that cannot bound a run themselves (the numbered log) get one batch from ``availableNow`` and days would close
    in the next run only.
    """
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").foreachBatch(write).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def latched_seasons(path: str, keys: Sequence[str], day: str = "d", value: str = "t", threshold: float = 0.75):
    """Sink that latches the first frozen day per (keys, season) from closed days: keys, season, frozen_date.

    A batch of closed days is reduced to one row per key and season and merged into the newest version of the
    latch table. A season is final when the next one begins, so only rows of seasons that the batch touches
    change. Late days move a date back, never forward. A repeated batch writes its version again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        below = batch.where(F.col(value) < threshold)
        fresh = below.groupBy(*keys, cal.season_of(F.col(day)).alias("season")).agg(F.min(day).alias("frozen_date"))
        if batch_id > 0:
            fresh = fresh.unionByName(tables.read_table(spark, path, fresh.schema, batch_id))
        merged = session.materialise(fresh, "latch").groupBy(*keys, "season").agg(F.min("frozen_date").alias("frozen_date"))
        tables.write_table(merged, path, batch_id + 1)
        tables.keep_versions(spark, path, 2)

    return write
