"""Streams give what the batch gives, whatever the file order, and resume where they stopped."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.operators import aggregate as agg
from frostline.plans import daily as daily_plan
from frostline.operators.quality import RawRules
from frostline.streaming import ingest
from helpers import at, day

K = ["k"]
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("t", T.DoubleType())])
DAILY = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("t", T.DoubleType())])


def rows(first, days, step_h=6, offset=0.0):
    start = at(first)
    return [(k, start + dt.timedelta(hours=h), (h % 24) / 10 + offset) for k in ("a", "b") for h in range(0, days * 24, step_h)]


def put(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def key(df):
    return sorted((r.k, r.d, None if r.t is None else round(r.t, 9)) for r in df.collect())


def test_daily_mean_equals_batch_with_repeats_and_disorder(spark, tmp_path):
    folder = str(tmp_path / "in")
    for first in ("2024-01-05", "2024-01-01", "2024-01-03"):
        put(spark, folder, rows(first, 2))
    put(spark, folder, rows("2024-01-03", 1))  # the same stamps once more
    streamed = ingest.streamed_table(
        ingest.daily_mean_stream(ingest.tail_files(spark, folder, SCHEMA, files_per_trigger=1), K, "ts", "t", "30 days"), "t")
    batch = agg.daily_reduce(spark.read.schema(SCHEMA).parquet(folder).dropDuplicates(["k", "ts"]), K, "ts", "t")
    assert key(streamed) == key(batch)


def test_latch_equals_batch_and_late_samples_move_it_back(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, rows("2024-11-10", 2, offset=0.0))
    put(spark, folder, rows("2024-11-01", 2, offset=0.5))
    streamed = ingest.streamed_table(ingest.latch_stream(ingest.tail_files(spark, folder, SCHEMA, files_per_trigger=1), K, "ts", "t"), "l")
    got = sorted((r.k, r.season, r.frozen_date) for r in streamed.collect())
    assert got == [(k, 2024, day("2024-11-01")) for k in ("a", "b")]
    all_rows = spark.read.schema(SCHEMA).parquet(folder).withColumn("d", F.to_date("ts"))
    batch = daily_plan.frozen_latch(all_rows, K)
    assert got == sorted((r.k, r.season, r.frozen_date) for r in batch.collect())


def test_closed_days_are_inserted_once_and_resume(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))

    def run():
        days = ingest.daily_mean_stream(ingest.tail_files(spark, folder, SCHEMA, files_per_trigger=1), K, "ts", "t", "1 hour")
        ingest.run_available(days, ingest.insert_only_table(table, DAILY, ["k", "d"]), checkpoint)
        return key(ingest.inserted_rows(spark, table, DAILY))

    put(spark, folder, rows("2024-01-01", 2))
    first = run()
    assert {d for _, d, _ in first} == {day("2024-01-01")}  # the open day is not emitted
    put(spark, folder, rows("2024-01-03", 2))
    second = run()
    assert {d for _, d, _ in second} == {day(f"2024-01-0{n}") for n in (1, 2, 3)}
    assert set(first) <= set(second)
    assert run() == second  # nothing new, nothing changed
    put(spark, folder, rows("2024-01-01", 1, offset=50.0))  # far too late: the stored day wins
    assert set(second) <= set(run())


def test_insert_only_sink_repeats_a_batch_without_harm(spark, tmp_path):
    path = str(tmp_path / "t")
    sink = ingest.insert_only_table(path, DAILY, ["k", "d"])
    one = spark.createDataFrame([("a", day("2024-01-01"), 1.0)], DAILY)
    two = spark.createDataFrame([("a", day("2024-01-01"), 9.0), ("a", day("2024-01-02"), 2.0)], DAILY)
    sink(one, 0)
    sink(two, 1)
    sink(two, 1)
    assert key(ingest.inserted_rows(spark, path, DAILY)) == [("a", day("2024-01-01"), 1.0), ("a", day("2024-01-02"), 2.0)]


def test_daily_ingestion_over_batches(spark, tmp_path):
    """Finished days come from the samples after the last stored day; open and late samples wait or are ignored."""
    rules = RawRules(max_per_hour=0.5, upper=30.0, deviation=3.0)
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "daily", "checkpoint"))

    def run():
        sink = ingest.clean_daily_table(str(tmp_path / "raw"), table, K, "ts", "t", rules)
        ingest.run_available(ingest.tail_files(spark, folder, SCHEMA, files_per_trigger=1), sink, checkpoint)
        return key(ingest.inserted_rows(spark, table, DAILY))

    def expected(*parts):
        out = []
        for samples in parts:
            frame = spark.createDataFrame(samples, SCHEMA).withColumn("n", F.lit(0))
            out += key(daily_plan.daily_from_samples(frame, K, "ts", "t", ["n"], rules).select("k", "d", "t"))
        return sorted(out)

    first, second = rows("2024-01-01", 3, 1), rows("2024-01-04", 3, 1)
    both = sorted(first + second)
    put(spark, folder, first)
    closed = [r for r in both if r[1] < at("2024-01-03")]
    assert run() == expected(closed)
    put(spark, folder, second + [("c", at("2024-01-01 12:00"), 1.0)])
    after = [r for r in both if at("2024-01-03") <= r[1] < at("2024-01-06")]
    assert run() == expected(closed, after)
    put(spark, folder, rows("2024-01-01", 1, 1, offset=9.0))  # late: nothing changes
    assert run() == expected(closed, after)
    put(spark, folder, [("c", at("2024-01-03 12:00"), 2.0)])  # a series that had only an open day
    got = [r for r in run() if r[0] == "c"]
    assert got == [("c", day("2024-01-01"), None)]  # one sample has no rate of change, so it is masked


def test_logger_files_to_daily_series(spark, tmp_path):
    """Text files through the stream: bad tokens and broken lines do not stop it."""
    from frostline.sources import text

    folder = tmp_path / "log"
    folder.mkdir()

    def put_file(number, day_text, token="2.5"):
        lines = [f'"{day_text} {h:02d}:00:00","{h}","{token if h else "Bad"}","a","b","c"' for h in range(24)]
        (folder / f"North.dat{number}.dat").write_text("\n".join([*lines, "broken"]) + "\n")

    def run():
        log = text.sensor_log_stream(spark, str(folder)).where("corrupt IS NULL")
        sink = ingest.clean_daily_table(str(tmp_path / "raw"), str(tmp_path / "daily"), ["series_key"], "ts", "t")
        ingest.run_available(log, sink, str(tmp_path / "checkpoint"))
        schema = T.StructType([T.StructField("series_key", T.StringType()), *DAILY.fields[1:]])
        return sorted((r.series_key, r.d, r.t) for r in ingest.inserted_rows(spark, str(tmp_path / "daily"), schema).collect())

    put_file(1, "2025-01-01")
    put_file(2, "2025-01-02")
    assert run() == [("North", day("2025-01-01"), 2.5)]
    put_file(3, "2025-01-03", "3.5")
    assert run() == [("North", day("2025-01-01"), 2.5), ("North", day("2025-01-02"), 2.5)]
