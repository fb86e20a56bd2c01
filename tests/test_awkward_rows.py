"""Rows that ordinary tables lack: NULL keys and times, repeated days, files without a number, retried writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from frostline.operators import aggregate as agg
from frostline.operators import ordered
from frostline.plans import yearly
from frostline.sources import tables, text
from frostline.streaming import ingest
from helpers import at, day


def test_blocked_fill_keeps_rows_without_key_or_time(spark):
    rows = [("a", at("2024-01-01T00:10:00"), 1.0), ("a", at("2024-01-01T03:00:00"), None), (None, at("2024-01-01T00:20:00"), 5.0),
            (None, at("2024-01-01T02:00:00"), None), ("a", None, 7.0)]
    samples = spark.createDataFrame(rows, "k string, ts timestamp, t double")
    for limit in (1_000_000, 1):
        blocked, axis = ordered.with_axis(samples, ["k"], "ts", "hour", limit)
        assert blocked.count() == 5
    got = {(r.k, r.ts): r.t_ffill for r in ordered.ffill_series(samples, ["k"], "ts", "t", block="hour").collect()}
    assert got == {("a", rows[0][1]): 1.0, ("a", rows[1][1]): 1.0, (None, rows[2][1]): 5.0, (None, rows[3][1]): 5.0, ("a", None): 7.0}


def test_blocks_of_a_crowded_cell_row_count(spark):
    """A crowded day is cut by its rows, whatever the unit."""
    samples = spark.range(4000).select(F.lit("a").alias("k"), F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"), F.lit(1.0).alias("t"))
    blocked, _ = ordered.with_axis(samples, ["k"], "ts", "day", 500)
    assert blocked.groupBy("_block").count().agg(F.max("count")).first()[0] <= 501 and blocked.count() == 4000


def write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_synthetic_time_keeps_files_without_number(spark, tmp_path):
    write(tmp_path, "stationA.csv", ["1,2.5,x,y,z", "1,2.6,x,y,z"])
    write(tmp_path, "S.dat1.dat", ["1,3.5,x,y,z", "1,3.6,x,y,z"])
    timed = text.assign_synthetic_time(text.read_variant_width(spark, str(tmp_path)), F.lit("2020-01-01"))
    assert sorted(r.t for r in timed.collect()) == [2.5, 2.6, 3.5, 3.6]


def test_synthetic_time_of_two_files_with_one_number(spark, tmp_path):
    for folder, value in (("x", 1.0), ("y", 2.0)):
        write(tmp_path / folder, "S.dat1.dat", [f"1,{value},x,y,z", f"1,{value + 0.5},x,y,z"])
    timed = text.assign_synthetic_time(text.read_variant_width(spark, str(tmp_path / "*")), F.lit("2020-01-01").cast("timestamp"))
    got = [(r.ts, r.t) for r in timed.orderBy("ts").collect()]
    assert got == [(dt.datetime(2020, 1, 1, 0, n), t) for n, t in enumerate([1.0, 1.5, 2.0, 2.5])]


def test_fill_calendar_with_a_repeated_day(spark):
    rows = spark.createDataFrame([("a", day("2024-01-05"), 1.0), ("a", day("2024-01-05"), 2.0), ("a", day("2024-01-07"), 3.0)], "k string, d date, t double")
    got = sorted((str(r.d), r.t) for r in agg.fill_calendar(rows, ["k"]).where("t is not null").collect())
    assert got == [("2024-01-05", 1.0), ("2024-01-05", 2.0), ("2024-01-07", 3.0)]
    assert agg.fill_calendar(rows, ["k"]).where("d < '2024-01-05'").count() == 0


def test_a_retried_issue_is_stored_once(spark, tmp_path):
    issue = spark.createDataFrame([(day("2001-10-07"), n, 350 + n, "monthly", 2001) for n in range(3)], "issued date, number int, fud int, feed string, season int")
    other = issue.withColumn("issued", F.lit("2001-11-07").cast("date"))
    for rows in (issue, other, issue):
        tables.append_forecast(rows, str(tmp_path / "log"))
    assert tables.read_forecast_log(spark, str(tmp_path / "log")).count() == 6


def test_training_table_tells_series_apart(spark):
    predictors = spark.createDataFrame([(s, v, float(s)) for s in (2000, 2001) for v in ("t2m", "sf", "tcc")], "season int, variable string, value double")
    freeze_up = spark.createDataFrame([("a", 2000, 360), ("b", 2000, 350), (None, 2000, 340)], "k string, season int, fudoy int")
    got = {(r.k, r.season): (r.t2m, r.fudoy) for r in yearly.training_table(predictors, freeze_up, ["k"]).collect()}
    assert got == {(k, s): (float(s), f if s == 2000 else None) for k, f in (("a", 360), ("b", 350), (None, 340)) for s in (2000, 2001)}


def test_stream_sink_keeps_the_first_file_and_null_keys(spark, tmp_path):
    """Files of one batch in their order, whatever order their rows arrive in."""
    hours = [at("2024-01-01T00:00:00") + dt.timedelta(hours=h) for h in range(25)]
    rows = [(k, ts, 9.5 if seq == 2 else 2.5, seq) for seq in (2, 1) for k in ("N", None) for ts in hours]
    batch = spark.createDataFrame(rows, "k string, ts timestamp, t double, file_seq int").coalesce(1)
    ingest.clean_daily_table(str(tmp_path / "raw"), str(tmp_path / "days"), ["k"], "ts", "t")(batch, 0)
    got = {(r.k, str(r.d)): r.t for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    assert got == {("N", "2024-01-01"): 2.5, (None, "2024-01-01"): 2.5}
