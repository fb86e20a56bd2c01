"""Ordered tailing of numbered files, and days that close once."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.sources import tables, tail
from frostline.streaming import closed, ingest
from helpers import at, day

K = ["series_key"]
DAILY = T.StructType([T.StructField("series_key", T.StringType()), T.StructField("d", T.DateType()), T.StructField("t", T.DoubleType()), T.StructField("n", T.LongType())])


def put(folder, station, number, stamps, extra=()):
    lines = [f'"{ts}","{n}","{t}","a","b","c"' for n, (ts, t) in enumerate(stamps)]
    (folder / f"{station}.dat{number}.dat").write_text("\n".join([*lines, *extra]) + "\n")


def hours(first, count, value=1.0):
    return [(at(first) + dt.timedelta(hours=n), value) for n in range(count)]


def collect(spark, folder, checkpoint, open_day="2025-01-10"):
    seen = []
    log = tail.numbered_log_stream(spark, str(folder), open_day)
    ingest.run_available(log, lambda batch, _: seen.extend(batch.collect()), str(checkpoint))
    return seen


def test_files_come_in_order_up_to_a_gap_and_the_open_day(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "cp"
    folder.mkdir()
    put(folder, "North", 5, hours("2025-01-01", 24))
    put(folder, "North", 7, hours("2025-01-03", 24))           # 6 is not there yet
    put(folder, "South", 0, hours("2025-01-01", 24), ["broken", '"x","1","2","3","4","5"', ""])
    put(folder, "South", 1, hours("2025-01-09", 25))            # reaches the open day
    put(folder, "South", 2, hours("2025-01-02", 1))             # behind an open file
    (folder / "North.dat6.dat.tmp").write_text("half written")
    files = lambda rows: sorted({(r.series_key, r.file_seq) for r in rows})
    first = collect(spark, folder, checkpoint)
    assert files(first) == [("North", 5), ("South", 0)]
    south = [r for r in first if r.series_key == "South"]
    assert [r.line for r in sorted(south, key=lambda r: r.line)] == list(range(26))
    assert sorted(r.corrupt for r in south if r.corrupt) == ["broken", "x,2"]
    assert collect(spark, folder, checkpoint) == []              # a restart reads nothing twice
    put(folder, "North", 6, hours("2025-01-02", 24, "Bad"))     # late
    (folder / "North.dat8.dat").write_text("")                   # an empty file holds nothing up
    put(folder, "North", 9, hours("2025-01-04", 2))
    later = collect(spark, folder, checkpoint)
    assert files(later) == [("North", 6), ("North", 7), ("North", 9)]
    assert all(r.t is None and r.ts is not None for r in later if r.file_seq == 6)
    assert files(collect(spark, folder, checkpoint, "2025-01-12")) == [("South", 1), ("South", 2)]


def test_only_new_file_ends_are_read(tmp_path):
    for n in range(200):
        put(tmp_path, "North", n, hours("2025-01-01", 1) if n < 150 else hours("2025-02-01", 1))
    reader = tail.NumberedLogReader({"path": str(tmp_path), "open_day": "2025-02-01"})
    asked = []
    reader._is_open = lambda system, path, is_open=reader._is_open: asked.append(path) or is_open(system, path)
    assert reader.latestOffset() == {"North": 150} and len(asked) < 150 + tail.AT_ONCE
    asked.clear()
    assert reader.latestOffset() == {"North": 150} and len(asked) <= tail.AT_ONCE
    # a restarted reader learns from the batch it repeats
    again = tail.NumberedLogReader({"path": str(tmp_path), "open_day": "2025-02-01"})
    parts = again.partitions({"North": 100}, {"North": 150})
    assert [n for p in parts for _, n in p.files] == list(range(100, 150)) and again.next == {"North": 150}


def test_days_close_once_with_the_first_copy_of_every_stamp(spark, tmp_path):
    """Copies within a file, in the next file and out of order; two runs; equal to the batch form; a state that does not grow."""
    folder, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    folder.mkdir()
    rng, rows = random.Random(1), []
    start = at("2025-01-01")
    for number in range(12):
        lines = []
        for station in ("North", "South"):
            own = [(start + dt.timedelta(days=number, hours=h), round(rng.random(), 6)) for h in range(24)]
            copies = [(ts, 100.0) for ts, _ in own[::5]]                                        # later lines of the same file
            before = [(start + dt.timedelta(days=number - 1, hours=h), 200.0) for h in (3, 4)]   # in a later file
            stamps = [*(before if number else []), *own, *copies]
            lines.append((station, stamps))
            rows += [(station, ts, t, number, n) for n, (ts, t) in enumerate(stamps)]
        for station, stamps in lines:
            if number < 6:
                put(folder, station, number, stamps)
    sizes = []

    def run():
        log = tail.numbered_log_stream(spark, str(folder), "2025-01-12").where("corrupt IS NULL")
        days = closed.closed_days(log, K, "ts", "t", ["file_seq", "line"], "1 hour")
        query = closed.run_until_idle(days, ingest.insert_only_table(table, DAILY, ["series_key", "d"]), checkpoint)
        sizes.append(sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]))
        return sorted((r.series_key, r.d, round(r.t, 9), r.n) for r in ingest.inserted_rows(spark, table, DAILY).collect())

    first = run()
    for number in range(6, 12):
        for station in ("North", "South"):
            put(folder, station, number, [(ts, t) for s, ts, t, f, _ in rows if s == station and f == number])
    second = run()
    frame = spark.createDataFrame(rows, "series_key string, ts timestamp, t double, file_seq long, line long")
    copies = frame.groupBy("series_key", "ts").agg(F.min_by("t", F.struct("file_seq", "line")).alias("t"))
    batch = copies.groupBy("series_key", F.to_date("ts").alias("d")).agg(F.avg("t").alias("t"), F.count("*").alias("n"))
    whole = sorted((r.series_key, r.d, round(r.t, 9), r.n) for r in batch.collect())
    assert first == [r for r in whole if r[1] < day("2025-01-06")]
    assert second == [r for r in whole if r[1] < day("2025-01-11")]   # the file of the open day is not read, the day before it is not over
    assert all(size <= 2 * 2 * 26 for size in sizes)                   # stamps of the open day only


def test_latch_from_closed_days(spark, tmp_path):
    from frostline.plans import daily as daily_plan

    schema = "k string, d date, t double"
    batches = [[("a", day("2024-12-01"), 2.0), ("a", day("2024-12-02"), 0.5), ("b", day("2024-12-02"), 0.7)],
               [("a", day("2024-12-03"), 0.1), ("b", day("2024-11-20"), 0.2)], [], [("a", day("2025-11-30"), 0.3), ("b", day("2025-07-01"), 5.0)]]
    path = str(tmp_path / "latch")
    sink = closed.latched_seasons(path, ["k"])
    for n, rows in enumerate(batches):
        for _ in range(2):  # every batch once more, as after a failure
            sink(spark.createDataFrame(rows, schema), n)
    everything = spark.createDataFrame([r for rows in batches for r in rows], schema)
    key = lambda df: sorted((r.k, r.season, r.frozen_date) for r in df.collect())
    expected = daily_plan.frozen_latch(everything, ["k"])
    assert key(tables.read_table(spark, path, expected.schema)) == key(expected) == [
        ("a", 2024, day("2024-12-02")), ("a", 2025, day("2025-11-30")), ("b", 2024, day("2024-11-20"))]
    assert tables.versions(spark, path) == [3, 4]
