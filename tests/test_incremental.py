"""What is kept up to date: moments, slices with a halo, gates measured while writing, the forecast log."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from frostline.operators import aggregate as agg
from frostline.operators import moments, ordered
from frostline.sources import gates, slices, tables
from helpers import at, close, day

K = ["k"]


def series(spark, days=900):
    rng = random.Random(4)
    rows = [(k, day("2020-01-01") + dt.timedelta(days=n), None if rng.random() < 0.1 else 1e6 + rng.random()) for k in ("a", None) for n in range(days) if rng.random() < 0.9]
    return spark.createDataFrame(rows, "k string, d date, t double")


def test_moments_of_batches_equal_those_of_the_whole(spark, tmp_path):
    days, path = series(spark), str(tmp_path / "m")
    sink = moments.moments_table(path, K)
    parts = ["d < date'2020-06-01'", "d >= date'2020-06-01' AND d < date'2021-11-30'", "d >= date'2021-11-30'"]
    for batch, part in enumerate(parts):
        for _ in range(2):  # every batch twice, as after a failure
            sink(days.where(part), batch)
    stored = tables.read_table(spark, path, moments.day_moments(days, K).schema)
    key = lambda df: {(r.k, r.doy): r for r in df.collect()}
    got = key(moments.climatology_of(stored, K))
    want = {k: r for k, r in key(agg.climatology(days, K)).items() if r.clim is not None}
    assert got.keys() == want.keys()
    for name in ("clim", "sd", "lo", "hi", "band"):
        close([got[k][name] for k in want], [want[k][name] for k in want], 1e-9)
    spread = {r.k: r.mean_sd for r in agg.mean_of_group_std(days, K, F.dayofyear("d"), "t").collect()}
    mine = {r.k: r.mean_sd for r in moments.mean_spread(stored, K).collect()}
    close([mine[k] for k in spread], [spread[k] for k in spread], 1e-6)
    assert tables.versions(spark, path) == [2, 3]


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """A dense key, one that is known rarely, one that exists in the slice only, one that is gone before it."""
    rng, rows = random.Random(6), []
    for n in range(60 * 24 * 4):
        rows.append(("dense", at("2024-01-01") + dt.timedelta(minutes=15 * n), None if rng.random() < 0.3 else rng.random()))
        if n % 96 == 10:
            known = n // 96 in (2, 55)
            rows.append(("rare", at("2024-01-01") + dt.timedelta(minutes=15 * n), rng.random() if known else None))
    rows += [("new", at("2024-01-30 01:00"), 1.0), ("new", at("2024-01-30 05:00"), None), ("gone", at("2024-01-02"), 1.0)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp, t double").withColumn("d", F.to_date("ts"))
    path = str(tmp_path_factory.mktemp("days") / "t")
    frame.repartition("d").write.partitionBy("d").parquet(path)
    return path, frame.schema


def test_a_slice_with_its_halo_equals_the_whole(spark, by_day):
    path, schema = by_day
    first, last = day("2024-01-29"), day("2024-01-31")
    reader = slices.SliceReader(spark, path, schema, K, "ts", "t")
    rows = reader.read(first, last)
    whole = spark.read.schema(schema).parquet(path)
    inside = F.col("d").between(F.lit(first), F.lit(last))
    for op, name in ((ordered.ffill_series, "t_ffill"), (ordered.interpolate_series, "t_interp"), (ordered.differentiate_series, "dt")):
        key = lambda df: {(r.k, r.ts): r[name] for r in op(df, K, "ts").where(inside).collect()}  # noqa: B023, E731
        got, want = key(rows), key(whole)
        assert got.keys() == want.keys()
        close([got[k] for k in sorted(want)], [want[k] for k in sorted(want)])
    assert {r.k for r in rows.select("k").distinct().collect()} == {"dense", "rare", "new"}


def test_a_slice_opens_no_more_days_than_it_needs(spark, by_day):
    path, schema = by_day
    reader = slices.SliceReader(spark, path, schema, K, "ts", "t")
    dense = reader.around(spark.createDataFrame([("dense",)], "k string"), [day("2024-01-28"), day("2024-01-27")], True)
    assert len(dense) == 1 and reader.opened == [day("2024-01-28")]
    plan = reader.days([day("2024-01-28")])
    assert {f.split("d=")[1][:10] for f in plan.inputFiles()} >= {"2024-01-28"}
    assert "PartitionFilters: [isnotnull" in plan._jdf.queryExecution().executedPlan().toString()
    reader.opened.clear()
    rare = reader.around(spark.createDataFrame([("rare",)], "k string"), [day("2024-01-28") - dt.timedelta(days=n) for n in range(28)], True)
    assert len(rare) == 5 and len(reader.opened) == 28  # 1 + 2 + 4 + 8 + the rest: its last known value is weeks old


def test_gates_are_measured_while_writing(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame([(day("2024-01-01"), 1.0), (day("2024-01-05"), 99.0), (day("2024-01-03"), None)], "d date, t double").mapInArrow(count, "d date, t double")
    path, status = str(tmp_path / "t"), str(tmp_path / "s")
    gate = lambda **more: gates.write_observed(frame, path, status, "one", F.col("d"), F.col("t") > 50, **more)
    assert gate(fresh_after="2024-01-03", max_refused=1) and reads.value == 3
    assert sorted(r.d for r in spark.read.parquet(path).collect()) == [day("2024-01-01"), day("2024-01-03")]
    assert [tuple(r) for r in gates.run_status(spark, status).collect()] == [("one", 2, day("2024-01-03"), 1, True)]
    assert not gate(fresh_after="2024-01-04") and not gate(max_refused=0) and not gate(min_rows=3)
    assert gates.run_status(spark, status).count() == 1
    empty = spark.createDataFrame([], "d date, t double")
    assert not gates.write_observed(empty, str(tmp_path / "e"), status, "two", F.col("d"), fresh_after="2024-01-01")


def issues(spark, *rows):
    return spark.createDataFrame([(day(d), n, fud, feed, season) for d, n, fud, feed, season in rows], tables.LOG_SCHEMA)


def test_forecast_log_keeps_a_folder_per_season(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_forecast(issues(spark, ("2020-07-07", 0, 360, "m", 2020), ("2020-07-07", 1, 361, "m", 2020), ("2019-08-07", 0, 350, "m", 2019)), path)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "log" / "feed=m" / "season=2019").iterdir()}
    later = issues(spark, ("2020-08-07", 0, 355, "m", 2020), ("2020-08-03", 0, 356, "w", 2020))
    for _ in range(2):
        tables.append_forecast(later, path)
    tables.append_forecast(issues(spark, ("2020-07-07", 0, 333, "m", 2020)), path)  # an issue that comes again is replaced as a whole
    got = sorted((str(r.issued), r.number, r.fud, r.feed) for r in tables.read_forecast_log(spark, path).collect())
    assert got == [("2019-08-07", 0, 350, "m"), ("2020-07-07", 0, 333, "m"), ("2020-08-03", 0, 356, "w"), ("2020-08-07", 0, 355, "m")]
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "log" / "feed=m" / "season=2019").iterdir()} == untouched
    assert sorted(p.name for p in (tmp_path / "log" / "feed=m").iterdir()) == ["season=2019", "season=2020"]


def test_a_run_leaves_nothing_behind(spark, sf_dir, tmp_path):
    """Working folders of a run, staged tables and tables it writes on its way, are gone when it has been consumed, also after an error."""
    import os

    from frostline import session
    from frostline.registry import QUERIES

    root = session.work_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    for name in ("daily_ingest", "forecast_input", "latest_json"):
        with session.run_scope(spark) as folders:
            QUERIES[name](spark, sf_dir).write.mode("overwrite").parquet(str(tmp_path / name))
            assert folders
        assert set(os.listdir(root)) <= before | {f for f in os.listdir(root) if "checkpoint" in f}
        assert spark.read.parquet(str(tmp_path / name)).columns
    with pytest.raises(ZeroDivisionError):
        with session.run_scope(spark) as folders:
            session.materialise(spark.range(3).toDF("n"), "x")
            1 / 0
    assert not os.path.exists(folders[0].removeprefix("file:"))
