"""Text layouts, grids, tables and the forecast log on small files."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from frostline.operators import publish
from frostline.sources import grid, tables, text
from helpers import at, close, column, daily, day

K = ["k"]


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_sensor_log(spark, tmp_path):
    write(tmp_path / "log", "Upstream.dat9.dat", '"2025-01-01 00:01:00","0","3.5","a","b","c"', '"2025-01-01 00:00:00","1","Bad","a","b","c"')
    write(tmp_path / "log", "Upstream.dat10.dat", '"2025-01-01 00:02:00","2","4.5","a","b","c"', 'garbage', '"2025-01-01 00:03:00","3","5.5","a","b","c"')
    log = text.read_sensor_log(spark, str(tmp_path / "log"))
    rows = text.good_rows(log).orderBy("ts").collect()
    assert [(r.series_key, r.ts, r.t, r.file_seq) for r in rows] == [
        ("Upstream", at("2025-01-01 00:00:00"), None, 9), ("Upstream", at("2025-01-01 00:01:00"), 3.5, 9),
        ("Upstream", at("2025-01-01 00:02:00"), 4.5, 10), ("Upstream", at("2025-01-01 00:03:00"), 5.5, 10)]
    assert [r.corrupt for r in text.quarantine(log).collect()] == ["garbage"]
    first = rows[1]["line"]["row"]
    assert first < rows[0]["line"]["row"]  # arrival order inside the file, not time order


def test_sheet_drops_footer_and_unnamed_columns(spark, tmp_path):
    write(tmp_path, "sheet.csv", ",,,Date,T (oC)", "0,1,2,1992-01-01,0.5", "1,1,2,1992-01-02,Bad", "mean,,,,1.1")
    sheet = text.read_sheet(spark, str(tmp_path / "sheet.csv"), ["Unnamed: 0", "Unnamed: 1", "Unnamed: 2", "Date", "T (oC)"])
    assert [(r.ts, r.t) for r in sheet.orderBy("ts").collect()] == [(at("1992-01-01"), 0.5), (at("1992-01-02"), None)]


def test_logger_preamble(spark, tmp_path):
    write(tmp_path, "Station.dat", '"TOA5","x"', '"more"', '"units"', '"","","Smp","Smp.1","Smp.2","Min","Smp.3"',
          '"2023-11-15 00:00:00",1,2,7.25,4,5,6', '"2023-11-15 00:01:00",1,2,"Bad",4,5,6')
    rows = text.read_logger_with_preamble(spark, str(tmp_path / "Station.dat")).orderBy("ts").collect()
    assert [(r.series_key, r.t) for r in rows] == [("Station", 7.25), ("Station", None)]


def test_variant_width_and_synthetic_time(spark, tmp_path):
    write(tmp_path / "raw", "S.dat2.dat", "1,x,9.5,a,b,c", "1,x,10.5,a,b,c")
    write(tmp_path / "raw", "S.dat1.dat", "1,7.5,a,b,c", "1,8.5,a,b,c", "1,2,3")
    os.utime(tmp_path / "raw/S.dat1.dat", (1734400000, 1734400000))  # 2024-12-17 01:46:40
    os.utime(tmp_path / "raw/S.dat2.dat", (1734404000, 1734404000))
    lines = text.read_variant_width(spark, str(tmp_path / "raw"))
    timed = text.assign_synthetic_time(lines).orderBy("ts").collect()
    assert [r.t for r in timed] == [7.5, 8.5, None, 9.5, 10.5]
    assert [r.ts for r in timed] == [at("2024-12-17 01:00") + dt.timedelta(minutes=n) for n in range(5)]


def test_synthetic_time_over_split_files(spark, tmp_path):
    """A file read in many blocks still numbers its lines in order."""
    for n in (1, 2):
        write(tmp_path / "raw", f"S.dat{n}.dat", *[f"1,{n * 10000 + i}.5,a,b,c" for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = text.read_variant_width(spark, str(tmp_path / "raw"))
        assert lines.select("block").distinct().count() > 3
        timed = text.assign_synthetic_time(lines, F.lit(at("2024-01-01 00:00"))).orderBy("ts").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.t for r in timed] == [n * 10000 + i + 0.5 for n in (1, 2) for i in range(3000)]


def grid_rows(spark):
    rows = [("t2m", at("1997-12-01"), h, None if h % 2 else at("1997-12-01") + dt.timedelta(hours=h), 45.0 + c, -75.0, 273.15 + h, "K") for h in range(48) for c in range(2)]
    rows += [("tcc", at("1997-09-01"), 0, at("1997-09-01"), 44.0, -74.0, 0.5, "(0 - 1)")]
    return spark.createDataFrame(rows, "variable string, ref_time timestamp, step_h int, valid_time timestamp, lat double, lon double, value double, units string")


def test_grid_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "grid")
    grid.write_grid(grid.normalise_valid_time(grid_rows(spark)), path)
    scan = grid.scan_analysis(spark, path, "t2m", months=[12], years=[1997])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "variable" in plan.split("PartitionFilters")[1][:200]
    assert scan.count() == 96
    cold = grid.grid_in_celsius(scan).groupBy().agg(F.min("value"), F.max("value")).first()
    close(list(cold), [0.0, 47.0])


def test_subset_request(spark):
    rows = grid.normalise_valid_time(grid_rows(spark))
    assert grid.subset_request(rows, grid.Box(), months=[12]).count() == 96
    assert grid.subset_request(rows, grid.Box(lat_max=45.5), months=[12], max_day=1).count() == 24
    assert grid.subset_request(rows, hours=[0, 12], months=[12]).count() == 8
    assert grid.subset_request(rows, leads=grid.LEADS).count() == 2
    assert len(grid.LEADS) == 215


def test_versioned_table_replaces_what_it_reads(spark, tmp_path):
    path, first = str(tmp_path / "t"), daily(spark, [1, 2])
    tables.write_table(first, path, 1)
    stored = tables.read_table(spark, path, first.schema)
    tables.write_table(stored.withColumn("t", F.col("t") + 1), path, 2)
    assert column(tables.read_table(spark, path, first.schema), "t") == [2.0, 3.0]
    assert column(tables.read_table(spark, path, first.schema, 1), "t") == [1.0, 2.0]


def log_rows(spark, rows):
    return spark.createDataFrame(rows, "issued date, number int, fud int, feed string, season int")


def test_forecast_log_fallback_and_refusal(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_forecast(log_rows(spark, [(day("2001-10-07"), n, 350 + n, "monthly", 2001) for n in range(3)]), path)
    tables.append_forecast(log_rows(spark, [(day("2000-10-02"), 0, 340, "weekly", 2000), (day("2000-10-07"), 0, 341, "monthly", 2000)]), path)
    assert tables.read_forecast_log(spark, path, "monthly", [2001]).count() == 3
    chosen = tables.feed_or_fallback(tables.read_forecast_log(spark, path), "weekly", "monthly")
    assert sorted((r.season, r.feed) for r in chosen.collect()) == [(2000, "weekly")] + [(2001, "monthly")] * 3
    with pytest.raises(Exception, match="ensemble mean missing"):
        tables.append_forecast(log_rows(spark, [(day("2001-11-07"), 1, 350, "monthly", 2001)]), path)
    assert tables.read_forecast_log(spark, path).count() == 5


def test_slices_cover_whole_days(spark):
    rows = spark.createDataFrame([("a", at(f"2001-01-0{n} 23:59:59")) for n in range(1, 5)], "k string, ts timestamp")
    assert tables.slice_time(rows, "ts", "2001-01-02", "2001-01-03").count() == 2
    assert tables.slice_time(rows, "ts", last="2001-01-03").count() == 3
    assert tables.complete_days_only(rows, "ts", "2001-01-04").count() == 3
    assert tables.complete_days_only(rows, "ts", "2001-01-04", after="2001-01-01").count() == 2


def test_quality_gate(spark):
    row = tables.quality_gate(daily(spark, [1, 2, 3]), K, "daily", "d", 3, "2001-01-03").collect()[0]
    assert (row.stage, row.n_rows, row.ok) == ("daily", 3, True)
    assert not tables.quality_gate(daily(spark, [1, 2, 3]), K, "daily", "d", 3, "2001-01-04").collect()[0].ok


def test_published_json(spark, tmp_path):
    series = daily(spark, [1, 2, 3], "2001-07-01")
    documents = publish.series_json(series, K)
    publish.export_json(documents, str(tmp_path / "out"))
    parsed = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert len(parsed["date"]) == len(parsed["clim"]) == 365
    assert (parsed["date"][0], parsed["date"][-1]) == ("07-01", "06-30")
    assert parsed["years"] == ["2001/2002"]
    assert parsed["seasons"]["2001/2002"][:4] == [1.0, 2.0, 3.0, None]
    latest = spark.createDataFrame([("a", day("2001-12-03"), 2001, 370)], "k string, issued date, season int, fud int")
    assert json.loads(publish.latest_json(latest, K).first()["json"]) == {"latestForecastIssued": "2001-12-03", "latestForecast": "2002-01-05"}
