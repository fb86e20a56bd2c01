"""From stored grids to forecast input: regions by tiles, two clocks, pruned folders, missing predictors."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frostline.operators import ensemble, regions
from frostline.operators import aggregate as agg
from frostline.plans import forecast as fc
from frostline.plans import gridded
from frostline.sources import grid
from helpers import at, close, day

BOXES = "region string, lat_min double, lat_max double, lon_min double, lon_max double"


def test_tiles_find_what_comparing_all_pairs_finds(spark):
    rng = random.Random(3)
    boxes = [(f"r{n}", *sorted((rng.uniform(-90, 90), rng.uniform(-90, 90))), rng.uniform(-180, 180), rng.uniform(-180, 180)) for n in range(30)]
    boxes += [("point", 10.0, 10.0, 20.0, 20.0), ("none", 5.0, 4.0, 0.0, 1.0), ("edge", 1.0, 2.0, 3.0, 4.0), ("pacific", -10.0, 10.0, 170.0, -170.0)]
    cells = [(n, rng.uniform(-90, 90), rng.uniform(-180, 180)) for n in range(400)]
    cells += [(1000, 10.0, 20.0), (1001, 1.0, 3.0), (1002, 2.0, 4.0), (1003, 2.0000001, 4.0), (1004, 0.0, 180.0), (1005, 0.0, -180.0), (1006, 0.0, 0.0), (1007, None, 3.0)]
    inside = lambda lon, w, e: w <= lon <= e if w <= e else lon >= w or lon <= e
    expected = sorted((n, r) for n, lat, lon in cells if lat is not None for r, s, t, w, e in boxes if s <= lat <= t and inside(lon, w, e))
    frame = spark.createDataFrame(cells, "n int, lat double, lon double")
    for tile in (1.0, 7.5):
        found = regions.assign_regions(frame, spark.createDataFrame(boxes, BOXES), tile=tile)
        assert sorted((r.n, r.region) for r in found.collect()) == expected
        assert found.columns == ["n", "lat", "lon", "region"]


def test_regions_are_found_without_pairs(spark):
    plan = regions.assign_regions(spark.range(10).selectExpr("id AS lat", "id AS lon"), spark.createDataFrame([("a", 0.0, 1.0, 0.0, 1.0)], BOXES))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" in plan


def hourly(variable, first, hours, value=lambda n: 1.0, step=1):
    start = at(first)
    return [("r", variable, start + dt.timedelta(hours=n * step), float(value(n))) for n in range(hours)]


def test_two_clocks(spark):
    """A month of accumulations runs from 01:00 of its first day to 00:00 after its last; means and observed days go as stamped."""
    keys = ["region", "variable"]
    rows = hourly("sf", "2020-11-01 01:00", 24 * 30, lambda n: n)            # November on the shifted clock, complete
    rows += hourly("t2m", "2020-12-01 00:00", 24 * 31, lambda n: n)          # December as stamped, complete
    rows += hourly("tcc", "2020-09-01 01:00", 24 * 30 - 1)                   # September without its first stamp
    stamps = spark.createDataFrame(rows, "region string, variable string, valid_time timestamp, value double")
    days = gridded.two_clock_days(stamps, keys)
    months = {(r.variable, r.target): r.value for r in gridded.full_months(days, keys).collect()}
    assert months == {("sf", day("2020-11-01")): float(sum(range(720))), ("t2m", day("2020-12-01")): (24 * 31 - 1) / 2}
    seen = {(r.variable, r.d): r.value for r in gridded.observed_days(days, keys).collect()}
    assert ("sf", day("2020-11-01")) not in seen and seen["sf", day("2020-11-02")] == float(sum(range(23, 47)))
    assert ("tcc", day("2020-09-01")) not in seen and seen["tcc", day("2020-09-02")] == 1.0
    assert len([k for k in seen if k[0] == "t2m"]) == 31


def test_unknown_values_make_a_day_incomplete(spark):
    rows = [(*r[:3], None if n == 5 else r[3]) for n, r in enumerate(hourly("t2m", "2020-12-01", 48))]
    days = gridded.two_clock_days(spark.createDataFrame(rows, "region string, variable string, valid_time timestamp, value double"), ["region", "variable"])
    assert [(r.d, r.value) for r in gridded.observed_days(days, ["region", "variable"]).collect()] == [(day("2020-12-02"), 1.0)]


def write_small_grids(spark, tmp_path):
    analysis, forecast = str(tmp_path / "analysis"), str(tmp_path / "forecast")
    cells = []
    for variable, month, units in (("t2m", 12, "K"), ("sf", 11, "m"), ("tcc", 9, "1")):
        start = at(f"2020-{month:02d}-01 00:00" if variable != "sf" else "2020-11-01 01:00")
        for n in range(24 * (31 if month == 12 else 30)):
            for lat, extra in ((45.0, 0.0), (45.5, 2.0), (80.0, 1000.0)):
                base = 273.15 if units == "K" else 0.0
                cells.append((variable, start, n, None, lat, -75.0, base + 1.0 + extra, units))
    schema = "variable string, ref_time timestamp, step_h int, valid_time timestamp, lat double, lon double, value double, units string"
    grid.write_grid(grid.normalise_valid_time(spark.createDataFrame(cells, schema)), analysis)
    leads = []
    for variable, units in (("t2m", "K"), ("sf", "m"), ("tcc", "1")):
        for month in (9, 10, 11, 12):
            for number in (1, 2):
                for lead in range(1, 130):
                    value = {"t2m": 275.15 + number, "sf": 2.0 * number * lead, "tcc": 0.5}[variable]
                    leads.append((variable, at(f"2020-{month:02d}-01"), lead * 24, None, 45.0, -75.0, value, units, at(f"2020-{month:02d}-01"), number))
    grid.write_grid(spark.createDataFrame(leads, schema + ", issue_time timestamp, number int"), forecast, "issue_time")
    return analysis, forecast


def issued(spark, *rows):
    return spark.createDataFrame([(day(d), feed) for d, feed in rows], "issued date, feed string")


HERE = ("here", 44.0, 46.0, -76.0, -74.0)


def test_forecast_input_from_grids(spark, tmp_path):
    """Full months from the analysis, others from the forecast with the observed days spliced in; per region."""
    analysis, forecast = write_small_grids(spark, tmp_path)
    rules = fc.source_rules(issued(spark, ("2020-10-07", "monthly"), ("2020-12-14", "weekly"), ("2021-02-07", "monthly")))
    places = spark.createDataFrame([HERE, ("nowhere", 0.0, 1.0, 0.0, 1.0)], BOXES)
    got = {(r.issued, r.number): r for r in gridded.forecast_input(spark, rules, places, analysis, forecast).collect()}
    assert {r.region for r in got.values()} == {"here"}
    # October: September's cloud is observed (cells of 1 and 3), the rest is forecast from October's issue
    first = got[day("2020-10-07"), 1]
    close([first.tcc, first.t2m, first.sf], [2.0, 3.0, 2.0 * 60])  # sf is read at the lead of November 30
    # mid December: November's snow is complete (720 stamps of 2), of the leads from December 2 on eight days are observed at 2 degrees
    weekly = got[day("2020-12-14"), 2]
    close([weekly.sf, weekly.tcc, weekly.t2m], [1440.0, 2.0, (8 * 2.0 + 22 * 4.0) / 30])
    assert (day("2021-02-07"), 1) not in got and got[day("2021-02-07"), 0].t2m == pytest.approx(2.0)  # all observed: the mean only


def test_only_named_folders_are_opened(spark, tmp_path):
    analysis, _ = write_small_grids(spark, tmp_path)
    rules = fc.source_rules(issued(spark, ("2020-10-07", "monthly")))
    folders = gridded.analysis_folders(rules)
    assert sorted(tuple(r) for r in folders.collect()) == [("tcc", 2020, 9)]
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    path = str(tmp_path / "folders")
    folders.write.parquet(path)
    rows = gridded.read_folders(spark, analysis, grid.ANALYSIS_SCHEMA, spark.read.parquet(path))
    assert rows.select("variable").distinct().collect()[0][0] == "tcc" and rows.count() == 24 * 30 * 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pruned = [line for line in plan.splitlines() if "PartitionFilters" in line and "dynamicpruning" in line]
    assert pruned and all(f"{c}#" in pruned[0] for c in ("variable", "year", "month"))
    # the summed variable also reads the month after
    late = gridded.analysis_folders(fc.source_rules(issued(spark, ("2020-12-07", "monthly"))))
    assert ("sf", 2020, 12) in {tuple(r) for r in late.collect()}


def test_one_aggregate_equals_the_lead_by_lead_splice(spark):
    """Random rules, gaps and unknown values: months from the one pass equal those from the spliced leads."""
    rng = random.Random(9)
    rules = fc.source_rules(issued(spark, *[(f"2020-{m:02d}-{d:02d}", "weekly") for m, d in ((9, 14), (9, 28), (11, 9), (11, 23), (12, 7), (12, 28))], ("2020-12-07", "monthly")))
    days = [day("2020-08-20") + dt.timedelta(days=n) for n in range(140)]
    observed = spark.createDataFrame([("x", v, d, None if rng.random() < 0.1 else rng.random()) for v in fc.NAMES for d in days if rng.random() < 0.8],
                                     "place string, variable string, d date, value double")
    rows = []
    for v in fc.NAMES:
        for m in (8, 9, 10, 11, 12):
            for number in (1, 2):
                rows += [("x", v, day(f"2020-{m:02d}-01"), number, day(f"2020-{m:02d}-01") + dt.timedelta(days=n), None if rng.random() < 0.1 else 5 + n + rng.random())
                         for n in range(1, 150) if rng.random() < 0.9]
    leads = spark.createDataFrame(rows, "place string, variable string, issue date, number int, d date, value double")
    got = fc.spliced_months(rules.withColumn("place", F.lit("x")), fc.observed_parts(rules, observed, ["place"]), leads, ["place"])

    keys = ["issued", "feed", "variable", "target"]
    wanted = rules.select("issued", "feed", "variable", "target", F.col("forecast_issue").alias("issue"), "observed_until", "method")
    joined = leads.join(wanted.drop("observed_until"), ["variable", "issue"])
    seen = wanted.where("observed_until IS NOT NULL").withColumn("d", F.explode(F.sequence("target", "observed_until"))).join(
        observed.withColumnRenamed("value", "obs"), ["variable", "d"]).where("obs IS NOT NULL")
    means = joined.where((F.col("method") == "mean") & (F.trunc("d", "month") == F.col("target")))
    by_mean = ensemble.splice_mean(means, seen.where("method = 'mean'").select(*keys, "d", "obs"), keys).groupBy(*keys, "number").agg(F.avg("value").alias("value"))
    spliced = ensemble.splice_cumulative(joined.where("method = 'sum'"), seen.where("method = 'sum'").select(*keys, "d", "obs"), keys, ["issue", "number"])
    by_sum = agg.value_at_month_end(spliced, ["issued", "feed", "variable", "number"], "d", "value", "target")
    want = by_mean.select(*keys, "number", "value").unionByName(by_sum.select(*keys, "number", "value"))
    key = lambda df: {(r.issued, r.feed, r.variable, r.number): r.value for r in df.collect()}
    got, want = key(got), key(want)
    assert got.keys() == want.keys() and len(got) > 30
    close([got[k] for k in sorted(want)], [want[k] for k in sorted(want)])


def test_missing_predictors_are_named(spark):
    inputs = spark.createDataFrame([("a", day("2020-12-07"), "monthly", 0, 1.0, None, None), ("a", day("2020-12-07"), "monthly", 1, 1.0, None, None),
                                    ("b", day("2020-12-07"), "monthly", 0, 1.0, 1.0, 1.0)],
                                   "region string, issued date, feed string, number int, t2m double, sf double, tcc double")
    rules = fc.source_rules(issued(spark, ("2020-12-07", "monthly"), ("2020-12-14", "weekly")))
    gaps = sorted(((r.region, str(r.issued), r.missing) for r in fc.missing_predictors(rules, inputs, ["region"]).collect()), key=str)
    assert gaps == [("a", "2020-12-07", ["sf", "tcc"]), (None, "2020-12-14", ["t2m", "sf", "tcc"])]
    assert fc.require_predictors(inputs.where("region = 'b'"), ["region"]).count() == 1
    with pytest.raises(PySparkException, match="sf not found in analysis or forecast: a 2020-12-07 monthly"):
        fc.require_predictors(inputs, ["region"]).collect()
