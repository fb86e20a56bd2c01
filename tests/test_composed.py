"""The composed jobs on small inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from frostline.plans import bootstrap, chart, forecast, yearly
from frostline.operators import align, model
from frostline.sources import tables
from helpers import at, close, column, daily, day

K = ["k"]


def test_initial_series_joins_its_pieces(spark):
    def hourly(first, days, value):
        return [("a", at(first) + dt.timedelta(hours=h), value) for h in range(0, 24 * days, 6)]

    schema = "k string, ts timestamp, t double"
    sheet = [r for r in hourly("2020-01-01", 731, 4.0) if r[1].date() != day("2020-03-01")]
    logger = hourly("2022-01-08", 6, 5.0)
    untimed = hourly("2022-01-11", 1, 6.0)
    series = bootstrap.initial_series(
        *[spark.createDataFrame(x, schema) for x in (sheet, logger, untimed)], K,
        ("2022-01-01", "2022-01-09"), ("2022-01-10", "2022-01-10"))
    rows = {r.d: r.t for r in series.collect()}
    assert rows[day("2020-03-01")] is None                       # a missing old day stays a row
    assert rows[day("2021-12-31")] == 4.0
    assert rows[day("2022-01-05")] == 4.0                        # bridged
    assert rows[day("2022-01-10")] == 5.0                        # logger, sliced to its period
    assert rows[day("2022-01-11")] == 6.0
    assert max(rows) == day("2022-01-11") and len(rows) == 731 + 11


def test_yearly_chain_finds_the_freeze_up(spark):
    days = spark.sql("SELECT 'a' AS k, explode(sequence(date'2000-01-01', date'2003-12-31')) AS d")
    # a yearly wave that touches the offset of 0.4 in mid winter, with one sensor jump in summer
    wave = 10 - 10 * F.cos((F.dayofyear("d") - 30) * 2 * 3.141592653589793 / 365)
    series = days.withColumn("t", F.round(wave, 3) + 0.4)
    series = series.withColumn("t", F.when(F.col("d") == F.lit(day("2001-07-10")), 60.0).otherwise(F.col("t")))
    tw = yearly.processed_series(series, K)
    jump = tw.where(F.col("d") == F.lit(day("2001-07-10"))).first()
    assert jump.t == 60.0 and jump.t_processed < 25                # masked and interpolated
    fuds = {r.season: r for r in yearly.observed_freeze_up(tw, K).collect()}
    assert set(fuds) == {2000, 2001, 2002}
    for season, row in fuds.items():
        assert dt.date(season, 12, 20) < row.fud < dt.date(season + 1, 1, 31)
        assert row.fudoy > 350


def analysis(spark, months, value):
    rows = []
    for variable, first, n in months:
        rows += [(variable, day(first) + dt.timedelta(days=k), value) for k in range(n)]
    return spark.createDataFrame(rows, "variable string, d date, value double")


def test_forecast_input_takes_the_right_source(spark):
    issues = spark.createDataFrame([(day("2001-10-01"), "weekly"), (day("2001-10-07"), "monthly"), (day("2002-01-07"), "monthly"), (day("2001-05-07"), "monthly")], "issued date, feed string")
    rules = forecast.source_rules(issues.where(F.month("issued") != 5))
    table = {(r.issued, r.variable): r for r in rules.collect()}
    early = table[(day("2001-10-01"), "tcc")]
    assert (early.analysis_due, early.forecast_issue, early.observed_until) == (False, day("2001-09-01"), day("2001-09-26"))
    assert table[(day("2001-10-07"), "tcc")].analysis_due
    assert table[(day("2001-10-07"), "t2m")].forecast_issue == day("2001-10-01")
    assert table[(day("2001-10-01"), "t2m")].forecast_issue == day("2001-09-01")
    assert table[(day("2002-01-07"), "t2m")].analysis_due and table[(day("2002-01-07"), "t2m")].season == 2001

    observed = analysis(spark, [("tcc", "2001-09-01", 30), ("sf", "2001-11-01", 30), ("t2m", "2001-12-01", 31)], 1.0)
    leads = [(v, day("2001-09-01") if v == "tcc" else i, n, i + dt.timedelta(days=k), float(k * n if v == "sf" else 10 * n))
             for v in ("t2m", "sf", "tcc") for i in (day("2001-09-01"), day("2001-10-01")) for n in (1, 2) for k in range(1, 120)
             if not (v == "tcc" and i == day("2001-10-01"))]
    members = spark.createDataFrame(leads, "variable string, issue date, number int, d date, value double")
    inputs = {(r.issued, r.number): r for r in forecast.forecast_input(rules, observed, members).collect()}
    # weekly on October 1: September 1-26 observed as 1.0, lead 1 is September 2, the rest of the month forecast
    close([inputs[(day("2001-10-01"), 1)].tcc], [(25 * 1.0 + 4 * 10) / 29])
    # monthly on October 7: the analysed September for everyone, forecasts for the rest
    row = inputs[(day("2001-10-07"), 2)]
    assert (row.tcc, row.t2m) == (1.0, 20.0)
    assert row.sf == 2.0 * (day("2001-11-30") - day("2001-10-01")).days
    # January: everything analysed, no members
    assert {n for i, n in inputs if i == day("2002-01-07")} == {0}
    row = inputs[(day("2002-01-07"), 0)]
    assert (row.t2m, row.sf, row.tcc) == (1.0, 30.0, 1.0)

    fitted = model.fit_mlr(spark.createDataFrame([(float(a), float(b), float(c), 360 + a - b + 2.0 * c) for a, b, c in [(1, 2, 3), (4, 1, 1), (2, 2, 0), (0, 5, 1), (3, 3, 3)]], "t2m double, sf double, tcc double, y double"), "y", forecast.NAMES)
    out = forecast.run_forecast(forecast.forecast_input(rules, observed, members), fitted).where(F.col("issued") == F.lit(day("2002-01-07"))).first()
    assert (out.fud, out.fud_date, out.season) == (333, day("2001-11-29"), 2001)


def test_operational_rules_wait_for_the_release_day(spark):
    issues = spark.createDataFrame([(day("2001-09-06"), "weekly"), (day("2001-09-10"), "weekly")], "issued date, feed string")
    until = lambda rules: [r.observed_until for r in rules.where("variable = 'tcc'").orderBy("issued").collect()]
    assert until(forecast.source_rules(issues)) == [day("2001-09-01"), day("2001-09-05")]
    assert until(forecast.source_rules(issues, from_release_day=True)) == [None, day("2001-09-05")]


def test_issue_calendar(spark):
    span = spark.createDataFrame([(day("2001-06-25"),), (day("2001-08-31"),)], "d date")
    got = sorted((r.issued.isoformat()[5:], r.feed) for r in forecast.issue_calendar(F.min("d"), F.max("d"), span).collect())
    assert ("07-02", "weekly") not in got and ("07-09", "weekly") in got
    assert [d for d, f in got if f == "monthly"] == ["07-07", "08-07"]


def test_training_table_reduces_space_then_time(spark):
    rows = []
    for y in (2000, 2001):
        rows += [("t2m", at(f"{y}-12-01 00:00"), 1.0), ("t2m", at(f"{y}-12-01 00:00"), 3.0), ("t2m", at(f"{y}-12-02 00:00"), 8.0)]
        rows += [("sf", at(f"{y}-11-01 00:00"), 100.0), ("sf", at(f"{y}-11-01 01:00"), 2.0), ("sf", at(f"{y}-12-01 00:00"), 3.0), ("sf", at(f"{y}-12-01 00:00"), 5.0)]
        rows += [("tcc", at(f"{y}-09-30 23:00"), 0.5), ("tcc", at(f"{y}-10-01 00:00"), 9.0)]
    predictors = yearly.monthly_predictors(spark.createDataFrame(rows, "variable string, valid_time timestamp, value double"))
    fuds = spark.createDataFrame([("a", 2000, day("2000-12-20"), 355)], "k string, season int, fud date, fudoy int")
    out = yearly.training_table(predictors, fuds).orderBy("season").collect()
    # November 1 00:00 belongs to October, December 1 00:00 to November
    assert [(r.season, r.t2m, r.sf, r.tcc, r.fudoy) for r in out] == [(2000, 5.0, 6.0, 0.5, 355), (2001, 5.0, 6.0, 0.5, None)]


def test_chart_shows_the_running_season_without_the_mean_offset(spark):
    processed = daily(spark, [5, 6], "2000-07-01").select("k", "d", "t", F.lit(2.0).alias("t_winter_offset"), (F.col("t") - 2).alias("t_no_offset"))
    updated = daily(spark, [1, 7, 8], "2001-07-01")
    shown = chart.shown_series(processed, updated, K, "2001-07-03")
    assert column(shown, "t") == [3.0, 4.0, 0.0, 5.0]              # July 3 itself is not over


def test_chart_prefers_the_latched_date(spark):
    observed = spark.createDataFrame([("a", 2000, day("2000-12-20")), ("b", 2000, day("2000-12-21")), ("b", 2001, day("1999-01-01"))], "k string, season int, fud date")
    latched = spark.createDataFrame([("a", 2001, day("2001-12-18"))], "k string, season int, frozen_date date")
    expected = spark.createDataFrame([("a", 2001, day("2001-12-25")), ("b", 2001, day("2001-12-26"))], "k string, season int, fud_date date")
    got = chart.chart_freeze_up(observed, latched, expected, K, "2002-01-15").collect()
    assert sorted((r.k, r.season, r.fud) for r in got) == [
        ("a", 2000, day("2000-12-20")), ("a", 2001, day("2001-12-18")), ("b", 2000, day("2000-12-21")), ("b", 2001, day("2001-12-26"))]


def test_gate_and_labels_compose(spark):
    ok = tables.quality_gate(daily(spark, [1, 2]), K, "daily", "d", 1, "2001-01-02").where("ok").select("k")
    assert align.require_labels(daily(spark, [1, 2]), ok, K, "t").count() == 2
