"""Queries that start at stored grids: regions, two clocks, forecast input and replay per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline import session
from frostline.functions import calendar as cal
from frostline.operators import ensemble, model, publish
from frostline.plans import forecast as fc
from frostline.plans import gridded, yearly
from frostline.registry import ensembles as e
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.inputs import rnd, text, with_ctes
from frostline.sources import grid, tables

PER_DAY = 2  # the synthetic grids are stamped at midnight and at noon
REGIONS = [("north", 44.0, 50.0, -80.0, -70.0), ("east", 40.0, 50.0, -75.0, -70.0), ("spot", 44.9, 45.2, -75.0, -74.9)]
KELVIN = 273.15


def regions(spark) -> DataFrame:
    return spark.createDataFrame(REGIONS, "region string, lat_min double, lat_max double, lon_min double, lon_max double")


def _variables(*values) -> F.Column:
    """One row per variable; the temperature of every other cell is in Kelvin."""
    t2m, sf, tcc, kelvin = values
    row = lambda name, value, units: F.struct(F.lit(name).alias("variable"), value.cast("double").alias("value"), units.alias("units"))
    return F.explode(F.array(row("t2m", F.when(kelvin, t2m + KELVIN).otherwise(t2m), F.when(kelvin, "K").otherwise("C")), row("sf", sf, F.lit("m")), row("tcc", tcc, F.lit("1"))))


def analysis_cells(spark, sf) -> DataFrame:
    """Line items as cells of an analysis stamped twice a day."""
    step = (F.col("l_orderkey") % 2 * 12).cast("int")
    rows = i.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ref_time"), step.alias("step_h"),
        (F.lit(40.05) + F.col("l_suppkey") % 100 / 10).alias("lat"), (F.lit(-79.95) + F.col("l_partkey") % 100 / 10).alias("lon"),
        _variables(F.col("l_quantity"), F.col("l_extendedprice") / 1009, F.col("l_discount") * 101 / i.OBS_DIVISOR, F.col("l_linenumber") % 2 == 0).alias("v"))
    stamp = F.col("ref_time") + F.make_dt_interval(hours=F.col("step_h"))
    return rows.select("v.variable", "ref_time", "step_h", stamp.alias("valid_time"), "lat", "lon", "v.value", "v.units")


def forecast_cells(spark, sf) -> DataFrame:
    """Monthly forecasts of four cells, seven members and 215 daily leads; sf accumulates since the issue in each cell."""
    cell = [(F.lit(40.05) + F.col("l_suppkey") % 2 * 5).alias("lat"), (F.lit(-79.95) + F.col("l_partkey") % 2 * 5).alias("lon")]
    daily = i.table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").cast("int").alias("number"), F.col("l_shipdate").cast("date").alias("d"), *cell).agg(
        F.avg("l_quantity").alias("t2m"), (F.avg("l_extendedprice") / 1009).alias("sf"), (F.avg("l_discount") * 101 / i.OBS_DIVISOR).alias("tcc"))
    rows = daily.select("number", "d", "lat", "lon", _variables(F.col("t2m"), F.col("sf"), F.col("tcc"), F.col("number") % 2 == 0).alias("v")).select("number", "d", "lat", "lon", "v.*")
    first = F.trunc(F.date_sub("d", e.LEADS), "month").cast("date")
    issues = F.explode(F.sequence(first, F.trunc("d", "month").cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("issue")
    rows = rows.select("*", issues).where((F.col("d") > F.col("issue")) & (F.date_diff("d", "issue") <= e.LEADS))
    since = Window.partitionBy("variable", "issue", "number", "lat", "lon").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("variable") == "sf", F.sum("value").over(since)).otherwise(F.col("value"))
    issued = F.col("issue").cast("timestamp")
    return rows.select("variable", issued.alias("ref_time"), (F.date_diff("d", "issue") * 24).alias("step_h"), F.lit(None).cast("timestamp").alias("valid_time"),
                       "lat", "lon", value.alias("value"), "units", issued.alias("issue_time"), "number")


def stored_grids(spark, sf) -> tuple[str, str]:
    analysis, forecast = session.new_folder(spark, "analysis-grid"), session.new_folder(spark, "forecast-grid")
    grid.write_grid(analysis_cells(spark, sf), analysis)
    grid.write_grid(forecast_cells(spark, sf), forecast, "issue_time")
    return analysis, forecast


# --- the same in SQL -------------------------------------------------------------------

PLACES = "SELECT * FROM (VALUES " + ", ".join(f"('{r[0]}', " + ", ".join(f"CAST({x} AS DOUBLE)" for x in r[1:]) + ")" for r in REGIONS) + ") v(region, lat_min, lat_max, lon_min, lon_max)"
VARIABLES = "unnest([{'variable': 't2m', 'value': t2m}, {'variable': 'sf', 'value': sf}, {'variable': 'tcc', 'value': tcc}], recursive := true)"
INSIDE = "lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max"
GRID_SQL = {
    "places": PLACES,
    "cells": """SELECT CAST(l_shipdate AS TIMESTAMP) + INTERVAL 12 HOUR * (l_orderkey % 2) AS ts, 40.05 + (l_suppkey % 100) / CAST(10 AS DOUBLE) AS lat,
        -79.95 + (l_partkey % 100) / CAST(10 AS DOUBLE) AS lon, CAST(l_quantity AS DOUBLE) AS t2m, CAST(l_extendedprice AS DOUBLE) / 1009 AS sf, CAST(l_discount AS DOUBLE) * 101 / 1.0009 AS tcc FROM lineitem""",
    "region_cells": f"SELECT region, ts, t2m, sf, tcc FROM cells JOIN places ON {INSIDE}",
    "stamp_means": "SELECT region, ts, avg(t2m) AS t2m, avg(sf) AS sf, avg(tcc) AS tcc FROM region_cells GROUP BY 1, 2",
    "stamps": f"SELECT region, ts, {VARIABLES} FROM stamp_means",
    "analysis_region": f"""SELECT region, variable, d, value FROM (SELECT region, variable, CAST(ts AS DATE) AS d, count(*) AS n,
        CASE WHEN variable = 'sf' THEN sum(value) ELSE avg(value) END AS value FROM stamps GROUP BY 1, 2, 3) WHERE n = {PER_DAY}""",
    "full_region": f"""SELECT region, variable, target, value FROM (SELECT region, variable, CAST(date_trunc('month', CASE WHEN variable = 'sf' THEN ts - INTERVAL 30 MINUTE ELSE ts END) AS DATE) AS target,
        count(*) AS n, CASE WHEN variable = 'sf' THEN sum(value) ELSE avg(value) END AS value FROM stamps GROUP BY 1, 2, 3) WHERE n = {PER_DAY} * day(last_day(target))""",
    "cell_days": """SELECT l_linenumber AS number, CAST(l_shipdate AS DATE) AS d, 40.05 + (l_suppkey % 2) * 5 AS lat, -79.95 + (l_partkey % 2) * 5 AS lon,
        avg(l_quantity) AS t2m, avg(l_extendedprice) / 1009 AS sf, avg(l_discount) * 101 / 1.0009 AS tcc FROM lineitem GROUP BY 1, 2, 3, 4""",
    "cell_rows": f"SELECT number, d, lat, lon, {VARIABLES} FROM cell_days",
    "cell_leads": f"""SELECT variable, issue, number, d, lat, lon, CASE WHEN variable = 'sf' THEN sum(value) OVER
          (PARTITION BY variable, issue, number, lat, lon ORDER BY d ROWS UNBOUNDED PRECEDING) ELSE value END AS value
        FROM (SELECT *, CAST(unnest(generate_series(date_trunc('month', d - {e.LEADS}), date_trunc('month', d), INTERVAL 1 MONTH)) AS DATE) AS issue FROM cell_rows)
        WHERE d > issue AND d - issue <= {e.LEADS}""",
    "fcst": f"SELECT region, variable, issue, number, d, avg(value) AS value FROM cell_leads JOIN places ON {INSIDE} GROUP BY 1, 2, 3, 4, 5",
    "known": "SELECT region, issued, feed, variable, value FROM rules JOIN full_region USING (variable, target) WHERE analysis_due",
    "open_rules": """SELECT * FROM (SELECT r.*, region FROM rules r JOIN (SELECT DISTINCT region, variable, issue FROM fcst) f ON f.variable = r.variable AND f.issue = r.forecast_issue)
        ANTI JOIN known USING (region, issued, feed, variable)""",
    "leads": """SELECT r.region, r.issued, r.feed, r.variable, r.target, r.method, r.observed_until, f.issue, f.number, f.d, f.value
        FROM fcst f JOIN open_rules r ON r.region = f.region AND r.variable = f.variable AND r.forecast_issue = f.issue""",
    "by_mean": """SELECT l.region, l.issued, l.feed, l.variable, l.number, avg(coalesce(a.value, l.value)) AS value FROM leads l
        LEFT JOIN analysis_region a ON a.region = l.region AND a.variable = l.variable AND a.d = l.d AND a.d BETWEEN l.target AND l.observed_until
        WHERE method = 'mean' AND CAST(date_trunc('month', l.d) AS DATE) = l.target GROUP BY 1, 2, 3, 4, 5""",
    "sums": "SELECT region, issued, feed, variable, target, issue, number, d, value FROM leads WHERE method = 'sum'",
    "seen": """SELECT r.region, r.issued, r.feed, r.variable, r.target, a.d, a.value AS obs FROM open_rules r
        JOIN analysis_region a ON a.region = r.region AND a.variable = r.variable AND a.d BETWEEN r.target AND r.observed_until WHERE method = 'sum'""",
    **e.splice_sql("sums", "seen", ["region", "issued", "feed", "variable", "target"], ["issue", "number"]),
    "by_sum": """SELECT region, issued, feed, variable, number, value FROM (SELECT *, row_number() OVER
        (PARTITION BY region, issued, feed, variable, number ORDER BY abs(d - last_day(target)), d) AS rn FROM spliced) WHERE rn = 1""",
    "members": "SELECT * FROM by_mean UNION ALL SELECT * FROM by_sum",
    "best": "SELECT * FROM known UNION ALL SELECT region, issued, feed, variable, avg(value) FROM members GROUP BY 1, 2, 3, 4",
    "bw": "SELECT region, issued, feed, " + ", ".join(e._pick(v, "b") for v in fc.NAMES) + " FROM best GROUP BY 1, 2, 3",
    "mw": "SELECT region, issued, feed, number, " + ", ".join(e._pick(v, "m") for v in fc.NAMES) + " FROM members GROUP BY 1, 2, 3, 4",
    "inputs": """SELECT region, issued, feed, 0 AS number, t2m, sf, tcc FROM bw UNION ALL
        SELECT region, issued, feed, number, coalesce(mw.t2m, bw.t2m), coalesce(mw.sf, bw.sf), coalesce(mw.tcc, bw.tcc) FROM mw JOIN bw USING (region, issued, feed)""",
}


@query("region_days", with_ctes("", f"""SELECT region, variable, {text('CAST(ts AS DATE)')} AS d, count(*) AS n, {rnd('sum(value)')} AS total,
       count(CASE WHEN hour(ts) = 0 THEN 1 END) AS early_n, {rnd('sum(CASE WHEN hour(ts) = 0 THEN value END)')} AS early FROM stamps GROUP BY 1, 2, 3""", **GRID_SQL))
def region_days(spark, sf):
    """Stored analysis cells to regions by tiles, to stamps, to days on two clocks."""
    path = session.new_folder(spark, "analysis-grid")
    grid.write_grid(analysis_cells(spark, sf), path)
    cells = spark.read.schema(grid.ANALYSIS_SCHEMA).parquet(path)
    return gridded.two_clock_days(gridded.region_stamps(cells, regions(spark)), ["region", "variable"])


@query("region_months", with_ctes("", f"SELECT region, variable, {text('target')} AS target, {rnd('value', 4)} AS value FROM full_region", **GRID_SQL), digits=4)
def region_months(spark, sf):
    """Complete months: means by the stamped clock, sums by the one half an hour behind."""
    keys = ["region", "variable"]
    days = gridded.two_clock_days(gridded.region_stamps(analysis_cells(spark, sf), regions(spark)), keys)
    return gridded.full_months(days, keys, PER_DAY)


def _inputs(spark, sf, rules) -> DataFrame:
    analysis, forecast = stored_grids(spark, sf)
    return gridded.forecast_input(spark, rules, regions(spark), analysis, forecast, PER_DAY)


def _rules(spark, sf) -> DataFrame:
    return fc.source_rules(e._issues(spark, sf))


@query("grid_forecast_input", with_ctes("", f"""SELECT region, {text('issued')} AS issued, feed, number, {rnd('t2m', 9)} AS t2m, {rnd('sf')} AS sf, {rnd('tcc', 9)} AS tcc FROM inputs""",
       **e.RULES_SQL, **GRID_SQL), digits=9)
def grid_forecast_input(spark, sf):
    """Forecast input of every region and issue from stored grids, opening only the folders that the issue rules name."""
    return _inputs(spark, sf, _rules(spark, sf)).withColumn("sf", F.round("sf", 6))


MISSING_SQL = {
    "partly": "SELECT region, issued, feed, list_filter([" + ", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in fc.NAMES) + """], lambda x: x IS NOT NULL) AS gaps FROM inputs WHERE number = 0""",
    "wholly": f"SELECT NULL AS region, issued, feed, {list(fc.NAMES)} AS gaps FROM (SELECT DISTINCT issued, feed FROM issues) ANTI JOIN inputs USING (issued, feed)",
}


@query("missing_predictors", with_ctes("", f"""SELECT region, {text('issued')} AS issued, feed, array_to_string(gaps, ',') AS missing FROM
       (SELECT * FROM partly WHERE len(gaps) > 0 UNION ALL SELECT * FROM wholly)""", **e.RULES_SQL, **GRID_SQL, **MISSING_SQL))
def missing_predictors(spark, sf):
    """Issues and regions for which neither analysis nor forecast has a predictor, by name."""
    rules = session.materialise(_rules(spark, sf), "rules")
    gaps = fc.missing_predictors(rules, session.materialise(_inputs(spark, sf, rules), "inputs"), ["region"])
    return gaps.withColumn("missing", F.concat_ws(",", "missing"))


@query("grid_hindcast", with_ctes("analysis_wide", f"""SELECT region, {text('issued')} AS issued, feed, number, season, {rnd('p', 4)} AS prediction, CAST(round_even(p, 0) AS INTEGER) AS fud,
       {text(e.FUD_DATE_SQL)} AS fud_date
       FROM (SELECT inputs.*, b + b0 * t2m + b1 * sf + b2 * tcc AS p, CASE WHEN month(issued) <= 4 THEN year(issued) - 1 ELSE year(issued) END AS season FROM inputs, fitted)""",
       **e.RULES_SQL, **GRID_SQL, **e.TRAINING, **e.fit_sql("training")), digits=4)
def grid_hindcast(spark, sf):
    """Replay of every issue for every region, from stored grids to dates."""
    replay = fc.run_forecast(_inputs(spark, sf, _rules(spark, sf)), model.fit_mlr(e.training(spark, sf), "y", fc.NAMES))
    return replay.select("region", "issued", "feed", "number", "season", "prediction", "fud", "fud_date")


# --- training and publication ----------------------------------------------------------


@query("stored_predictors", with_ctes("", f"SELECT season, {rnd('t2m', 5)} AS t2m, {rnd('sf', 5)} AS sf, {rnd('tcc', 5)} AS tcc FROM p",
       cells=GRID_SQL["cells"], stamps="SELECT ts, avg(t2m) AS t2m, avg(sf) AS sf, avg(tcc) AS tcc FROM cells GROUP BY 1",
       p="""SELECT season, max(t2m) AS t2m, max(sf) AS sf, max(tcc) AS tcc FROM (
        SELECT year(ts) AS season, avg(t2m) AS t2m, NULL AS sf, NULL AS tcc FROM stamps WHERE month(ts) = 12 GROUP BY 1
        UNION ALL SELECT year(h), NULL, sum(sf), NULL FROM (SELECT ts - INTERVAL 30 MINUTE AS h, sf FROM stamps) WHERE month(h) = 11 GROUP BY 1
        UNION ALL SELECT year(ts), NULL, NULL, avg(tcc) FROM stamps WHERE month(ts) = 9 GROUP BY 1) GROUP BY 1"""), digits=5)
def stored_predictors(spark, sf):
    """Training predictors from a stored analysis, a pruned scan per predictor."""
    path = session.new_folder(spark, "analysis-grid")
    grid.write_grid(analysis_cells(spark, sf), path)
    return ensemble.widen(yearly.stored_predictors(spark, path), ["season"], fc.NAMES)


OPERATION_SQL = {**e.RULES_SQL, "rules": e.RULES_SQL["rules"].replace("AND reach >= target THEN reach", "AND reach >= target AND issued >= target + 6 THEN reach")}


@query("source_rules_operation", with_ctes("", f"""SELECT {text('issued')} AS issued, feed, season, variable, method, {text('target')} AS target, analysis_due,
       {text('forecast_issue')} AS forecast_issue, {text('observed_until')} AS observed_until FROM rules""", **OPERATION_SQL))
def source_rules_operation(spark, sf):
    """Rules of the running service, which splices observed days from the release day on."""
    return fc.source_rules(e._issues(spark, sf), from_release_day=True)


SHOWN_ON = "1998-07-05"
LATEST_SQL = {
    **e.TRAINING, **e.fit_sql("training"),
    "member_x": "SELECT CAST(date_trunc('month', d) AS DATE) AS month, number, avg(t2m) AS t2m, sum(sf) AS sf, avg(tcc) AS tcc FROM grid_wide GROUP BY 1, 2",
    "inputs": "SELECT * FROM member_x UNION ALL SELECT month, 0, avg(t2m), avg(sf), avg(tcc) FROM member_x GROUP BY 1",
    "log": """SELECT month AS issued, number, CAST(round_even(b + b0 * t2m + b1 * sf + b2 * tcc, 0) AS INTEGER) AS p,
        CASE WHEN month(month) <= 4 THEN year(month) - 1 ELSE year(month) END AS season FROM inputs, fitted WHERE month(month) NOT IN (5, 6)""",
    "newest": f"SELECT * FROM log WHERE number = 0 AND season = 1997 AND issued <= DATE '{SHOWN_ON}' ORDER BY issued DESC LIMIT 1",
}


@query("latest_json", with_ctes("analysis_wide grid_wide", f"""SELECT '{{"latestForecastIssued":"' || {text('issued')} || '","latestForecast":"' || {text(e.FUD_DATE_SQL)} || '"}}' AS json FROM newest""", **LATEST_SQL))
def latest_json(spark, sf):
    """The service from regression to document: forecasts of two feeds logged, the newest of the season shown early in July, exported as JSON and read back."""
    path = session.new_folder(spark, "latest")
    issued = e.mlr_predict_ensemble.__wrapped__(spark, sf).select(F.col("month").cast("date").alias("issued"), F.col("number").cast("int").alias("number"), "fud", cal.forecast_season(F.col("month")).alias("season"))
    issued = session.materialise(issued.where(F.col("season").isNotNull()), "issues")
    tables.append_forecast(issued.withColumn("feed", F.lit("monthly")), f"{path}/log")
    tables.append_forecast(issued.where(F.month("issued") % 2 == 0).withColumn("feed", F.lit("weekly")), f"{path}/log")
    publish.export_json(fc.latest_document(tables.read_forecast_log(spark, f"{path}/log"), SHOWN_ON), f"{path}/json")
    return spark.read.text(f"{path}/json").withColumnRenamed("value", "json")
