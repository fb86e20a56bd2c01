"""Queries on grids, ensembles, regression and the replay of past forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators import aggregate as agg
from frostline.operators import ensemble, model
from frostline.plans import forecast as fc
from frostline.plans import hindcast as hc
from frostline.plans import yearly
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.inputs import rnd, text, with_ctes
from frostline.sources import grid

MEMBERS = range(1, 8)


def lines(spark, sf) -> DataFrame:
    return i.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("number"), F.col("l_shipdate").alias("valid_time"), F.col("l_suppkey").alias("cell"),
        F.col("l_partkey").alias("lon"), F.col("l_quantity").alias("value"),
    )


@query("monthly_mean", f"SELECT l_linenumber AS number, year(l_shipdate) AS y, month(l_shipdate) AS m, {rnd('avg(l_quantity)', 5)} AS value FROM lineitem GROUP BY 1, 2, 3", digits=5)
def monthly_mean(spark, sf):
    return agg.monthly_mean(lines(spark, sf), ["number"], "valid_time", "value")


@query("spatial_mean", f"SELECT l_linenumber AS number, {text('CAST(l_shipdate AS DATE)')} AS d, {rnd('avg(l_quantity / 1.0009)')} AS value FROM lineitem GROUP BY 1, 2")
def spatial_mean(spark, sf):
    rows = lines(spark, sf).select("number", F.col("valid_time").cast("date").alias("d"), (F.col("value") / i.OBS_DIVISOR).alias("value"))
    return agg.spatial_mean(rows, ["number", "d"])


@query("ensemble_mean", f"""SELECT y, m, {rnd('avg(value)')} AS value FROM (SELECT l_linenumber, year(l_shipdate) AS y, month(l_shipdate) AS m,
       avg(l_quantity / 1.0009) AS value FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def ensemble_mean(spark, sf):
    rows = lines(spark, sf).withColumn("value", F.col("value") / i.OBS_DIVISOR)
    return agg.ensemble_mean(agg.monthly_mean(rows, ["number"], "valid_time", "value"), ["y", "m"])


@query("pivot_members", "SELECT y, m, " + ", ".join(f"{rnd(f'max(CASE WHEN number = {n} THEN value END)')} AS member_{n}" for n in MEMBERS) + """
       FROM (SELECT l_linenumber AS number, year(l_shipdate) AS y, month(l_shipdate) AS m, avg(l_quantity / 1.0009) AS value FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def pivot_members(spark, sf):
    rows = lines(spark, sf).withColumn("value", F.col("value") / i.OBS_DIVISOR)
    monthly = agg.monthly_mean(rows, ["number"], "valid_time", "value")
    return ensemble.pivot_members(monthly, ["y", "m"], MEMBERS, value="value")


@query("subset_request", f"""SELECT l_linenumber AS number, count(*) AS n, {rnd('avg(l_quantity / 1.0009)')} AS value FROM lineitem
       WHERE l_suppkey BETWEEN 20 AND 70 AND l_partkey BETWEEN 100 AND 1500 AND month(l_shipdate) IN (9, 11, 12) AND day(l_shipdate) <= 20 GROUP BY 1""")
def subset_request(spark, sf):
    box = grid.Box(20, 70, 100, 1500)
    kept = grid.subset_request(lines(spark, sf), box, months=[9, 11, 12], max_day=20, lat="cell", lon="lon")
    return kept.groupBy("number").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("value") / i.OBS_DIVISOR).alias("value"))


@query("normalize_valid_time", f"SELECT {text('CAST(l_shipdate AS DATE)')} AS d, count(*) AS n, sum(l_linenumber) AS s FROM lineitem GROUP BY 1")
def normalize_valid_time(spark, sf):
    """Odd members carry the stamped time, even members a reference time and a step."""
    stamped = F.col("l_shipdate").cast("timestamp")
    ref = F.date_trunc("month", stamped)
    rows = i.table(spark, sf, "lineitem").select(
        "l_linenumber", F.when(F.col("l_linenumber") % 2 == 1, stamped).alias("valid_time"), ref.alias("ref_time"),
        (F.date_diff(F.col("l_shipdate"), ref) * 24).alias("step_h"),
    )
    day = F.to_date("valid_time").alias("d")
    return grid.normalise_valid_time(rows).groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("s"))


# --- forecasts issued each month -------------------------------------------------------


def issued_forecasts(daily: DataFrame, leads: int) -> DataFrame:
    """Every daily member value as part of all forecasts whose leads cover its day.

    A row fans out to one forecast per month in ``leads`` days; sf accumulates since the issue.
    """
    first = F.trunc(F.date_sub("d", leads), "month").cast("date")
    issues = F.explode(F.sequence(first, F.trunc("d", "month").cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("issue")
    rows = daily.select("*", issues).where((F.col("d") > F.col("issue")) & (F.date_diff("d", "issue") <= leads))
    since = Window.partitionBy("variable", "issue", "number").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("value").over(since)
    return rows.withColumn("value", F.when(F.col("variable") == "sf", total).otherwise(F.col("value")))


def issued_sql(leads: int) -> str:
    return f"""SELECT variable, issue, number, d, CASE WHEN variable = 'sf' THEN sum(value) OVER
          (PARTITION BY variable, issue, number ORDER BY d ROWS UNBOUNDED PRECEDING) ELSE value END AS value
        FROM (SELECT *, CAST(unnest(generate_series(date_trunc('month', d - {leads}), date_trunc('month', d), INTERVAL 1 MONTH)) AS DATE) AS issue FROM grid_daily)
        WHERE d > issue AND d - issue <= {leads}"""


def with_targets(forecast: DataFrame) -> DataFrame:
    """Each forecast serves its issue month and the month after as target."""
    targets = F.explode(F.array("issue", F.add_months("issue", 1))).alias("target")
    return forecast.select("*", targets).where(F.col("d") <= F.last_day("target"))


GRID = "grid_wide grid_daily"
LEADS = 215
TARGETED = {
    "issued": issued_sql(LEADS),
    "targeted": """SELECT * FROM (SELECT *, unnest([issue, CAST(issue + INTERVAL 1 MONTH AS DATE)]) AS target FROM issued) WHERE d <= last_day(target)""",
    "seen": "SELECT CAST(date_trunc('month', d) AS DATE) AS target, d, avg(t) AS obs FROM daily WHERE day(d) <= 12 GROUP BY d",
}


def splice_sql(source: str, observed: str, keys: list[str], member: list[str]) -> dict[str, str]:
    """Steps of the cumulative splice over a forecast (d, value) and its observations (d, obs)."""
    k, km = ", ".join(keys), ", ".join(keys + member)
    on = " AND ".join(f"s.{c} = f.{c}" for c in keys)
    return {
        "s_ends": f"SELECT {k}, min(d) AS i1, max(d) AS i2 FROM {observed} GROUP BY {k}",
        "s_sums": f"""SELECT {k}, d AS own, sum(obs) OVER (PARTITION BY {k} ORDER BY d ROWS UNBOUNDED PRECEDING) AS total,
            lead(d) OVER (PARTITION BY {k} ORDER BY d) AS nxt FROM {observed}""",
        "s_joined": f"SELECT f.*, i1, i2 FROM {source} f LEFT JOIN s_ends USING ({k})",
        "s_anchor": f"""SELECT {km}, arg_max(value, d) FILTER (WHERE d < i1) AS before, arg_max(value, d) FILTER (WHERE d <= i2) AS old,
            max(d) FILTER (WHERE d <= i2) AS last_d, date_trunc('month', min(d)) >= date_trunc('month', min(i1)) AS same FROM s_joined GROUP BY {km}""",
        "s_based": f"""SELECT f.*, a.old, a.last_d, CASE WHEN coalesce(a.same, FALSE) THEN 0 ELSE coalesce(a.before, 0) END AS base
            FROM s_joined f JOIN s_anchor a USING ({km})""",
        "s_at": f"""SELECT f.*, s.total FROM s_based f LEFT JOIN s_sums s ON {on} AND f.d >= s.own AND
            (f.d < s.nxt OR (s.nxt IS NULL AND f.d = s.own))""",
        "s_last": f"SELECT {km}, base + arg_max(total, d) FILTER (WHERE d = last_d) AS new FROM s_at GROUP BY {km}, base",
        "spliced": f"""SELECT f.* EXCLUDE (value), CASE WHEN i1 IS NULL OR d < i1 THEN value WHEN d <= i2 THEN coalesce(base + total, value)
            ELSE coalesce(value - old + new, value) END AS value FROM s_at f JOIN s_last USING ({km})""",
    }


def _issued_targets(spark, sf, *variables):
    return with_targets(issued_forecasts(i.grid_daily(spark, sf).where(F.col("variable").isin(*variables)), LEADS))


def _seen(spark, sf):
    days = i.daily(spark, sf).where(F.dayofmonth("d") <= 12).groupBy("d").agg(F.avg("t").alias("obs"))
    return days.select(F.trunc("d", "month").cast("date").alias("target"), "d", "obs")


@query("splice_mean", with_ctes(f"daily {GRID}", f"""SELECT variable, {text('f.target')} AS target, {text('issue')} AS issue, number, {text('f.d')} AS d, {rnd('coalesce(obs, value)')} AS value
       FROM targeted f LEFT JOIN seen ON seen.target = f.target AND seen.d = f.d WHERE variable IN ('t2m', 'tcc')""", **TARGETED))
def splice_mean(spark, sf):
    spliced = ensemble.splice_mean(_issued_targets(spark, sf, "t2m", "tcc"), _seen(spark, sf), ["target"])
    return spliced.select("variable", "target", "issue", "number", "d", "value")


@query("splice_cumulative", with_ctes(f"daily {GRID}", f"SELECT {text('target')} AS target, {text('issue')} AS issue, number, {text('d')} AS d, {rnd('value', 5)} AS value FROM spliced",
       **TARGETED, sums="SELECT * FROM targeted WHERE variable = 'sf'", **splice_sql("sums", "seen", ["target"], ["issue", "number"])), digits=5)
def splice_cumulative(spark, sf):
    spliced = ensemble.splice_cumulative(_issued_targets(spark, sf, "sf"), _seen(spark, sf), ["target"], ["issue", "number"])
    return spliced.select("target", "issue", "number", "d", "value")


@query("value_at_month_end", with_ctes(f"daily {GRID}", f"""SELECT {text('issue')} AS issue, number, {text('target')} AS target, {text('d')} AS label, {rnd('value', 5)} AS value
       FROM (SELECT *, row_number() OVER (PARTITION BY issue, number, target ORDER BY abs(d - last_day(target)), d) AS rn FROM targeted WHERE variable = 'sf') WHERE rn = 1""", **TARGETED), digits=5)
def value_at_month_end(spark, sf):
    return agg.value_at_month_end(_issued_targets(spark, sf, "sf"), ["issue", "number"], "d", "value", "target")


MONTHS = {
    "member_months": "SELECT variable, number, CAST(date_trunc('month', d) AS DATE) AS month, avg(value) AS value FROM grid_daily GROUP BY 1, 2, 3",
    "mean_months": "SELECT variable, month, avg(value) AS value FROM member_months GROUP BY 1, 2",
}


def member_months(spark, sf):
    return i.grid_daily(spark, sf).groupBy("variable", "number", F.trunc("d", "month").alias("month")).agg(F.avg("value").alias("value"))


def lacking(c):
    """tcc is known for no member, sf not for member 7."""
    return (F.col("variable") == "tcc") | ((F.col("variable") == "sf") & (F.col(c) == 7))


def _pick(v, source):
    return f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}"


@query("member_fallback", with_ctes(GRID, f"""SELECT {text('month')} AS month, 0 AS number, {rnd('t2m')} AS t2m, {rnd('sf')} AS sf, {rnd('tcc')} AS tcc FROM mw
       UNION ALL SELECT {text('month')}, number, {rnd('coalesce(w.t2m, mw.t2m)')}, {rnd('coalesce(w.sf, mw.sf)')}, {rnd('coalesce(w.tcc, mw.tcc)')} FROM w JOIN mw USING (month)""",
       **MONTHS, mw="SELECT month, " + ", ".join(_pick(v, "m") for v in fc.NAMES) + " FROM mean_months GROUP BY 1",
       w="SELECT month, number, " + ", ".join(_pick(v, "m") for v in fc.NAMES) + " FROM member_months WHERE NOT (variable = 'tcc' OR (variable = 'sf' AND number = 7)) GROUP BY 1, 2"))
def member_fallback(spark, sf):
    months = member_months(spark, sf)
    means = agg.ensemble_mean(months, ["variable", "month"])
    return ensemble.member_fallback(months.where(~lacking("number")), means, ["month"], fc.NAMES)


# --- predictors and regression ---------------------------------------------------------

PREDICTORS_SQL = {
    "stamps": "SELECT CAST(l_shipdate AS DATE) AS d, avg(l_quantity / 1.0009) AS t2m, avg(l_extendedprice / 1009) AS sf, avg(l_discount * 101) AS tcc FROM lineitem GROUP BY 1",
    "p": """SELECT season, max(t2m) AS t2m, max(sf) AS sf, max(tcc) AS tcc FROM (
        SELECT year(d) AS season, avg(t2m) AS t2m, NULL AS sf, NULL AS tcc FROM stamps WHERE month(d) = 12 GROUP BY 1
        UNION ALL SELECT year(d), NULL, sum(sf), NULL FROM (SELECT CAST(d - INTERVAL 30 MINUTE AS DATE) AS d, sf FROM stamps) WHERE month(d) = 11 GROUP BY 1
        UNION ALL SELECT year(d), NULL, NULL, avg(tcc) FROM stamps WHERE month(d) = 9 GROUP BY 1) GROUP BY 1""",
}


def gridded_analysis(spark, sf) -> DataFrame:
    rows = i.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("valid_time"), (F.col("l_quantity") / i.OBS_DIVISOR).alias("t2m"),
        (F.col("l_extendedprice") / 1009).alias("sf"), (F.col("l_discount") * 101).alias("tcc"))
    return rows.unpivot(["valid_time"], ["t2m", "sf", "tcc"], "variable", "value")


@query("monthly_predictors", with_ctes("", f"SELECT season, {rnd('t2m', 5)} AS t2m, {rnd('sf', 5)} AS sf, {rnd('tcc', 5)} AS tcc FROM p", **PREDICTORS_SQL), digits=5)
def monthly_predictors(spark, sf):
    return ensemble.widen(yearly.monthly_predictors(gridded_analysis(spark, sf)), ["season"], fc.NAMES)


FUD_SEASONS = """SELECT k, season, min(d) AS fud FROM (SELECT k, d, CASE WHEN month(d) <= 5 THEN year(d) - 1 WHEN month(d) = 12 OR (month(d) = 11 AND day(d) > 1) THEN year(d) END AS season
    FROM daily WHERE t > 0 AND t <= 3) WHERE season BETWEEN 1995 AND 2000 GROUP BY 1, 2"""


@query("build_predictors", with_ctes("daily", f"""SELECT k, season, {rnd('t2m', 5)} AS t2m, {rnd('sf', 5)} AS sf, {rnd('tcc', 5)} AS tcc,
       dayofyear(fud) + CASE WHEN dayofyear(fud) < 300 THEN dayofyear(make_date(season, 12, 31)) ELSE 0 END AS fudoy
       FROM p CROSS JOIN (SELECT DISTINCT k FROM daily) LEFT JOIN f USING (k, season) WHERE season BETWEEN greatest(1995, (SELECT min(season) FROM p)) AND 2001""", **PREDICTORS_SQL, f=FUD_SEASONS), digits=5)
def build_predictors(spark, sf):
    """Predictors with the freeze-up of every series; seasons without a crossing stay missing."""
    fuds = yearly.observed_freeze_up(i.daily(spark, sf), ["k"], "t", yearly.DailyRules(threshold=3.0))
    return yearly.training_table(yearly.monthly_predictors(gridded_analysis(spark, sf)), fuds, ["k"])


TRAINING = {
    "x_months": "SELECT CAST(date_trunc('month', d) AS DATE) AS month, avg(t2m) AS t2m, sum(sf) AS sf, avg(tcc) AS tcc FROM analysis_wide GROUP BY 1",
    "y_months": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 335 + avg(o_totalprice) / 8009 AS y FROM orders GROUP BY 1",
    "training": "SELECT * FROM x_months JOIN y_months USING (month)",
}


def _training_x(spark, sf) -> DataFrame:
    v = F.col("value")
    return i.analysis_daily(spark, sf).groupBy(F.trunc("d", "month").alias("month")).agg(
        F.avg(F.when(F.col("variable") == "t2m", v)).alias("t2m"), F.sum(F.when(F.col("variable") == "sf", v)).alias("sf"),
        F.avg(F.when(F.col("variable") == "tcc", v)).alias("tcc"))


def _training_y(spark, sf, *keys) -> DataFrame:
    return i.table(spark, sf, "orders").groupBy(*keys, F.trunc("o_orderdate", "month").alias("month")).agg(
        (F.avg("o_totalprice") / 8009 + 335).alias("y"))


def training(spark, sf) -> DataFrame:
    return _training_x(spark, sf).join(_training_y(spark, sf), "month")


def fit_sql(source: str, keys: str = "") -> dict[str, str]:
    """Coefficients by Cramer's rule on the covariances."""
    group = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    xs = fc.NAMES
    cov = ", ".join(f"covar_pop({a}, {b}) AS s{p}{q}" for p, a in enumerate(xs) for q, b in enumerate(xs))
    cov += ", " + ", ".join(f"covar_pop({a}, y) AS r{p}" for p, a in enumerate(xs))
    cov += ", " + ", ".join(f"avg({a}) AS m{p}" for p, a in enumerate(xs))

    def det(m):
        (a, b, c), (d, e, f), (g, h, j) = m
        return f"({a} * ({e} * {j} - {f} * {h}) - {b} * ({d} * {j} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    full = [[f"s{p}{q}" for q in range(3)] for p in range(3)]

    def swapped(column):
        return [[f"r{p}" if q == column else full[p][q] for q in range(3)] for p in range(3)]

    betas = ", ".join(f"{det(swapped(c))} / {det(full)} AS b{c}" for c in range(3))
    return {
        "moments": f"SELECT {group}count(*) AS n, avg(y) AS my, {cov} FROM {source} {by}",
        "solved": f"SELECT *, {betas} FROM moments",
        "fitted": "SELECT *, my - b0 * m0 - b1 * m1 - b2 * m2 AS b FROM solved",
    }


AN = "analysis_wide"


@query("regression_moments", with_ctes(AN, f"""SELECT n, {rnd('my')} AS y_mean, {rnd('m0')} AS x0, {rnd('m1', 4)} AS x1, {rnd('m2')} AS x2,
       {rnd('s01', 4)} AS s01, {rnd('s12', 4)} AS s12, {rnd('r0', 5)} AS r0, {rnd('r1', 4)} AS r1, {rnd('r2', 5)} AS r2 FROM moments""",
       **TRAINING, **fit_sql("training")))
def regression_moments(spark, sf):
    m = model.regression_moments(training(spark, sf), "y", fc.NAMES)
    return m.select("n", "y_mean", F.col("x_mean")[0].alias("x0"), F.round(F.col("x_mean")[1], 4).alias("x1"), F.col("x_mean")[2].alias("x2"),
                    F.round(F.col("sxx")[1], 4).alias("s01"), F.round(F.col("sxx")[5], 4).alias("s12"),
                    F.round(F.col("sxy")[0], 5).alias("r0"), F.round(F.col("sxy")[1], 4).alias("r1"), F.round(F.col("sxy")[2], 5).alias("r2"))


COEFFICIENTS = f"n, {rnd('b')} AS intercept, {rnd('b0')} AS b_t2m, {rnd('b1')} AS b_sf, {rnd('b2')} AS b_tcc"


def _coefficients(fitted: DataFrame, *keys) -> DataFrame:
    return fitted.select(*keys, "n", "intercept", *[F.col("coef")[p].alias(f"b_{x}") for p, x in enumerate(fc.NAMES)])


@query("mlr_fit", with_ctes(AN, f"SELECT {COEFFICIENTS} FROM fitted", **TRAINING, **fit_sql("training")))
def mlr_fit(spark, sf):
    return _coefficients(model.fit_mlr(training(spark, sf), "y", fc.NAMES))


@query("mlr_fit_keyed", with_ctes(AN, f"SELECT k, {COEFFICIENTS} FROM fitted", x_months=TRAINING["x_months"],
       y_months="SELECT o_orderpriority AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 335 + avg(o_totalprice) / 8009 AS y FROM orders GROUP BY 1, 2",
       training=TRAINING["training"], **fit_sql("training", "k")))
def mlr_fit_keyed(spark, sf):
    rows = _training_y(spark, sf, F.col("o_orderpriority").alias("k")).join(_training_x(spark, sf), "month")
    return _coefficients(model.fit_mlr(rows, "y", fc.NAMES, ["k"]), "k")


@query("mlr_predict_ensemble", with_ctes(f"{AN} {GRID}", f"""SELECT {text('month')} AS month, number, {rnd('p', 5)} AS prediction, CAST(round_even(p, 0) AS INTEGER) AS fud
       FROM (SELECT i.month, i.number, b + b0 * t2m + b1 * sf + b2 * tcc AS p FROM inputs i, fitted)""",
       **TRAINING, **fit_sql("training"),
       member_x="SELECT CAST(date_trunc('month', d) AS DATE) AS month, number, avg(t2m) AS t2m, sum(sf) AS sf, avg(tcc) AS tcc FROM grid_wide GROUP BY 1, 2",
       inputs="SELECT * FROM member_x UNION ALL SELECT month, 0, avg(t2m), avg(sf), avg(tcc) FROM member_x GROUP BY 1"), digits=5)
def mlr_predict_ensemble(spark, sf):
    v = F.col("value")
    long = i.grid_daily(spark, sf).groupBy("variable", "number", F.trunc("d", "month").alias("month")).agg(
        F.when(F.col("variable") == "sf", F.sum(v)).otherwise(F.avg(v)).alias("value"))
    rows = ensemble.member_fallback(long, agg.ensemble_mean(long, ["variable", "month"]), ["month"], fc.NAMES)
    predicted = model.predict(rows, model.fit_mlr(training(spark, sf), "y", fc.NAMES), fc.NAMES)
    return predicted.select("month", "number", "prediction", "fud")


# --- replay of past issues -------------------------------------------------------------

RULES_SQL = {
    "span": "SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem",
    "days_all": "SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS issued FROM span",
    "issues": """SELECT issued, 'monthly' AS feed FROM days_all WHERE day(issued) = 7 AND month(issued) NOT IN (5, 6)
        UNION ALL SELECT issued, 'weekly' FROM days_all WHERE isodow(issued) = 1 AND month(issued) NOT IN (5, 6) AND NOT (month(issued) = 7 AND day(issued) < 7)""",
    "specs": "SELECT * FROM (VALUES ('t2m', 12, 'mean'), ('sf', 11, 'sum'), ('tcc', 9, 'mean')) v(variable, tm, method)",
    "placed_rules": """SELECT *, make_date(season, tm, 1) AS target FROM (
        SELECT *, CASE WHEN month(issued) <= 4 THEN year(issued) - 1 ELSE year(issued) END AS season FROM issues, specs)""",
    "rules": """SELECT issued, feed, season, variable, method, target, issued >= due AS analysis_due,
          CAST(CASE WHEN tm < month(issued) THEN target WHEN day(issued) < 7 THEN date_trunc('month', issued) - INTERVAL 1 MONTH
               ELSE date_trunc('month', issued) END AS DATE) AS forecast_issue,
          CASE WHEN feed = 'weekly' AND issued < due AND reach >= target THEN reach END AS observed_until
        FROM (SELECT *, CAST(target + INTERVAL 1 MONTH AS DATE) + 6 AS due, least(issued - 5, last_day(target)) AS reach FROM placed_rules)""",
}


def _issues(spark, sf) -> DataFrame:
    days = i.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return fc.issue_calendar(F.min("d"), F.max("d"), days)


@query("source_rules", with_ctes("", f"""SELECT {text('issued')} AS issued, feed, season, variable, method, {text('target')} AS target, analysis_due,
       {text('forecast_issue')} AS forecast_issue, {text('observed_until')} AS observed_until FROM rules""", **RULES_SQL))
def source_rules(spark, sf):
    return fc.source_rules(_issues(spark, sf))


INPUT_SQL = {
    "fcst": issued_sql(fc.FORECAST_LEADS),
    "full_months": """SELECT variable, target, CASE WHEN variable = 'sf' THEN s ELSE m END AS value FROM (
        SELECT variable, CAST(date_trunc('month', d) AS DATE) AS target, count(*) AS n, avg(value) AS m, sum(value) AS s FROM analysis_daily GROUP BY 1, 2)
        WHERE n = day(last_day(target))""",
    "known": "SELECT issued, feed, variable, value FROM rules JOIN full_months USING (variable, target) WHERE analysis_due",
    "open_rules": "SELECT * FROM rules ANTI JOIN known USING (issued, feed, variable)",
    "leads": """SELECT r.issued, r.feed, r.variable, r.target, r.method, r.observed_until, f.issue, f.number, f.d, f.value
        FROM fcst f JOIN open_rules r ON r.variable = f.variable AND r.forecast_issue = f.issue""",
    "by_mean": """SELECT l.issued, l.feed, l.variable, l.number, avg(coalesce(a.value, l.value)) AS value FROM leads l
        LEFT JOIN analysis_daily a ON a.variable = l.variable AND a.d = l.d AND a.d BETWEEN l.target AND l.observed_until
        WHERE method = 'mean' AND CAST(date_trunc('month', l.d) AS DATE) = l.target GROUP BY 1, 2, 3, 4""",
    "sums": "SELECT issued, feed, variable, target, issue, number, d, value FROM leads WHERE method = 'sum'",
    "seen": """SELECT r.issued, r.feed, r.variable, r.target, a.d, a.value AS obs FROM open_rules r
        JOIN analysis_daily a ON a.variable = r.variable AND a.d BETWEEN r.target AND r.observed_until WHERE method = 'sum'""",
    **splice_sql("sums", "seen", ["issued", "feed", "variable", "target"], ["issue", "number"]),
    "by_sum": """SELECT issued, feed, variable, number, value FROM (SELECT *, row_number() OVER
        (PARTITION BY issued, feed, variable, number ORDER BY abs(d - last_day(target)), d) AS rn FROM spliced) WHERE rn = 1""",
    "members": "SELECT * FROM by_mean UNION ALL SELECT * FROM by_sum",
    "best": "SELECT * FROM known UNION ALL SELECT issued, feed, variable, avg(value) FROM members GROUP BY 1, 2, 3",
    "bw": "SELECT issued, feed, " + ", ".join(_pick(v, "b") for v in fc.NAMES) + " FROM best GROUP BY 1, 2",
    "mw": "SELECT issued, feed, number, " + ", ".join(_pick(v, "m") for v in fc.NAMES) + " FROM members GROUP BY 1, 2, 3",
    "inputs": """SELECT issued, feed, 0 AS number, t2m, sf, tcc FROM bw UNION ALL
        SELECT issued, feed, number, coalesce(mw.t2m, bw.t2m), coalesce(mw.sf, bw.sf), coalesce(mw.tcc, bw.tcc) FROM mw JOIN bw USING (issued, feed)""",
}
ALL_GRID = f"{AN} {GRID} analysis_daily"
FUD_DATE_SQL = """CASE WHEN p > 365 THEN make_date(season + 1, 1, 1) + CAST(round_even(p - 366, 0) AS INTEGER)
         WHEN dayofyear(make_date(season, 12, 31)) = 366 THEN make_date(season, 1, 1) + CAST(round_even(p, 0) AS INTEGER)
         ELSE make_date(season, 1, 1) + CAST(round_even(p - 1, 0) AS INTEGER) END"""


@query("forecast_input", with_ctes(ALL_GRID, f"SELECT {text('issued')} AS issued, feed, number, {rnd('t2m', 9)} AS t2m, {rnd('sf', 6)} AS sf, {rnd('tcc', 9)} AS tcc FROM inputs",
       **RULES_SQL, **INPUT_SQL), digits=9)
def forecast_input(spark, sf):
    """Means of few days lie on the rounding grid of six digits, so they are compared with nine; sums are large and keep six."""
    forecasts = issued_forecasts(i.grid_daily(spark, sf), fc.FORECAST_LEADS)
    return fc.forecast_input(fc.source_rules(_issues(spark, sf)), i.analysis_daily(spark, sf), forecasts).withColumn("sf", F.round("sf", 6))


@query("hindcast", with_ctes(ALL_GRID, f"""SELECT {text('issued')} AS issued, feed, number, season, {rnd('p', 4)} AS prediction, CAST(round_even(p, 0) AS INTEGER) AS fud,
       {text(FUD_DATE_SQL)} AS fud_date
       FROM (SELECT inputs.*, b + b0 * t2m + b1 * sf + b2 * tcc AS p, CASE WHEN month(issued) <= 4 THEN year(issued) - 1 ELSE year(issued) END AS season
             FROM inputs, fitted)""",
       **RULES_SQL, **INPUT_SQL, **TRAINING, **fit_sql("training")), digits=4)
def hindcast(spark, sf):
    forecasts = issued_forecasts(i.grid_daily(spark, sf), fc.FORECAST_LEADS)
    replay = hc.hindcast(_issues(spark, sf), training(spark, sf), "y", i.analysis_daily(spark, sf), forecasts)
    return replay.select("issued", "feed", "number", "season", "prediction", "fud", "fud_date")
