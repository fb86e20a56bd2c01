"""Queries on merging, aligning and calendar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.functions import values as val
from frostline.operators import align, quality
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.inputs import rnd, text, with_ctes
from frostline.sources import tables

K = ["k"]
SEASON = "year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END"
LEAP = "CASE WHEN dayofyear(make_date(year(d), 12, 31)) = 366 THEN 1 ELSE 0 END"


@query("calendar_functions", f"""SELECT {text('d')} AS d, dayofyear(d) AS doy, {LEAP} AS leap, {SEASON} AS season,
       CASE WHEN month(d) <= 4 THEN year(d) - 1 WHEN month(d) >= 7 THEN year(d) END AS forecast_season,
       ({SEASON}) || '/' || ({SEASON} + 1) AS label, strftime(DATE '2001-01-01' + CAST(dayofyear(d) AS INTEGER) - 1, '%m-%d') AS monthday,
       strftime(DATE '2001-01-01' + CAST(dayofyear(d) AS INTEGER) - 1, '%b-%d') AS monthday_name,
       CASE WHEN month(d) <= 5 THEN year(d) - 1 WHEN month(d) = 12 OR (month(d) = 11 AND day(d) > 1) THEN year(d) END AS winter,
       {text("CAST(date_trunc('quarter', d + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)")} AS quarter,
       d - make_date({SEASON}, 7, 1) AS pos,
       CASE WHEN dayofyear(d) <= 365 THEN (dayofyear(d) - 182 + 365) % 365 END AS clim_pos
       FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def calendar_functions(spark, sf):
    d = F.col("d")
    days = i.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    doy = F.dayofyear(d)
    return days.select(
        "d", doy.alias("doy"), cal.is_leap(F.year(d)).cast("int").alias("leap"), cal.season_of(d).alias("season"),
        cal.forecast_season(d).alias("forecast_season"), cal.season_label(cal.season_of(d)).alias("label"),
        cal.doy_to_monthday(doy).alias("monthday"), cal.doy_to_monthday(doy, "MMM-dd").alias("monthday_name"),
        cal.winter_season(d).alias("winter"), cal.quarter_from_december(d).alias("quarter"),
        cal.season_position(d, cal.season_of(d)).alias("pos"), cal.climatology_position(doy).alias("clim_pos"),
    )


@query("slice_time", with_ctes("daily", f"""SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM daily
       WHERE d BETWEEN DATE '1996-02-29' AND DATE '1999-06-30'"""))
def slice_time(spark, sf):
    return tables.slice_time(i.daily(spark, sf), "d", "1996-02-29", "1999-06-30")


@query("complete_days_only", with_ctes("obs", f"""SELECT k, {text('CAST(ts AS DATE)')} AS d, count(*) AS n FROM obs
       WHERE ts < TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-11' GROUP BY 1, 2"""))
def complete_days_only(spark, sf):
    recent = tables.complete_days_only(i.obs(spark, sf), "ts", as_of="2024-01-20", after="2024-01-10")
    return recent.groupBy("k", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("select_month", with_ctes("daily", f"SELECT k, year(d) AS y, {rnd('avg(t)')} AS t FROM daily WHERE month(d) = 9 GROUP BY 1, 2"))
def select_month(spark, sf):
    return i.daily(spark, sf).where(F.month("d") == 9).groupBy("k", F.year("d").alias("y")).agg(F.avg("t").alias("t"))


@query("merge_no_conflict", with_ctes("daily_exact", f"SELECT k, {text('d')} AS d, {rnd('CASE WHEN day(d) % 3 = 2 AND t > 20 THEN NULL ELSE t END')} AS t FROM daily_exact"))
def merge_no_conflict(spark, sf):
    """Overlap on every third day; on some days one side is missing."""
    full = i.daily_exact(spark, sf)
    third = F.dayofmonth("d") % 3
    a = full.where(third != 0).withColumn("t", F.when(~((third == 2) & (F.col("t") > 20)), F.col("t")))
    b = full.where(third != 2)
    return align.merge_no_conflict([a, b], ["k", "d"])


@query("insert_only_merge", with_ctes("daily", f"""SELECT k, {text('d')} AS d, {rnd('CASE WHEN year(d) <= 1998 THEN t ELSE t + 100 END')} AS t FROM daily"""))
def insert_only_merge(spark, sf):
    full = i.daily(spark, sf)
    stored = full.where(F.year("d") <= 1998)
    new = full.where(F.year("d") >= 1998).withColumn("t", F.col("t") + 100)
    return align.insert_only_merge(stored, new, ["k", "d"])


@query("rows_to_insert", with_ctes("daily", f"SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM daily WHERE year(d) >= 1999"))
def rows_to_insert(spark, sf):
    full = i.daily(spark, sf)
    return align.rows_to_insert(full.where(F.year("d") <= 1998), full.where(F.year("d") >= 1998), ["k", "d"])


@query("common_period", f"""WITH a AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) AS m, avg(l_quantity) AS x FROM lineitem GROUP BY 1),
       b AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m, avg(o_totalprice) / 20011 AS y FROM orders GROUP BY 1),
       r AS (SELECT greatest((SELECT min(m) FROM a), (SELECT min(m) FROM b)) AS lo, least((SELECT max(m) FROM a), (SELECT max(m) FROM b)) + 1 AS hi)
       SELECT m, {rnd('x')} AS x, {rnd('y')} AS y FROM a LEFT JOIN b USING (m) WHERE m BETWEEN (SELECT lo FROM r) AND (SELECT hi FROM r)""")
def common_period(spark, sf):
    def index(c):
        return (F.year(c) * 12 + F.month(c)).alias("m")

    a = i.table(spark, sf, "lineitem").groupBy(index("l_shipdate")).agg(F.avg("l_quantity").alias("x"))
    b = i.table(spark, sf, "orders").groupBy(index("o_orderdate")).agg((F.avg("o_totalprice") / i.DAILY_DIVISOR).alias("y"))
    return align.common_period(a, b, "m")


NEAREST = """SELECT *, row_number() OVER (PARTITION BY k, target ORDER BY abs(label - target), label) AS rn
    FROM (SELECT DISTINCT k, last_day(d) AS target FROM daily) m
    JOIN (SELECT k, d AS label, t FROM daily WHERE t > 15) s USING (k)"""


@query("nearest_join", with_ctes("daily", f"SELECT k, {text('target')} AS target, {text('label')} AS label, {rnd('t')} AS nearest FROM n WHERE rn = 1", n=NEAREST))
def nearest_join(spark, sf):
    full = i.daily(spark, sf)
    ends = full.select("k", F.last_day("d").alias("d")).distinct()
    return align.nearest_join(ends, full.where(F.col("t") > 15), K, "d", "t").withColumnRenamed("d", "target")


@query("nearest_join_limited", with_ctes("daily", f"""SELECT k, {text('target')} AS target,
       {text('CASE WHEN abs(label - target) <= 2 THEN label END')} AS label, {rnd('CASE WHEN abs(label - target) <= 2 THEN t END')} AS nearest FROM n WHERE rn = 1""", n=NEAREST))
def nearest_join_limited(spark, sf):
    full = i.daily(spark, sf)
    ends = full.select("k", F.last_day("d").alias("d")).distinct()
    return align.nearest_join(ends, full.where(F.col("t") > 15), K, "d", "t", max_dist=2).withColumnRenamed("d", "target")


PREFER = {
    "p": """SELECT CAST(date_trunc('month', d) AS DATE) AS month, avg(t) AS value FROM daily GROUP BY 1
            HAVING count(DISTINCT d) >= 31""",
    "f": "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_quantity) AS value FROM lineitem GROUP BY 1",
}


def _sources(spark, sf):
    month = F.trunc("d", "month").alias("month")
    # only months of 31 known days are analysed, so that the others fall back
    months = i.daily(spark, sf).groupBy(month)
    analysis = months.agg(F.avg("t").alias("value"), F.countDistinct("d").alias("n")).where(F.col("n") >= 31).drop("n")
    forecast = i.table(spark, sf, "lineitem").groupBy(F.trunc("l_shipdate", "month").alias("month")).agg(
        F.avg("l_quantity").alias("value"))
    return analysis, forecast


@query("prefer_source", with_ctes("daily", f"""SELECT {text('month')} AS month, {rnd('coalesce(p.value, f.value)')} AS value,
       CASE WHEN p.value IS NULL THEN 'forecast' ELSE 'analysis' END AS source FROM p FULL JOIN f USING (month)""", **PREFER))
def prefer_source(spark, sf):
    analysis, forecast = _sources(spark, sf)
    return align.prefer_source([("analysis", analysis), ("forecast", forecast)], ["month"])


@query("require_labels", with_ctes("daily", f"""SELECT {text('month')} AS month, {rnd('coalesce(p.value, f.value)')} AS value,
       CASE WHEN p.value IS NULL THEN 'forecast' ELSE 'analysis' END AS source FROM p FULL JOIN f USING (month) WHERE month(month) = 9""", **PREFER))
def require_labels(spark, sf):
    analysis, forecast = _sources(spark, sf)
    best = align.prefer_source([("analysis", analysis), ("forecast", forecast)], ["month"])
    needed = forecast.where(F.month("month") == 9).select("month")
    return align.require_labels(best, needed, ["month"])


@query("latest_of_feeds", with_ctes("obs", f"""SELECT user_id, {text('issued')} AS issued, feed, {rnd('fud')} AS fud FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY issued DESC, rank DESC, event_id DESC) AS rn FROM (
           SELECT user_id, event_id, CAST(ts AS DATE) AS issued, t AS fud, CASE WHEN k IN ('view', 'click') THEN 'weekly' ELSE 'monthly' END AS feed,
             CASE WHEN k IN ('view', 'click') THEN 2 ELSE 1 END AS rank FROM obs
           WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0)) WHERE rn = 1"""))
def latest_of_feeds(spark, sf):
    log = i.obs(spark, sf).select(
        "user_id", "event_id", "k", F.to_date("ts").alias("issued"), F.col("t").alias("fud"),
        (F.get_json_object("props", "$.k").cast("int") % 2).alias("number"),
    )
    weekly = F.col("k").isin("view", "click")
    feeds = [("weekly", log.where(weekly)), ("monthly", log.where(~weekly))]
    return align.latest_of_feeds(feeds, ["user_id"], tie=["event_id"])


@query("dedupe_first", f"""SELECT o_custkey, {text('d')} AS d, o_orderkey, {rnd('o_totalprice', 2)} AS o_totalprice FROM (
       SELECT *, CAST(o_orderdate AS DATE) AS d, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""", digits=2)
def dedupe_first(spark, sf):
    rows = i.table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderkey", "o_totalprice")
    return quality.dedupe_keep_first(rows, ["o_custkey", "d"], ["o_orderkey"])


@query("parse_bad_value", with_ctes("obs", f"""SELECT k, CAST(ts AS DATE)::VARCHAR AS d, count(*) AS n, count(CASE WHEN k <> 'error' AND t <= 120 THEN t END) AS n_known,
       {rnd("avg(CASE WHEN k <> 'error' AND t <= 120 THEN t END)")} AS t FROM obs GROUP BY 1, 2"""))
def parse_bad_value(spark, sf):
    raw = F.when(F.col("k") == "error", "Bad").when(F.col("t") > 120, "n/a").otherwise(F.col("t").cast("string"))
    parsed = i.obs(spark, sf).select("k", F.to_date("ts").alias("d"), val.parse_value(raw).alias("t"))
    return parsed.groupBy("k", "d").agg(F.count(F.lit(1)).alias("n"), F.count("t").alias("n_known"), F.avg("t").alias("t"))


@query("to_celsius", f"""SELECT l_returnflag, l_linestatus, {rnd("avg(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity - 273.15 ELSE l_quantity END)")} AS value
       FROM lineitem GROUP BY 1, 2""")
def to_celsius(spark, sf):
    variable = F.when(F.col("l_returnflag") == "R", "t2m").otherwise("tcc")
    units = F.when(F.col("l_linestatus") == "O", "K").otherwise("(0 - 1)")
    rows = i.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", val.to_celsius(F.col("l_quantity"), variable, units).alias("value"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.avg("value").alias("value"))


@query("clamp", with_ctes("daily bounds days full_daily", f"SELECT k, {text('d')} AS d, {rnd('CASE WHEN t - 10 < 0 THEN 0 ELSE t - 10 END')} AS t FROM full_daily"))
def clamp(spark, sf):
    return i.calendar_daily(spark, sf).select("k", "d", val.clamp_min0(F.col("t") - 10).alias("t"))


@query("drop_null", with_ctes("daily bounds days full_daily", f"SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM full_daily WHERE t IS NOT NULL"))
def drop_null(spark, sf):
    return i.calendar_daily(spark, sf).dropna(subset=["t"])


@query("quality_gate", with_ctes("daily", f"""SELECT k, 'daily' AS stage, count(*) AS n_rows, {text('max(d)')} AS last_d,
       count(*) >= 1700 AND max(d) >= DATE '2001-07-31' AS ok FROM daily GROUP BY k"""))
def quality_gate(spark, sf):
    return tables.quality_gate(i.daily(spark, sf), K, "daily", "d", 1700, "2001-07-31")
