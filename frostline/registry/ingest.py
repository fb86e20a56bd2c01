"""Queries on the high-rate series: raw-grain operators, ingestion, files and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline import session
from frostline.operators import aggregate as agg
from frostline.operators import align, ordered, quality
from frostline.operators.quality import RawRules
from frostline.plans import bootstrap
from frostline.plans import daily as daily_plan
from frostline.registry import ensembles
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.inputs import rnd, sql_derivative, sql_interpolate, text, with_ctes
from frostline.sources import grid, tables
from frostline.sources import text as text_source
from frostline.streaming import ingest as stream

K = ["k"]
HOUR_US = 3_600_000_000

# Parameters that make every rule of the chain act on the synthetic samples.
RULES = RawRules(max_per_hour=400.0, upper=150.0, deviation=40.0)


def holed(spark, sf) -> DataFrame:
    """Samples above 60 are missing, so runs of missing values cross block borders."""
    return i.obs(spark, sf).select("k", "event_id", "ts", F.when(F.col("t") <= 60, F.col("t")).alias("t"))


HOLED = "SELECT k, event_id, us, ts, CASE WHEN t <= 60 THEN t END AS t FROM obs"
FWD = "OVER (PARTITION BY k ORDER BY us ROWS UNBOUNDED PRECEDING)"


@query("monthly_sum_shifted", with_ctes("obs", f"""SELECT k, year(h) AS y, month(h) AS m, {rnd('sum(v)', 4)} AS value
       FROM (SELECT k, us_h - INTERVAL 30 MINUTE AS h, avg(t) AS v FROM (SELECT *, date_trunc('hour', ts) AS us_h FROM obs) GROUP BY 1, 2) GROUP BY 1, 2, 3"""), digits=4)
def monthly_sum_shifted(spark, sf):
    hourly = i.obs(spark, sf).withColumn("hour", F.date_trunc("hour", "ts"))
    return agg.monthly_sum(hourly, K, "hour", "t")


@query("day_completeness", with_ctes("obs", f"""SELECT k, {text('CAST(ts AS DATE)')} AS d, count(DISTINCT hour(ts)) AS hours, {rnd('avg(t)')} AS t
       FROM obs GROUP BY 1, 2 HAVING count(DISTINCT hour(ts)) = 24"""))
def day_completeness(spark, sf):
    return agg.complete_days(i.obs(spark, sf), K, "ts", "t")


@query("own_day_deviation", with_ctes("obs", f"""SELECT event_id, {rnd('CASE WHEN t - m < 30 THEN t END')} AS t_kept
       FROM (SELECT *, avg(t) OVER (PARTITION BY k, CAST(ts AS DATE)) AS m FROM obs)"""))
def own_day_deviation(spark, sf):
    return quality.mask_own_day_deviation(i.obs(spark, sf), K, "ts", "t", 30.0).select("event_id", "t_kept")


@query("own_day_deviation_two_sided", with_ctes("obs", f"""SELECT event_id, {rnd('CASE WHEN abs(t - m) < 30 THEN t END')} AS t_kept
       FROM (SELECT *, avg(t) OVER (PARTITION BY k, CAST(ts AS DATE)) AS m FROM obs)"""))
def own_day_deviation_two_sided(spark, sf):
    return quality.mask_own_day_deviation(i.obs(spark, sf), K, "ts", "t", 30.0, two_sided=True).select("event_id", "t_kept")


@query("raw_ffill", with_ctes("obs", f"SELECT event_id, {rnd(f'last_value(t IGNORE NULLS) {FWD}')} AS t_ffill FROM h", h=HOLED))
def raw_ffill(spark, sf):
    return ordered.ffill_series(holed(spark, sf), K, "ts", block="hour").select("event_id", "t_ffill")


@query("raw_differentiate", with_ctes("obs", f"SELECT event_id, {rnd('dt', 4)} AS dt FROM x", h=HOLED,
       f=f"SELECT *, last_value(t IGNORE NULLS) {FWD} AS f FROM h", x=sql_derivative("f", "f", "us", HOUR_US, "dt")), digits=4)
def raw_differentiate(spark, sf):
    return ordered.differentiate_series(holed(spark, sf), K, "ts", unit="hour", block="hour").select("event_id", "dt")


@query("raw_interpolate", with_ctes("obs", f"SELECT event_id, {rnd('t_interp')} AS t_interp FROM x", h=HOLED,
       x=sql_interpolate("h", "t", "us", "t_interp")))
def raw_interpolate(spark, sf):
    return ordered.interpolate_series(holed(spark, sf), K, "ts", block="hour").select("event_id", "t_interp")


@query("raw_cumsum", with_ctes("obs", f"SELECT event_id, {rnd(f'coalesce(sum(t) {FWD}, 0)', 4)} AS running FROM h", h=HOLED), digits=4)
def raw_cumsum(spark, sf):
    return ordered.cumsum_series(holed(spark, sf), K, "ts", block="hour").select("event_id", "running")


@query("raw_nearest", with_ctes("obs", f"""SELECT k, epoch_us(target) AS target_us, us AS label_us, {rnd('t')} AS nearest FROM (
         SELECT *, row_number() OVER (PARTITION BY k, target ORDER BY abs(us - epoch_us(target)), us) AS rn
         FROM (SELECT DISTINCT k, date_trunc('day', ts) + INTERVAL 12 HOUR AS target FROM obs) JOIN (SELECT k, us, t FROM obs WHERE t > 50) USING (k)) WHERE rn = 1"""))
def raw_nearest(spark, sf):
    samples = i.obs(spark, sf)
    noons = samples.select("k", (F.date_trunc("day", "ts") + F.make_dt_interval(hours=F.lit(12))).alias("ts")).distinct()
    found = align.nearest_join(noons, samples.where(F.col("t") > 50), K, "ts", "t", block="hour")
    return found.select("k", F.unix_micros("ts").alias("target_us"), F.unix_micros("label").alias("label_us"), "nearest")


STUCK = {"filled": f"SELECT k, event_id, us, t, last_value(t IGNORE NULLS) {FWD} AS f FROM obs"}


@query("raw_constant_runs", with_ctes("obs", f"""SELECT event_id, CASE WHEN flag THEN count(*) OVER (PARTITION BY k, run, flag) ELSE 0 END AS run_len,
       {rnd('CASE WHEN NOT (flag AND count(*) OVER (PARTITION BY k, run, flag) >= 3) THEN t END')} AS t_kept
       FROM (SELECT *, sum(CASE WHEN flag THEN 0 ELSE 1 END) {FWD} AS run FROM (SELECT *, coalesce(abs(rate) < 60 AND t > 20, FALSE) AS flag FROM x))""",
       **STUCK, x=sql_derivative("filled", "f", "us", HOUR_US, "rate")))
def raw_constant_runs(spark, sf):
    """Stuck stretches of the high-rate series, found by blocks of an hour and stitched over their borders."""
    samples = i.obs(spark, sf).select("k", "event_id", "ts", "t")
    return quality.mask_stuck_samples(samples, K, "ts", "t", 60.0, 20.0, 3).select("event_id", F.col("run_len").cast("bigint").alias("run_len"), "t_kept")


@query("raw_spike_mask", with_ctes("obs", f"SELECT event_id, {rnd('CASE WHEN abs(rate) <= 6000 AND t <= 120 THEN t END')} AS t_masked FROM x", **STUCK,
       x=sql_derivative("filled", "f", "us", 2 * 24 * HOUR_US, "rate")))
def raw_spike_mask(spark, sf):
    """The mask of the daily chain at the grain of the samples."""
    return quality.mask_spikes(i.obs(spark, sf).select("k", "event_id", "ts", "t"), K, "ts", limit=6000.0, upper=120.0).select("event_id", "t_masked")


@query("raw_interpolate_to_grid", with_ctes("obs", f"SELECT k, us, {rnd('t_grid')} AS t_grid FROM x WHERE on_grid",
       held="SELECT k, us, max(t) AS t, max(on_grid) AS on_grid FROM (SELECT k, us, t, FALSE AS on_grid FROM obs WHERE t <= 60 UNION ALL "
            "SELECT DISTINCT k, epoch_us(date_trunc('hour', ts)), CAST(NULL AS DOUBLE), TRUE FROM obs) GROUP BY 1, 2",
       x=sql_interpolate("held", "t", "us", "t_grid")))
def raw_interpolate_to_grid(spark, sf):
    """Samples interpolated onto the full hours, by blocks."""
    samples = i.obs(spark, sf)
    hours = samples.select("k", F.date_trunc("hour", "ts").alias("ts"))
    grid_rows = ordered.interpolate_to_grid(samples.where(F.col("t") <= 60).select("k", "ts", "t"), hours, K, "ts")
    return grid_rows.select("k", F.unix_micros("ts").alias("us"), "t_grid")


CLEAN = {
    "filled": f"SELECT k, event_id, us, ts, t, last_value(t IGNORE NULLS) {FWD} AS f FROM obs",
    "rated": sql_derivative("filled", "f", "us", HOUR_US, "rate"),
    "calm": f"SELECT *, CASE WHEN abs(rate) < {RULES.max_per_hour} AND t < {RULES.upper} THEN t END AS c FROM rated",
    "near": f"SELECT *, CASE WHEN c - avg(c) OVER (PARTITION BY k, CAST(ts AS DATE)) < {RULES.deviation} THEN c END AS e FROM calm",
    "clean": sql_interpolate("near", "e", "us", "t_clean"),
}


# Cleaned daily means on the calendar of each series.
FRESH = {
    "means": "SELECT k, CAST(ts AS DATE) AS d, avg(t_clean) AS t FROM clean GROUP BY 1, 2",
    "fresh": """SELECT k, d, t FROM (SELECT k, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM means GROUP BY k)
        LEFT JOIN means USING (k, d)""",
}


@query("clean_samples", with_ctes("obs", f"SELECT k, us, {rnd('t_clean')} AS t_clean FROM clean", **CLEAN))
def clean_samples(spark, sf):
    clean = daily_plan.clean_samples(i.obs(spark, sf), K, "ts", "t", ["event_id"], RULES)
    return clean.select("k", F.unix_micros("ts").alias("us"), "t_clean")


@query("daily_ingest", with_ctes("obs", f"""SELECT k, {text('d')} AS d, {rnd('CASE WHEN s.k IS NOT NULL THEN s.t ELSE n.t END')} AS t FROM stored s FULL JOIN fresh n USING (k, d)""",
       **CLEAN, stored="SELECT k, CAST(ts AS DATE) AS d, avg(t) AS t FROM obs WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1, 2",
       **FRESH))
def daily_ingest(spark, sf):
    """Ten stored days, the rest from cleaned samples."""
    samples = i.obs(spark, sf)
    stored = agg.daily_reduce(tables.complete_days_only(samples, "ts", "2024-01-11"), K, "ts", "t")
    return daily_plan.update_daily(stored, samples, K, "ts", "t", ["event_id"], RULES)


SMOOTH = sql_derivative("filled", "f", "pos", 2, "dt")


@query("bootstrap_series", with_ctes("daily_exact", f"""SELECT k, {text('d')} AS d, {rnd('coalesce(o.t, e.t, l.t)')} AS t
       FROM full_old o FULL JOIN ext e USING (k, d) FULL JOIN late l USING (k, d)""",
       old="SELECT * FROM daily_exact WHERE d < DATE '1998-01-01'", late="SELECT * FROM daily_exact WHERE d >= DATE '1999-01-01'",
       bounds="SELECT k, min(d) AS lo, max(d) AS hi FROM old GROUP BY k",
       days=i.CTES["days"], full_old="SELECT k, d, t FROM days LEFT JOIN old USING (k, d)",
       filled="SELECT k, d, t, (d - DATE '1970-01-01') AS pos, last_value(t IGNORE NULLS) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS f FROM full_old",
       sm=SMOOTH, clim="SELECT k, dayofyear(d) AS doy, avg(CASE WHEN abs(dt) <= 12 AND t <= 20 THEN t END) AS t FROM sm WHERE dayofyear(d) <= 365 GROUP BY 1, 2",
       ext="SELECT k, CAST(make_date(1998, 1, 1) + CAST(doy AS INTEGER) - 1 AS DATE) AS d, t FROM clim"))
def bootstrap_series(spark, sf):
    """Old record, a year bridged by its climatology, and a later record, merged by day."""
    full = i.daily_exact(spark, sf)
    old = full.where(F.col("d") < F.lit("1998-01-01").cast("date"))
    late = full.where(F.col("d") >= F.lit("1999-01-01").cast("date"))
    bridged = bootstrap.bridge_gap(agg.fill_calendar(old, K), K, "1998-01-01", "1998-12-31", 12.0, 20.0)
    return bootstrap.permanent_series([bridged, late], K)


# --- files -----------------------------------------------------------------------------


@query("sensor_log", with_ctes("obs", f"SELECT k, {text('CAST(ts AS DATE)')} AS d, count(*) AS n, count(CASE WHEN t <= 120 THEN t END) AS n_known, {rnd('avg(CASE WHEN t <= 120 THEN t END)')} AS t FROM obs GROUP BY 1, 2"))
def sensor_log(spark, sf):
    """Samples written as quoted logger lines per station folder and read back."""
    path = session.new_folder(spark, "sensor-log")
    token = F.when(F.col("t") > 120, "Bad").otherwise(F.col("t").cast("string"))
    lines = i.obs(spark, sf).select(
        F.col("k").alias("series_key"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("1"), token, F.lit("a"), F.lit("b"), F.lit("c"))
    lines.write.partitionBy("series_key").option("quoteAll", "true").csv(path)
    log = text_source.good_rows(text_source.read_sensor_log(spark, path, station_folders=True))
    return log.groupBy(F.col("series_key").alias("k"), F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count("t").alias("n_known"), F.avg("t").alias("t"))


@query("synthetic_time", with_ctes("obs", f"""SELECT k, us, {rnd('t')} AS t FROM (SELECT k, t,
       epoch_us(TIMESTAMP '2024-03-01') + (row_number() OVER (PARTITION BY k ORDER BY event_id) - 1) * 60000000 AS us FROM obs)"""))
def synthetic_time(spark, sf):
    """Samples written as lines without a time, in order, then given one minute each by position."""
    path = session.new_folder(spark, "untimed-log")
    v = F.col("t").cast("string")
    line = F.when(F.col("event_id") % 2 == 0, F.concat_ws(",", F.lit("1"), v, F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(
        F.concat_ws(",", F.lit("1"), F.lit("x"), v, F.lit("a"), F.lit("b"), F.lit("c")))
    ordered_lines = i.obs(spark, sf).select(F.col("k").alias("series_key"), "event_id", line.alias("value"))
    ordered_lines.repartitionByRange("series_key", "event_id").sortWithinPartitions("series_key", "event_id").drop(
        "event_id").write.partitionBy("series_key").text(path)
    lines = text_source.read_variant_width(spark, path, station_folders=True)
    timed = text_source.assign_synthetic_time(lines, F.lit("2024-03-01 00:00:00").cast("timestamp"))
    return timed.select(F.col("series_key").alias("k"), F.unix_micros("ts").alias("us"), "t")


@query("scan_grid", f"""SELECT CAST(l_linenumber AS INTEGER) AS number, year(l_shipdate) AS y, count(*) AS n, {rnd('avg(l_quantity / 1.0009)')} AS value FROM lineitem
       WHERE month(l_shipdate) = 9 AND year(l_shipdate) IN (1996, 1998) GROUP BY 1, 2""")
def scan_grid(spark, sf):
    """Grid written by variable, year and month; one month of two years read back."""
    path = session.new_folder(spark, "grid")
    stamped = F.col("l_shipdate").cast("timestamp")
    rows = i.table(spark, sf, "lineitem").select(
        F.lit("t2m").alias("variable"), stamped.alias("ref_time"), F.lit(0).alias("step_h"), stamped.alias("valid_time"),
        F.col("l_suppkey").cast("double").alias("lat"), F.col("l_linenumber").cast("double").alias("lon"),
        (F.col("l_quantity") / i.OBS_DIVISOR).alias("value"), F.lit("C").alias("units"))
    grid.write_grid(rows, path)
    september = grid.scan_analysis(spark, path, "t2m", months=[9], years=[1996, 1998])
    return september.groupBy(F.col("lon").cast("int").alias("number"), F.col("year").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"))


ISSUED = "SELECT month, number, CAST(round_even(b + b0 * t2m + b1 * sf + b2 * tcc, 0) AS INTEGER) AS fud FROM inputs, fitted"
FEEDS = {
    **ensembles.TRAINING, **ensembles.fit_sql("training"),
    "member_x": "SELECT CAST(date_trunc('month', d) AS DATE) AS month, number, avg(t2m) AS t2m, sum(sf) AS sf, avg(tcc) AS tcc FROM grid_wide GROUP BY 1, 2",
    "inputs": "SELECT * FROM member_x UNION ALL SELECT month, 0, avg(t2m), avg(sf), avg(tcc) FROM member_x GROUP BY 1",
    "issues": ISSUED,
}


@query("forecast_log", with_ctes("analysis_wide grid_wide grid_daily", f"""SELECT {text('month')} AS issued, number, fud, 'weekly' AS feed, year(month) AS season FROM issues WHERE year(month) <> 1999
       UNION ALL SELECT {text('month')}, number, fud, 'monthly', year(month) FROM issues WHERE year(month) = 1999""", **FEEDS))
def forecast_log(spark, sf):
    """Two feeds appended to the log; the weekly one lacks a season, where the monthly stands in."""
    path = session.new_folder(spark, "forecast-log")
    issued = ensembles.mlr_predict_ensemble.__wrapped__(spark, sf).select(
        F.col("month").alias("issued"), "number", "fud", F.year("month").alias("season"))
    tables.append_forecast(issued.withColumn("feed", F.lit("monthly")), path)
    tables.append_forecast(issued.where(F.col("season") != 1999).withColumn("feed", F.lit("weekly")), path)
    return tables.feed_or_fallback(tables.read_forecast_log(spark, path), "weekly", "monthly")


# --- streams ---------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def obs_stream(spark, sf) -> DataFrame:
    events = stream.tail_files(spark, f"{sf}/event[s].parquet", EVENT_SCHEMA)  # a pattern takes a file as well as a folder
    # A watermark needs an instant; the stored stamps are wall-clock UTC.
    return events.select(F.col("event_type").alias("k"), F.col("ts").cast("timestamp").alias("ts"),
                         (F.col("value") / i.OBS_DIVISOR).alias("t"))


@query("stream_daily_mean", with_ctes("obs", f"SELECT k, {text('CAST(ts AS DATE)')} AS d, {rnd('avg(t)')} AS t FROM obs GROUP BY 1, 2"))
def stream_daily_mean(spark, sf):
    return stream.streamed_table(stream.daily_mean_stream(obs_stream(spark, sf), K, "ts", "t", "40 days"), "daily-mean")


@query("frozen_latch_stream", with_ctes("obs", f"""SELECT k, year(ts) - CASE WHEN month(ts) < 7 THEN 1 ELSE 0 END AS season, {text('min(CAST(ts AS DATE))')} AS frozen_date
       FROM obs WHERE t < 0.75 GROUP BY 1, 2"""))
def frozen_latch_stream(spark, sf):
    return stream.streamed_table(stream.latch_stream(obs_stream(spark, sf), K, "ts", "t"), "latch")


DAILY_SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("t", T.DoubleType())])


@query("stream_clean_daily", with_ctes("", f"""SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM fresh JOIN last_days USING (k) WHERE d < last_d""",
       obs=i.CTES["obs"].replace("FROM events", "FROM events JOIN (SELECT event_type, max(CAST(ts AS DATE)) AS open_d FROM events GROUP BY 1) USING (event_type) WHERE CAST(ts AS DATE) < open_d"),
       **CLEAN, **FRESH, last_days="SELECT event_type AS k, max(CAST(ts AS DATE)) AS last_d FROM events GROUP BY 1"))
def stream_clean_daily(spark, sf):
    """The whole daily ingestion on a stream: samples kept, finished days cleaned and inserted."""
    path = session.new_folder(spark, "clean-daily")
    sink = stream.clean_daily_table(f"{path}/raw", f"{path}/daily", K, "ts", "t", RULES)
    stream.run_available(obs_stream(spark, sf), sink, f"{path}/checkpoint")
    return stream.inserted_rows(spark, f"{path}/daily", DAILY_SCHEMA)
