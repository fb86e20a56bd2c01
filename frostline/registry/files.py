"""Queries on readers and sinks: forecast grids, sheets, logger exports, broken lines, late batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline import session
from frostline.functions import calendar as cal
from frostline.operators import moments, ordered
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.ingest import HOLED
from frostline.registry.inputs import rnd, sql_derivative, sql_interpolate, text, with_ctes
from frostline.sources import gates, grid, slices, tables, tail
from frostline.sources import text as text_source
from frostline.streaming import closed
from frostline.streaming import ingest as stream


def forecast_grid(spark, sf) -> DataFrame:
    """Line items as leads of a forecast: issued on the month's first day, one lead in hours per day since."""
    stamped, issue = F.col("l_shipdate").cast("timestamp"), F.trunc("l_shipdate", "month").cast("timestamp")
    step = (F.datediff("l_shipdate", F.trunc("l_shipdate", "month")) + 1) * 24
    return i.table(spark, sf, "lineitem").select(
        F.lit("sf").alias("variable"), issue.alias("ref_time"), step.cast("int").alias("step_h"), stamped.alias("valid_time"),
        F.col("l_suppkey").cast("double").alias("lat"), F.col("l_partkey").cast("double").alias("lon"),
        F.col("l_extendedprice").alias("value"), F.lit("m").alias("units"), issue.alias("issue_time"),
        F.col("l_linenumber").cast("int").alias("number"))


@query("scan_forecast", f"""SELECT CAST(l_linenumber AS INTEGER) AS number, date_diff('day', date_trunc('month', l_shipdate), l_shipdate) + 1 AS lead, count(*) AS n,
       {rnd('avg(l_extendedprice)', 4)} AS value FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 10 GROUP BY 1, 2""", digits=4)
def scan_forecast(spark, sf):
    """Forecast grid written by variable, year and month of the issue; one issue read back."""
    path = session.new_folder(spark, "forecast-grid")
    grid.write_grid(forecast_grid(spark, sf), path, "issue_time")
    issue = grid.scan_forecast(spark, path, "sf", 1997, 10)
    return issue.groupBy("number", (F.col("step_h") / 24).cast("bigint").alias("lead")).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"))


@query("subset_hours", with_ctes("obs", f"SELECT k, hour(ts) AS h, count(*) AS n, {rnd('avg(t)')} AS t FROM obs WHERE hour(ts) IN (0, 6, 12, 18) GROUP BY 1, 2"))
def subset_hours(spark, sf):
    """Four hours of the day of all samples."""
    picked = grid.subset_request(i.obs(spark, sf), hours=[0, 6, 12, 18], time="ts")
    return picked.groupBy("k", F.hour("ts").cast("bigint").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.avg("t").alias("t"))


@query("subset_leads", f"""SELECT step_h, count(*) AS n, {rnd('avg(l_extendedprice)', 4)} AS value FROM (SELECT *,
       (date_diff('day', date_trunc('month', l_shipdate), l_shipdate) + 1) * 24 AS step_h FROM lineitem) WHERE step_h IN (24, 168, 336, 720) GROUP BY 1""", digits=4)
def subset_leads(spark, sf):
    """Four leads of all issues."""
    picked = grid.subset_request(forecast_grid(spark, sf), leads=[24, 168, 336, 720])
    return picked.groupBy(F.col("step_h").cast("bigint").alias("step_h")).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"))


BROKEN = "k = 'error'"


@query("quarantine", with_ctes("obs", f"""SELECT k, {BROKEN} AS broken, count(*) AS n FROM obs GROUP BY 1, 2"""))
def quarantine(spark, sf):
    """Sensor log in which the lines of one series have no readable time: kept apart, none lost."""
    path = session.new_folder(spark, "broken-log")
    stamp = F.when(F.expr(BROKEN), F.lit("no time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    lines = i.obs(spark, sf).select(F.col("k").alias("series_key"), stamp, F.lit("1"), F.col("t").cast("string"), F.lit("a"), F.lit("b"), F.lit("c"))
    lines.write.partitionBy("series_key").option("quoteAll", "true").csv(path)
    log = text_source.read_sensor_log(spark, path, station_folders=True)
    good = text_source.good_rows(log).select("series_key", F.lit(False).alias("broken"))
    return good.unionByName(text_source.quarantine(log).select("series_key", F.lit(True).alias("broken"))).groupBy(
        F.col("series_key").alias("k"), "broken").agg(F.count(F.lit(1)).alias("n"))


@query("read_sheet", with_ctes("obs", f"""SELECT CAST(ts AS DATE)::VARCHAR AS d, count(*) AS n, count(CASE WHEN t <= 120 THEN t END) AS n_known,
       {rnd('avg(CASE WHEN t <= 120 THEN t END)')} AS t FROM obs GROUP BY 1"""))
def read_sheet(spark, sf):
    """Samples written as sheets with unnamed columns, a header and a footer without a date, and read back."""
    path = session.new_folder(spark, "sheet")
    token = F.when(F.col("t") > 120, "Bad").otherwise(F.col("t").cast("string"))
    rows = i.obs(spark, sf).select(F.col("event_id").cast("string").alias("Unnamed: 0"), F.lit("x").alias("Unnamed: 1"), F.lit("y").alias("Unnamed: 2"),
                                   F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date"), token.alias("T (oC)"))
    footer = rows.select("Unnamed: 0", "Unnamed: 1", "Unnamed: 2", F.lit("total").alias("Date"), F.lit("0").alias("T (oC)")).limit(1)
    rows.unionByName(footer).write.option("header", "true").csv(path)
    sheet = text_source.read_sheet(spark, path, rows.columns)
    return sheet.groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count("t").alias("n_known"), F.avg("t").alias("t"))


@query("read_logger", with_ctes("obs", f"SELECT CAST(ts AS DATE)::VARCHAR AS d, count(*) AS n, {rnd('avg(t)')} AS t FROM obs GROUP BY 1"))
def read_logger(spark, sf):
    """Samples written as logger exports with a header line in every file, and read back."""
    path = session.new_folder(spark, "logger")
    fields = [F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("1"), F.lit("2"), F.col("t").cast("string"), F.lit("4"), F.lit("5"), F.lit("6")]
    rows = i.obs(spark, sf).select(*[f.alias(n) for f, n in zip(fields, ("TIMESTAMP", "RECORD", "a", "Smp", "b", "Min", "c"))])
    rows.write.option("header", "true").csv(path)
    export = text_source.read_logger_with_preamble(spark, path)
    return export.groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.avg("t").alias("t"))


@query("insert_only_batches", with_ctes("obs", f"""SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM (SELECT *, row_number() OVER (PARTITION BY k, d ORDER BY part) AS rn
       FROM (SELECT k, CAST(ts AS DATE) AS d, event_id % 3 AS part, avg(t) AS t FROM obs GROUP BY 1, 2, 3)) WHERE rn = 1"""))
def insert_only_batches(spark, sf):
    """Three batches of daily means for the same days: the first stays, late ones change nothing; the last batch is repeated."""
    path = session.new_folder(spark, "insert-only")
    parts = i.obs(spark, sf).groupBy("k", F.to_date("ts").alias("d"), (F.col("event_id") % 3).alias("part")).agg(F.avg("t").alias("t"))
    schema = parts.select("k", "d", "t").schema
    sink = stream.insert_only_table(path, schema, ["k", "d"])
    for batch in (0, 1, 2, 2):
        sink(parts.where(F.col("part") == batch).select("k", "d", "t"), batch)
    return stream.inserted_rows(spark, path, schema)


@query("append_retried", with_ctes("obs", "SELECT k AS feed, CAST(min(ts) AS DATE)::VARCHAR AS issued, count(*) AS n FROM obs GROUP BY 1"))
def append_retried(spark, sf):
    """An issue appended twice, as a retried job does, is stored once."""
    path = session.new_folder(spark, "retried-log")
    samples = i.obs(spark, sf)
    first = samples.groupBy("k").agg(F.to_date(F.min("ts")).alias("issued"), F.min("event_id").alias("mean"))
    number = F.when(F.col("event_id") == F.col("mean"), 0).otherwise(F.col("event_id") + 1)
    rows = samples.select("k", "event_id").join(first, "k").select(
        F.col("k").alias("feed"), "issued", F.lit(2024).alias("season"), F.col("event_id").cast("int").alias("fud"), number.cast("int").alias("number"))
    for _ in range(2):
        tables.append_forecast(rows, path)
    return tables.read_forecast_log(spark, path).groupBy("feed", "issued").agg(F.count(F.lit(1)).alias("n"))


# --- numbered logger files in order ----------------------------------------------------


def _log_file(folder: str):
    """Writes the lines of one station and number, in order, as one file."""
    import pandas as pd

    def write(lines: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        station, number = lines["k"].iloc[0], int(lines["number"].iloc[0])
        ordered = lines.assign(own=lines["copy"] != 2).sort_values(["own", "copy", "event_id"])  # copies of the day before come first
        text = "".join(f'"{stamp}","1","{t}","a","b","c"\n' for stamp, t in zip(ordered["stamp"], ordered["t"]))
        name = f"{root}/{station}.dat{number}.dat"
        with system.open_output_stream(f"{name}.{id(lines)}.tmp", compression=None) as out:
            out.write(text.encode("utf-8"))
        system.move(f"{name}.{id(lines)}.tmp", name)
        return pd.DataFrame({"n": [len(lines)]})

    return write


def put_numbered_files(rows: DataFrame, folder: str) -> int:
    """A file per station and number, written by the tasks; returns the number of lines."""
    return rows.groupBy("k", "number").applyInPandas(_log_file(folder), "n bigint").agg(F.sum("n")).first()[0] or 0


LAG = 5          # days that stations may lag behind each other
LATE_FILE = 10   # comes only after the first run


def numbered_samples(spark, sf) -> DataFrame:
    """Samples by station, day and file; of every seventh a wrong copy follows in its own file and in the next one."""
    days = Window.partitionBy("k").orderBy("d")
    numbers = i.obs(spark, sf).select("k", F.to_date("ts").alias("d")).distinct().withColumn("number", F.row_number().over(days) - 1)
    copies = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    rows = i.obs(spark, sf).withColumn("d", F.to_date("ts")).join(numbers, ["k", "d"]).withColumn("copy", F.explode(copies))
    return rows.select("k", "event_id", "copy", (F.col("number") + F.when(F.col("copy") == 2, 1).otherwise(0)).alias("number"),
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("stamp"), (F.col("t") + F.col("copy") * 1000).alias("t"))


CLOSED_SCHEMA = T.StructType([T.StructField("series_key", T.StringType()), T.StructField("d", T.DateType()), T.StructField("t", T.DoubleType()), T.StructField("n", T.LongType())])


@query("stream_closed_days", with_ctes("obs", f"""SELECT k, {text('d')} AS d, {rnd('t')} AS t, n FROM (SELECT k, CAST(ts AS DATE) AS d, avg(t) AS t, count(*) AS n FROM firsts GROUP BY 1, 2), newest
       WHERE CAST(d + 1 AS TIMESTAMP) <= top - INTERVAL {LAG} DAY""",
       firsts="SELECT k, ts, arg_min(t, event_id) AS t FROM obs GROUP BY 1, 2",
       newest="SELECT max(ts) AS top FROM obs WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM obs)"))
def stream_closed_days(spark, sf):
    """Numbered files of several stations read in order over two runs, one file late, copies of samples in later lines and
    files, the file of the open day left out: every closed day once, from first copies."""
    path = session.new_folder(spark, "numbered-log")
    rows = session.materialise(numbered_samples(spark, sf), "numbered-samples")
    open_day = str(i.obs(spark, sf).agg(F.max(F.to_date("ts"))).first()[0])

    def run() -> None:
        log = tail.numbered_log_stream(spark, f"{path}/in", open_day).where("corrupt IS NULL")
        days = closed.closed_days(log, ["series_key"], "ts", "t", ["file_seq", "line"], f"{LAG} days")
        closed.run_until_idle(days, stream.insert_only_table(f"{path}/daily", CLOSED_SCHEMA, ["series_key", "d"]), f"{path}/checkpoint")

    put_numbered_files(rows.where(F.col("number") != LATE_FILE), f"{path}/in")
    run()
    put_numbered_files(rows.where(F.col("number") == LATE_FILE), f"{path}/in")
    run()
    return stream.inserted_rows(spark, f"{path}/daily", CLOSED_SCHEMA).withColumnRenamed("series_key", "k")


# --- kept up to date -------------------------------------------------------------------


@query("climatology_batches", with_ctes("daily", f"""SELECT k, doy, {rnd('avg(t)')} AS clim, {rnd('stddev_pop(t)')} AS sd, {rnd('min(t)')} AS lo, {rnd('max(t)')} AS hi, {rnd('max(t) - min(t)')} AS band,
       {rnd('max(mean_sd)')} AS mean_sd FROM (SELECT k, dayofyear(d) AS doy, t FROM daily) JOIN spreads USING (k) GROUP BY 1, 2""",
       spreads="SELECT k, avg(sd) AS mean_sd FROM (SELECT k, dayofyear(d) AS doy, stddev_pop(t) AS sd FROM daily GROUP BY 1, 2) GROUP BY 1"))
def climatology_batches(spark, sf):
    """Climatology and mean spread kept over four batches of years, the last one repeated, without reading stored days again."""
    path = session.new_folder(spark, "moments")
    days = session.materialise(i.daily(spark, sf), "days")
    sink = moments.moments_table(path, ["k"])
    parts = [F.year("d") < 1994, F.year("d").between(1994, 1995), F.year("d") == 1996, F.year("d") > 1996]
    for batch, part in [*enumerate(parts), (3, parts[3])]:
        sink(days.where(part), batch)
    stored = tables.read_table(spark, path, moments.day_moments(days, ["k"]).schema)
    return moments.climatology_of(stored, ["k"]).join(moments.mean_spread(stored, ["k"]), "k")


SLICE = ("2024-01-10", "2024-01-12")


@query("raw_slice", with_ctes("obs", f"""SELECT event_id, {rnd('t_interp')} AS t_interp, {rnd('dt', 4)} + 0.0 AS dt FROM (SELECT event_id, ts, t_interp FROM filled)
       JOIN (SELECT event_id, dt FROM derived) USING (event_id) WHERE CAST(ts AS DATE) BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'""",
       h=HOLED, filled=sql_interpolate("h", "t", "us", "t_interp"),
       f="SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY k ORDER BY us ROWS UNBOUNDED PRECEDING) AS f FROM h", derived=sql_derivative("f", "f", "us", 3_600_000_000, "dt")))
def raw_slice(spark, sf):
    """Three days of a table stored by day, interpolated and derived with a halo of neighbouring rows in place of the whole series."""
    path = session.new_folder(spark, "samples-by-day")
    samples = i.obs(spark, sf).select("k", "event_id", "ts", F.when(F.col("t") <= 60, F.col("t")).alias("t"), F.to_date("ts").alias("d"))
    samples.hint("rebalance", "d").write.partitionBy("d").parquet(path)
    first, last = (dt.date.fromisoformat(d) for d in SLICE)
    rows = session.materialise(slices.SliceReader(spark, path, samples.schema, ["k"], "ts", "t", also=["event_id"]).read(first, last), "slice")
    inside = F.col("d").between(F.lit(SLICE[0]).cast("date"), F.lit(SLICE[1]).cast("date"))
    filled = ordered.interpolate_series(rows, ["k"], "ts").where(inside).select("k", "event_id", "t_interp")
    derived = ordered.differentiate_series(rows, ["k"], "ts", unit="hour").where(inside).select("k", "event_id", F.round("dt", 4).alias("dt"))
    return filled.join(derived, ["k", "event_id"]).select("event_id", "t_interp", "dt")


@query("run_gates", with_ctes("obs", f"""SELECT 'samples' AS stage, count(CASE WHEN t <= 120 THEN 1 END) AS n_rows, {text('max(CASE WHEN t <= 120 THEN CAST(ts AS DATE) END)')} AS last_d,
       count(CASE WHEN t > 120 THEN 1 END) AS refused, TRUE AS ok FROM obs
       UNION ALL SELECT 'daily', count(*), {text('max(d)')}, 0, FALSE FROM days""",
       days="SELECT k, CAST(ts AS DATE) AS d FROM obs WHERE t <= 120 GROUP BY 1, 2"))
def run_gates(spark, sf):
    """Two steps of a run whose gates are measured by the jobs that write their tables; the second is not fresh enough."""
    path = session.new_folder(spark, "run")
    samples = i.obs(spark, sf).select("k", "ts", "t")
    if gates.write_observed(samples, f"{path}/samples", f"{path}/status", "samples", F.to_date("ts"), F.col("t") > 120, fresh_after="2024-01-02"):
        stored = spark.read.schema(samples.schema).parquet(f"{path}/samples")
        days = stored.groupBy("k", F.to_date("ts").alias("d")).agg(F.avg("t").alias("t"))
        gates.write_observed(days, f"{path}/daily", f"{path}/status", "daily", F.col("d"), fresh_after="2999-01-01")
    return gates.run_status(spark, f"{path}/status")


@query("latch_closed_days", with_ctes("obs", f"""SELECT k, year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END AS season, {text('min(d)')} AS frozen_date
       FROM (SELECT k, CAST(ts AS DATE) AS d, avg(t) AS t FROM obs GROUP BY 1, 2) WHERE t < 40 GROUP BY 1, 2"""))
def latch_closed_days(spark, sf):
    """Frozen latch fed by batches of closed days, three of them, the middle one repeated."""
    path = session.new_folder(spark, "latch")
    days = session.materialise(i.obs(spark, sf).groupBy("k", F.to_date("ts").alias("d")).agg(F.avg("t").alias("t")), "days")
    sink = closed.latched_seasons(path, ["k"], threshold=40.0)
    part = F.pmod(F.unix_date("d"), F.lit(3))
    for batch in (0, 1, 1, 2):
        sink(days.where(part == batch), batch)
    return tables.read_table(spark, path, days.select("k", cal.season_of(F.col("d")).alias("season"), F.col("d").alias("frozen_date")).schema)
