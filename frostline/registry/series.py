"""Queries on the daily series: resampling, ordered operators, masks, seasons, freeze-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.functions import values as val
from frostline.operators import aggregate as agg
from frostline.operators import align, ordered, publish, quality, seasons
from frostline.operators.quality import DailyRules
from frostline.plans import chart
from frostline.plans import daily as daily_plan
from frostline.plans import yearly
from frostline.registry import inputs as i
from frostline.registry.base import query
from frostline.registry.inputs import FULL, rnd, sql_derivative, sql_interpolate, text, with_ctes

K = ["k"]

# Parameters that make every rule of the chain act on the synthetic series.
RULES = DailyRules(constant_eps=9.0, constant_above=4.0, constant_min_len=7, sigma=2.0, max_gap_days=3,
                   unit_days=2.0, quiet_max=8.0, quiet_eps=25.0, threshold=3.0)

POS = "(d - DATE '1970-01-01')"
FILLED = "SELECT k, d, t, (d - DATE '1970-01-01') AS pos, last_value(t IGNORE NULLS) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS f FROM full_daily"

CHAIN = {
    "filled": FILLED,
    "d1": sql_derivative("filled", "f", "pos", RULES.unit_days, "dt"),
    "d2": sql_derivative("d1", "dt", "pos", RULES.unit_days, "d2t"),
    "flagged": f"SELECT *, coalesce(abs(dt) < {RULES.constant_eps} AND t > {RULES.constant_above}, FALSE) AS flag FROM d2",
    "numbered": "SELECT *, sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS run FROM flagged",
    "runs": "SELECT *, CASE WHEN flag THEN sum(CASE WHEN flag THEN 1 ELSE 0 END) OVER (PARTITION BY k, run) ELSE 0 END AS run_len FROM numbered",
    "unstuck": f"SELECT *, CASE WHEN run_len < {RULES.constant_min_len} THEN t END AS p1 FROM runs",
    "limits": "SELECT k, avg(abs(d2t)) + stddev_pop(d2t) AS lim FROM d2 GROUP BY k",
    "unjumped": "SELECT u.*, CASE WHEN NOT coalesce(abs(d2t) > lim, FALSE) THEN p1 END AS p2 FROM unstuck u JOIN limits USING (k)",
    "doys": "SELECT k, dayofyear(d) AS doy, avg(p2) AS m, stddev_pop(p2) AS sd FROM unjumped GROUP BY 1, 2",
    "spreads": "SELECT k, avg(sd) AS spread FROM doys GROUP BY k",
    "bounded": f"""SELECT u.*, CASE WHEN NOT coalesce(abs(p2 - m) > {RULES.sigma} * spread, FALSE)
        THEN CASE WHEN p2 < 0 THEN 0 ELSE p2 END END AS p3
        FROM unjumped u JOIN doys ON doys.k = u.k AND doys.doy = dayofyear(u.d) JOIN spreads ON spreads.k = u.k""",
    "processed": sql_interpolate("bounded", "p3", "pos", "t_processed", RULES.max_gap_days),
}
OFFSET = {
    "quiet": f"""SELECT *, year(d) + CASE WHEN month(d) = 12 THEN 1 ELSE 0 END AS wy, max(year(d)) OVER (PARTITION BY k) AS last_y,
        CASE WHEN month(d) IN (12, 1, 2) AND t_processed <= {RULES.quiet_max}
          AND NOT coalesce(abs(dt) > {RULES.quiet_eps}, FALSE) AND NOT coalesce(abs(d2t) > {RULES.quiet_eps}, FALSE)
        THEN t_processed END AS q FROM processed""",
    "winters": "SELECT k, wy, avg(q) AS wmean FROM quiet GROUP BY 1, 2",
    "assigned": """SELECT quiet.*, CASE WHEN month(d) IN (12, 1, 2, 3, 4) AND quiet.wy <= last_y THEN wmean END AS o
        FROM quiet JOIN winters ON winters.k = quiet.k AND winters.wy = quiet.wy""",
    "offsets": sql_interpolate("assigned", "o", "pos", "t_winter_offset"),
    "noff": """SELECT *, CASE WHEN t_processed - t_winter_offset < 0 THEN 0 ELSE t_processed - t_winter_offset END
        AS t_no_offset FROM offsets""",
}
WINTER = "CASE WHEN month(d) <= 5 THEN year(d) - 1 WHEN month(d) = 12 OR (month(d) = 11 AND day(d) > 1) THEN year(d) END"


def crossing_sql(source: str, value: str, threshold: float) -> str:
    """Freeze-up per (k, season) with its day number."""
    return f"""SELECT k, season, fud, dayofyear(fud) + CASE WHEN dayofyear(fud) < 300
          THEN dayofyear(make_date(season, 12, 31)) ELSE 0 END AS fudoy
      FROM (SELECT k, season, min(CASE WHEN v > 0 AND v <= {threshold} THEN d END) AS fud
            FROM (SELECT k, d, {value} AS v, {WINTER} AS season, min(year(d)) OVER (PARTITION BY k) AS y0,
                    max(year(d)) OVER (PARTITION BY k) AS y1 FROM {source})
            WHERE season >= y0 AND season < y1 GROUP BY 1, 2)"""


def processed(spark, sf):
    return yearly.processed_series(i.calendar_daily(spark, sf), K, RULES)


def simple_fuds(spark, sf):
    return agg.freeze_up_table(i.daily(spark, sf), K, "d", val.threshold_flag(F.col("t"), RULES.threshold))


@query("resample_daily", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('t')} AS t FROM full_daily"))
def resample_daily(spark, sf):
    return agg.resample_daily(i.orders_series(spark, sf), K, "ts", "v")


@query("daily_sum", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('coalesce(s, 0)')} AS t FROM days LEFT JOIN sums USING (k, d)",
       sums=f"SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice / {i.DAILY_DIVISOR}) AS s FROM orders GROUP BY 1, 2"))
def daily_sum(spark, sf):
    return agg.resample_daily(i.orders_series(spark, sf), K, "ts", "v", how="sum")


@query("climatology", with_ctes("daily", f"""SELECT k, dayofyear(d) AS doy, {rnd('avg(t)')} AS clim, {rnd('stddev_pop(t)')} AS sd,
       {rnd('min(t)')} AS lo, {rnd('max(t)')} AS hi, {rnd('max(t) - min(t)')} AS band FROM daily GROUP BY 1, 2"""))
def climatology(spark, sf):
    return agg.climatology(i.daily(spark, sf), K)


@query("rotate_climatology", with_ctes("daily", f"""SELECT k, (dayofyear(d) - 182 + 365) % 365 AS pos, {rnd('avg(t)')} AS clim
       FROM daily WHERE dayofyear(d) <= 365 GROUP BY k, dayofyear(d)"""))
def rotate_climatology(spark, sf):
    return seasons.rotate_climatology(agg.climatology(i.daily(spark, sf), K)).select("k", "pos", "clim")


@query("ffill", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('t')} AS t, {rnd('f')} AS t_ffill FROM filled", filled=FILLED))
def ffill(spark, sf):
    return ordered.ffill_series(i.calendar_daily(spark, sf), K)


@query("differentiate", with_ctes("daily", f"SELECT k, {text('d')} AS d, {rnd('dt')} AS dt FROM d1",
       src=f"SELECT *, {POS} AS pos FROM daily", d1=sql_derivative("src", "t", "pos", 1, "dt")))
def differentiate(spark, sf):
    return ordered.differentiate_series(i.daily(spark, sf), K, fill=False).select("k", "d", "dt")


@query("second_derivative", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('dt')} AS dt, {rnd('d2t')} AS d2t FROM d2",
       **{n: CHAIN[n] for n in ("filled", "d1", "d2")}))
def second_derivative(spark, sf):
    return quality.derivatives(i.calendar_daily(spark, sf), K, unit_days=RULES.unit_days).select("k", "d", "dt", "d2t")


@query("interpolate", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('t_interp')} AS t_interp FROM x",
       filled=FILLED, x=sql_interpolate("filled", "t", "pos", "t_interp")))
def interpolate(spark, sf):
    return ordered.interpolate_series(i.calendar_daily(spark, sf), K).select("k", "d", "t_interp")


@query("interpolate_max_gap", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('t_interp')} AS t_interp FROM x",
       filled=FILLED, x=sql_interpolate("filled", "t", "pos", "t_interp", 3)))
def interpolate_max_gap(spark, sf):
    return ordered.interpolate_series(i.calendar_daily(spark, sf), K, max_gap=3).select("k", "d", "t_interp")


@query("interpolate_to_grid", with_ctes(FULL, f"""SELECT k, {text('d')} AS d, {rnd('t_grid')} AS t_grid FROM x
       WHERE d = last_day(d) OR day(d) = 15""",
       sparse=f"SELECT k, d, CASE WHEN t > 5 THEN t END AS t, {POS} AS pos FROM full_daily",
       x=sql_interpolate("sparse", "t", "pos", "t_grid")))
def interpolate_to_grid(spark, sf):
    full = i.calendar_daily(spark, sf)
    labels = full.where((F.col("d") == F.last_day("d")) | (F.dayofmonth("d") == 15)).select("k", "d")
    sparse = i.daily(spark, sf).where(F.col("t") > 5)
    return ordered.interpolate_to_grid(sparse, labels, K)


@query("cumsum", with_ctes("daily", f"""SELECT k, {text('d')} AS d,
       {rnd('sum(t) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING)', 5)} AS running FROM daily"""), digits=5)
def cumsum(spark, sf):
    return ordered.cumsum_series(i.daily(spark, sf), K).select("k", "d", "running")


@query("spike_mask", with_ctes(FULL, f"""SELECT k, {text('d')} AS d,
       {rnd('CASE WHEN abs(dt) <= 12 AND t <= 20 THEN t END')} AS t_masked FROM d1""",
       filled=FILLED, d1=CHAIN["d1"]))
def spike_mask(spark, sf):
    return quality.mask_spikes(i.calendar_daily(spark, sf), K, limit=12.0, upper=20.0).select("k", "d", "t_masked")


@query("constant_runs", with_ctes(FULL, f"SELECT k, {text('d')} AS d, CAST(run_len AS BIGINT) AS run_len, {rnd('p1')} AS t_processed FROM unstuck",
       **{n: CHAIN[n] for n in ("filled", "d1", "d2", "flagged", "numbered", "runs", "unstuck")}))
def constant_runs(spark, sf):
    framed = quality.derivatives(i.calendar_daily(spark, sf), K, unit_days=RULES.unit_days)
    framed = framed.withColumn("t_processed", F.col("t"))
    masked = quality.mask_constant_runs(framed, K, eps=RULES.constant_eps, above=RULES.constant_above,
                                        min_len=RULES.constant_min_len)
    return masked.select("k", "d", F.col("run_len").cast("bigint").alias("run_len"), "t_processed")


@query("jump_mask", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('CASE WHEN NOT coalesce(abs(d2t) > lim, FALSE) THEN t END')} AS t_masked FROM d2 JOIN limits USING (k)",
       **{n: CHAIN[n] for n in ("filled", "d1", "d2", "limits")}))
def jump_mask(spark, sf):
    framed = quality.derivatives(i.calendar_daily(spark, sf), K, unit_days=RULES.unit_days)
    return quality.mask_jumps(framed.withColumn("t_masked", F.col("t")), K, "t_masked").select("k", "d", "t_masked")


SIGMA_STEPS = {
    "doys": "SELECT k, dayofyear(d) AS doy, avg(t) AS m, stddev_pop(t) AS sd FROM full_daily GROUP BY 1, 2",
    "spreads": "SELECT k, avg(sd) AS spread FROM doys GROUP BY k",
}


@query("sigma_mask", with_ctes(FULL, f"""SELECT f.k AS k, {text('f.d')} AS d,
       {rnd(f'CASE WHEN NOT coalesce(abs(t - m) > {RULES.sigma} * spread, FALSE) THEN t END')} AS t_masked
       FROM full_daily f JOIN doys ON doys.k = f.k AND doys.doy = dayofyear(f.d) JOIN spreads ON spreads.k = f.k""", **SIGMA_STEPS))
def sigma_mask(spark, sf):
    framed = i.calendar_daily(spark, sf).withColumn("t_masked", F.col("t"))
    return quality.mask_sigma(framed, K, value="t_masked", sigma=RULES.sigma).select("k", "d", "t_masked")


@query("mean_of_group_std", with_ctes("daily", f"SELECT k, {rnd('spread')} AS mean_sd FROM spreads",
       doys="SELECT k, dayofyear(d) AS doy, stddev_pop(t) AS sd FROM daily GROUP BY 1, 2",
       spreads="SELECT k, avg(sd) AS spread FROM doys GROUP BY k"))
def mean_of_group_std(spark, sf):
    return agg.mean_of_group_std(i.daily(spark, sf), K, F.dayofyear("d"), "t")


@query("global_stat_threshold", with_ctes(FULL, f"SELECT k, {rnd('lim')} AS lim FROM limits",
       **{n: CHAIN[n] for n in ("filled", "d1", "d2", "limits")}))
def global_stat_threshold(spark, sf):
    framed = quality.derivatives(i.calendar_daily(spark, sf), K, unit_days=RULES.unit_days)
    return framed.groupBy("k").agg(agg.jump_threshold(F.col("d2t")).alias("lim"))


@query("anomaly_join", with_ctes("daily", f"""SELECT k, {text('d')} AS d, {rnd('t - m')} AS anomaly FROM daily
       JOIN (SELECT k, dayofyear(d) AS doy, avg(t) AS m FROM daily GROUP BY 1, 2) c USING (k) WHERE c.doy = dayofyear(d)"""))
def anomaly_join(spark, sf):
    return align.anomaly(i.daily(spark, sf), K, F.dayofyear("d"), "t").select("k", "d", "anomaly")


@query("quality_chain", with_ctes(FULL, f"SELECT k, {text('d')} AS d, {rnd('t_processed')} AS t_processed FROM processed", **CHAIN))
def quality_chain(spark, sf):
    return quality.quality_chain(i.calendar_daily(spark, sf), K, rules=RULES).select("k", "d", "t_processed")


@query("seasonal_mean", with_ctes("daily", f"""SELECT k, {text("CAST(make_date(wy - 1, 12, 1) + INTERVAL 45 DAY AS DATE)")} AS label, {rnd('avg(t)')} AS t
       FROM (SELECT *, year(d) + CASE WHEN month(d) = 12 THEN 1 ELSE 0 END AS wy FROM daily WHERE month(d) IN (12, 1, 2)) GROUP BY k, wy"""))
def seasonal_mean(spark, sf):
    return agg.seasonal_mean_djf(i.daily(spark, sf), K)


@query("winter_offset", with_ctes(FULL, f"""SELECT k, {text('d')} AS d, {rnd('t_winter_offset')} AS t_winter_offset,
       {rnd('t_no_offset')} AS t_no_offset FROM noff""", **CHAIN, **OFFSET))
def winter_offset(spark, sf):
    return processed(spark, sf).select("k", "d", "t_winter_offset", "t_no_offset")


@query("current_season_offset", with_ctes(FULL, f"""SELECT k, {text('d')} AS d,
       {rnd('CASE WHEN t - mo < 0 THEN 0 ELSE t - mo END')} AS t_no_offset FROM daily JOIN mo USING (k) WHERE d >= DATE '2000-07-01'""",
       **CHAIN, **OFFSET, mo="SELECT k, avg(t_winter_offset) AS mo FROM noff GROUP BY k"))
def current_season_offset(spark, sf):
    current = i.daily(spark, sf).where(F.col("d") >= F.lit("2000-07-01").cast("date"))
    return seasons.remove_mean_offset(current, processed(spark, sf), K).select("k", "d", "t_no_offset")


@query("threshold_flag", with_ctes(FULL, f"""SELECT k, {text('d')} AS d, CASE WHEN t > 0 AND t <= 3 THEN 1 ELSE 0 END AS flag,
       CASE WHEN t >= 0 AND t <= 3 THEN 1 ELSE 0 END AS flag_with_zero FROM full_daily"""))
def threshold_flag(spark, sf):
    t = F.col("t")
    return i.calendar_daily(spark, sf).select("k", "d", val.threshold_flag(t, 3.0).alias("flag"),
                                              val.threshold_flag(t, 3.0, include_zero=True).alias("flag_with_zero"))


@query("first_crossing", with_ctes("daily", f"SELECT k, season, {text('fud')} AS fud FROM c", c=crossing_sql("daily", "t", 3.0)))
def first_crossing(spark, sf):
    return simple_fuds(spark, sf).select("k", "season", "fud")


@query("fudoy", with_ctes("daily", f"""SELECT k, season, fudoy,
       fudoy - CASE WHEN dayofyear(make_date(season, 12, 31)) = 366 THEN 1 ELSE 0 END AS fudoy_fixed FROM c""",
       c=crossing_sql("daily", "t", 3.0)))
def fudoy(spark, sf):
    fuds = simple_fuds(spark, sf)
    return fuds.select("k", "season", "fudoy", cal.fudoy(F.col("fud"), F.col("season"), True).alias("fudoy_fixed"))


@query("mean_fud", with_ctes("daily", """SELECT k, CAST(round_even(avg(fudoy), 0) AS INTEGER) AS mean_fudoy,
       strftime(DATE '2001-01-01' + CAST(round_even(avg(fudoy), 0) AS INTEGER) - 1, '%m-%d') AS monthday FROM c GROUP BY k""",
       c=crossing_sql("daily", "t", 3.0)))
def mean_fud(spark, sf):
    return agg.mean_freeze_up(simple_fuds(spark, sf), K)


@query("observed_freeze_up", with_ctes(FULL, f"SELECT k, season, {text('fud')} AS fud, fudoy FROM c", **CHAIN, **OFFSET,
       c=crossing_sql("noff", "t_no_offset", RULES.threshold)))
def observed_freeze_up(spark, sf):
    return yearly.observed_freeze_up(processed(spark, sf), K, rules=RULES)


@query("fudoy_to_date", with_ctes("daily", f"""SELECT k, {text('d')} AS d, f, {text('''CASE
         WHEN f > 365 THEN make_date(season + 1, 1, 1) + CAST(round_even(f - 366, 0) AS INTEGER)
         WHEN dayofyear(make_date(season, 12, 31)) = 366 THEN make_date(season, 1, 1) + CAST(round_even(f, 0) AS INTEGER)
         ELSE make_date(season, 1, 1) + CAST(round_even(f - 1, 0) AS INTEGER) END''')} AS fud_date
       FROM (SELECT k, d, 340 + floor(t * 4) / 2 AS f, year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END AS season FROM daily)"""))
def fudoy_to_date(spark, sf):
    numbered = i.daily(spark, sf).select("k", "d", (F.floor(F.col("t") * 4) / 2 + 340).alias("f"))
    return numbered.withColumn("fud_date", cal.fudoy_to_date(F.col("f"), cal.season_of(F.col("d"))))


MATRIX = {
    "placed": "SELECT k, d, t, year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END AS season FROM daily",
    "sliced": """SELECT k, season, d - make_date(season, 7, 1) AS pos, t FROM placed
                 WHERE d - make_date(season, 7, 1) BETWEEN 0 AND 364""",
    "matrix": """SELECT g.k, g.season, g.season || '/' || (g.season + 1) AS season_label, g.pos, s.t
                 FROM (SELECT k, season, unnest(range(0, 365)) AS pos FROM (SELECT DISTINCT k, season FROM sliced)) g
                 LEFT JOIN sliced s ON s.k = g.k AND s.season = g.season AND s.pos = g.pos""",
}


@query("season_matrix", with_ctes("daily", f"SELECT k, season, pos, {rnd('t')} AS t FROM matrix", **MATRIX))
def season_matrix(spark, sf):
    return seasons.season_matrix(i.daily(spark, sf), K)


@query("season_arrays", with_ctes("daily", f"SELECT k, season_label, pos, {rnd('t')} AS t FROM matrix", **MATRIX))
def season_arrays(spark, sf):
    """The arrays unfolded again, so that every element is compared."""
    arrays = seasons.season_arrays(seasons.season_slice(i.daily(spark, sf), K), K)
    return arrays.select("k", "season_label", F.posexplode("days").alias("pos", "t"))


@query("gap_fill_climatology", with_ctes("daily", f"""SELECT k, {text('d')} AS d, {rnd('coalesce(t, m)')} AS t FROM kept
       FULL JOIN (SELECT k, CAST(make_date(1997, 1, 1) + CAST(doy AS INTEGER) - 1 AS DATE) AS d, m FROM clim) e USING (k, d)""",
       kept="SELECT * FROM daily WHERE year(d) <> 1997",
       clim="SELECT k, dayofyear(d) AS doy, avg(t) AS m FROM kept WHERE dayofyear(d) <= 365 GROUP BY 1, 2"))
def gap_fill_climatology(spark, sf):
    kept = i.daily(spark, sf).where(F.year("d") != 1997)
    return seasons.fill_with_climatology(kept, K, "1997-01-01", "1997-12-31")


@query("series_summary", with_ctes("daily", f"""SELECT k, {text('min(d)')} AS first_d, {rnd('arg_min(t, d)')} AS first_t, {text('max(d)')} AS last_d,
       {rnd('arg_max(t, d)')} AS last_t, min(year(d)) AS min_year, max(year(d)) AS max_year FROM daily GROUP BY k"""))
def series_summary(spark, sf):
    return agg.series_summary(i.daily(spark, sf), K)


@query("frozen_latch", with_ctes("daily", f"""SELECT k, year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END AS season,
       {text('min(d)')} AS frozen_date FROM daily WHERE t < 0.75 GROUP BY 1, 2"""))
def frozen_latch(spark, sf):
    return daily_plan.frozen_latch(i.daily(spark, sf), K)


@query("freeze_up_labels", with_ctes("daily", """SELECT k, season || '/' || (season + 1) AS season_label, strftime(fud, '%m-%d') AS monthday FROM c""",
       c=crossing_sql("daily", "t", 3.0)))
def freeze_up_labels(spark, sf):
    return publish.freeze_up_labels(simple_fuds(spark, sf), K)


def label_mean_sql(day: str) -> str:
    """Mean common-year day number, half to even, as MM-dd."""
    doy = f"(dayofyear({day}) - CASE WHEN dayofyear(make_date(year({day}), 12, 31)) = 366 AND month({day}) > 2 THEN 1 ELSE 0 END)"
    number = f"({doy} + CASE WHEN {doy} < 182 THEN 365 ELSE 0 END)"
    return f"strftime(DATE '2001-01-01' + CAST(round_even(avg({number}), 0) AS INTEGER) - 1, '%m-%d')"


@query("freeze_up_json", with_ctes("daily", f"""SELECT k, season || '/' || (season + 1) AS season_label, strftime(fud, '%m-%d') AS monthday
       FROM c WHERE fud IS NOT NULL UNION ALL
       SELECT k, 'clim', {label_mean_sql('fud')} FROM c WHERE fud IS NOT NULL GROUP BY k""",
       c=crossing_sql("daily", "t", 3.0)))
def freeze_up_json(spark, sf):
    """The documents parsed again into their entries."""
    documents = publish.freeze_up_json(simple_fuds(spark, sf), K)
    return documents.select("k", F.explode(F.from_json("json", "map<string,string>")).alias("season_label", "monthday"))


JSON_SCHEMA = "date array<string>, years array<string>, clim array<double>, `clim-std` array<double>, `clim+std` array<double>, seasons map<string,array<double>>"


def json_parts(documents):
    """Documents parsed again, one row per array element."""
    parsed = documents.select("k", F.from_json("json", JSON_SCHEMA).alias("j"))
    envelope = F.create_map(*[x for n in ("clim", "clim-std", "clim+std") for x in (F.lit(n), F.col(f"j.`{n}`"))])
    parts = parsed.select("k", F.explode(F.map_concat(envelope, "j.seasons")).alias("part", "days"))
    return parts.select("k", "part", F.posexplode("days").alias("pos", "x"))


PARTS_SQL = f"""SELECT k, season_label AS part, pos, {rnd('t')} AS x FROM matrix
       UNION ALL SELECT k, 'clim', pos, {rnd('m')} FROM c UNION ALL SELECT k, 'clim-std', pos, {rnd('lo')} FROM c
       UNION ALL SELECT k, 'clim+std', pos, {rnd('band')} FROM c"""


def envelope_sql(source: str, value: str) -> str:
    return f"""SELECT a.k, a.pos, m, lo, band FROM (SELECT k, unnest(range(0, 365)) AS pos FROM (SELECT DISTINCT k FROM {source})) a
        LEFT JOIN (SELECT k, (dayofyear(d) - 182 + 365) % 365 AS pos, avg({value}) AS m, min({value}) AS lo, max({value}) - min({value}) AS band
                   FROM {source} WHERE dayofyear(d) <= 365 GROUP BY k, dayofyear(d)) e ON e.k = a.k AND e.pos = a.pos"""


@query("series_json", with_ctes("daily", PARTS_SQL, **MATRIX, c=envelope_sql("daily", "t")))
def series_json(spark, sf):
    return json_parts(publish.series_json(i.daily(spark, sf), K))


AS_OF = "2001-02-15"


@query("chart_series", with_ctes(FULL, PARTS_SQL, **CHAIN, **OFFSET,
       mo="SELECT k, avg(t_winter_offset) AS mo FROM noff GROUP BY k",
       shown="""SELECT k, d, t_no_offset AS t FROM noff WHERE d < DATE '2000-07-01' UNION ALL
                SELECT k, d, CASE WHEN t - mo < 0 THEN 0 ELSE t - mo END FROM daily JOIN mo USING (k) WHERE d >= DATE '2000-07-01' AND d < DATE '2001-02-15'""",
       placed=MATRIX["placed"].replace("FROM daily", "FROM shown"), sliced=MATRIX["sliced"], matrix=MATRIX["matrix"],
       known="SELECT k, d, t_no_offset AS t FROM noff WHERE d <= DATE '2000-06-30'", c=envelope_sql("known", "t")))
def chart_series(spark, sf):
    return json_parts(chart.chart_series(processed(spark, sf), i.daily(spark, sf), K, AS_OF))


@query("chart_freeze_up", with_ctes("daily", f"""SELECT k, season, {text('fud')} AS fud FROM c WHERE season < 2000
       UNION ALL SELECT k, 2000, {text('coalesce(l.d, DATE ' + "'2000-12-31'" + ' - CAST(floor(t9) AS INTEGER))')} FROM f LEFT JOIN l USING (k)""",
       c=crossing_sql("daily", "t", 3.0),
       l="SELECT k, min(d) AS d FROM daily WHERE t < 0.3 AND d >= DATE '2000-07-01' AND d < DATE '2001-02-15' GROUP BY k",
       f="SELECT k, avg(t) AS t9 FROM daily GROUP BY k"))
def chart_freeze_up(spark, sf):
    full = i.daily(spark, sf)
    latched = daily_plan.frozen_latch(full.where(F.col("d") < F.lit(AS_OF).cast("date")), K, threshold=0.3)
    expected = full.groupBy("k").agg(F.floor(F.avg("t")).cast("int").alias("n")).select(
        "k", F.lit(2000).alias("season"), F.date_sub(F.lit("2000-12-31").cast("date"), F.col("n")).alias("fud_date"))
    return chart.chart_freeze_up(simple_fuds(spark, sf), latched, expected, K, AS_OF)
