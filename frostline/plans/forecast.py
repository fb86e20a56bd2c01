"""Forecast input and forecast: which source feeds which predictor, and the regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.operators import aggregate as agg
from frostline.operators import align, ensemble, model, publish
from frostline.plans.yearly import PREDICTORS
from frostline.session import Stage, materialise

# Fixed values of the release calendar.
RELEASE_DAY = 7        # forecasts and full analysis months arrive on the 7th
ANALYSIS_LAG_DAYS = 5  # the analysis runs this many days behind
FORECAST_LEADS = 215   # daily leads of one forecast
ISO_MONDAY = 0         # weekday() of the weekly issue

NAMES = tuple(name for name, _, _ in PREDICTORS)


def issue_calendar(first: Column, last: Column, source: DataFrame) -> DataFrame:
    """Issue dates between the bounds found in ``source``: every 7th (monthly), every Monday (weekly)."""
    days = source.agg(first.alias("_a"), last.alias("_b")).select(cal.day_grid(F.col("_a"), F.col("_b")).alias("issued"))
    seventh = F.dayofmonth("issued") == RELEASE_DAY
    # July 1-6 precedes the season's first monthly forecast.
    too_early = (F.month("issued") == 7) & (F.dayofmonth("issued") < RELEASE_DAY)
    monday = (F.weekday("issued") == ISO_MONDAY) & ~too_early
    feeds = F.array_compact(F.array(F.when(seventh, "monthly"), F.when(monday, "weekly")))
    issued = days.where(cal.forecast_season(F.col("issued")).isNotNull())
    return issued.select("issued", F.explode(feeds).alias("feed"))


def source_rules(issues: DataFrame, from_release_day: bool = False) -> DataFrame:
    """Per issue and predictor: target month, preferred source, forecast to use, observed days.

    With ``from_release_day`` observed days are used from the 7th of the target month on, when
    its own forecast is out (operation); without, as soon as there are any (replay).

    Adds season, variable, method, target (month start), analysis_due, forecast_issue (month
    start) and observed_until (weekly feed only). The rules are column expressions over a
    three-entry array, so nothing is joined.
    """
    specs = F.array(*[
        F.struct(F.lit(n).alias("variable"), F.lit(m).alias("month"), F.lit(h).alias("method"))
        for n, m, h in PREDICTORS
    ])
    issued, target = F.col("issued"), F.col("target")
    due = F.date_add(F.add_months(target, 1), RELEASE_DAY - 1)
    this_month = F.trunc(issued, "month").cast("date")
    latest = F.when(F.dayofmonth(issued) < RELEASE_DAY, F.add_months(this_month, -1)).otherwise(this_month)
    reach = F.least(F.date_sub(issued, ANALYSIS_LAG_DAYS), F.last_day(target))
    partial = (F.col("feed") == "weekly") & (issued < due) & (reach >= target)
    if from_release_day:
        partial = partial & (issued >= F.date_add(target, RELEASE_DAY - 1))
    return (
        issues.withColumn("season", cal.forecast_season(issued))
        .withColumn("_spec", F.explode(specs))
        .select("*", "_spec.*").drop("_spec")
        .withColumn("target", F.make_date("season", "month", F.lit(1)))
        .withColumn("analysis_due", issued >= due)
        .withColumn("forecast_issue", F.when(F.col("month") < F.month(issued), target).otherwise(latest))
        .withColumn("observed_until", F.when(partial, reach))
        .drop("month")
    )


def analysis_months(analysis_daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Complete months of the analysis: (keys, variable, target, value), reduced by each variable's method.

    ``analysis_daily`` has keys, variable, d and value: the spatial mean (or daily accumulation).
    """
    method = F.element_at(F.create_map(*[F.lit(x) for n, _, h in PREDICTORS for x in (n, h)]), F.col("variable"))
    month = F.trunc("d", "month").cast("date")
    folded = analysis_daily.where(F.col("value").isNotNull()).groupBy(*keys, "variable", month.alias("target")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_mean"), F.sum("value").alias("_sum")
    )
    complete = folded.where(F.col("_n") == F.dayofmonth(F.last_day("target")))
    return complete.select(
        *keys, "variable", "target", F.when(method == "sum", F.col("_sum")).otherwise(F.col("_mean")).alias("value")
    )


def observed_parts(rules: DataFrame, analysis_daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The observed days of each partly observed target month, as arrays by day of the month.

    (keys, issued, feed, variable, obs, sums, i1, i2): values, running sums and the first and last observed
    day. A month has at most 31 days, so a row is small and no join by day is needed later.
    """
    month = F.trunc("d", "month").cast("date")
    known = analysis_daily.where(F.col("value").isNotNull()).groupBy(*keys, "variable", month.alias("target")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("d"), "value"))).alias("_days"))
    asked = rules.where(F.col("observed_until").isNotNull()).select("issued", "feed", "variable", "target", F.dayofmonth("observed_until").alias("_until"))
    obs = F.transform(F.sequence(F.lit(1), F.lit(31)), lambda n: F.when(n <= F.col("_until"), F.try_element_at("_days", n)))
    seen = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda n: F.get("obs", n - 1).isNotNull())
    total = lambda n: F.aggregate(F.slice("obs", 1, n), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    parts = asked.join(known, ["variable", "target"]).withColumn("obs", obs)
    return parts.select(*keys, "issued", "feed", "variable", "obs", F.transform(F.sequence(F.lit(1), F.lit(31)), total).alias("sums"),
                        F.array_min(seen).alias("i1"), F.array_max(seen).alias("i2")).where(F.col("i1").isNotNull())


def spliced_months(rules: DataFrame, observed: DataFrame, forecast_daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Members' monthly predictors from forecasts, the observed days of the month spliced in, as one aggregate over the leads.

    ``forecast_daily`` has keys, variable, issue, number, d and value (accumulated since the issue
    for summed variables). Means take the observed value of a day. A sum is read at the lead nearest to the month's end:
    within the observed days it is the member's base plus the observed sum, after them the member's value
    moved by what the observed days changed, as ``ensemble.splice_cumulative`` does for all leads.
    """
    names = ["issued", "feed", "variable"]
    wanted = rules.select(*keys, *names, "target", "method", F.col("forecast_issue").alias("issue"))
    wanted = wanted.join(observed, [*keys, *names], "left")
    leads = forecast_daily.join(wanted, [*keys, "variable", "issue"])
    d, v, summed = F.col("d"), F.col("value"), F.col("method") == "sum"
    in_month = F.trunc("d", "month") == F.col("target")
    first, last = F.date_add("target", F.col("i1") - 1), F.date_add("target", F.col("i2") - 1)
    nth = F.dayofmonth("d") - 1
    rows = leads.where(summed | in_month).select(
        *keys, *names, "number", "target", "method", "d", "value", first.alias("i1"), last.alias("i2"),
        F.when(in_month & ~summed, F.get("obs", nth)).alias("obs"),
        F.when(in_month & summed & d.between(first, last), F.get("sums", nth)).alias("sum"))
    at_end = F.when(d <= F.col("i2"), d)
    # nearest to the month's end, the earlier of two, in one number
    rank = F.when(v.isNotNull() | F.col("sum").isNotNull(),
                  F.abs(F.datediff(d, F.last_day("target"))).cast("bigint") * 1_000_000 + F.datediff(d, F.lit("1900-01-01").cast("date")))
    folded = rows.groupBy(*keys, *names, "number", "target", "method", "i1", "i2").agg(
        F.avg(F.coalesce("obs", "value")).alias("_mean"), F.min("d").alias("_d0"), F.max_by("value", F.when(d < F.col("i1"), d)).alias("_before"),
        F.max_by("value", at_end).alias("_old"), F.max_by("sum", at_end).alias("_end"), F.min_by("d", rank).alias("_d"),
        F.min_by("value", rank).alias("_v"), F.min_by("sum", rank).alias("_s"))
    base = F.when(F.trunc("_d0", "month") >= F.trunc("i1", "month"), F.lit(0.0)).otherwise(F.coalesce("_before", F.lit(0.0)))
    at = F.col("_d")
    spliced = (F.when(at < F.col("i1"), F.col("_v")).when(at <= F.col("i2"), F.coalesce(base + F.col("_s"), F.col("_v")))
               .otherwise(F.coalesce(F.col("_v") - F.col("_old") + base + F.col("_end"), F.col("_v"))))
    value = F.when(F.col("method") == "sum", spliced).otherwise(F.col("_mean"))
    # a sum without any known lead has no row
    return folded.where((F.col("method") == "mean") | at.isNotNull()).select(*keys, *names, "number", value.alias("value"))


def forecast_input(rules: DataFrame, analysis_daily: DataFrame, forecast_daily: DataFrame, stage: Stage = materialise,
                   keys: Sequence[str] = (), months: DataFrame | None = None) -> DataFrame:
    """Wide predictor rows per issue: member 0 is the ensemble mean, members lacking a variable use it.

    ``keys`` (regions) are columns of the daily tables; ``months`` are the complete months of the analysis, by default
    those of ``analysis_daily``. The daily tables are reductions of whole grids and every one of them, like the rules, has
    several readers here: each is written once.
    """
    keys, issue = list(keys), ["issued", "feed"]
    rules = stage(rules, "issue-rules")
    analysis_daily = stage(analysis_daily, "analysis-daily")
    forecast_daily = stage(forecast_daily, "forecast-daily")
    months = analysis_months(analysis_daily, keys) if months is None else months
    full = stage(rules.where("analysis_due").join(months, ["variable", "target"]).select(*keys, *issue, "variable", "value"), "full-months")
    named = rules
    if keys:  # a rule is open in the places that its forecast covers
        places = forecast_daily.select(*keys, "variable", F.col("issue").alias("forecast_issue")).distinct()
        named = rules.join(places, ["variable", "forecast_issue"])
    open_rules = named.join(full.select(*keys, *issue, "variable"), [*keys, *issue, "variable"], "left_anti")
    observed = stage(observed_parts(rules, analysis_daily, keys), "observed-parts")
    members = spliced_months(stage(open_rules, "open-rules"), observed, forecast_daily, keys)
    members = stage(members.select(*keys, *issue, "number", "variable", "value"), "members")
    means = agg.ensemble_mean(members, [*keys, *issue, "variable"])
    best = align.prefer_source([("analysis", full), ("forecast", means)], [*keys, *issue, "variable"])
    return ensemble.member_fallback(members, best.drop("source"), [*keys, *issue], NAMES)


def missing_predictors(rules: DataFrame, inputs: DataFrame, keys: Sequence[str] = (), names: Sequence[str] = NAMES) -> DataFrame:
    """Issues for which neither source has a predictor: (keys, issued, feed, missing), ``missing`` in the order of ``names``.

    An issue that no place has any predictor for comes once, with NULL keys.
    """
    lacking = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))
    partly = inputs.where(F.col("number") == 0).select(*keys, "issued", "feed", lacking.alias("missing")).where(F.size("missing") > 0)
    asked = rules.groupBy("issued", "feed").agg(F.collect_set("variable").alias("_asked"))
    wholly = asked.join(inputs.select("issued", "feed").distinct(), ["issued", "feed"], "left_anti").select(
        *[F.lit(None).cast(inputs.schema[k].dataType).alias(k) for k in keys], "issued", "feed",
        F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains("_asked", n)).alias("missing"))
    return partly.unionByName(wholly)


def require_predictors(inputs: DataFrame, keys: Sequence[str] = (), names: Sequence[str] = NAMES) -> DataFrame:
    """The same rows; the job fails at a row whose ensemble mean lacks a predictor and names the row and the predictor."""
    label = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys], F.col("issued").cast("string"), "feed")
    gaps = [F.when(F.col(n).isNull() & (F.col("number") == 0), F.raise_error(F.concat(F.lit(f"{n} not found in analysis or forecast: "), label))) for n in names]
    checked = F.coalesce(*[g.cast("double") for g in gaps])
    return inputs.select(*[F.coalesce(c, checked).alias(c) if c in names else F.col(c) for c in inputs.columns])


def run_forecast(inputs: DataFrame, fitted: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """Forecast day number and date of the mean and every member; the model is fitted once.

    A row that lacks a predictor keeps its place with a NULL forecast.
    """
    predicted = model.predict(inputs, fitted, names)
    season = cal.forecast_season(F.col("issued"))
    return predicted.withColumn("season", season).withColumn(
        "fud_date", cal.fudoy_to_date(F.col("prediction"), F.col("season"))
    )


def latest_document(log: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """JSON of the newest forecast of the season shown on ``as_of``, of either feed, per key; the weekly feed wins on one date."""
    day = F.lit(as_of).cast("date")
    shown = log.where((F.col("season") == cal.published_season(day)) & (F.col("issued") <= day))
    feeds = [(name, shown.where(F.col("feed") == name)) for name in ("weekly", "monthly")]
    return publish.latest_json(align.latest_of_feeds(feeds, keys, carry=["season"]), keys)
