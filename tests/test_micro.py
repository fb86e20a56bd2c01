"""Hand-computed cases, one per rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frostline.functions import calendar as cal
from frostline.functions import values as val
from frostline.operators import aggregate as agg
from frostline.operators import align, ensemble, model, ordered, quality, seasons
from frostline.plans import daily as daily_plan
from helpers import at, close, column, daily, day

K = ["k"]


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_differentiate_uneven(spark):
    series = daily(spark, [1, 2, 0, 4, 9], skip=(2,))
    close(column(ordered.differentiate_series(series, K), "dt"), [1, 1, 11 / 3, 5])


def test_differentiate_per_two_days(spark):
    close(column(ordered.differentiate_series(daily(spark, [0, 1, 4]), K, per=2), "dt"), [2, 4, 6])


def test_ffill(spark):
    close(column(ordered.ffill_series(daily(spark, [None, 1, None, None, 2]), K), "t_ffill"), [None, 1, 1, 1, 2])


def test_interpolate_within_max_gap(spark):
    seven = daily(spark, [0] + [None] * 6 + [7])
    close(column(ordered.interpolate_series(seven, K, max_gap=7), "t_interp"), list(range(8)))
    eight = daily(spark, [0] + [None] * 7 + [8])
    close(column(ordered.interpolate_series(eight, K, max_gap=7), "t_interp"), [0] + [None] * 7 + [8])


def test_interpolate_keeps_open_ends(spark):
    close(column(ordered.interpolate_series(daily(spark, [None, 1, None, 3, None]), K), "t_interp"), [None, 1, 2, 3, None])


def test_constant_runs(spark):
    values = [10.0] * 8 + [20, 30] + [40.0] * 7 + [50, 60]
    # after the derivative: 7 flat days at the start, 5 flat days in the middle
    series = quality.derivatives(daily(spark, values), K).withColumn("t_processed", F.col("t"))
    masked = quality.mask_constant_runs(series, K)
    assert column(masked, "t_processed")[:8] == [None] * 7 + [10.0]
    assert column(masked, "t_processed")[10:17] == [40.0] * 7
    assert column(masked, "run_len")[:8] == [7] * 7 + [0]


def test_parse_and_clamp(spark):
    raw = spark.createDataFrame([("Bad",), ("3.5",), ("x",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in raw.select(val.parse_value(F.col("v"))).collect()] == [None, 3.5, None, None, None]
    nums = spark.createDataFrame([(-1.0,), (0.0,), (None,), (2.0,)], "v double")
    assert [r[0] for r in nums.select(val.clamp_min0(F.col("v"))).collect()] == [0.0, 0.0, None, 2.0]


def test_to_celsius(spark):
    rows = spark.createDataFrame([("t2m", 273.15, "K"), ("tcc", 0.5, "(0 - 1)"), ("t2m", 1.0, "C"), ("t2m", 1.0, None)], "n string, v double, u string")
    out = rows.select(val.to_celsius(F.col("v"), F.col("n"), F.col("u")).alias("x"))
    assert [r.x for r in out.collect()] == [0.0, 0.5, 1.0, 1.0]


def test_threshold_flag(spark):
    rows = spark.createDataFrame([(0.0,), (0.5,), (0.75,), (0.76,), (None,)], "v double")
    plain = rows.select(val.threshold_flag(F.col("v"), 0.75).alias("a"), val.threshold_flag(F.col("v"), 0.75, True).alias("b")).collect()
    assert [r.a for r in plain] == [0, 1, 1, 0, 0]
    assert [r.b for r in plain] == [1, 1, 1, 0, 0]


def test_first_crossing_right_closed_and_never(spark):
    rows = [("a", day("2000-01-01"), 9.0), ("a", day("2000-11-01"), 0.5), ("a", day("2000-12-20"), 0.5), ("a", day("2001-05-31"), 5.0),
            ("a", day("2001-11-01"), 0.5), ("a", day("2001-12-01"), 5.0), ("a", day("2002-06-01"), 0.5)]
    series = spark.createDataFrame(rows, "k string, d date, t double")
    found = agg.first_crossing(series, K, "d", val.threshold_flag(F.col("t"), 0.75)).orderBy("season").collect()
    assert [(r.season, r.fud) for r in found] == [(2000, day("2000-12-20")), (2001, None)]


def test_first_crossing_may_31_inside(spark):
    rows = [("a", day("2000-06-01"), 9.0), ("a", day("2001-05-31"), 0.5), ("a", day("2001-06-01"), 0.1)]
    found = agg.first_crossing(spark.createDataFrame(rows, "k string, d date, t double"), K, "d", val.threshold_flag(F.col("t"), 0.75))
    assert found.collect()[0].fud == day("2001-05-31")


@pytest.mark.parametrize("number, season, expected", [
    (356, 2001, "2001-12-22"), (365, 2001, "2001-12-31"), (366, 2001, "2002-01-01"), (370, 2001, "2002-01-05"),
    (356, 2000, "2000-12-22"), (366, 2000, "2001-01-01"), (355.5, 2001, "2001-12-21"), (356.5, 2001, "2001-12-23"),
])
def test_fudoy_to_date(spark, number, season, expected):
    assert one(spark, cal.fudoy_to_date(F.lit(float(number)), F.lit(season))) == day(expected)


def test_fudoy_round_trip_in_leap_and_common_seasons(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-11-02', date'2002-05-31')) AS d")
    winters = days.withColumn("season", cal.winter_season(F.col("d"))).where(F.col("season").isNotNull())
    number = cal.fudoy(F.col("d"), F.col("season"), fixed_year_length=True)
    back = winters.withColumn("back", cal.fudoy_to_date(number.cast("double"), F.col("season")))
    assert back.where(F.col("back") != F.col("d")).count() == 0
    assert back.count() > 500


def test_fudoy_uses_the_length_of_its_own_season(spark):
    assert one(spark, cal.fudoy(F.lit(day("2001-01-05")), F.lit(2000))) == 5 + 366
    assert one(spark, cal.fudoy(F.lit(day("2002-01-05")), F.lit(2001))) == 5 + 365


def test_round_half_even(spark):
    assert one(spark, val.round_half_even(F.lit(2.5))) == 2
    assert one(spark, val.round_half_even(F.lit(365.5))) == 366


@pytest.mark.parametrize("text, expected", [
    ("1992-01-01", "1991-12-01"), ("1992-02-29", "1991-12-01"), ("1992-03-01", "1992-03-01"), ("1992-12-01", "1992-12-01"),
])
def test_quarter_from_december(spark, text, expected):
    assert one(spark, cal.quarter_from_december(F.lit(day(text)))) == day(expected)


@pytest.mark.parametrize("text, season, pos", [
    ("2000-07-01", 2000, 0), ("2001-06-30", 2000, 364), ("1999-07-01", 1999, 0), ("2000-06-29", 1999, 364), ("2000-06-30", 1999, 365),
])
def test_season_position(spark, text, season, pos):
    d = F.lit(day(text))
    assert one(spark, cal.season_of(d)) == season
    assert one(spark, cal.season_position(d, cal.season_of(d))) == pos


def members(spark, first, values, issue="1997-08-01"):
    start = day(first)
    rows = [("x", day(issue), 1, start + dt.timedelta(days=n), float(v)) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, issue date, number int, d date, value double")


def observations(spark, first, values):
    start = day(first)
    return spark.createDataFrame([("x", start + dt.timedelta(days=n), float(v)) for n, v in enumerate(values)], "k string, d date, obs double")


def test_splice_cumulative_later_month(spark):
    out = ensemble.splice_cumulative(members(spark, "1997-08-30", [10, 11, 12, 13, 14]), observations(spark, "1997-09-01", [5, 1]), K, ["issue", "number"])
    # August 30 and 31 precede the observed days
    close(column(out, "value"), [10, 11, 16, 17, 18])
    out = ensemble.splice_cumulative(members(spark, "1997-08-31", [10, 11, 12, 13, 14]), observations(spark, "1997-09-01", [5, 1]), K, ["issue", "number"])
    close(column(out, "value"), [10, 15, 16, 17, 18])


def test_splice_cumulative_same_month(spark):
    out = ensemble.splice_cumulative(members(spark, "1997-09-02", [1, 2, 3, 4], "1997-09-01"), observations(spark, "1997-09-01", [2, 2, 2]), K, ["issue", "number"])
    close(column(out, "value"), [4, 6, 7, 8])


def test_splice_cumulative_single_observed_day_same_month(spark):
    out = ensemble.splice_cumulative(members(spark, "1997-09-02", [1, 2, 3], "1997-09-01"), observations(spark, "1997-09-01", [7]), K, ["issue", "number"])
    close(column(out, "value"), [1, 2, 3])


def test_splices_without_observations_change_nothing(spark):
    forecast, none = members(spark, "1997-09-02", [1, 2, 3, 4]), observations(spark, "1997-09-01", [1]).limit(0)
    close(column(ensemble.splice_cumulative(forecast, none, K, ["issue", "number"]), "value"), [1, 2, 3, 4])
    close(column(ensemble.splice_mean(forecast, none, K), "value"), [1, 2, 3, 4])


def test_splice_mean(spark):
    out = ensemble.splice_mean(members(spark, "1997-08-30", [1, 1, 1, 1]), observations(spark, "1997-08-31", [7]), K)
    close(column(out, "value"), [1, 7, 1, 1])


def test_splice_cumulative_keeps_later_increments(spark):
    values = [3, 4, 7, 7, 11, 12]
    out = column(ensemble.splice_cumulative(members(spark, "1997-08-30", values), observations(spark, "1997-09-01", [9, 9]), K, ["issue", "number"]), "value")
    assert [out[n + 1] - out[n] for n in (3, 4)] == [values[n + 1] - values[n] for n in (3, 4)]


def test_insert_only_merge(spark):
    stored, new = daily(spark, [1]), daily(spark, [9, 2])
    merged = align.insert_only_merge(stored, new, ["k", "d"])
    assert column(merged, "t") == [1.0, 2.0]
    assert column(align.insert_only_merge(merged, new, ["k", "d"]), "t") == [1.0, 2.0]
    assert column(align.insert_only_merge(daily(spark, [None]), daily(spark, [9]), ["k", "d"]), "t") == [None]
    assert column(align.rows_to_insert(stored, new, ["k", "d"]), "t") == [2.0]


def test_merge_no_conflict(spark):
    merged = align.merge_no_conflict([daily(spark, [1, None]), daily(spark, [5, 6], "2001-01-02")], ["k", "d"])
    assert column(merged, "t") == [1.0, 5.0, 6.0]
    with pytest.raises(Exception, match="conflicting values at a 2001-01-01"):
        align.merge_no_conflict([daily(spark, [1]), daily(spark, [2])], ["k", "d"]).collect()


def test_completeness(spark):
    rows = [("a", at(f"2001-01-01 {h:02d}:00"), 1.0) for h in range(23)] + [("a", at(f"2001-01-02 {h:02d}:00"), 2.0) for h in range(24)]
    out = agg.complete_days(spark.createDataFrame(rows, "k string, ts timestamp, t double"), K, "ts", "t").collect()
    assert [(r.d, r.t) for r in out] == [(day("2001-01-02"), 2.0)]


def test_accumulation_shift(spark):
    rows = spark.createDataFrame([("a", at("2001-11-01 00:00"), 4.0), ("a", at("2001-11-01 01:00"), 1.0)], "k string, ts timestamp, t double")
    out = {(r.y, r.m): r.value for r in agg.monthly_sum(rows, K, "ts", "t").collect()}
    assert out == {(2001, 10): 4.0, (2001, 11): 1.0}
    assert {r.m: r.value for r in agg.monthly_sum(rows, K, "ts", "t", [11]).collect()} == {11: 1.0}


def test_resample_daily_emits_empty_days(spark):
    rows = spark.createDataFrame([("a", at("2001-01-01 10:00"), 4.0), ("a", at("2001-01-01 11:00"), None), ("a", at("2001-01-04 01:00"), 1.0)], "k string, ts timestamp, t double")
    assert column(agg.resample_daily(rows, K, "ts", "t"), "t") == [4.0, None, None, 1.0]
    assert column(agg.resample_daily(rows, K, "ts", "t", how="sum"), "t") == [4.0, 0.0, 0.0, 1.0]


def test_regression_is_exact(spark):
    rows = [(float(a), float(b), float(c) * 1e6, 340 + 5.0 * a - 3.0 * b + 2e-6 * c * 1e6) for a, b, c in
            [(1, 2, 3), (2, 1, 5), (4, 0, 1), (3, 3, 3), (5, 1, 2), (0, 2, 9)]]
    table = spark.createDataFrame(rows, "a double, b double, c double, y double")
    fitted = model.fit_mlr(table, "y", ["a", "b", "c"])
    row = fitted.first()
    close([row.intercept, *row.coef], [340, 5, -3, 2e-6])
    new = spark.createDataFrame([(1.0, 1.0, 250000.0), (2.0, 0.5, 0.0)], "a double, b double, c double")
    out = model.predict(new, fitted, ["a", "b", "c"]).orderBy("a").collect()
    close([r.prediction for r in out], [342.5, 348.5])
    assert [r.fud for r in out] == [342, 348]


def test_regression_per_key_and_rank_deficient(spark):
    rows = [("p", float(n), 2.0 * n, 1 + 3.0 * n) for n in range(6)] + [("q", float(n), float(n * n), 2.0 - n) for n in range(6)]
    table = spark.createDataFrame(rows, "k string, a double, b double, y double")
    fitted = model.fit_mlr(table, "y", ["a", "b"], K)
    out = model.predict(table, fitted, ["a", "b"], K).collect()
    close([r.prediction for r in out], [r.y for r in out])


def test_member_fallback(spark):
    got = spark.createDataFrame([(1, n, "sf", float(n)) for n in (1, 2)], "s int, number int, variable string, value double")
    mean = spark.createDataFrame([(1, "sf", 1.5), (1, "tcc", 0.7)], "s int, variable string, value double")
    out = ensemble.member_fallback(got, mean, ["s"], ["sf", "tcc"]).orderBy("number").collect()
    assert [(r.number, r.sf, r.tcc) for r in out] == [(0, 1.5, 0.7), (1, 1.0, 0.7), (2, 2.0, 0.7)]


def test_frozen_latch(spark):
    assert [r.frozen_date for r in daily_plan.frozen_latch(daily(spark, [2, 0.5, 3, 0.4], "2001-12-01"), K).collect()] == [day("2001-12-02")]


def test_nearest_tie_takes_the_earlier_label(spark):
    data = daily(spark, [1, 0, 0, 0, 5], skip=(1, 2, 3))
    target = daily(spark, [0], "2001-01-03").select("k", "d")
    row = align.nearest_join(target, data, K, "d", "t").collect()[0]
    assert (row.label, row.nearest) == (day("2001-01-01"), 1.0)
    assert align.nearest_join(target, data, K, "d", "t", max_dist=1).collect()[0].nearest is None


def test_value_nearest_tie_takes_the_earlier_label(spark):
    data = daily(spark, [1, 0, 0, 0, 5], skip=(1, 2, 3))
    row = agg.value_nearest(data, K, "d", F.lit(day("2001-01-03")), "t").collect()[0]
    assert (row.label, row.value) == (day("2001-01-01"), 1.0)


def test_latest_of_feeds_prefers_the_first_feed_on_one_date(spark):
    schema = "k string, issued date, number int, fud int"
    weekly = spark.createDataFrame([("a", day("2001-10-01"), 0, 350), ("a", day("2001-10-08"), 0, 351), ("a", day("2001-10-08"), 1, 9)], schema)
    monthly = spark.createDataFrame([("a", day("2001-10-08"), 0, 360), ("b", day("2001-10-08"), 0, 361)], schema)
    out = align.latest_of_feeds([("weekly", weekly), ("monthly", monthly)], K).orderBy("k").collect()
    assert [(r.k, r.feed, r.fud) for r in out] == [("a", "weekly", 351), ("b", "monthly", 361)]


def test_prefer_source_and_required_labels(spark):
    a = spark.createDataFrame([(1, 10.0), (2, None)], "m int, value double")
    b = spark.createDataFrame([(1, 11.0), (2, 12.0), (3, 13.0)], "m int, value double")
    best = align.prefer_source([("analysis", a), ("forecast", b)], ["m"])
    assert {(r.m, r.value, r.source) for r in best.collect()} == {(1, 10.0, "analysis"), (2, 12.0, "forecast"), (3, 13.0, "forecast")}
    with pytest.raises(Exception, match="not found: 4"):
        align.require_labels(best, spark.createDataFrame([(1,), (4,)], "m int"), ["m"]).collect()


def test_dedupe_keeps_the_first_row_whole(spark):
    rows = spark.createDataFrame([("a", 1, 7, None), ("a", 1, 3, 5.0), ("a", 2, 1, None)], "k string, ts int, seq int, t double")
    out = quality.dedupe_keep_first(rows, ["k", "ts"], ["seq"]).orderBy("ts").collect()
    assert [(r.ts, r.seq, r.t) for r in out] == [(1, 3, 5.0), (2, 1, None)]


def test_own_day_deviation_is_one_sided(spark):
    rows = spark.createDataFrame([("a", at("2001-01-01 01:00"), 0.0), ("a", at("2001-01-01 02:00"), 10.0), ("a", at("2001-01-01 03:00"), -10.0)], "k string, ts timestamp, t double")
    assert column(quality.mask_own_day_deviation(rows, K, "ts", "t", 3.0), "t_kept", "ts") == [0.0, None, -10.0]
    assert column(quality.mask_own_day_deviation(rows, K, "ts", "t", 3.0, two_sided=True), "t_kept", "ts") == [0.0, None, None]


def test_spike_mask_loses_values_without_a_derivative(spark):
    assert column(quality.mask_spikes(daily(spark, [5.0]), K), "t_masked") == [None]


def test_jump_mask_keeps_values_without_a_derivative(spark):
    framed = quality.derivatives(daily(spark, [5.0]), K).withColumn("t_processed", F.col("t"))
    assert column(quality.mask_jumps(framed, K), "t_processed") == [5.0]


def test_winter_offset_first_and_last_winter(spark):
    # two calendar years at 1.0 in winter and 10.0 otherwise: the last December is not assigned
    days = spark.sql("SELECT 'a' AS k, explode(sequence(date'2001-01-01', date'2002-12-31')) AS d")
    series = days.withColumn("t_processed", F.when(F.month("d").isin(12, 1, 2, 3, 4), 1.0).otherwise(10.0))
    series = series.withColumn("dt", F.lit(0.0)).withColumn("d2t", F.lit(0.0))
    out = {r.d: r for r in seasons.winter_offset(series, K).collect()}
    assert out[day("2001-01-01")].t_winter_offset == 1.0
    assert out[day("2001-07-15")].t_winter_offset == 1.0      # interpolated between winters
    assert out[day("2001-07-15")].t_no_offset == 9.0
    assert out[day("2002-04-30")].t_winter_offset == 1.0
    assert out[day("2002-05-01")].t_winter_offset is None     # nothing beyond the last winter
    assert out[day("2002-12-15")].t_no_offset is None


def test_fill_with_climatology_prefers_stored_days(spark):
    series = daily(spark, [1, 2, None], "2001-01-01")
    out = seasons.fill_with_climatology(series, K, "2001-01-03", "2002-01-02")
    rows = {r.d: r.t for r in out.collect()}
    assert rows[day("2001-01-02")] == 2.0 and rows[day("2002-01-01")] == 1.0 and rows[day("2002-01-02")] == 2.0
    assert rows[day("2001-01-03")] is None


def test_pad_season(spark):
    out = seasons.season_matrix(daily(spark, [4, 5], "2000-07-01"), K).orderBy("pos").collect()
    assert [r.pos for r in out] == list(range(365))
    assert [r.t for r in out[:3]] == [4.0, 5.0, None]


def test_day_numbers_run_into_the_next_year(spark):
    assert one(spark, cal.doy_to_monthday(F.lit(366))) == "01-01"
    assert one(spark, cal.doy_to_monthday(F.lit(356), "MMM-dd")) == "Dec-22"


def test_common_period_reaches_one_label_further(spark):
    base = spark.createDataFrame([(y, float(y)) for y in range(1990, 2003)], "season int, x double")
    other = spark.createDataFrame([(y, y) for y in range(1995, 2001)], "season int, fudoy int")
    out = align.common_period(base, other, "season").orderBy("season").collect()
    assert [(r.season, r.fudoy) for r in out] == [(y, y) for y in range(1995, 2001)] + [(2001, None)]


def test_the_old_season_is_shown_until_the_eighth_of_july(spark):
    days = spark.sql("SELECT explode(array(date'2024-01-03', date'2024-06-30', date'2024-07-01', date'2024-07-07', date'2024-07-08', date'2024-12-31')) AS d")
    assert [r[0] for r in days.select(cal.published_season(F.col("d"))).collect()] == [2023, 2023, 2023, 2023, 2024, 2024]
