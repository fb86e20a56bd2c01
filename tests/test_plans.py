"""Shape of the physical plans: shuffles, pushed filters, no pair joins, no stray Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from frostline.operators import ordered, quality
from frostline.plans import yearly
from frostline.registry import QUERIES
from frostline.registry import inputs as i
from frostline.registry.series import RULES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "Exchange rangepartitioning")
SOLVERS = {"mlr_fit", "mlr_fit_keyed", "mlr_predict_ensemble", "hindcast", "forecast_log", "grid_hindcast"}
# These write files or run streams when they are built; what is left to plan is only a read.
EAGER = {"stream_daily_mean", "frozen_latch_stream", "forecast_log", "scan_grid", "sensor_log", "synthetic_time",
         "clean_samples", "daily_ingest", "hindcast", "forecast_input"}


# Their staged plans may hold Python that writes or reads files, or sort to give lines an order.
WRITERS = {"stream_closed_days", "synthetic_time"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_partitions_follow_aggregates(plan):
    # one partition ever only holds finished partial aggregates
    lines = plan.splitlines()
    for n, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[n + 1], plan


STAGED = sorted(EAGER | {"grid_forecast_input", "grid_hindcast", "region_months", "raw_constant_runs", "raw_slice", "climatology_batches", "latest_json", "stored_predictors"})


@pytest.mark.parametrize("name", STAGED)
def test_every_staged_plan_is_free_of_pair_joins(spark, sf_dir, name, monkeypatch):
    """Plans of the tables a query writes on its way, taken when they are written."""
    plans, write = [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        if not self._df.isStreaming:
            plans.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    plans.append(plan_of(QUERIES[name](spark, sf_dir)))
    assert len(plans) > 1 or name in ("sensor_log", "synthetic_time", "frozen_latch_stream", "stream_daily_mean")
    for plan in plans:
        assert not any(word in plan for word in FORBIDDEN[:3]), plan
        if name not in WRITERS:
            assert not any(word in plan for word in FORBIDDEN[3:]), plan
        single_partitions_follow_aggregates(plan)


def test_predictors_open_their_own_months(spark, sf_dir, tmp_path):
    from frostline.registry import grids
    from frostline.sources import grid

    grid.write_grid(grids.analysis_cells(spark, sf_dir), str(tmp_path / "g"))
    plan = plan_of(yearly.stored_predictors(spark, str(tmp_path / "g")))
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(scans) == 3
    for variable, months in (("t2m", "12"), ("sf", "11"), ("tcc", "9")):
        own = [s for s in scans if f"= {variable})" in s]
        assert len(own) == 1 and re.search(rf"month#\d+ (IN \(|= ){months}", own[0]), own


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pair_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in FORBIDDEN:
        assert word not in plan
    if name not in SOLVERS:
        assert "EvalPython" not in plan
    single_partitions_follow_aggregates(plan)


def test_the_whole_yearly_chain_has_two_exchanges(spark, sf_dir):
    plan = plan_of(QUERIES["observed_freeze_up"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 2  # (series, day) for the means, series for all windows


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["subset_request"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^\]]*l_suppkey[^\]]*", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"}
    plan = plan_of(yearly.processed_series(i.calendar_daily(spark, sf_dir), ["k"], RULES))
    assert plan.count("FileScan") == 1


def test_raw_windows_are_partitioned_by_key_and_block(spark, sf_dir):
    plan = plan_of(ordered.differentiate_series(i.obs(spark, sf_dir).select("k", "ts", "t"), ["k"], "ts", unit="hour", block="hour"))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert windows and all("_block" in w for w in windows)


def test_small_block_tables_are_broadcast_without_shuffling_samples(spark, sf_dir):
    plan = plan_of(quality.mask_own_day_deviation(i.obs(spark, sf_dir), ["k"], "ts", "t", 30.0))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_large_block_tables_are_not_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = quality.mask_own_day_deviation(i.obs(spark, sf_dir), ["k"], "ts", "t", 30.0)
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        shuffled = df.where(F.col("t_kept").isNotNull()).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == quality.mask_own_day_deviation(i.obs(spark, sf_dir), ["k"], "ts", "t", 30.0).where(F.col("t_kept").isNotNull()).count()
