"""Registered raw queries on rows whose stamps repeat within a series, next to their SQL."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from frostline.registry import ORACLES, QUERIES

START = dt.datetime(2024, 1, 9, 20)


@pytest.fixture(scope="module")
def copied(spark, tmp_path_factory):
    """A table repeated with shifted keys: three events at every stamp, of which some lie outside the slice and some above its bound."""
    rows = [(n + 1000 * copy, START + dt.timedelta(minutes=13 * n), n % 3, ("a", "b")[n % 7 == 0], float(10 + (37 * n) % 61) if n % 11 else 200.0, "{}")
            for n in range(400) for copy in range(3)]
    folder = tmp_path_factory.mktemp("copied")
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def check(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    found = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    plain = lambda rows: sorted([repr(None if v is None or math.isnan(v) else float(v)) for v in r] for r in rows)
    theirs = result.fetchall()
    assert plain(found.select(*names).collect()) == plain(theirs) and len(theirs) > 0


def test_raw_differentiate(spark, copied):
    check(spark, copied, "raw_differentiate")


def test_raw_constant_runs(spark, copied):
    check(spark, copied, "raw_constant_runs")


def test_raw_spike_mask(spark, copied):
    check(spark, copied, "raw_spike_mask")


def test_raw_slice(spark, copied):
    """Each event of the slice once, however many share its stamp."""
    check(spark, copied, "raw_slice")
