"""Standard series derived from the tables, once as DataFrames and once as SQL.

``daily`` is a daily series per order priority, ``obs`` a high-rate series per event type,
``lineitem`` plays the gridded ensemble. Divisors are uneven so that values stay off the
rounding grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.operators import aggregate as agg

DAILY_DIVISOR = 20011
OBS_DIVISOR = 1.0009


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").alias("ts"),
        (F.col("o_totalprice") / DAILY_DIVISOR).alias("v"), "o_orderkey",
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, d, t for the days that have orders."""
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("d")
    ).agg((F.avg("o_totalprice") / DAILY_DIVISOR).alias("t"))


def daily_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like daily, with a maximum instead of a mean: the same bits however often it is computed."""
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("d")
    ).agg((F.max("o_totalprice") / DAILY_DIVISOR).alias("t"))


def calendar_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily on the full calendar, empty days missing."""
    return agg.fill_calendar(daily(spark, sf_dir), ["k"])


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("k"), F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") / OBS_DIVISOR).alias("t"), "props",
    )


def grid_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily ensemble: variable, number, d, value."""
    day = F.col("l_shipdate").cast("date").alias("d")
    folded = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("number"), day).agg(*_variables())
    return _unpivot(folded, ["number", "d"])


def analysis_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily analysis, the mean over everything: variable, d, value."""
    folded = table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(*_variables())
    return _unpivot(folded, ["d"])


def _variables():
    return (
        F.avg("l_quantity").alias("t2m"),
        (F.avg("l_extendedprice") / 1009).alias("sf"),
        (F.avg("l_discount") * 101).alias("tcc"),
    )


def _unpivot(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.unpivot(keys, ["t2m", "sf", "tcc"], "variable", "value")


# --- the same inputs in SQL ------------------------------------------------------------

CTES: dict[str, str] = {
    "daily": f"""SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d,
        avg(o_totalprice) / {DAILY_DIVISOR} AS t FROM orders GROUP BY 1, 2""",
    "daily_exact": f"""SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d,
        max(o_totalprice) / {DAILY_DIVISOR} AS t FROM orders GROUP BY 1, 2""",
    "bounds": "SELECT k, min(d) AS lo, max(d) AS hi FROM daily GROUP BY k",
    "days": "SELECT k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds",
    "full_daily": "SELECT k, d, t FROM days LEFT JOIN daily USING (k, d)",
    "obs": f"""SELECT event_id, user_id, event_type AS k, ts, value / {OBS_DIVISOR} AS t, props,
        epoch_us(ts) AS us FROM events""",
    "grid_wide": """SELECT l_linenumber AS number, CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS t2m,
        avg(l_extendedprice) / 1009 AS sf, avg(l_discount) * 101 AS tcc FROM lineitem GROUP BY 1, 2""",
    "analysis_wide": """SELECT CAST(l_shipdate AS DATE) AS d, avg(l_quantity) AS t2m,
        avg(l_extendedprice) / 1009 AS sf, avg(l_discount) * 101 AS tcc FROM lineitem GROUP BY 1""",
    "grid_daily": "SELECT number, d, variable, value FROM (UNPIVOT grid_wide ON t2m, sf, tcc INTO NAME variable VALUE value)",
    "analysis_daily": "SELECT d, variable, value FROM (UNPIVOT analysis_wide ON t2m, sf, tcc INTO NAME variable VALUE value)",
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """WITH clause of the named inputs and further steps, then the body."""
    parts = [f"{n} AS ({CTES[n]})" for n in names.split()] + [f"{n} AS ({s})" for n, s in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


FULL = "daily bounds days full_daily"


def rnd(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def sql_derivative(source: str, y: str, pos: str, unit: float, out: str, part: str = "k") -> str:
    """SELECT adding the uneven central difference of y over pos / unit."""
    w = f"(PARTITION BY {part} ORDER BY {pos})"
    return f"""SELECT * EXCLUDE (_yp, _yn, _hs, _hd), CASE
        WHEN _hs IS NULL THEN (_yn - {y}) / _hd
        WHEN _hd IS NULL THEN ({y} - _yp) / _hs
        ELSE (_hs * _hs * _yn + (_hd * _hd - _hs * _hs) * {y} - _hd * _hd * _yp) / (_hs * _hd * (_hd + _hs))
        END AS {out}
      FROM (SELECT *, lag({y}) OVER {w} AS _yp, lead({y}) OVER {w} AS _yn,
              ({pos} - lag({pos}) OVER {w}) / CAST({unit} AS DOUBLE) AS _hs,
              (lead({pos}) OVER {w} - {pos}) / CAST({unit} AS DOUBLE) AS _hd FROM {source})"""


def sql_interpolate(source: str, y: str, pos: str, out: str, max_gap: int | None = None, part: str = "k") -> str:
    """SELECT adding linear interpolation of y over pos."""
    fwd = f"(PARTITION BY {part} ORDER BY {pos} ROWS UNBOUNDED PRECEDING)"
    bwd = f"(PARTITION BY {part} ORDER BY {pos} DESC ROWS UNBOUNDED PRECEDING)"
    seen = f"CASE WHEN {y} IS NOT NULL THEN {pos} END"
    gap = "" if max_gap is None else f" AND _p1 - _p0 <= {max_gap}"
    return f"""SELECT * EXCLUDE (_p0, _p1, _v0, _v1), CASE WHEN {y} IS NOT NULL THEN {y}
        WHEN _p1 > _p0{gap} THEN _v0 + (_v1 - _v0) * ({pos} - _p0) / (_p1 - _p0) END AS {out}
      FROM (SELECT *, last_value({seen} IGNORE NULLS) OVER {fwd} AS _p0, last_value({y} IGNORE NULLS) OVER {fwd} AS _v0,
              last_value({seen} IGNORE NULLS) OVER {bwd} AS _p1, last_value({y} IGNORE NULLS) OVER {bwd} AS _v1
            FROM {source})"""
