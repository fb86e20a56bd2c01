"""How the ordered operators scale: many series, and one series holding all rows.

    python bench_scale.py [keys] [copies]

Both inputs are copies of the given tables under new keys or shifted stamps. Prints one JSON
line per measurement.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main(argv: list[str]) -> None:
    from pyspark.sql import functions as F

    from frostline.operators import ordered
    from frostline.plans import yearly
    from frostline.registry import inputs as i
    from frostline.registry.series import RULES
    from frostline.session import build_session, materialise

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    keys, copies = int(argv[0]) if argv else 10_000, int(argv[1]) if len(argv) > 1 else 50

    def timed(df) -> float:
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 2)

    def session(cpus: int):
        spark = build_session("frostline-scale", f"local[{cpus}]", spark__sql__shuffle__partitions="64",
                              spark__ui__enabled="false", spark__driver__memory="16g")
        spark.sparkContext.setLogLevel("ERROR")
        return spark

    spark = session(8)
    base = i.calendar_daily(spark, sf_dir)
    many = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(keys // 5)))).select(
        F.concat_ws("#", "k", F.col("n").cast("string")).alias("k"), "d", "t")
    path = materialise(many.repartition(64), "many").inputFiles()[0].rsplit("/", 1)[0]
    stamps = i.obs(spark, sf_dir).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = stamps.select(F.lit("hot").alias("k"), F.timestamp_micros(F.unix_micros("ts") * copies + F.col("n")).alias("ts"),
                        F.when(F.col("t") < 60, F.col("t")).alias("t"))
    hot_path = materialise(hot.repartition(64), "hot").inputFiles()[0].rsplit("/", 1)[0]
    spark.stop()

    for cpus in [int(c) for c in os.environ.get("BENCH_CPU_STEPS", "2,4,8").split(",")]:
        spark = session(cpus)
        series = spark.read.parquet(path)
        timed(yearly.observed_freeze_up(yearly.processed_series(series.where("k like '%#1'"), ["k"], RULES), ["k"], rules=RULES))
        seconds = timed(yearly.observed_freeze_up(yearly.processed_series(series, ["k"], RULES), ["k"], rules=RULES))
        print(json.dumps({"case": "yearly chain, many series", "series": keys, "rows": series.count(), "cpus": cpus, "seconds": seconds}), flush=True)
        spark.stop()

    spark = session(8)
    rows = spark.read.parquet(hot_path)
    for block in ("day", None):
        began = time.perf_counter()
        timed(ordered.interpolate_series(rows, ["k"], "ts", block=block))
        print(json.dumps({"case": "interpolate, one series", "rows": rows.count(), "block": block, "cpus": 8,
                          "seconds": round(time.perf_counter() - began, 2)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
