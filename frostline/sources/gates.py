"""Gates between the steps of a run, measured while a step's table is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS = T.StructType([T.StructField("stage", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("last_d", T.DateType()),
                       T.StructField("refused", T.LongType()), T.StructField("ok", T.BooleanType())])


def write_observed(df: DataFrame, path: str, status_path: str, stage: str, day: Column, refused: Column | None = None, min_rows: int = 1,
                   fresh_after: str | None = None, max_refused: int | None = None) -> bool:
    """Write a table and, from metrics of the very job that writes it, the row of its gate; True if the next step may run.

    Rows that meet ``refused`` are counted and not written. The gate opens if at least ``min_rows`` were written, the newest
    day is ``fresh_after`` or later and no more than ``max_refused`` were refused. The status of a stage is a folder of its own, so
    a repeated run replaces it. Nothing is read twice: the metrics travel with the tasks' results.
    """
    spark, seen = df.sparkSession, Observation()
    bad = F.coalesce(refused, F.lit(False)) if refused is not None else F.lit(False)
    marked = df.withColumn("_refused", bad).observe(
        seen, F.count_if(~F.col("_refused")).alias("n_rows"), F.max(F.when(~F.col("_refused"), day)).alias("last_d"), F.count_if("_refused").alias("refused"))
    marked.where(~F.col("_refused")).drop("_refused").write.mode("overwrite").parquet(path)
    got = seen.get
    ok = got["n_rows"] >= min_rows and (max_refused is None or got["refused"] <= max_refused)
    if fresh_after is not None:
        ok = ok and got["last_d"] is not None and str(got["last_d"]) >= fresh_after
    row = spark.createDataFrame([(stage, got["n_rows"], got["last_d"], got["refused"], bool(ok))], STATUS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{status_path}/run={stage}")
    return bool(ok)


def run_status(spark: SparkSession, status_path: str) -> DataFrame:
    """The newest gate of every stage."""
    return spark.read.schema(STATUS).parquet(status_path).select(*STATUS.fieldNames())
