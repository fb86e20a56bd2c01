"""Multiple linear regression from distributed moments.

The data is reduced to means and covariances in one aggregate; only those few numbers per
model reach the small solver, so neither the driver nor a task sees training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.functions import values as val
from frostline.functions.joins import join_null_safe


def regression_moments(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Count, means, predictor covariances (row by row) and covariances with the target."""
    clean = df.dropna(subset=[y, *xs])
    return clean.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("y_mean"),
        F.array(*[F.avg(x) for x in xs]).alias("x_mean"),
        F.array(*[F.covar_pop(a, b) for a in xs for b in xs]).alias("sxx"),
        F.array(*[F.covar_pop(x, y) for x in xs]).alias("sxy"),
    )


def _solver():
    """Least-squares coefficients of each model from its covariances.

    Predictors are scaled to unit variance first: their magnitudes differ by many orders.
    Nested so that it travels to the executors by value.
    """

    def solve(sxx: pd.Series, sxy: pd.Series) -> pd.Series:
        solved = []
        for a, b in zip(sxx, sxy):
            b = np.asarray(b, dtype=float)
            a = np.asarray(a, dtype=float).reshape(b.size, b.size)
            scale = np.sqrt(np.diag(a))
            scale = np.where(scale > 0, scale, 1.0)
            correlation = a / np.outer(scale, scale)
            solved.append(np.linalg.lstsq(correlation, b / scale, rcond=1e-12)[0] / scale)
        return pd.Series(solved)

    return F.pandas_udf(solve, T.ArrayType(T.DoubleType()))


def fit_mlr(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key with n, intercept and coef (in the order of ``xs``)."""
    moments = regression_moments(df, y, xs, keys).withColumn("coef", _solver()("sxx", "sxy"))
    shift = F.aggregate(F.zip_with("coef", "x_mean", lambda c, m: c * m), F.lit(0.0), lambda s, x: s + x)
    return moments.select(*keys, "n", (F.col("y_mean") - shift).alias("intercept"), "coef")


def _linear(intercept: Column, coef: Column, xs: Sequence[str]) -> Column:
    total = intercept
    for i, x in enumerate(xs):
        total = total + coef[i] * F.col(x)
    return total


def predict(rows: DataFrame, model: DataFrame, xs: Sequence[str], keys: Sequence[str] = (),
            out: str = "prediction") -> DataFrame:
    """Apply a model to predictor rows; adds the value and its rounding to a whole day."""
    packed = F.struct("intercept", "coef").alias("_model")
    if keys:
        framed = join_null_safe(rows, model.select(*keys, packed), list(keys), "left")
    else:
        framed = rows.withColumn("_model", model.select(packed).scalar())
    framed = framed.withColumn(out, _linear(F.col("_model.intercept"), F.col("_model.coef"), xs)).drop("_model")
    return framed.withColumn("fud", val.round_half_even(F.col(out)))
