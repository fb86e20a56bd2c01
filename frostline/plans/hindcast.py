"""Replay of every issue date of the past as one distributed job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from frostline.operators import model
from frostline.plans import forecast as fc


def hindcast(issues: DataFrame, training: DataFrame, target: str, analysis_daily: DataFrame,
             forecast_daily: DataFrame) -> DataFrame:
    """Forecasts of all issues: (issued, feed, number, prediction, fud, season, fud_date).

    In-sample like the operational replay: the model is fitted on the whole training table.
    """
    rules = fc.source_rules(issues)
    inputs = fc.forecast_input(rules, analysis_daily, forecast_daily)
    return fc.run_forecast(inputs, model.fit_mlr(training, target, fc.NAMES))
