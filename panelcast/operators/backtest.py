"""Hold-out comparison of the monthly models, each at its own grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.metrics import evaluate, temporal_split
from panelcast.operators import naive, pooled, quantile_trees, seasonal, window_ar, window_net
from panelcast.operators.features_monthly import SERIES, TARGET

ALL_MODELS = ("naive", "pooled", "trees", "seasonal", "window", "network")
#: Those that the monthly flow compares by default; the forests and the network take some minutes more.
FLOW_MODELS = ("naive", "pooled", "seasonal", "window")


def score(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], model: str, grain: str) -> DataFrame:
    joined = actual.select(*keys, "date", TARGET).join(forecast.select(*keys, "date", "yhat"), [*keys, "date"])
    return evaluate(joined, TARGET, "yhat").select(
        F.lit(model).alias("model"), F.lit(grain).alias("grain"), "mae", "rmse", "mape").where(F.col("mae").isNotNull())


def backtest(features: DataFrame, horizon: int, models: Sequence[str] = ALL_MODELS) -> DataFrame:
    """One row of metrics per model. Naive (the month a year before), pooled, tree, window and network models are scored at trust x code, the
    seasonal one at national x code, as their forecasts are made there."""
    train, test = temporal_split(features, "date", horizon)
    rows = []
    if "naive" in models:
        fc = naive.seasonal_naive_forecast(train.select(*SERIES, "date", TARGET), SERIES, TARGET, horizon)
        rows.append(score(fc, test, SERIES, "naive", "trust"))
    if "pooled" in models:
        fc = pooled.recursive_forecast(train, pooled.train(train), horizon)
        rows.append(score(fc, test, SERIES, "pooled", "trust"))
    if "trees" in models:
        fc = quantile_trees.recursive_forecast(train, quantile_trees.train(train), horizon)
        rows.append(score(fc, test, SERIES, "trees", "trust"))
    if "seasonal" in models:
        code = ["procedure_code"]
        national = lambda df: df.groupBy(*code, "date").agg(F.sum(TARGET).alias(TARGET))
        fc = seasonal.forecast(national(train), horizon, code, target=TARGET).where(F.col("error").isNull())
        rows.append(score(fc, national(test), code, "seasonal", "national"))
    if "window" in models:
        rows.append(score(window_ar.forecast(train, horizon, SERIES, TARGET), test, SERIES, "window", "trust"))
    if "network" in models:
        rows.append(score(window_net.forecast(train, horizon, SERIES, TARGET), test, SERIES, "network", "trust"))
    return reduce(DataFrame.unionByName, rows)
