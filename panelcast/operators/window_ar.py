"""Pooled window forecaster: one linear map from the last 12 standardised values to the next one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import Z80_WINDOW
from panelcast.functions.folds import bind, dot, literals, tail


@dataclass(frozen=True)
class WindowModel:
    intercept: float
    weights: tuple[float, ...]

    def next_value(self, window: Column) -> Column:
        return dot(window, literals(self.weights)) + self.intercept


def standardise(
    df: DataFrame, keys: Sequence[str], target: str, lookback: int = 12, date: str = "date"
) -> DataFrame:
    """Per-series z-score; series shorter than lookback + 6 are left out."""
    stats = df.groupBy(*keys).agg(
        F.avg(target).alias("mu"), (F.stddev_pop(target) + 1e-6).alias("sd"), F.count("*").alias("n"))
    return df.select(*keys, date, target).join(
        stats.where(F.col("n") >= lookback + 6).drop("n"), list(keys)).withColumn(
            "z", (F.col(target) - F.col("mu")) / F.col("sd"))


def windows(df: DataFrame, keys: Sequence[str], value: str, lookback: int = 12, date: str = "date") -> DataFrame:
    """Each row with the ``lookback`` values before it, where that many exist."""
    before = Window.partitionBy(*keys).orderBy(date).rowsBetween(-lookback, -1)
    return df.withColumn("window", F.collect_list(value).over(before)).where(F.size("window") == lookback)


def fit(z: DataFrame, keys: Sequence[str], lookback: int = 12) -> WindowModel:
    rows = windows(z, keys, "z", lookback).select(array_to_vector("window").alias("features"), F.col("z").alias("label"))
    model = LinearRegression(solver="normal", regParam=1e-6).fit(rows)
    return WindowModel(float(model.intercept), tuple(float(w) for w in model.coefficients))


def decode(z: DataFrame, model, keys: Sequence[str], horizon: int, lookback: int = 12) -> DataFrame:
    """Recursive prediction as a fold inside each series' row, back on the original scale.

    `model` has `next_value`, a column of the next value from the column of a window.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"))
    recent = z.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= lookback)
    state = recent.groupBy(*keys).agg(
        F.max("date").alias("last_date"), F.first("mu").alias("mu"), F.first("sd").alias("sd"),
        F.transform(F.array_sort(F.collect_list(F.struct("date", "z"))), lambda s: s["z"]).alias("history"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), F.col("history"),
        lambda acc, _: F.concat(acc, F.array(bind(tail(acc, lookback), model.next_value))))
    steps = state.select(*keys, "last_date", "mu", "sd", F.posexplode(tail(walked, horizon)).alias("pos", "p"))
    yhat = F.greatest(F.col("p") * F.col("sd") + F.col("mu"), F.lit(0.0))
    half = F.col("sd") * Z80_WINDOW
    return steps.select(
        *keys, F.add_months(F.trunc("last_date", "month"), F.col("pos") + 1).alias("date"),
        yhat.alias("yhat"), F.greatest(yhat - half, F.lit(0.0)).alias("yhat_lower"),
        (yhat + half).alias("yhat_upper"))


def forecast(
    df: DataFrame, horizon: int, keys: Sequence[str] = ("trust_code", "procedure_code"),
    target: str = "n_procedures", lookback: int = 12,
) -> DataFrame:
    z = standardise(df, keys, target, lookback)
    return decode(z, fit(z, keys, lookback), keys, horizon, lookback)
