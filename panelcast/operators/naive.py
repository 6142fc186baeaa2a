"""Seasonal-naive forecasts, and the constant tags every forecast carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import Z80
from panelcast.functions.panel import densify_months, scalar, series_window


def tag(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def weekly_naive(lag7: str = "n_billable_lag7", mean7: str = "n_billable_rollmean7") -> Column:
    """Same weekday last week, else the trailing week's mean."""
    return F.coalesce(F.col(lag7).cast("double"), F.col(mean7))


def seasonal_naive_holdout(
    facts: DataFrame, keys: Sequence[str], target: str, horizon: int = 12, season: int = 12, z: float = Z80
) -> DataFrame:
    """Value one season earlier for the last ``horizon`` months of the densified panel, with actuals."""
    panel = densify_months(facts, keys, target)
    w = series_window(keys, ["date"])
    spread = z * F.stddev_samp(target).over(Window.partitionBy(*keys))
    from_month = F.add_months(scalar(facts, F.max("date")), 1 - horizon)
    point = F.lag(target, season).over(w).cast("double")
    return panel.select(
        *keys, "date", F.col(target).alias("actual"), point.alias("yhat"),
        F.greatest(point - spread, F.lit(0.0)).alias("yhat_lower"), (point + spread).alias("yhat_upper"),
    ).where((F.col("date") >= from_month) & F.col("yhat").isNotNull())


def seasonal_naive_forecast(
    facts: DataFrame, keys: Sequence[str], target: str, horizon: int = 12, season: int = 12, z: float = Z80
) -> DataFrame:
    """The last observed season repeated over the coming ``horizon`` months, for every series."""
    last = scalar(facts, F.max("date"))
    panel = densify_months(facts, keys, target)
    sigma = F.stddev_samp(target).over(Window.partitionBy(*keys))
    recent = panel.select(*keys, "date", target, sigma.alias("sigma")).where(
        F.col("date") > F.add_months(last, -season))
    cycles = (horizon + season - 1) // season
    ahead = recent.withColumn("cycle", F.explode(F.sequence(F.lit(1), F.lit(cycles)))).withColumn(
        "date", F.add_months("date", F.col("cycle") * season)).where(F.col("date") <= F.add_months(last, horizon))
    point = F.col(target).cast("double")
    return ahead.select(
        *keys, "date", point.alias("yhat"),
        F.greatest(point - z * F.col("sigma"), F.lit(0.0)).alias("yhat_lower"),
        (point + z * F.col("sigma")).alias("yhat_upper"))
