"""Forecast accuracy as aggregate expressions, and the temporal split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.panel import scalar


def mae(y: str, f: str) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(f)))


def rmse(y: str, f: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(f), 2)))


def mape(y: str, f: str, floor: float = 1.0) -> Column:
    """Percentage error with a floor under the denominator."""
    return F.avg(F.abs(F.col(y) - F.col(f)) / F.greatest(F.abs(y), F.lit(floor))) * 100


def pinball(y: str, f: str, q: float) -> Column:
    d = F.col(y) - F.col(f)
    return F.avg(F.greatest(q * d, (q - 1) * d))


def coverage(y: str, low: str, high: str) -> Column:
    inside = (F.col(y) >= F.col(low)) & (F.col(y) <= F.col(high))
    return F.avg(F.when(inside, 1.0).otherwise(0.0))


def evaluate(df: DataFrame, y: str, f: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(mae(y, f).alias("mae"), rmse(y, f).alias("rmse"), mape(y, f).alias("mape"))


def cutoff_date(df: DataFrame, horizon: int, date: str = "date") -> Column:
    """The ``horizon``-th largest distinct date, as a scalar subquery; fails when there are fewer."""
    newest = df.select(F.col(date).alias("d")).where(F.col("d").isNotNull()).distinct().orderBy(
        F.desc("d")).limit(horizon)
    enough = F.when(F.count("*") == horizon, F.min("d"))
    return scalar(newest, F.coalesce(
        enough, F.raise_error(F.lit(f"fewer than {horizon} distinct dates")).cast("date")))


def temporal_split(df: DataFrame, date: str, horizon: int) -> tuple[DataFrame, DataFrame]:
    """Train before the cutoff, test from it on."""
    cutoff = cutoff_date(df, horizon, date)
    return df.where(F.col(date) < cutoff), df.where(F.col(date) >= cutoff)
