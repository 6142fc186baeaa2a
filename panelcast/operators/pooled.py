"""Pooled quantile forecaster for monthly series with recursive multi-step prediction.

One linear model per quantile is shared by all series. Values are divided by the series' trailing
level, which puts small and large series on one scale, and the loss is weighted back to units.
Quantiles are fitted by the majorise-minimise scheme of Hunter and Lange (2000): each pass is one
Spark job of weighted normal equations for all quantiles together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import MONTHLY_LAGS, MONTHLY_WINDOWS
from panelcast.functions.folds import bind, deviation_of, dot, literals, matrix, mean_of, solve_scaled, summed, tail, vector
from panelcast.functions.panel import scalar
from panelcast.operators.features_monthly import SERIES, TARGET
from panelcast.sources.storage import iteration_input

QUANTILES = {"yhat_lower": 0.1, "yhat": 0.5, "yhat_upper": 0.9}
DRIVERS = ("proc_mix_share", "wl_size", "wl_pct_18wk", "pop_65plus_share")
LOOKBACK = max(*MONTHLY_LAGS, *MONTHLY_WINDOWS)


@dataclass(frozen=True)
class PooledModel:
    """Coefficients per quantile, and the driver means that stand in for missing values."""
    coefficients: tuple[tuple[float, ...], ...]
    driver_means: tuple[float, ...]
    first_year: int
    kind: str = "pooled"


def training_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col(TARGET).isNotNull() & F.col(f"{TARGET}_lag{max(MONTHLY_LAGS)}").isNotNull())


def ar_features(history: Column) -> dict[str, Column]:
    """Autoregressive inputs at the end of a value array: a lag beyond it is NULL, statistics use
    what is there, the deviation of fewer than two values is 0."""
    out = {f"{TARGET}_lag{k}": F.try_element_at(history, F.lit(-k)) for k in MONTHLY_LAGS}
    for w in MONTHLY_WINDOWS:
        out[f"{TARGET}_rollmean{w}"] = mean_of(tail(history, w))
        out[f"{TARGET}_rollstd{w}"] = deviation_of(tail(history, w))
    return out


def monotone(low: Column, mid: Column, high: Column) -> Column:
    """Clip at zero and order the three values."""
    zero = F.lit(0.0)
    return F.array_sort(F.array(F.greatest(low, zero), F.greatest(mid, zero), F.greatest(high, zero)))


def _inputs(
    level: Column, ar: dict[str, Column], month: Column, time_idx: Column, drivers: dict[str, Column],
    driver_means: Sequence[float],
) -> Column:
    """The model's input array. AR inputs are relative to the level; a missing driver takes its mean
    and raises an indicator."""
    one = F.lit(1.0)
    cells = [one, time_idx / F.lit(120.0)]
    cells += [F.when(month == m, 1.0).otherwise(0.0) for m in range(2, 13)]
    cells += [F.coalesce(F.try_divide(ar[f"{TARGET}_lag{k}"], level), one) for k in MONTHLY_LAGS]
    for w in MONTHLY_WINDOWS:
        if w != max(MONTHLY_WINDOWS):
            cells.append(F.coalesce(F.try_divide(ar[f"{TARGET}_rollmean{w}"], level), one))
        cells.append(F.coalesce(F.try_divide(ar[f"{TARGET}_rollstd{w}"], level), F.lit(0.0)))
    for name, mean in zip(DRIVERS, driver_means):
        usual = mean if abs(mean) > 1e-12 else 1.0
        cells.append(F.coalesce(drivers[name] / F.lit(usual), one))
        cells.append(F.when(drivers[name].isNull(), 1.0).otherwise(0.0))
    return F.array(*cells)


def _level(ar: dict[str, Column]) -> Column:
    return F.greatest(ar[f"{TARGET}_rollmean{max(MONTHLY_WINDOWS)}"], F.lit(1.0))


def _training_drivers() -> dict[str, Column]:
    """Drivers as known before the month: lagged pressure, lagged mix, yearly share."""
    return {
        "proc_mix_share": F.col("proc_mix_share_lag1"),
        "wl_size": F.col("wl_size_lag1").cast("double"),
        "wl_pct_18wk": F.col("wl_pct_18wk_lag1"),
        "pop_65plus_share": F.col("pop_65plus_share"),
    }


def train(features: DataFrame, max_iter: int = 200, tol: float = 2e-4) -> PooledModel:
    known = training_rows(features)
    if "proc_mix_share_lag1" not in features.columns:
        known = known.withColumn("proc_mix_share_lag1", F.col("proc_mix_share"))
    drivers = _training_drivers()
    facts = known.agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(n) for n, c in drivers.items()],
        F.coalesce(F.min(F.year("date") - F.floor(F.col("time_idx") / 12)), F.lit(0)).alias("first_year")).first()
    means = tuple(float(facts[n]) for n in DRIVERS)
    ar = {c: F.col(c) for c in known.columns if c.startswith(f"{TARGET}_")}
    level = _level(ar)
    rows = iteration_input(known.select(
        _inputs(level, ar, F.month("date"), F.col("time_idx").cast("double"), drivers, means).alias("x"),
        (F.col(TARGET) / level).alias("y"), level.alias("weight")), "pooled-train")
    try:
        betas = _fit_quantiles(rows, list(QUANTILES.values()), max_iter, tol)
    finally:
        rows.unpersist()
    return PooledModel(tuple(tuple(float(b) for b in beta) for beta in betas), means, int(facts["first_year"]))


def _least_squares(rows: DataFrame) -> np.ndarray:
    def fold(batch) -> np.ndarray:
        x, y, s = matrix(batch, "x"), vector(batch, "y"), vector(batch, "weight")
        wx = x * s[:, None]
        return np.concatenate([(x.T @ wx).ravel(), wx.T @ y])

    flat = summed(rows, fold)
    if not len(flat):
        raise ArithmeticError("no rows to fit")
    p = int((np.sqrt(4 * len(flat) + 1) - 1) / 2)
    return solve_scaled(flat[: p * p].reshape(p, p), flat[p * p:])


def _fit_quantiles(rows: DataFrame, levels: Sequence[float], max_iter: int, tol: float) -> list[np.ndarray]:
    """Coefficients per level, all levels advanced by the same pass over the data.

    The start is least squares with its intercept (the first input) moved to the quantiles of the
    residuals, which leaves the passes only the slopes to adjust. Raises ``ArithmeticError`` if the loss has not
    settled after ``max_iter`` passes.
    """
    centre = _least_squares(rows)
    p = len(centre)
    residual = F.col("y") - dot(F.col("x"), literals(centre))
    shifts = rows.agg(F.percentile_approx(residual, list(levels), 10_000).alias("q")).first().q
    betas = [centre + shift * (np.arange(p) == 0) for shift in shifts]
    previous: float | None = None
    for _ in range(max_iter):
        current = betas

        def fold(batch) -> np.ndarray:
            x, y, s = matrix(batch, "x"), vector(batch, "y"), vector(batch, "weight")
            pull = x.T @ s
            parts = []
            for q, beta in zip(levels, current):
                r = y - x @ beta
                w = s / (1e-4 + np.abs(r))
                wx = x * w[:, None]
                loss = (s * np.maximum(q * r, (q - 1) * r)).sum()
                parts += [(x.T @ wx).ravel(), wx.T @ y + (2 * q - 1) * pull, [loss]]
            return np.concatenate(parts)

        blocks = summed(rows, fold).reshape(len(levels), -1)
        loss = float(blocks[:, -1].sum())
        if previous is not None and abs(previous - loss) <= tol * previous:
            return betas
        previous = loss
        betas = [solve_scaled(b[: p * p].reshape(p, p), b[p * p: p * p + p]) for b in blocks]
    raise ArithmeticError(f"no convergence after {max_iter} passes")


def series_state(features: DataFrame) -> DataFrame:
    """One row per series: last date, its labels and drivers, and the last values, oldest first."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    recent = features.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= LOOKBACK)
    last = F.struct("region", "opcs_chapter", *[F.col(c).cast("double").alias(c) for c in DRIVERS])
    return recent.groupBy(*SERIES).agg(
        F.max("date").alias("last_date"),
        F.max_by(last, "date").alias("last"),
        F.transform(F.array_sort(F.collect_list(F.struct("date", F.col(TARGET).cast("double").alias("v")))),
                    lambda s: s["v"]).alias("history"))


def recursive_forecast(features: DataFrame, model: PooledModel, horizon: int) -> DataFrame:
    """Every series ``horizon`` months ahead, the median fed back.

    The walk is a fold over the horizon inside the series' row: one projection, no job per step.
    """
    state = series_state(features)
    drivers = {name: F.col(f"last.{name}") for name in DRIVERS}
    betas = [literals(b) for b in model.coefficients]

    def predict(month: Column, history: Column) -> Column:
        ar = ar_features(history)
        time_idx = (F.year(month) - model.first_year) * 12 + F.month(month) - 1

        def scaled(level: Column) -> Column:
            inputs = _inputs(level, ar, F.month(month), time_idx.cast("double"), drivers, model.driver_means)
            return bind(inputs, lambda x: monotone(*[dot(x, b) * level for b in betas]))

        return bind(_level(ar), scaled)

    def advance(walk: Column, step: Column) -> Column:
        month = F.add_months(F.trunc(F.col("last_date"), "month"), step)
        band = bind(month, lambda m: bind(
            F.transform(tail(walk, LOOKBACK), lambda b: b[1]), lambda history: predict(m, history)))
        return F.concat(walk, F.array(band))

    start = F.transform("history", lambda v: F.array(v, v, v))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance)
    steps = state.select(
        *SERIES, F.col("last.region").alias("region"), "last_date",
        F.posexplode(tail(walked, horizon)).alias("pos", "band"))
    return steps.select(
        "trust_code", "region", "procedure_code",
        F.add_months(F.trunc("last_date", "month"), F.col("pos") + 1).alias("date"),
        F.col("band")[1].alias("yhat"), F.col("band")[0].alias("yhat_lower"), F.col("band")[2].alias("yhat_upper"))


def forecast(features: DataFrame, horizon: int) -> DataFrame:
    """Train on the whole table and forecast from its end."""
    return recursive_forecast(features, train(features), horizon)
