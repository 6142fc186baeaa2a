"""Over-dispersed count regression with an exposure offset, fitted by distributed IRLS.

Each IRLS pass is one Spark job: tasks fold their rows into p x p partial sums, Spark adds the
partials, and only O(p^2) numbers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.distributions import count_quantiles
from panelcast.functions.folds import dot, literals, matrix, solve_scaled, summed, vector
from panelcast.functions.metrics import coverage, pinball
from panelcast.functions.panel import scalar
from panelcast.operators.features_device import NUMERIC_FEATURES, TARGET
from panelcast.operators.naive import weekly_naive
from panelcast.sources.storage import iteration_input

MU_FLOOR = 1e-6
MIN_TRAINING_ROWS = 50
ALPHA_RANGE = (1e-4, 10.0)


@dataclass(frozen=True)
class CountModel:
    """``kind`` is negbin, poisson or naive; ``params`` is the intercept followed by the features."""
    kind: str
    params: tuple[float, ...]
    alpha: float
    feature_cols: tuple[str, ...]
    fallback_rate: float


def is_finite(column: str) -> Column:
    c = F.col(column).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))


def training_rows(features: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Rows with a target and a warmed-up window, below the cap, with finite features."""
    keep = F.col(TARGET).isNotNull() & F.col(f"{TARGET}_rollmean28").isNotNull()
    if "cap_sessions_day" in features.columns:
        keep = keep & (F.col("n_sessions") < F.col("cap_sessions_day"))
    for c in cols:
        keep = keep & is_finite(c)
    return features.where(keep)


def design(df: DataFrame, cols: Sequence[str], output: str = "x") -> DataFrame:
    """Intercept and features as one array column."""
    return df.withColumn(output, F.array(F.lit(1.0), *[F.col(c).cast("double") for c in cols]))


def weighted_normal_equations(rows: DataFrame, beta: np.ndarray | None, alpha: float, p: int):
    """X'WX, X'Wz and the log-likelihood kernel at ``beta`` (or at the starting means)."""

    def fold(batch) -> np.ndarray:
        x, y, offset = matrix(batch, "x"), vector(batch, "y"), vector(batch, "log_exposure")
        if beta is None:
            mu = y + 0.5
            eta = np.log(mu)
        else:
            eta = np.clip(x @ beta + offset, -700, 700)
            mu = np.maximum(np.exp(eta), 1e-10)
        weight = mu / (1 + alpha * mu)
        z = eta - offset + (y - mu) / mu
        wx = x * weight[:, None]
        if alpha > 0:
            score = y * np.log(mu / (1 + alpha * mu)) - np.log1p(alpha * mu) / alpha
        else:
            score = y * np.log(mu) - mu
        return np.concatenate([(x.T @ wx).ravel(), wx.T @ z, [score.sum()]])

    flat = summed(rows.select("x", "y", "log_exposure"), fold)
    if not len(flat):
        raise ArithmeticError("no rows to fit")
    return flat[: p * p].reshape(p, p), flat[p * p: p * p + p], flat[-1]


def fit_glm(
    rows: DataFrame, p: int, alpha: float, start: np.ndarray | None = None, max_iter: int = 100, tol: float = 1e-8
) -> np.ndarray:
    """Poisson (``alpha`` 0) or negative-binomial coefficients for rows (x, y, log_exposure).

    Raises ``ArithmeticError`` if the likelihood has not settled after ``max_iter`` passes.
    """
    beta, previous = start, None
    for _ in range(max_iter):
        gram, moment, score = weighted_normal_equations(rows, beta, alpha, p)
        if previous is not None and abs(score - previous) <= tol * (abs(previous) + tol):
            return beta
        previous = None if beta is None else score
        beta = solve_scaled(gram, moment)
    raise ArithmeticError(f"no convergence after {max_iter} passes")


def linear_predictor(params: Sequence[float], cols: Sequence[str]) -> Column:
    out = F.lit(float(params[0]))
    for b, c in zip(params[1:], cols):
        out = out + F.col(c) * F.lit(float(b))
    return out


def mu_column(model: CountModel) -> Column:
    """Expected count of a row, floored."""
    if model.kind == "naive":
        return F.greatest(F.col("exposure_hours") * model.fallback_rate, F.lit(MU_FLOOR))
    eta = linear_predictor(model.params, model.feature_cols) + F.log("exposure_hours")
    return F.greatest(F.exp(eta), F.lit(MU_FLOOR))


def predict_mu(model: CountModel, df: DataFrame, output: str = "mu") -> DataFrame:
    return df.withColumn(output, mu_column(model))


def dispersion(y: Column, mu: Column) -> Column:
    """Auxiliary-regression dispersion: sum(mu * a) / sum(mu^2), a = ((y - mu)^2 - y) / mu, clipped."""
    aux = (F.pow(y - mu, 2) - y) / mu
    low, high = ALPHA_RANGE
    return F.least(F.greatest(F.sum(mu * aux) / F.sum(mu * mu), F.lit(low)), F.lit(high))


def _training_input(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    return iteration_input(design(training_rows(features, cols), cols).select(
        "x", F.col(TARGET).cast("double").alias("y"), "exposure_hours",
        F.log("exposure_hours").alias("log_exposure")), "count-train")


def _size_and_rate(train: DataFrame) -> tuple[int, float]:
    total = train.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("y"),
        F.coalesce(F.sum("exposure_hours"), F.lit(0.0)).alias("exposure")).first()
    return total.n, total.y / max(total.exposure, 1.0)


def fit_poisson(features: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> CountModel:
    """Poisson regression with the exposure offset."""
    cols = tuple(c for c in cols if c in features.columns)
    train = _training_input(features, cols)
    try:
        _, rate = _size_and_rate(train)
        beta = fit_glm(train, len(cols) + 1, 0.0)
        return CountModel("poisson", tuple(float(b) for b in beta), 0.0, cols, rate)
    finally:
        train.unpersist()


def fit(features: DataFrame, cols: Sequence[str] = NUMERIC_FEATURES) -> CountModel:
    """Negative binomial, falling back to Poisson and then to a plain rate."""
    cols = tuple(c for c in cols if c in features.columns)
    train = _training_input(features, cols)
    try:
        n, rate = _size_and_rate(train)
        naive = CountModel("naive", (), 0.0, cols, rate)
        if n < MIN_TRAINING_ROWS:
            return naive
        p = len(cols) + 1
        try:
            poisson = fit_glm(train, p, 0.0)
        except (ArithmeticError, np.linalg.LinAlgError):
            return naive
        params = tuple(float(b) for b in poisson)
        mu = F.greatest(F.exp(dot(F.col("x"), literals(params)) + F.col("log_exposure")), F.lit(MU_FLOOR))
        alpha = float(train.select("y", mu.alias("mu")).agg(dispersion(F.col("y"), F.col("mu"))).first()[0])
        try:
            negbin = fit_glm(train, p, alpha, start=poisson)
        except (ArithmeticError, np.linalg.LinAlgError):
            return CountModel("poisson", params, 0.0, cols, rate)
        return CountModel("negbin", tuple(float(b) for b in negbin), alpha, cols, rate)
    finally:
        train.unpersist()


def predict_quantiles(
    model: CountModel, df: DataFrame, quantiles: Sequence[float], mu: str = "mu", names: Sequence[str] | None = None
) -> DataFrame:
    """Predictive quantiles per row, one array per Arrow batch and split into columns."""
    levels = np.array(quantiles, float)
    r = math.inf if model.alpha <= 0 else 1.0 / model.alpha

    @F.pandas_udf("array<double>")
    def quantile_array(means: pd.Series) -> pd.Series:
        m = means.to_numpy(float)
        found = count_quantiles(np.tile(levels, len(m)), np.repeat(m, len(levels)), r)
        return pd.Series(list(found.reshape(len(m), len(levels))))

    names = list(names or [f"q{q:g}" for q in quantiles])
    out = df.withColumn("__q", quantile_array(F.col(mu)))
    return out.withColumns({n: F.col("__q")[i] for i, n in enumerate(names)}).drop("__q")


def predictive_variance(alpha: float, mu: Column | str = "mu") -> Column:
    m = F.col(mu) if isinstance(mu, str) else mu
    return m + alpha * m * m


def backtest(
    features: DataFrame, horizon_days: int, quantiles: tuple[float, float, float] = (0.05, 0.5, 0.95),
    n_origins: int = 1,
) -> DataFrame:
    """Hold-out accuracy, one row per origin: one-step-ahead on actual lags, origins one horizon apart."""
    low, mid, high = quantiles
    newest = scalar(features, F.max("date"))
    reports = []
    for origin in range(n_origins):
        cutoff = F.date_sub(newest, horizon_days * (origin + 1))
        upto = F.date_sub(newest, horizon_days * origin)
        model = fit(features.where(F.col("date") <= cutoff))
        test = features.where(
            (F.col("date") > cutoff) & (F.col("date") <= upto) & F.col(f"{TARGET}_rollmean28").isNotNull())
        scored = predict_quantiles(model, predict_mu(model, test), quantiles, names=["lo", "md", "hi"])
        scored = scored.select(
            F.col(TARGET).cast("double").alias("y"), "mu", "lo", "md", "hi", weekly_naive().alias("naive"))
        digits = lambda c: F.round(c, 4)
        reports.append(scored.agg(
            F.lit(origin).alias("origin"),
            F.lit(model.kind).alias("model_kind"), F.lit(round(model.alpha, 4)).alias("alpha"),
            F.count("*").alias("n_test"),
            digits(pinball("y", "lo", low)).alias("pinball_p05"),
            digits(pinball("y", "md", mid)).alias("pinball_p50"),
            digits(pinball("y", "hi", high)).alias("pinball_p95"),
            digits(pinball("y", "naive", mid)).alias("pinball_p50_naive"),
            digits(F.avg(F.abs(F.col("y") - F.col("mu")))).alias("mae"),
            digits(coverage("y", "lo", "hi")).alias("coverage_90")))
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out.where(F.col("n_test") > 0)
