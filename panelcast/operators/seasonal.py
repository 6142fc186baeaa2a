"""Seasonal ARIMA (1,1,1)(1,1,0,12) per series by exact likelihood.

Hannan-Rissanen regressions give the start. From there the Gaussian likelihood of the twice-differenced series, by a Kalman
filter over its 13 states, is raised by a pattern search over the three coefficients, which are kept stationary and
invertible by a transform. All series of a batch are filtered side by side, and the innovations' variance is concentrated
out, so a step costs a few small matrix products per series.

A series is a few hundred months at most; Spark groups the months of each into one row and spreads the rows. Series that are
too short or fail come back with a reason instead of vanishing, and series whose start had to be pulled inside the bounds
are flagged by `bounded`.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 24
SEASON = 12
#: States of the differenced series, and the bound of its coefficients.
STATES, BOUND = SEASON + 1, 0.99
#: Bound of the start, steps of the search (in transformed coefficients), and rounds at most.
START_BOUND, FIRST_STEP, LAST_STEP, ROUNDS = 0.95, 0.4, 0.005, 80


def month_grid(dates: pd.Series, values: pd.Series) -> tuple[pd.DatetimeIndex, np.ndarray]:
    """Values on a gap-free month grid; inner gaps are interpolated linearly."""
    series = pd.Series(values.to_numpy(float), index=pd.DatetimeIndex(dates)).sort_index()
    grid = pd.date_range(series.index[0], series.index[-1], freq="MS")
    return grid, series.reindex(grid).interpolate().to_numpy()


def _lagged(v: np.ndarray, k: int, start: int) -> np.ndarray:
    return v[start - k: len(v) - k]


def _regress(columns: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(np.stack(columns, axis=1), y, rcond=None)[0]


def start_values(w: np.ndarray) -> tuple[np.ndarray, bool]:
    """(phi, theta, seasonal phi) of a twice-differenced series by regressions, and whether one had to be bounded."""
    order = max(1, min(6, len(w) // 4))
    long_ar = _regress([_lagged(w, k, order) for k in range(1, order + 1)], w[order:])
    e = np.concatenate([np.zeros(order), w[order:] - sum(a * _lagged(w, k, order) for k, a in enumerate(long_ar, 1))])
    if len(w) > SEASON + 6:
        s = SEASON + 1
        phi, big, theta = _regress([_lagged(w, 1, s), _lagged(w, SEASON, s), _lagged(e, 1, s)], w[s:])
    else:
        (phi, theta), big = _regress([_lagged(w, 1, 1), _lagged(e, 1, 1)], w[1:]), 0.0
    found = np.array([phi, theta, big], float)
    if not np.isfinite(found).all():
        raise ArithmeticError("non-finite start")
    return np.clip(found, -START_BOUND, START_BOUND), bool((np.abs(found) > START_BOUND).any())


def _autoregression(beta: np.ndarray) -> np.ndarray:
    """(series, STATES): the weights of (1 - phi B)(1 - seasonal phi B^12)."""
    out = np.zeros((len(beta), STATES))
    out[:, 0], out[:, SEASON - 1], out[:, SEASON] = beta[:, 0], beta[:, 2], -beta[:, 0] * beta[:, 2]
    return out


def kalman(beta: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each row of `w` (NaN at the end of shorter ones) under its coefficients in `beta`, the variance of
    the innovations that maximises it, and the last innovation."""
    n, length = w.shape
    ar = _autoregression(beta)
    step = np.zeros((n, STATES, STATES))
    step[:, :, 0] = ar
    step[:, np.arange(STATES - 1), np.arange(1, STATES)] = 1.0
    shock = np.zeros((n, STATES))
    shock[:, 0], shock[:, 1] = 1.0, beta[:, 1]
    noise = shock[:, :, None] * shock[:, None, :]
    # Stationary variance by doubling: the sum of T^k R R' T'^k.
    p, power = noise.copy(), step.copy()
    for _ in range(12):
        p = p + power @ p @ power.transpose(0, 2, 1)
        power = power @ power
    state = np.zeros((n, STATES))
    squares, logs, count, last = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(length):
        seen = ~np.isnan(w[:, t])
        if not seen.any():
            break
        f = np.maximum(p[:, 0, 0], 1e-12)
        v = np.where(seen, w[:, t] - state[:, 0], 0.0)
        gain = np.where(seen[:, None], p[:, :, 0] / f[:, None], 0.0)
        squares += v * v / f
        logs += np.where(seen, np.log(f), 0.0)
        count += seen
        last = np.where(seen, v, last)
        state = state + gain * v[:, None]
        p = p - gain[:, :, None] * p[:, None, 0, :]
        state = np.einsum("nij,nj->ni", step, state)
        p = step @ p @ step.transpose(0, 2, 1) + noise
    variance = squares / np.maximum(count, 1)
    likelihood = -0.5 * (count * np.log(np.maximum(variance, 1e-300)) + logs + count)
    return np.where(np.isfinite(likelihood), likelihood, -np.inf), variance, last


def maximise(start: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of each series and their log-likelihood, never below the start's.

    Every round tries a step up and down in each (transformed) coefficient, moves to the best, and halves the step of the
    series that did not move.
    """
    free = lambda beta: np.arctanh(beta / BOUND)
    bound = lambda x: np.tanh(x) * BOUND
    x = free(start)
    best = kalman(bound(x), w)[0]
    size = np.full(len(x), FIRST_STEP)
    moves = np.concatenate([np.eye(3), -np.eye(3)])
    for _ in range(ROUNDS):
        active = np.flatnonzero(size >= LAST_STEP)
        if not len(active):
            break
        tried = np.clip(x[active, None, :] + size[active, None, None] * moves, -3.5, 3.5)
        found = kalman(bound(tried.reshape(-1, 3)), np.repeat(w[active], len(moves), axis=0))[0].reshape(len(active), -1)
        choice = found.argmax(axis=1)
        up = found[np.arange(len(active)), choice]
        better = up > best[active] + 1e-9
        rows = active[better]
        x[rows], best[rows] = tried[better, choice[better]], up[better]
        size[active[~better]] /= 2
    return bound(x), best


def extrapolate(y: np.ndarray, beta: np.ndarray, variance: float, last: float, horizon: int, z: float):
    """Mean and band of a series on its own scale."""
    phi, theta, big = beta
    # Full autoregressive polynomial: both differences times both AR factors.
    poly = np.array([1.0, -phi])
    for lag, c in ((SEASON, big), (1, 1.0), (SEASON, 1.0)):
        factor = np.zeros(lag + 1)
        factor[0], factor[lag] = 1.0, -c
        poly = np.convolve(poly, factor)
    ar = -poly[1:]
    path = list(np.concatenate([np.zeros(max(0, len(ar) - len(y))), y]))
    psi = np.zeros(horizon)
    for h in range(horizon):
        path.append(float(np.dot(ar, path[-1: -len(ar) - 1: -1])) + (theta * last if h == 0 else 0.0))
        psi[h] = 1.0 if h == 0 else sum(ar[i - 1] * psi[h - i] for i in range(1, min(h, len(ar)) + 1)) + (theta if h == 1 else 0.0)
    half = z * np.sqrt(variance * np.cumsum(psi ** 2))
    mean = np.array(path[-horizon:])
    return mean, mean - half, mean + half


def fit_batch(series: list[np.ndarray]) -> list[dict | str]:
    """Per series (values on a month grid): coefficients, likelihood, variance, last innovation, flag; or why it failed."""
    out: list[dict | str] = ["" for _ in series]
    fits = []
    for i, y in enumerate(series):
        try:
            d = np.diff(y)
            w = d[SEASON:] - d[:-SEASON]
            fits.append((i, w, *start_values(w)))
        except (ArithmeticError, ValueError, np.linalg.LinAlgError) as exc:
            out[i] = f"{type(exc).__name__}: {exc}"
    if fits:
        w = np.full((len(fits), max(len(f[1]) for f in fits)), np.nan)
        for row, f in enumerate(fits):
            w[row, : len(f[1])] = f[1]
        beta, likelihood = maximise(np.array([f[2] for f in fits]), w)
        _, variance, last = kalman(beta, w)
        for row, f in enumerate(fits):
            out[f[0]] = dict(beta=beta[row], likelihood=likelihood[row], variance=variance[row], last=last[row], bounded=f[3])
    return out


#: Series filtered side by side.
BATCH = 256


def forecast(
    df: DataFrame, horizon: int, keys: Sequence[str] = ("procedure_code",), date: str = "date",
    target: str = "n_procedures", alpha: float = 0.2, flags: bool = False,
) -> DataFrame:
    """Forecast rows of every series, plus an ``error`` column that is set on skipped series (and ``bounded`` with `flags`)."""
    keys = list(keys)
    z = NormalDist().inv_cdf(1 - alpha / 2)
    empty = {"date": None, "yhat": None, "yhat_lower": None, "yhat_upper": None, "bounded": None}

    def rows_of(head: dict, grid, y, fitted) -> list[dict]:
        if isinstance(fitted, str):
            return [{**head, **empty, "error": fitted}]
        mean, low, high = extrapolate(y, fitted["beta"], fitted["variance"], fitted["last"], horizon, z)
        if not (np.isfinite(mean).all() and np.isfinite(high).all()):
            return [{**head, **empty, "error": "non-finite forecast"}]
        ahead = pd.date_range(grid[-1], periods=horizon + 1, freq="MS")[1:]
        return [{**head, "date": day.date(), "yhat": max(m, 0.0), "yhat_lower": max(a, 0.0), "yhat_upper": max(b, 0.0),
                 "bounded": fitted["bounded"], "error": None} for day, m, a, b in zip(ahead, mean, low, high)]

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at: at + BATCH]
                heads, whole, out = part[keys].to_dict("records"), [], []
                for head, months in zip(heads, part["months"]):
                    if len(months) < MIN_ROWS:
                        out.append({**head, **empty, "error": f"{len(months)} rows, {MIN_ROWS} needed"})
                    else:
                        grid, y = month_grid(pd.Series([m["date"] for m in months]), pd.Series([m["y"] for m in months]))
                        whole.append((head, grid, y))
                for (head, grid, y), fitted in zip(whole, fit_batch([y for *_, y in whole])):
                    out += rows_of(head, grid, y, fitted)
                yield pd.DataFrame(out, columns=[*keys, *empty, "error"])

    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys]) + (
        ", date date, yhat double, yhat_lower double, yhat_upper double, bounded boolean, error string")
    # Duplicate months are summed first, so a series' row is bounded by its months.
    monthly = df.groupBy(*keys, F.trunc(date, "month").alias("date")).agg(F.sum(target).cast("double").alias("y"))
    series = monthly.where(F.col("y").isNotNull()).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("date", "y"))).alias("months"))
    out = series.mapInPandas(run, schema)
    return out if flags else out.drop("bounded")
