"""Non-linear window forecaster: a small network from the last 12 standardised values to the next one.

    next = b + s . z + sum over units j of v_j tanh(W_j . z + c_j)

It is fitted over all series by damped Gauss-Newton steps (Levenberg-Marquardt). A step needs the sums J'J and J'r over the
windows, which every task adds up for its rows; what reaches the driver is one triangle of parameters by parameters per
pass, whatever the number of rows. The start is the linear model (all v_j = 0), and a step counts only if it lowers the
loss, so the fit is never worse on its rows than the linear one. Seeded units make it repeatable; the order of partitions
changes it by rounding only.

Synchronous mini-batches in a barrier stage were tried: one exchange takes about a second in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.folds import dot, literals, matrix, summed, vector
from panelcast.operators.window_ar import decode, standardise, windows
from panelcast.sources.storage import iteration_input

UNITS, PASSES, SEED, RIDGE = 6, 40, 7, 1e-6
#: The fit ends when two steps in a row lower the loss by less than this share.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class NetModel:
    """Parameters as one vector: b, s, v, then W and c unit by unit."""

    theta: np.ndarray
    lookback: int

    @property
    def parts(self):
        k = self.lookback
        units = (len(self.theta) - 1 - k) // (k + 2)
        b, s, v, w = np.split(self.theta, [1, 1 + k, 1 + k + units])
        w = w.reshape(units, k + 1)
        return float(b[0]), s, v, w[:, :k], w[:, k]

    def values(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions, and the activations of the units."""
        b, s, v, w, c = self.parts
        h = np.tanh(z @ w.T + c)
        return b + z @ s + h @ v, h

    def next_value(self, window: Column) -> Column:
        b, s, v, w, c = self.parts
        out = dot(window, literals(s)) + F.lit(b)
        for j in range(len(v)):
            out = out + F.tanh(dot(window, literals(w[j])) + F.lit(float(c[j]))) * F.lit(float(v[j]))
        return out


def _sums(rows: DataFrame, model: NetModel) -> tuple[np.ndarray, np.ndarray, float, float]:
    """J'J, J'r, the sum of squares and the number of windows: one pass."""
    p = len(model.theta)
    triangle = np.triu_indices(p)

    def fold(batch) -> np.ndarray:
        z, y = matrix(batch, "window"), vector(batch, "z")
        predicted, h = model.values(z)
        _, _, v, _, _ = model.parts
        slope = (1 - h * h) * v
        one = np.ones((len(z), 1))
        inner = slope[:, :, None] * np.concatenate([z, one], axis=1)[:, None, :]
        j = np.concatenate([one, z, h, inner.reshape(len(z), -1)], axis=1)
        r = y - predicted
        return np.concatenate([(j.T @ j)[triangle], j.T @ r, [r @ r, float(len(r))]])

    flat = summed(rows, fold)
    if not len(flat):
        raise ArithmeticError("no windows to fit")
    gram = np.zeros((p, p))
    gram[triangle] = flat[: len(triangle[0])]
    gram = gram + np.triu(gram, 1).T
    return gram, flat[len(triangle[0]): -2], float(flat[-2]), float(flat[-1])


def fit(z: DataFrame, keys: Sequence[str], lookback: int = 12, units: int = UNITS, passes: int = PASSES) -> NetModel:
    rng = np.random.default_rng(SEED)
    rows = iteration_input(windows(z, keys, "z", lookback).select("window", "z"), "network-windows")
    try:
        linear = 1 + lookback
        theta = np.zeros(linear + units * (lookback + 2))
        theta[linear + units:] = rng.normal(0, 0.7 / np.sqrt(lookback), units * (lookback + 1))
        gram, pull, loss, n = _sums(rows, NetModel(theta, lookback))
        # The linear start: its sums are the first rows of the same pass.
        free = slice(0, linear)
        theta[free] = np.linalg.solve(gram[free, free] + RIDGE * n * np.eye(linear), pull[free])
        model, damping, small = NetModel(theta, lookback), 1e-2, 0
        gram, pull, loss, _ = _sums(rows, model)
        for _ in range(passes):
            scale = np.diag(gram) + RIDGE * n
            step = np.linalg.solve(gram + damping * np.diag(scale) + RIDGE * n * np.eye(len(theta)), pull)
            tried = NetModel(model.theta + step, lookback)
            found = _sums(rows, tried)
            if np.isfinite(found[2]) and found[2] < loss:
                small = small + 1 if loss - found[2] < TOLERANCE * loss else 0
                model, (gram, pull, loss, _), damping = tried, found, max(damping / 3, 1e-6)
                if small == 2:
                    break
            else:
                damping *= 5
                if damping > 1e8:
                    break
        return model
    finally:
        rows.unpersist()


def forecast(
    df: DataFrame, horizon: int, keys: Sequence[str] = ("trust_code", "procedure_code"),
    target: str = "n_procedures", lookback: int = 12,
) -> DataFrame:
    """Every series `horizon` months ahead, its own prediction fed back, with the window model's band."""
    z = standardise(df, keys, target, lookback)
    return decode(z, fit(z, keys, lookback), keys, horizon, lookback)
