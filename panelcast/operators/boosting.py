"""Histogram gradient boosting on the pinball loss, a forest per quantile.

The forests are grown on a sample of at most about `SAMPLE_ROWS` rows, chosen by a hash of the row's key (all rows of a
smaller table); that bound is what lets a task hold its rows, cut into bins of one byte, over all rounds. Each quantile is
grown by a task of its own. What must hold for all rows, the shares below each quantile, is then set over all rows: the
residuals' quantiles move each forest's start (`calibrated`).

* Trees grow leaf by leaf: the open leaves with the largest gain are split until a tree has `leaves` leaves.
* A missing input goes to the side where the gain is larger.
* A leaf's value is the weighted quantile of the residuals in it.
* Rows of a round are drawn by a hash of the row's own key, inputs by the round, so a repeated task grows the same trees.

Growing synchronously over many tasks was tried: an exchange in a barrier stage takes a second each in Spark, and a forest
needs some thousands.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.folds import matrix, vector
from panelcast.sources.storage import iteration_input

#: Rows that the forests are grown on, about, and the grain of their share.
SAMPLE_ROWS, SHARES = 100_000, 1 << 20
NODES = "quantile int, tree int, node int, input int, cut int, missing_left boolean, left int, right int, value double"
NODE_FIELDS = ("quantile", "tree", "node", "input", "cut", "missing_left", "left", "right", "value")
NODE_SCHEMA = pa.schema([(c, {"value": pa.float64(), "missing_left": pa.bool_()}.get(c, pa.int32())) for c in NODE_FIELDS])


@dataclass(frozen=True)
class Settings:
    """As the reference model's: rounds, rate, leaves, rows of a leaf, shares of rows and inputs of a round."""

    rounds: int = 400
    rate: float = 0.05
    leaves: int = 63
    least_rows: int = 30
    row_share: float = 0.8
    input_share: float = 0.8
    bins: int = 48
    seed: int = 7


@dataclass(frozen=True)
class Forest:
    """Trees of all quantiles as flat arrays: (quantile, tree, node). A leaf has input -1."""

    quantiles: tuple[float, ...]
    edges: tuple[np.ndarray, ...]  # of each input, ascending; a value's bin is the number of edges below it
    start: np.ndarray  # of each quantile
    rate: float
    input: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray = field(repr=False)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """One row per row of `x` (missing: NaN), one column per quantile."""
        return self.predict_bins(self.bins(x))

    def predict_bins(self, b: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
        n, (q, trees, _) = len(b), self.input.shape
        out = np.tile(self.start, (n, 1))
        if not trees:
            return out
        step = max(1, cells // trees)
        tree = np.arange(trees)[None, :]
        for k in range(q):
            nodes = (self.input[k], self.cut[k], self.missing_left[k], self.left[k], self.right[k])
            for at in range(0, n, step):
                rows = b[at: at + step]
                node = np.zeros((len(rows), trees), np.int64)
                who = np.arange(len(rows))[:, None]
                while True:
                    feature, cut, missing, left, right = (a[tree, node] for a in nodes)
                    inner = feature >= 0
                    if not inner.any():
                        break
                    bin_ = rows[who, np.maximum(feature, 0)]
                    goes = np.where(bin_ == MISSING, missing, bin_ <= cut)
                    node = np.where(inner, np.where(goes, left, right), node)
                out[at: at + step, k] += self.rate * self.value[k][tree, node].sum(axis=1)
        return out


MISSING = 255


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        column = x[:, j]
        out[:, j] = np.where(np.isnan(column), MISSING, np.searchsorted(e, column, side="left"))
    return out


def forest_of(rows: Sequence, quantiles, edges, start, rate: float) -> Forest:
    """A forest from rows of NODES."""
    trees = 1 + max((r["tree"] for r in rows), default=-1)
    nodes = 1 + max((r["node"] for r in rows), default=0)
    shape = (len(quantiles), trees, nodes)
    made = {"input": np.full(shape, -1, np.int16), "cut": np.zeros(shape, np.int16), "missing_left": np.zeros(shape, bool),
            "left": np.zeros(shape, np.int16), "right": np.zeros(shape, np.int16), "value": np.zeros(shape)}
    if rows:
        at = tuple(np.array([r[c] for r in rows]) for c in ("quantile", "tree", "node"))
        for name, values in made.items():
            values[at] = [r[name] for r in rows]
    return Forest(tuple(quantiles), tuple(edges), np.asarray(start, float), rate, **made)


def quantile_of(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    """The smallest value at which the weights reach the share `q`."""
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weights[order])
    return float(values[order][min(np.searchsorted(reached, q * reached[-1]), len(values) - 1)])


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row keys, another set for each salt."""
    x = keys.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


class _Grower:
    """One tree on the rows of a task."""

    def __init__(self, bins, gradient, weight, used, columns, settings: Settings):
        self.bins, self.gradient, self.weight, self.columns, self.settings = bins, gradient, weight, columns, settings
        # Each row's bins of the round's inputs, numbered over all of these inputs.
        self.cells = bins[:, columns].astype(np.int32) + np.arange(len(columns), dtype=np.int32) * (settings.bins + 1)
        self.nodes = [self._leaf()]
        self.rows = {0: np.arange(len(bins))}  # of each leaf
        self.drawn = {0: np.flatnonzero(used)}  # those drawn for the round
        sums = self._sums(self.drawn[0])
        self.sums, self.best = {0: sums}, {0: self._best(sums)}

    @staticmethod
    def _leaf() -> dict:
        return dict(input=-1, cut=0, missing_left=False, left=0, right=0, value=0.0)

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        """(inputs, bins and missing, 3): gradients, weights and number of the rows in each bin."""
        width, p = self.settings.bins + 1, len(self.columns)
        cell = self.cells[rows].ravel()
        of = (np.bincount(cell, np.repeat(self.gradient[rows], p), p * width),
              np.bincount(cell, np.repeat(self.weight[rows], p), p * width), np.bincount(cell, minlength=p * width))
        return np.stack(of, axis=-1).reshape(p, width, 3)

    def _best(self, sums: np.ndarray):
        """(gain, input, cut, missing left?) of a leaf, or None."""
        known, missing = sums[:, :-1].cumsum(axis=1), sums[:, -1:]
        whole = known[:, -1:] + missing
        best, least = None, self.settings.least_rows
        for missing_left in (True, False):
            left = known + missing if missing_left else known
            right = whole - left
            ok = (left[..., 2] >= least) & (right[..., 2] >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1]
                        - whole[..., 0] ** 2 / whole[..., 1])
            gain = np.where(ok & np.isfinite(gain), gain, 0.0)
            at = np.unravel_index(gain.argmax(), gain.shape)
            if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                best = (float(gain[at]), int(self.columns[at[0]]), int(at[1]), missing_left)
        return best

    def grow(self) -> None:
        while len(self.rows) < self.settings.leaves:
            leaf = max((k for k, s in self.best.items() if s), key=lambda k: (self.best[k][0], -k), default=None)
            if leaf is None:
                return
            _, column, cut, missing_left = self.best.pop(leaf)
            left, whole = len(self.nodes), self.sums.pop(leaf)
            self.nodes += [self._leaf(), self._leaf()]
            self.nodes[leaf] |= dict(input=column, cut=cut, missing_left=missing_left, left=left, right=left + 1)
            for of in (self.rows, self.drawn):
                rows = of.pop(leaf)
                b = self.bins[rows, column]
                goes = np.where(b == self.settings.bins, missing_left, b <= cut)
                of[left], of[left + 1] = rows[goes], rows[~goes]
            # Sums of the smaller side; the other's are what is left.
            small = left if len(self.drawn[left]) <= len(self.drawn[left + 1]) else left + 1
            large = 2 * left + 1 - small
            self.sums[small] = self._sums(self.drawn[small])
            self.sums[large] = whole - self.sums[small]
            for k in (left, left + 1):
                self.best[k] = self._best(self.sums[k])

    def settle(self, residual: np.ndarray, q: float, fitted: np.ndarray, rate: float) -> None:
        """Leaf values, added to the fitted values of the leaves' rows."""
        for leaf, rows in self.rows.items():
            if len(rows):
                value = quantile_of(residual[rows], self.weight[rows], q)
                self.nodes[leaf]["value"] = value
                fitted[rows] += rate * value


def _grow_forest(settings: Settings, edges, quantiles, start):
    """All rounds of one quantile: a group of rows in, NODES out."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        k = table.column("quantile")[0].as_py()
        q = quantiles[k]
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        column = table.column("x").combine_chunks()
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[order]
        y, weight, key = (table.column(c).to_numpy()[order] for c in ("y", "weight", "key"))
        p = len(edges)
        bins = binned(x, edges)
        bins[bins == MISSING] = settings.bins
        fitted = np.full(len(y), start[k])
        out = []
        for r in range(settings.rounds):
            columns = np.sort(np.random.default_rng((settings.seed, r)).permutation(p)[: max(1, round(settings.input_share * p))])
            used = _mixed(key, settings.seed * 1_000_003 + r) < settings.row_share
            grower = _Grower(bins, weight * ((y < fitted) - q), weight, used, columns, settings)
            grower.grow()
            grower.settle(y - fitted, q, fitted, settings.rate)
            out += [(k, r, i, *n.values()) for i, n in enumerate(grower.nodes)]
        return pa.Table.from_pylist([dict(zip(NODE_FIELDS, row)) for row in out], NODE_SCHEMA)
    return run


def bin_edges(rows: DataFrame, p: int, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each of `p` inputs in the array column `x`, NaN left out: at most `bins` - 1 each."""
    shares = [i / bins for i in range(1, bins)]
    cells = [F.percentile_approx(F.when(~F.isnan(F.col("x")[j]), F.col("x")[j]), shares, 1000).alias(f"e{j}") for j in range(p)]
    found = rows.agg(*cells).first()
    return [np.unique(np.array(found[f"e{j}"] or [], float)) for j in range(p)]


def calibrated(forest: Forest, rows: DataFrame) -> Forest:
    """The forest with its starts moved so that each quantile's share of all rows lies below it."""
    def residuals(batches):
        for b in batches:
            left = vector(b, "y")[:, None] - forest.predict(matrix(b, "x"))
            yield pa.RecordBatch.from_arrays([pa.array(left[:, k]) for k in range(left.shape[1])],
                                             [f"r{k}" for k in range(left.shape[1])])

    schema = ", ".join(f"r{k} double" for k in range(len(forest.quantiles)))
    found = rows.mapInArrow(residuals, schema).agg(
        *[F.percentile_approx(f"r{k}", q, 10_000).alias(f"r{k}") for k, q in enumerate(forest.quantiles)]).first()
    return replace(forest, start=forest.start + np.array(list(found), float))


def train(rows: DataFrame, quantiles: Sequence[float], settings: Settings = Settings(), sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest of (x array<double> with NaN where missing, y double, weight double, key long) rows.

    `key` tells rows apart: for the sample and for the draws of a round. Raises ``ArithmeticError`` on an empty table.
    """
    kept = iteration_input(rows.select("x", "y", "weight", "key"), "boosting-rows")
    try:
        n = kept.count()
        if not n:
            raise ArithmeticError("no rows to fit")
        p = kept.select(F.size("x")).first()[0]
        edges = bin_edges(kept, p, settings.bins)
        start = kept.agg(F.percentile_approx("y", list(quantiles), 10_000)).first()[0]
        share = SHARES if n <= sample_rows else sample_rows * SHARES // n
        some = kept.where(F.pmod(F.xxhash64("key"), F.lit(SHARES)) < share)
        dealt = some.withColumn("quantile", F.explode(F.sequence(F.lit(0), F.lit(len(quantiles) - 1))))
        grown = dealt.groupBy("quantile").applyInArrow(_grow_forest(settings, edges, tuple(quantiles), list(start)), NODES)
        forest = forest_of(grown.collect(), quantiles, edges, start, settings.rate)
        return calibrated(forest, kept)
    finally:
        kept.unpersist()
