"""Boosted quantile forests and their recursive forecast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import boosting as bo, pooled, quantile_trees as qt
from panelcast.operators.features_monthly import SERIES, TARGET, build_feature_table
from panelcast.plans.queries_demand import given_forest
from panelcast.sources.storage import materialise
from tests.test_features import TABLE, inputs

LEVELS = (0.1, 0.5, 0.9)


@pytest.fixture(scope="module")
def table(spark, panel):
    waiting, demo = inputs(spark, panel)
    return materialise(build_feature_table(panel, waiting, demo, TABLE), "features")


def _sample(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[rng.random(n) < 0.2, 2] = np.nan
    y = np.where(x[:, 0] * x[:, 1] > 0, 4.0, -4.0) + np.where(np.isnan(x[:, 2]), 3.0, 0.0) + rng.normal(size=n)
    return x, y


def _frame(spark, x, y):
    rows = [([float(v) for v in a], float(b), 1.0, i) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "x array<double>, y double, weight double, key long")


def test_forests_learn_interactions_and_missing_values(spark):
    """A product of signs, invisible to each input alone and to a linear model, and a shift where an input is missing."""
    x, y = _sample(3000)
    forest = bo.train(_frame(spark, x, y).repartition(3), LEVELS, bo.Settings(rounds=150, rate=0.1))
    x, y = _sample(3000, seed=2)
    p = forest.predict(x)
    assert forest.input.shape[1] == 150 and (forest.input >= 0).sum(axis=2).max() <= 62
    assert np.abs(p[:, 1] - y).mean() < 1.0  # the noise alone has 0.8, the linear fit 4.1
    for k, q in enumerate(LEVELS):
        assert np.mean(y <= p[:, k]) == pytest.approx(q, abs=0.05)
    gone = np.isnan(x[:, 2])
    both = x[~gone].copy()
    both[:, 2] = np.nan
    assert np.mean(forest.predict(both)[:, 1] - p[~gone, 1]) == pytest.approx(3.0, abs=0.4)


def test_partitions_and_repeats_change_nothing(spark):
    x, y = _sample(600)
    one, two = (bo.train(_frame(spark, x, y).repartition(n), LEVELS, bo.Settings(rounds=5)) for n in (1, 7))
    for name in ("input", "cut", "left", "value"):
        assert np.array_equal(getattr(one, name), getattr(two, name)), name
    with pytest.raises(ArithmeticError, match="no rows"):
        bo.train(_frame(spark, x[:0], y[:0]), LEVELS)


def test_shares_hold_over_all_rows_when_grown_on_a_sample(spark):
    x, y = _sample(4000)
    forest = bo.train(_frame(spark, x, y), LEVELS, bo.Settings(rounds=20), sample_rows=500)
    p = forest.predict(x)
    for k, q in enumerate(LEVELS):
        assert np.mean(y <= p[:, k]) == pytest.approx(q, abs=0.005)


def test_leaf_values_and_least_rows():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 8, (400, 2)).astype(np.uint8)
    y = np.where(bins[:, 0] < 3, 10.0, 0.0) + rng.random(400)
    settings = bo.Settings(leaves=2, bins=8, least_rows=30)
    grower = bo._Grower(bins, (y < np.median(y)) - 0.5, np.ones(400), np.ones(400, bool), np.array([0, 1]), settings)
    grower.grow()
    fitted = np.zeros(400)
    grower.settle(y, 0.5, fitted, 1.0)
    assert grower.nodes[0]["input"] == 0 and grower.nodes[0]["cut"] == 2
    low, high = y[bins[:, 0] < 3], y[bins[:, 0] >= 3]
    assert sorted(set(fitted)) == sorted([np.sort(low)[(len(low) - 1) // 2], np.sort(high)[(len(high) - 1) // 2]])
    tight = bo._Grower(bins, y * 0 + 1.0, np.ones(400), np.ones(400, bool), np.array([0, 1]), bo.Settings(bins=8, least_rows=201))
    tight.grow()
    assert len(tight.nodes) == 1


def test_weighted_quantile():
    assert bo.quantile_of(np.array([3.0, 1.0, 2.0]), np.array([1.0, 1.0, 8.0]), 0.5) == 2.0
    assert bo.quantile_of(np.array([3.0, 1.0]), np.array([1.0, 1.0]), 0.9) == 3.0


def _stepwise(history, month, forest, horizon):
    """One series, month by month, in plain Python."""
    at = {c: i for i, c in enumerate(qt.INPUTS)}
    history, out = list(history), []
    for step in range(1, horizon + 1):
        level = max(np.mean(history[-12:]), 1.0)
        x = np.full((1, len(qt.INPUTS)), np.nan)
        x[0, at["lag1"]], x[0, at["month"]] = history[-1] / level, (month - 1 + step) % 12 + 1
        band = sorted(max(0.0, v) for v in forest.predict(x)[0] * level)
        out.append(band)
        history.append(band[1])
    return out


def test_walk_equals_stepwise_forecast(spark, panel, table):
    none = spark.createDataFrame([], "kind string, name string, code double")
    got = qt.recursive_forecast(table, qt.TreeForecaster(given_forest(), none, 2018), 30)
    rows = got.where("trust_code = 'T1' AND procedure_code = 'C2'").orderBy("date").collect()
    history = [r[TARGET] for r in panel.where("trust_code = 'T1' AND procedure_code = 'C2'").orderBy("date").collect()]
    want = _stepwise(history, 12, given_forest(), 30)
    assert len(rows) == 30 and got.count() == 24 * 30
    for r, (low, mid, high) in zip(rows, want):
        assert (r.yhat_lower, r.yhat, r.yhat_upper) == pytest.approx((low, mid, high))


def test_forecast_on_the_panel(spark, panel, table):
    train = table.where("date < '2023-07-01'")
    model = qt.train(train, bo.Settings(rounds=150, rate=0.1))
    out = materialise(qt.recursive_forecast(train, model, 6), "tree-forecast")
    assert out.count() == 24 * 6 and out.where("yhat_lower < 0 OR yhat_lower > yhat OR yhat > yhat_upper").count() == 0
    joined = out.join(panel.select(*SERIES, "date", TARGET), [*SERIES, "date"])
    row = joined.agg(F.avg(F.expr(f"abs(yhat - {TARGET}) / {TARGET}")).alias("ape"),
                     F.avg(F.expr(f"if({TARGET} BETWEEN yhat_lower AND yhat_upper, 1.0, 0.0)")).alias("inside")).first()
    assert row.ape < 0.12 and row.inside > 0.5
    # A series of a new trust has no code; its forecast still comes.
    new = train.where("trust_code = 'T1'").withColumn("trust_code", F.lit("new"))
    assert qt.recursive_forecast(new, model, 3).where("yhat IS NOT NULL").count() == 4 * 3


def test_inputs_cover_the_drivers():
    assert set(pooled.DRIVERS) <= set(qt.INPUTS)
