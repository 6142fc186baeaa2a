import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions.folds import bind, deviation_of, mean_of, solve_scaled, tail
from panelcast.operators import backtest, naive, pooled, pooled_trees, seasonal, window_ar
from panelcast.operators.features_monthly import SERIES, build_feature_table
from panelcast.sources.storage import materialise
from tests.test_features import TABLE, inputs


@pytest.fixture(scope="module")
def table(spark, panel):
    waiting, demo = inputs(spark, panel)
    return materialise(build_feature_table(panel, waiting, demo, TABLE), "features")


def test_models_beat_the_seasonal_naive(panel, table):
    scores = {r.model: r for r in backtest.backtest(table, 12).collect()}
    base = naive.seasonal_naive_holdout(panel, ["trust_code", "region", "procedure_code"], "n_procedures")
    naive_mae = base.agg(F.avg(F.abs(F.col("actual") - F.col("yhat")))).first()[0]
    assert scores["pooled"].mae < naive_mae and scores["window"].mae < naive_mae
    assert scores["pooled"].grain == "trust" and scores["seasonal"].grain == "national"
    assert scores["seasonal"].mape < 8


def test_pooled_forecast_contract(panel, table):
    out = pooled.forecast(table, 6)
    assert out.count() == 24 * 6
    assert out.where("yhat_lower < 0 or yhat_lower > yhat or yhat > yhat_upper").count() == 0
    dates = [r.date for r in out.select("date").distinct().orderBy("date").collect()]
    assert dates == [datetime.date(2024, m, 1) for m in range(1, 7)]


def test_pooled_band_coverage(table, panel):
    """The 80 % band of one-year-ahead forecasts holds well over half of the actuals."""
    train = table.where("date < '2023-01-01'")
    out = pooled.recursive_forecast(train, pooled.train(train), 12).join(
        panel.select(*SERIES, "date", "n_procedures"), [*SERIES, "date"])
    inside = out.agg(F.avg(F.when(F.expr("n_procedures between yhat_lower and yhat_upper"), 1.0).otherwise(0.0))).first()[0]
    assert inside > 0.6


def test_pooled_model_recovers_quantiles(spark):
    """With an intercept only, the fitted values are the empirical quantiles."""
    rng = np.random.default_rng(3)
    y = rng.exponential(size=4001)
    rows = spark.createDataFrame([([1.0], float(v), 1.0) for v in y], "x array<double>, y double, weight double")
    betas = pooled._fit_quantiles(rows.repartition(3), [0.1, 0.5, 0.9], 200, 1e-9)
    for q, b in zip([0.1, 0.5, 0.9], betas):
        assert np.mean(y <= b[0]) == pytest.approx(q, abs=0.01)


def test_unsettled_quantile_fit_raises(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([([1.0, float(v)], float(v * e), 1.0) for v, e in rng.exponential(size=(500, 2))],
                                 "x array<double>, y double, weight double")
    with pytest.raises(ArithmeticError, match="no convergence"):
        pooled._fit_quantiles(rows, [0.1, 0.9], 2, 1e-9)


def test_ar_features_of_short_and_long_histories(spark):
    df = spark.createDataFrame([(1, [5.0]), (2, [float(i) for i in range(1, 15)])], "id int, h array<double>")
    ar = pooled.ar_features(F.col("h"))
    short, long = df.select("id", *[c.alias(n) for n, c in ar.items()]).orderBy("id").collect()
    assert short.n_procedures_lag1 == 5.0 and short.n_procedures_lag2 is None
    assert short.n_procedures_rollmean12 == 5.0 and short.n_procedures_rollstd3 == 0.0
    assert (long.n_procedures_lag1, long.n_procedures_lag12) == (14.0, 3.0)
    assert long.n_procedures_rollmean3 == 13.0 and long.n_procedures_rollstd3 == pytest.approx(1.0)


def test_boosted_trees(panel, table):
    """Close to the season-and-trend truth, ordered bands, a sensible share of actuals inside."""
    train = table.where("date < '2023-07-01'")
    out = pooled_trees.recursive_forecast(train, pooled_trees.train(train, 6, rounds=12, depth=4), 6, cut_every=2)
    assert out.count() == 24 * 6
    assert out.where("yhat_lower < 0 or yhat_lower > yhat or yhat > yhat_upper").count() == 0
    joined = out.join(panel.select(*SERIES, "date", "n_procedures"), [*SERIES, "date"])
    row = joined.agg(F.avg(F.expr("abs(yhat - n_procedures) / n_procedures")).alias("ape"),
                     F.avg(F.expr("if(n_procedures between yhat_lower and yhat_upper, 1.0, 0.0)")).alias("inside")).first()
    assert row.ape < 0.25 and row.inside > 0.4


def test_monotone_band(spark):
    row = spark.range(1).select(pooled.monotone(F.lit(9.0), F.lit(-4.0), F.lit(3.0)).alias("b")).first()
    assert row.b == [0.0, 3.0, 9.0]


def test_seasonal_series(spark):
    months = pd.date_range("2015-01-01", periods=96, freq="MS")
    y = 100 + 0.5 * np.arange(96) + 20 * np.sin(2 * np.pi * np.arange(96) / 12)
    rng = np.random.default_rng(0)
    rows = [("A", d.date(), float(v)) for d, v in zip(months[:84], y[:84] + rng.normal(0, 1, 84))]
    rows += [("short", d.date(), 5.0) for d in months[:10]]
    df = spark.createDataFrame(rows, "procedure_code string, date date, n_procedures double")
    out = seasonal.forecast(df, 12).toPandas()
    bad = out[out.error.notna()]
    assert bad.procedure_code.tolist() == ["short"] and "24 needed" in bad.error.iloc[0]
    good = out[out.error.isna()].sort_values("date")
    assert np.abs(good.yhat.to_numpy() - y[84:]).mean() < 5
    assert (good.yhat_lower <= good.yhat).all() and (good.yhat <= good.yhat_upper).all()
    width = (good.yhat_upper - good.yhat_lower).to_numpy()
    assert width[-1] > width[0] > 0


def _seasonal_process(rng, n, phi=0.5, theta=0.4, big=0.3):
    """A (1,1,1)(1,1,0,12) path of n months after a run-in."""
    m = n + 200
    e = rng.normal(0, 1, m)
    w = np.zeros(m)
    for t in range(13, m):
        w[t] = phi * w[t - 1] + big * (w[t - 12] - phi * w[t - 13]) + e[t] + theta * e[t - 1]
    w = w[-n:]
    d = np.zeros(n)
    for t in range(n):
        d[t] = w[t] + (d[t - 12] if t >= 12 else rng.normal())
    return 500 + np.cumsum(d)


def test_filter_equals_the_dense_likelihood():
    """The filter's likelihood is that of the joint normal distribution of a short series."""
    beta = np.array([[0.5, 0.4, 0.3]])
    psi = np.zeros(600)
    ar = seasonal._autoregression(beta)[0]
    for j in range(600):
        psi[j] = (j == 0) + 0.4 * (j == 1) + sum(ar[i] * psi[j - i - 1] for i in range(min(j, 13)))
    n = 30
    cov = np.array([[psi[: 600 - abs(a - b)] @ psi[abs(a - b):] for a in range(n)] for b in range(n)])
    w = np.random.default_rng(2).normal(size=n)
    got, variance, _ = seasonal.kalman(beta, w[None, :])
    s2 = w @ np.linalg.solve(cov, w) / n
    assert variance[0] == pytest.approx(s2, rel=1e-6)
    assert got[0] == pytest.approx(-0.5 * (n * np.log(s2) + np.linalg.slogdet(cov)[1] + n), rel=1e-6)


def test_likelihood_fit():
    """Never below the start, near the truth, and alike for series of other lengths in the batch."""
    rng = np.random.default_rng(7)
    series = [_seasonal_process(rng, 240) for _ in range(20)]
    fits = seasonal.fit_batch([*series, series[0][:100]])
    for y, f in zip(series, fits):
        d = np.diff(y)
        w = d[12:] - d[:-12]
        assert f["likelihood"] >= seasonal.kalman(seasonal.start_values(w)[0][None, :], w[None, :])[0][0] - 1e-9
    assert np.mean([f["beta"] for f in fits[:20]], axis=0) == pytest.approx([0.5, 0.4, 0.3], abs=0.12)
    alone = seasonal.fit_batch([series[0][:100]])[0]
    assert alone["beta"] == pytest.approx(fits[20]["beta"]) and alone["likelihood"] == pytest.approx(fits[20]["likelihood"])


def test_likelihood_bands_cover():
    rng = np.random.default_rng(11)
    series = [_seasonal_process(rng, 132) for _ in range(150)]
    inside = []
    for y, f in zip(series, seasonal.fit_batch([y[:120] for y in series])):
        _, low, high = seasonal.extrapolate(y[:120], f["beta"], f["variance"], f["last"], 12, 1.2815515655446004)
        inside.append(((low <= y[120:]) & (y[120:] <= high)).mean())
    assert 0.75 <= np.mean(inside) <= 0.85


def test_bounded_start_is_flagged(spark):
    months = pd.date_range("2015-01-01", periods=60, freq="MS")
    rng = np.random.default_rng(1)
    rows = [("A", d.date(), float(v)) for d, v in zip(months, _seasonal_process(rng, 60))]
    rows += [("B", d.date(), float(i % 12)) for i, d in enumerate(months)]  # no noise at all
    out = seasonal.forecast(spark.createDataFrame(rows, "procedure_code string, date date, n_procedures double"), 3, flags=True)
    found = {r.procedure_code: r for r in out.collect()}
    assert found["A"].bounded is False and found["A"].error is None
    assert found["B"].error is not None or found["B"].yhat is not None


def test_windows_and_standardise(spark, panel):
    short = panel.where("date < '2019-06-01'")
    assert window_ar.standardise(short, SERIES, "n_procedures").count() == 0
    z = window_ar.standardise(panel, SERIES, "n_procedures")
    stats = z.groupBy(*SERIES).agg(F.avg("z").alias("m"), F.stddev_pop("z").alias("s")).collect()
    assert all(abs(r.m) < 1e-9 and r.s == pytest.approx(1.0, abs=1e-5) for r in stats)
    w = window_ar.windows(z, SERIES, "z")
    assert w.count() == 24 * 60 and w.where("size(window) <> 12").count() == 0


def test_window_decode_is_recursive(spark):
    """A model that repeats the value of 12 months ago reproduces the last season."""
    months = pd.date_range("2020-01-01", periods=24, freq="MS")
    rows = [("a", d.date(), float(10 + i % 12)) for i, d in enumerate(months)]
    df = spark.createDataFrame(rows, "k string, date date, n_procedures double")
    z = window_ar.standardise(df, ["k"], "n_procedures")
    model = window_ar.WindowModel(0.0, (1.0,) + (0.0,) * 11)
    out = window_ar.decode(z, model, ["k"], 24).orderBy("date").collect()
    assert [r.yhat for r in out] == pytest.approx([10 + i % 12 for i in range(24)])
    assert out[0].date == datetime.date(2022, 1, 1)


def test_naive_forecast_repeats_the_season(panel):
    out = naive.seasonal_naive_forecast(panel, ["trust_code", "region", "procedure_code"], "n_procedures", 18)
    assert out.count() == 24 * 18
    joined = out.where("date < '2025-01-01'").join(
        panel.withColumn("date", F.add_months("date", 12)), ["trust_code", "region", "procedure_code", "date"])
    assert joined.count() == 24 * 12 and joined.where("yhat <> n_procedures").count() == 0


def test_array_helpers(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([],)], "v array<double>")
    rows = df.select(mean_of(F.col("v")).alias("m"), deviation_of(F.col("v")).alias("s"), tail(F.col("v"), 2).alias("t"),
                     bind(F.size("v"), lambda n: n * n).alias("sq")).collect()
    assert rows[0].m == 2.5 and rows[0].s == pytest.approx(np.std([1, 2, 3, 4], ddof=1)) and rows[0].t == [3.0, 4.0]
    assert rows[1].m is None and rows[1].s == 0.0 and rows[1].sq == 0


def test_solver_handles_collinear_columns():
    x = np.array([[1.0, 2.0, 0.0], [1.0, 2.0, 0.0], [1.0, 2.0, 0.0]])
    beta = solve_scaled(x.T @ x, x.T @ np.array([3.0, 3.0, 3.0]))
    assert x @ beta == pytest.approx([3.0, 3.0, 3.0]) and beta[2] == 0.0
