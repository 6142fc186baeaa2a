import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import count_model as cm, risk
from panelcast.plans.flows import copula_loadings


def book_of(spark, n=5, mean=30.0):
    rows = [(f"dev{i}", mean + 3 * i, (mean + 3 * i) * (1.5 + i), 20, "s", "r", "q", 500.0 + 10 * i, 4000.0, 9000.0, 400.0)
            for i in range(n)]
    return spark.createDataFrame(
        rows, "device_id string, exp_sessions double, var_sessions double, cap_day int, site_id string, region string, "
              "specialty string, price_per_session_gbp double, floor_gbp double, fixed_gbp double, cap_sessions double")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.poisson(6, size=(40, 7)) + 4 * rng.random((40, 1))
    x = x - x.mean(axis=0)
    df = spark.createDataFrame([(f"dev{i}", [float(v) for v in x[:, i]]) for i in range(7)], "device_id string, v array<double>")
    return df, x


def ledoit_wolf(x):
    n, p = x.shape
    s = x.T @ x / n
    m = np.trace(s) / p
    d2 = ((s - m * np.eye(p)) ** 2).sum()
    b2 = sum(((np.outer(r, r) - s) ** 2).sum() for r in x) / n ** 2
    k = min(b2, d2) / d2
    return k, (1 - k) * s + k * m * np.eye(p)


def as_matrix(long, value, n=7):
    out = np.zeros((n, n))
    for r in long.collect():
        out[int(r.dev_a[3:]), int(r.dev_b[3:])] = r[value]
    return out


def test_shrunk_covariance_against_definition(vectors, monkeypatch):
    df, x = vectors
    k, want = ledoit_wolf(x)
    stats = risk.shrinkage(df.repartition(3))
    assert stats[:2] == (40, 7) and stats[2] == pytest.approx(k)
    assert as_matrix(risk.shrunk_covariance(df, stats), "cov") == pytest.approx(want)
    monkeypatch.setattr(risk, "BLOCK", 2)
    assert as_matrix(risk.shrunk_covariance(df, stats), "cov") == pytest.approx(want)


def test_correlation_properties(vectors):
    df, _ = vectors
    corr = as_matrix(risk.correlation(risk.shrunk_covariance(df)), "corr")
    assert corr == pytest.approx(corr.T) and np.diag(corr).tolist() == [1.0] * 7
    assert np.linalg.eigvalsh(corr).min() > -1e-9


def test_too_few_dates_give_identity(spark):
    df = spark.createDataFrame([("dev0", [1.0, -1.0]), ("dev1", [2.0, -2.0])], "device_id string, v array<double>")
    assert as_matrix(risk.shrunk_covariance(df), "cov", 2) == pytest.approx(np.eye(2))


def implied(loadings):
    rows = {r.device_id: r for r in loadings.collect()}
    ids = sorted(rows)
    b = np.array([rows[d].loadings for d in ids])
    return b @ b.T + np.diag([rows[d].idio ** 2 for d in ids])


def test_loadings_imply_the_shrunk_correlation(vectors):
    df, _ = vectors
    stats = risk.shrinkage(df)
    want = as_matrix(risk.correlation(risk.shrunk_covariance(df, stats)), "corr")
    assert implied(risk.panel_loadings(df, stats)) == pytest.approx(want, abs=1e-9)


def test_common_share_is_bounded(spark):
    line = [float(v) for v in range(-20, 20)]
    df = spark.createDataFrame([(f"dev{i}", [v * (i + 1) * 100 for v in line]) for i in range(3)],
                               "device_id string, v array<double>")
    corr = implied(risk.panel_loadings(df, (40, 3, 0.0, 1e-6)))
    assert np.diag(corr) == pytest.approx(1.0) and corr[0, 1] == pytest.approx(risk.MAX_COMMON)
    assert np.linalg.eigvalsh(corr).min() > 0


def test_loadings_of_a_device_do_not_depend_on_the_size_of_the_book(spark):
    rng = np.random.default_rng(5)
    rows = [(f"dev{i}", [float(v) for v in rng.normal(size=30)]) for i in range(300)]
    whole = spark.createDataFrame(rows, "device_id string, v array<double>")
    stats = risk.shrinkage(whole)
    some = {r.device_id: (r.loadings, r.idio) for r in risk.panel_loadings(whole.where("device_id < 'dev2'"), stats).collect()}
    every = {r.device_id: (r.loadings, r.idio) for r in risk.panel_loadings(whole, stats).collect()}
    assert len(every) == 300 and all(every[d] == v for d, v in some.items())


def test_simulation_is_partition_invariant(spark, vectors):
    df, _ = vectors
    loadings = risk.panel_loadings(df, risk.shrinkage(df))
    positions = book_of(spark)
    one = risk.simulate(positions.repartition(1), loadings, 60)
    many = risk.simulate(positions.repartition(5), loadings.repartition(3), 60)
    rows = {r.device_id: (r.sessions, r.revenue) for r in many.collect()}
    assert len(rows) == 5 and {r.device_id: (r.sessions, r.revenue) for r in one.collect()} == rows
    assert all(len(x) == 60 for pair in rows.values() for x in pair)


def test_simulated_moments_and_correlation(spark):
    positions = book_of(spark, 2).withColumn("cap_sessions", F.lit(1e9))
    tight = math.sqrt(0.9)
    loadings = spark.createDataFrame(
        [(f"dev{i}", [tight], math.sqrt(0.1)) for i in range(2)], "device_id string, loadings array<double>, idio double")
    wide = pd.DataFrame({r.device_id: r.sessions for r in risk.simulate(positions, loadings, 4000).collect()})
    assert wide["dev0"].mean() == pytest.approx(30.0, rel=0.03)
    assert wide["dev0"].var() == pytest.approx(45.0, rel=0.1)
    assert wide[["dev0", "dev1"]].corr(method="spearman").iloc[0, 1] == pytest.approx(6 / math.pi * math.asin(0.45), abs=0.03)


def test_devices_without_a_finite_mean_reach_their_cap(spark, vectors):
    df, _ = vectors
    many = F.when(F.col("device_id") == "dev1", math.inf)
    positions = book_of(spark).withColumns({c: F.coalesce(many, F.col(c)) for c in ("exp_sessions", "var_sessions")})
    usual = {r.device_id: r.sessions for r in risk.simulate(book_of(spark), risk.panel_loadings(df, risk.shrinkage(df)), 60).collect()}
    rows = {r.device_id: r.sessions for r in risk.simulate(positions, risk.panel_loadings(df, risk.shrinkage(df)), 60).collect()}
    cap = positions.where("device_id = 'dev1'").first().cap_sessions
    assert rows.pop("dev1") == [cap] * 60 and usual.pop("dev1") and rows == usual


def test_cap_and_floor(spark):
    positions = book_of(spark, 1).withColumn("cap_sessions", F.lit(20.0))
    draws = spark.createDataFrame([("dev0", [50.0, 2.0])], "device_id string, sessions array<double>")
    row = risk.cap_and_floor(draws, positions).first()
    assert (row.sessions, row.revenue) == ([20.0, 2.0], [10000.0, 4000.0])


def test_tail_and_pricing_against_numpy(spark, vectors):
    df, _ = vectors
    positions = book_of(spark)
    draws = risk.simulate(positions, risk.panel_loadings(df, risk.shrinkage(df)), 300).persist()
    rev = np.array([r.revenue for r in draws.orderBy("device_id").collect()]).T
    assert risk.book_revenue(draws) == pytest.approx(rev.sum(axis=1))
    book, fixed = rev.sum(axis=1), 9000.0 * 5
    loss = fixed - book
    row = risk.tail_risk(draws, positions).first()
    var = np.quantile(loss, 0.95)
    assert row.var_loss_gbp == pytest.approx(var)
    assert row.cvar_loss_gbp == pytest.approx(loss[loss >= var].mean()) and row.cvar_loss_gbp >= row.var_loss_gbp
    assert row.revenue_std_gbp == pytest.approx(book.std()) and row.fixed_cost_gbp == pytest.approx(fixed)
    stats = {r.device_id: r for r in risk.device_statistics(draws, positions).collect()}
    rest = book - rev[:, 2]
    assert stats["dev2"].beta == pytest.approx(np.cov(rev[:, 2], rest)[0, 1] / rest.var())
    assert stats["dev2"].cv == pytest.approx(rev[:, 2].std() / rev[:, 2].mean())
    spread = risk.diversification(draws).first()
    assert 1 <= spread.effective_n_independent <= 5 and spread.n_devices == 5


def python_walk(model, features, horizon, ddof):
    """Plain recursion for one device, row by row."""
    g = features.sort_values("date")
    last, hist = g.iloc[-1], list(g["n_billable"].astype(float))
    out = []
    for h in range(1, horizon + 1):
        day = last["date"] + np.timedelta64(h, "D")
        arr = np.array(hist)
        row = {c: last[c] for c in risk.SLOW_FEATURES}
        dow, doy = day.dayofweek, day.dayofyear
        row |= {"dow_sin": math.sin(2 * math.pi * dow / 7), "dow_cos": math.cos(2 * math.pi * dow / 7),
                "doy_sin": math.sin(2 * math.pi * doy / 365.25), "doy_cos": math.cos(2 * math.pi * doy / 365.25),
                "is_weekend": float(dow >= 5), "trend": last["trend"] + h / 365.25}
        for k in (1, 7, 14):
            row[f"n_billable_lag{k}"] = arr[-k] if len(arr) >= k else arr.mean()
        for w in (7, 28):
            row[f"n_billable_rollmean{w}"] = arr[-w:].mean()
            row[f"n_billable_rollstd{w}"] = arr[-w:].std(ddof=ddof) if len(arr) > 1 else 0.0
        eta = model.params[0] + sum(b * row[c] for b, c in zip(model.params[1:], model.feature_cols))
        out.append(max(math.exp(eta) * (4.0 if dow >= 5 else 10.0), 1e-6))
        hist.append(out[-1])
    return out


@pytest.mark.parametrize("compat", [False, True])
def test_horizon_forecast_against_plain_recursion(fleet, compat):
    rng = np.random.default_rng(1)
    cols = tuple(c for c in fleet["features"].columns if c in cm.NUMERIC_FEATURES)
    model = cm.CountModel("negbin", (-1.5, *rng.normal(0, 0.02, len(cols))), 0.1, cols, 0.2)
    got = risk.forecast_horizon(model, fleet["features"], fleet["devices"], 10, compat).toPandas()
    features = fleet["features"].toPandas()
    features["date"] = pd.to_datetime(features["date"])
    for dev, g in features.groupby("device_id"):
        mine = got[got.device_id == dev].sort_values("date")["mu"].to_numpy()
        assert mine == pytest.approx(python_walk(model, g, 10, 0 if compat else 1))


def test_copula_loadings_are_unit_length(fleet):
    loadings = copula_loadings(fleet["days"])
    for r in loadings.collect():
        assert sum(v * v for v in r.loadings) + r.idio ** 2 == pytest.approx(1.0)
