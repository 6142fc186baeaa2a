import math

import numpy as np
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from panelcast.functions import distributions as ds
from panelcast.functions import metrics
from panelcast.operators import count_model as cm
from panelcast.operators.features_monthly import assemble


def brute_quantile(u, mean, r):
    p = r / (r + mean)
    total, k = 0.0, -1
    while total < u - 1e-12:
        k += 1
        total += math.exp(math.lgamma(k + r) - math.lgamma(r) - math.lgamma(k + 1) + r * math.log(p) + k * math.log1p(-p))
    return k


@pytest.mark.parametrize("mean,r", [(0.3, 2.0), (4.0, 0.5), (25.0, 10.0), (300.0, 1e4), (1e-6, 1e4)])
def test_quantiles_against_brute_force(mean, r):
    u = np.array([0.01, 0.05, 0.37, 0.5, 0.9, 0.95, 0.999])
    assert ds.count_quantiles(u, mean, r).tolist() == [brute_quantile(x, mean, r) for x in u]


def test_poisson_quantiles():
    u = np.array([0.05, 0.5, 0.95, 0.9999])
    for mean in (0.01, 6.5, 900.0):
        k = np.arange(3000)
        cdf = np.cumsum(np.exp(-mean + k * math.log(mean) - ds.log_gamma(k + 1.0)))
        assert ds.count_quantiles(u, mean, math.inf).tolist() == np.searchsorted(cdf, u - 1e-12).tolist()


@pytest.mark.parametrize("mean,r,u,want", [(10, 1e-3, 0.999, 2648), (10, 0.01, 0.99, 265), (10, 0.01, 0.9999, 3228),
                                           (50, 0.1, 0.99999, 3683)])
def test_tails_are_whole(mean, r, u, want):
    assert ds.count_quantiles([u], mean, r).tolist() == [want]


@pytest.mark.parametrize("mean,r", [(0.3, 2.0), (30.0, 20.0), (400.0, 3.0), (1e6, 0.5), (1e6, 1e-3), (5e4, math.inf)])
def test_many_draws_of_one_law(mean, r):
    u = np.random.default_rng(1).random(300)
    found = ds.law_quantiles(u, mean, r)
    assert found.tolist() == ds.count_quantiles(u, mean, r).tolist()
    assert (ds.count_cdf(found, mean, r) >= u - 1e-11).all()
    assert (ds.count_cdf(found - 1, mean, r) <= u + 1e-11).all()


@pytest.mark.parametrize("mean", [1e9, 1e15, 1e17, 2e21, 1e300])
def test_large_means_keep_the_shape_of_the_law(mean):
    """Relative to the mean the law tends to the gamma law, whose quantiles are 5.42540570, 9.66871461 and 15.70521642 tenths."""
    u = np.array([0.05, 0.5, 0.95])
    found = ds.count_quantiles(u, mean, 10.0)
    assert found / mean == pytest.approx([0.542540570, 0.966871461, 1.570521642], rel=2e-8)
    assert ds.law_quantiles(u, mean, 10.0) == pytest.approx(found, rel=1e-12)


def test_quantiles_of_infinite_and_undefined_means():
    with np.errstate(all="ignore"):
        assert np.isinf(ds.count_quantiles([0.05, 0.95], math.inf, 10.0)).all()
        assert np.isnan(ds.count_quantiles([0.05, 0.95], math.nan, 10.0)).all()
        assert np.isnan(ds.law_quantiles(np.array([0.05, 0.95]), math.nan, math.nan)).all()


def test_normal_distribution_function():
    z = np.concatenate((np.linspace(-9, 9, 2001), [-37.0, 0.0, 40.0]))
    assert ds.normal_cdf(z) == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in z], rel=1e-7, abs=1e-15)


def test_a_fit_that_does_not_settle_says_so(counts):
    df, *_ = counts
    rows = cm.design(df, ["a", "b"]).select("x", "y", F.log("exposure_hours").alias("log_exposure"))
    with pytest.raises(ArithmeticError):
        cm.fit_glm(rows, 3, 0.0, max_iter=2)


def test_incomplete_beta_known_values():
    assert ds.incomplete_beta(2.0, 3.0, 0.4)[0] == pytest.approx(0.5248, abs=1e-10)
    assert ds.incomplete_beta(5.0, 1.0, 0.7)[0] == pytest.approx(0.7 ** 5)


def numpy_irls(x, y, offset, alpha):
    beta = np.zeros(x.shape[1])
    beta[0] = math.log(y.mean()) - offset.mean()
    for _ in range(200):
        eta = x @ beta + offset
        mu = np.exp(eta)
        w = mu / (1 + alpha * mu)
        z = eta - offset + (y - mu) / mu
        beta = np.linalg.lstsq(x * np.sqrt(w)[:, None], z * np.sqrt(w), rcond=None)[0]
    return beta


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(11)
    n = 900
    a, b = rng.normal(size=n), rng.random(n)
    exposure = rng.uniform(4, 10, n)
    mu = np.exp(0.4 * a - 0.8 * b - 0.5) * exposure
    y = rng.negative_binomial(2.0, 2.0 / (2.0 + mu))
    df = spark.createDataFrame(
        [tuple(map(float, r)) for r in zip(a, b, exposure, y)], "a double, b double, exposure_hours double, y double")
    x = np.column_stack([np.ones(n), a, b, np.zeros(n)])
    return df, x, y.astype(float), np.log(exposure)


@pytest.mark.parametrize("alpha", [0.0, 0.5])
def test_distributed_irls_against_numpy(counts, alpha):
    df, x, y, offset = counts
    rows = cm.design(df.withColumn("zero", F.lit(0.0)), ["a", "b", "zero"]).select(
        "x", "y", F.log("exposure_hours").alias("log_exposure")).repartition(5)
    beta = cm.fit_glm(rows, 4, alpha)
    assert beta[3] == 0.0
    assert beta[:3] == pytest.approx(numpy_irls(x[:, :3], y, offset, alpha), abs=2e-5)


def test_poisson_agrees_with_spark_glm(counts):
    df, *_ = counts
    rows = cm.design(df, ["a", "b"]).withColumn("log_exposure", F.log("exposure_hours"))
    beta = cm.fit_glm(rows.select("x", "y", "log_exposure"), 3, 0.0)
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", offsetCol="log_exposure", labelCol="y", maxIter=50, tol=1e-10).fit(
            assemble(rows, ["a", "b"]))
    assert beta == pytest.approx([glm.intercept, *glm.coefficients], abs=1e-5)


def test_fit_and_predict_on_the_fleet(fleet):
    model = cm.fit(fleet["features"].withColumn("cap_sessions_day", F.lit(99)))
    assert model.kind == "negbin" and cm.ALPHA_RANGE[0] <= model.alpha <= cm.ALPHA_RANGE[1]
    train = cm.training_rows(fleet["features"].withColumn("cap_sessions_day", F.lit(99)))
    sums = cm.predict_mu(model, train).agg(F.sum("mu"), F.sum("n_billable"), F.min("mu")).first()
    assert sums[0] == pytest.approx(sums[1], rel=0.05) and sums[2] >= cm.MU_FLOOR


def test_fallback_to_rate(fleet):
    few = fleet["features"].withColumn("cap_sessions_day", F.lit(0))
    model = cm.fit(few)
    assert model.kind == "naive" and model.params == ()
    assert cm.predict_mu(model, few).where("mu <= 0").count() == 0


def test_backtest_figures(fleet):
    row = cm.backtest(fleet["features"].withColumn("cap_sessions_day", F.lit(99)), 7).first()
    assert row.n_test > 0 and 0 <= row.coverage_90 <= 1
    assert all(math.isfinite(row[c]) for c in ("pinball_p05", "pinball_p50", "pinball_p95", "mae"))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.0, 3.0)], "y double, f double")
    row = metrics.evaluate(df, "y", "f").first()
    assert row.mae == 2.5 and row.rmse == pytest.approx(math.sqrt(6.5))
    assert row.mape == pytest.approx((0.2 + 3.0) / 2 * 100)
    assert df.agg(metrics.pinball("y", "f", 0.9)).first()[0] == pytest.approx(0.25)
    assert df.agg(metrics.coverage("y", "y", "f")).first()[0] == 1.0


def test_temporal_split(spark, panel):
    train, test = metrics.temporal_split(panel, "date", 6)
    assert test.select("date").distinct().count() == 6
    assert train.count() + test.count() == panel.count()
    with pytest.raises(Exception, match="fewer than 500"):
        metrics.temporal_split(panel, "date", 500)[0].count()
