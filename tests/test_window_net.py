"""The network on windows against the linear window model, on a series that is not linear."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import window_ar, window_net
from panelcast.sources.storage import materialise


def _map(rng, n):
    """A noisy quadratic map: the next value depends on the last one, but has no correlation with it."""
    y = [rng.uniform(-0.5, 0.5)]
    for _ in range(n - 1):
        y.append(float(np.clip(1 - 1.7 * y[-1] ** 2 + 0.05 * rng.normal(), -1, 1)))
    return y


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    start = datetime.date(2000, 1, 1)
    rows = [(f"s{k}", start.replace(year=2000 + i // 12, month=1 + i % 12), 100 + 10 * v)
            for k in range(8) for i, v in enumerate(_map(rng, 120))]
    return materialise(spark.createDataFrame(rows, "k string, date date, v double"), "network-series")


def _error(model, spark, z):
    rows = window_ar.windows(z, ["k"], "z").withColumn("p", model.next_value(F.col("window")))
    return rows.agg(F.avg(F.abs(F.col("p") - F.col("z")))).first()[0]


def test_beats_the_linear_model_and_partitions_do_not_matter(spark, series):
    z = materialise(window_ar.standardise(series, ["k"], "v"), "network-z")
    late = z.where("date >= '2008-01-01'")
    train = z.where("date < '2008-01-01'")
    linear, net = window_ar.fit(train, ["k"]), window_net.fit(train.repartition(1), ["k"])
    assert _error(net, spark, late) < 0.6 * _error(linear, spark, late)
    other = window_net.fit(train.repartition(7), ["k"])
    window = np.random.default_rng(1).normal(size=(50, 12))
    assert other.values(window)[0] == pytest.approx(net.values(window)[0], abs=1e-3)


def test_columns_equal_numpy(spark):
    rng = np.random.default_rng(2)
    model = window_net.NetModel(rng.normal(size=13 + 6 * 14), 12)
    z = rng.normal(size=(5, 12))
    rows = spark.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(z)], "i int, w array<double>")
    got = [r.p for r in rows.select("i", model.next_value(F.col("w")).alias("p")).orderBy("i").collect()]
    assert got == pytest.approx(model.values(z)[0].tolist())


def test_no_windows_raise(spark, series):
    with pytest.raises(ArithmeticError, match="no windows"):
        window_net.fit(window_ar.standardise(series, ["k"], "v").limit(0), ["k"])


def test_forecast_contract(series):
    out = window_net.forecast(series, 6, ["k"], "v")
    assert out.count() == 8 * 6 and out.where("yhat_lower > yhat OR yhat > yhat_upper OR yhat IS NULL").count() == 0
