import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("panelcast-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return ROOT


@pytest.fixture(scope="session")
def fleet(spark):
    """Stored sessions, device-days and features of the small fleet."""
    from panelcast.operators import features_device as fd, sessions
    from panelcast.sources import adapters
    from panelcast.sources.storage import materialise

    f = adapters.fleet(spark, ROOT)
    devices = materialise(f.devices, "devices")
    billed = materialise(sessions.attach_billing(sessions.sessionise(f.events), devices), "sessions")
    days = materialise(sessions.device_day(f.events, billed), "days")
    features = materialise(fd.build_features(days, billed, devices), "features")
    return dict(devices=devices, events=f.events, sessions=billed, days=days, features=features)


@pytest.fixture(scope="session")
def panel(spark):
    """Seeded seasonal series: 6 trusts x 4 codes x 72 months with trend, season and noise."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    months = pd.date_range("2018-01-01", periods=72, freq="MS")
    rows = []
    for t in range(6):
        for c in range(4):
            level = 60 + 40 * t + 25 * c
            season = 1 + 0.25 * np.sin(2 * np.pi * (months.month.to_numpy() + c) / 12)
            trend = 1 + 0.004 * np.arange(72)
            y = np.maximum(0, np.round(level * season * trend * (1 + 0.05 * rng.standard_normal(72))))
            rows += [(d.date(), f"T{t}", f"R{t % 2}", f"F{c % 2}", f"C{c}", int(v)) for d, v in zip(months, y)]
    return spark.createDataFrame(
        rows, "date date, trust_code string, region string, opcs_chapter string, procedure_code string, n_procedures bigint")
