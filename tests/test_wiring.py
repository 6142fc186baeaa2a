"""Feeds that fall back, the waiting-list chain, and options of the monthly operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelcast.operators import demand, features_monthly as fm, scenarios, sessions
from panelcast.operators.quality import failed_errors
from panelcast.schemas import DATASETS
from panelcast.sources import conform, storage

D = datetime.date


def _activity(spark):
    rows = [(D(2020, 1, 1), "T1", "R1", "gp", 5), (D(2020, 2, 1), "T1", "R1", "gp", 6)]
    return spark.createDataFrame(rows, "date date, trust_code string, region string, activity_type string, n_activity bigint")


def _csv(spark, df):
    path = storage.scratch_path(spark, "feed-test")
    df.write.option("header", "true").csv(path)
    return path


def test_empty_and_unparsable_feeds_fall_back(spark):
    good = storage.scratch_path(spark, "feed-good")
    _activity(spark).write.parquet(good)
    kept = _csv(spark, _activity(spark))
    bad = _csv(spark, _activity(spark).withColumn("n_activity", F.lit("n/a")))
    empty = storage.scratch_path(spark, "feed-empty")
    _activity(spark).limit(0).write.parquet(empty)
    junk = storage.scratch_path(spark, "feed-junk")
    _activity(spark).select(F.lit("not parquet")).write.text(junk)
    fallback_csv = _csv(spark, _activity(spark))
    for path, fmt, kind, says in ((kept, "csv", "live", kept), (bad, "csv", "fallback", "unparsable cells in n_activity"),
                                  (empty, "parquet", "fallback", "empty feed"), (junk, "parquet", "fallback", ""),
                                  (good + "-absent", "parquet", "fallback", "PATH_NOT_FOUND")):
        feed = conform.Feed(path, fallback_csv if fmt == "csv" else good, fmt)
        df, (name, got, detail) = conform.load_dataset(spark, "activity", feed)
        assert (name, got) == ("activity", kind) and says in detail, detail
        assert df.count() == 2 and df.columns == DATASETS["activity"].fieldNames()


def test_waiting_list_chain(spark):
    """National workbook rows, required and split top-down; without dated rows the feed falls back."""
    shares = spark.createDataFrame([("T1", "R1", 1.0), ("T2", "R1", 3.0)], "trust_code string, region string, size double")
    sheet = spark.createDataFrame([("title", None, None, 0), ("2020-01-01", None, "800", 1), ("2020-03-01", "1600", "9", 2)],
                                  "c2 string, c7 string, c8 string, row_no int")
    live, other = storage.scratch_path(spark, "sheet"), storage.scratch_path(spark, "sheet-none")
    sheet.write.parquet(live)
    sheet.where("row_no = 0").write.parquet(other)
    back = storage.scratch_path(spark, "sheet-back")
    spark.createDataFrame([], DATASETS["rtt"]).write.parquet(back)
    build = lambda s: conform.waiting_from_sheet(s, shares, ["F1", "F2"])
    df, entry = conform.load_dataset(spark, "rtt", conform.Feed(live, back, build=build))
    assert entry == ("rtt", "live", live)
    got = {(r.date, r.trust_code, r.treatment_function): r.waiting_list_size for r in df.collect()}
    assert got[D(2020, 1, 1), "T2", "F1"] == 300 and got[D(2020, 2, 1), "T1", "F2"] == 100 and len(got) == 12
    _, entry = conform.load_dataset(spark, "rtt", conform.Feed(other, back, build=build))
    assert entry[1] == "fallback" and "no dated rows" in entry[2]


def test_backlog_by_family(spark):
    fc = spark.createDataFrame([(D(2020, 1, 1), c, y, y - 1.0, y + 1.0) for c, y in (("A", 30.0), ("B", 10.0), ("C", 60.0), ("X", 5.0))],
                               "date date, procedure_code string, yhat double, yhat_lower double, yhat_upper double")
    waiting = spark.createDataFrame([(D(2019, 12, 1), "T", "F1", 1200), (D(2019, 12, 1), "T", "F2", 120)],
                                    "date date, trust_code string, treatment_function string, waiting_list_size bigint")
    families = spark.createDataFrame([("A", "F1"), ("B", "F1"), ("C", "F2")], "procedure_code string, treatment_function string")
    out = scenarios.backlog_clear(fc, waiting, 1, 0.5, families)
    assert {r.procedure_code: r.yhat for r in out.collect()} == {"A": 480.0, "B": 160.0, "C": 120.0, "X": 5.0}
    whole = scenarios.backlog_clear(fc, waiting, 1, 0.5)
    assert whole.agg(F.sum("yhat")).first()[0] == pytest.approx(105 + 660)


def test_lags_on_a_month_spine(spark):
    rows = [(D(2020, 1, 1), "T", "C", 5), (D(2020, 3, 1), "T", "C", 7)]
    df = spark.createDataFrame(rows, "date date, trust_code string, procedure_code string, n_procedures bigint")
    plain = {r.date: r.n_procedures_lag1 for r in fm.lags_and_rolls(df).collect()}
    dense = {r.date: (r.n_procedures, r.n_procedures_lag1, r.n_procedures_lag2) for r in fm.lags_and_rolls(df, densify=True).collect()}
    assert plain[D(2020, 3, 1)] == 5
    assert dense[D(2020, 2, 1)] == (0, 5, None) and dense[D(2020, 3, 1)] == (7, 0, 5)


def test_negative_exposure_is_reported(spark):
    rows = [("d1", D(2020, 1, 1), 2.0), ("d2", D(2020, 1, 1), -1.5)]
    exposed = spark.createDataFrame(rows, "device_id string, date date, exposure_hours double")
    assert sessions.check_exposure(exposed.where("exposure_hours > 0")).where("NOT passed").count() == 0
    failed = sessions.check_exposure(exposed).where("NOT passed").collect()
    assert len(failed) == 1 and "exposure_hours" in str(failed[0])


def test_equipment_file(spark):
    path = storage.scratch_path(spark, "equipment-test")
    demand.load_equipment(spark).write.option("header", "true").csv(path)
    assert sorted(map(tuple, demand.load_equipment(spark, path).collect())) == sorted(map(tuple, demand.load_equipment(spark).collect()))
