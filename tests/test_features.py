import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import features_monthly as fm
from panelcast.functions import panel as pn

TABLE = {"F0": "A", "F1": "A"}


def inputs(spark, panel):
    waiting = panel.select("date", "trust_code", "region").distinct().select(
        "date", "trust_code", "region", F.lit("A").alias("treatment_function"),
        (100 + F.pmod(F.hash("date", "trust_code"), F.lit(7))).cast("bigint").alias("waiting_list_size"), F.lit(50.0).alias("pct_within_18wk"))
    years = panel.select(F.year("date").alias("year"), "region").distinct().where("year <> 2020")
    demo = years.select("year", "region", F.explode(F.array(F.lit("65-79"), F.lit("0-17"))).alias("age_band")).withColumn(
        "population", F.when(F.col("age_band") == "65-79", F.col("year") - 2000).otherwise(100).cast("bigint"))
    return waiting, demo


def build(spark, panel, **kw):
    waiting, demo = inputs(spark, panel)
    return fm.build_feature_table(panel, waiting, demo, TABLE, **kw)


def test_all_features_present_with_warmup(spark, panel):
    out = build(spark, panel)
    assert len(fm.FEATURE_COLUMNS) == 24
    assert set(fm.FEATURE_COLUMNS) <= set(out.columns)
    assert out.count() == panel.count()
    assert out.where("n_procedures_lag12 is null").count() == 24 * 12
    assert out.where("n_procedures_rollmean12 is null").count() == 24 * 12


def test_no_leakage(spark, panel):
    """Changing y at the last month leaves that month's lagged inputs as they were."""
    last = panel.agg(F.max("date")).first()[0]
    moved = panel.withColumn(
        "n_procedures", F.when(F.col("date") == last, F.col("n_procedures") * 3 + 17).otherwise(F.col("n_procedures")))
    safe = [c for c in fm.FEATURE_COLUMNS if c != "proc_mix_share"] + ["date", "proc_mix_share_lag1"]
    a, b = build(spark, panel).select(safe), build(spark, moved).select(safe)
    assert a.exceptAll(b).count() == 0


def test_rolling_matches_pandas(spark, panel):
    out = build(spark, panel).where("trust_code = 'T1' and procedure_code = 'C2'").orderBy("date").toPandas()
    y = out["n_procedures"].astype(float)
    for w in (3, 6, 12):
        want = y.shift(1).rolling(w)
        assert out[f"n_procedures_rollmean{w}"].dropna().to_numpy() == pytest.approx(want.mean().dropna().to_numpy())
        assert out[f"n_procedures_rollstd{w}"].dropna().to_numpy() == pytest.approx(want.std().dropna().to_numpy())


def test_pressure_lag_modes(spark, panel):
    keys = ["trust_code", "procedure_code", "date"]
    safe = build(spark, panel).where("trust_code = 'T0'").select(*keys, "wl_size_lag1").toPandas()
    compat = build(spark, panel, compat=True).where("trust_code = 'T0'").select(
        *keys, "treatment_function", "wl_size", "wl_size_lag1").toPandas()
    assert safe.groupby("procedure_code")["wl_size_lag1"].apply(lambda s: s.isna().sum()).tolist() == [1, 1, 1, 1]
    ordered = compat.sort_values(["procedure_code", "date"])
    want = ordered.groupby(["trust_code", "treatment_function"])["wl_size"].shift(1)
    assert ordered["wl_size_lag1"].isna().sum() == 1
    pd.testing.assert_series_equal(ordered["wl_size_lag1"], want, check_names=False, check_dtype=False)


def test_older_share_is_carried_over_missing_years(spark, panel):
    out = build(spark, panel)
    shares = {r.y: r.s for r in out.groupBy(F.year("date").alias("y")).agg(F.max("pop_65plus_share").alias("s")).collect()}
    assert shares[2019] == pytest.approx(19 / 119)
    assert shares[2020] == pytest.approx(shares[2019])
    assert shares[2021] == pytest.approx(21 / 121)


def test_mix_share_sums_to_one_and_zero_total_is_null(spark, panel):
    out = fm.mix_share(panel).groupBy("trust_code", "date").agg(F.sum("proc_mix_share").alias("s"))
    assert out.where("abs(s - 1) > 1e-9").count() == 0
    zero = fm.mix_share(panel.withColumn("n_procedures", F.lit(0).cast("bigint")))
    assert zero.where("proc_mix_share is not null").count() == 0


def test_group_total_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    rows = pn.with_group_total(df, ["k"], {"t": F.sum("v")}).collect()
    assert sorted((r.v, r.t) for r in rows) == [(1, 3), (2, 3), (5, 5)]


def test_densify(spark):
    d = datetime.date
    df = spark.createDataFrame([("a", d(2020, 1, 1), 4), ("b", d(2020, 3, 1), 7)], "k string, date date, v int")
    rows = pn.densify_months(df, ["k"], "v").orderBy("k", "date").collect()
    assert [(r.k, r.date.month, r.v) for r in rows] == [
        ("a", 1, 4), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 0), ("b", 3, 7)]


def test_category_codes_are_alphabetical(spark, panel):
    rows = fm.encode_categories(panel).select("trust_code", "trust_code_idx").distinct().collect()
    assert {r.trust_code: int(r.trust_code_idx) for r in rows} == {f"T{i}": i for i in range(6)}


def test_feature_windows_share_one_sort(spark, panel):
    """All series windows run over one exchange by series and one sort."""
    plan = fm.lags_and_rolls(panel)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(trust_code") == 1
    assert plan.count("Sort [trust_code") == 1


def test_category_codes_are_dense_and_ordered(spark):
    """Numbers run through all partitions; NULL and values of other data get the last code."""
    names = [f"n{i:04d}" for i in range(500)]
    rows = [(n, f"g{i % 3}") for i, n in enumerate(names)] * 2 + [(None, "g0")]
    df = spark.createDataFrame(rows, "name string, grp string").repartition(5)
    codes = fm.category_codes(df, ["name", "grp"])
    found = {(r.kind, r.name): r.code for r in codes.collect()}
    assert [found["name", n] for n in names] == list(range(500)) and [found["grp", f"g{i}"] for i in range(3)] == [0, 1, 2]
    new = spark.createDataFrame([("n0007", "g2"), ("other", None)], "name string, grp string")
    got = fm.encode_categories(new, ["name", "grp"], codes).collect()
    assert {(r.name, r.name_idx, r.grp_idx) for r in got} == {("n0007", 7.0, 2.0), ("other", 500.0, 3.0)}
    empty = fm.encode_categories(new.limit(0), ["name"])
    assert empty.columns == ["name", "grp", "name_idx"] and empty.count() == 0
