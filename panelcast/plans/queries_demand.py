"""Registered queries: monthly features, forecasting, hierarchy, mapping, scenarios."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import metrics
from panelcast.functions.panel import rounded, series_window
from panelcast.operators import (
    backtest, demand, features_monthly as fm, hierarchy, naive, pooled, pooled_trees, quantile_trees, scenarios,
    seasonal, window_ar, window_net,
)
from panelcast.operators.boosting import Forest, forest_of
from panelcast.plans.registry import query
from panelcast.sources import adapters
from panelcast.sources.storage import materialise

LEAF_KEYS = ["trust_code", "region", "procedure_code"]
HORIZON = 12


def facts(spark: SparkSession, root: str) -> DataFrame:
    """Monthly procedures written once: operators that read their input more than once read the
    small aggregate again, not the line items."""
    return materialise(adapters.procedures(spark, root), "procedures")


def base_forecast(spark: SparkSession, root: str) -> DataFrame:
    """Seasonal-naive band for the last 12 months, at the leaf."""
    return naive.seasonal_naive_holdout(facts(spark, root), LEAF_KEYS, fm.TARGET, HORIZON)


def feature_table(spark: SparkSession, root: str, compat: bool = False) -> DataFrame:
    return fm.build_feature_table(
        facts(spark, root), adapters.rtt(spark, root), adapters.demographics(spark, root),
        adapters.CHAPTER_TO_FUNCTION, adapters.OLDER_SEGMENTS, compat)


def mapping(spark: SparkSession) -> DataFrame:
    return demand.check_mapping(adapters.mapping_rows(spark))


def _pressed(spark: SparkSession, root: str) -> DataFrame:
    base = fm.treatment_function(facts(spark, root), adapters.CHAPTER_TO_FUNCTION)
    return fm.pressure(base, adapters.rtt(spark, root))


@query
def c1_calendar(spark: SparkSession, root: str) -> DataFrame:
    return rounded(fm.calendar(facts(spark, root)).select(
        "date", "trust_code", "procedure_code", "month", "quarter", "year", "sin_month", "cos_month", "time_idx"))


@query
def c2_lags(spark: SparkSession, root: str) -> DataFrame:
    out = fm.lags_and_rolls(adapters.procedures(spark, root))
    return out.select("date", "trust_code", "procedure_code", *[c for c in out.columns if "_lag" in c])


@query
def c3_rolling(spark: SparkSession, root: str) -> DataFrame:
    out = fm.lags_and_rolls(adapters.procedures(spark, root))
    return rounded(out.select("date", "trust_code", "procedure_code", *[c for c in out.columns if "_roll" in c]))


@query
def c4_mix_share(spark: SparkSession, root: str) -> DataFrame:
    return rounded(fm.mix_share(facts(spark, root)).select(
        "date", "trust_code", "procedure_code", "proc_mix_share"))


@query
def c5_treatment_function(spark: SparkSession, root: str) -> DataFrame:
    return fm.treatment_function(adapters.procedures(spark, root), adapters.CHAPTER_TO_FUNCTION).select(
        "date", "trust_code", "procedure_code", "treatment_function")


@query
def c6_pressure(spark: SparkSession, root: str) -> DataFrame:
    return rounded(_pressed(spark, root).select("date", "trust_code", "procedure_code", "wl_size", "wl_pct_18wk"))


@query
def c7_pressure_lag(spark: SparkSession, root: str) -> DataFrame:
    return rounded(fm.pressure_lag(_pressed(spark, root)).select(
        "date", "trust_code", "procedure_code", "wl_size_lag1", "wl_pct_18wk_lag1"))


@query
def c7_pressure_lag_compat(spark: SparkSession, root: str) -> DataFrame:
    return rounded(fm.pressure_lag(_pressed(spark, root), compat=True).select(
        "date", "trust_code", "procedure_code", "wl_size_lag1", "wl_pct_18wk_lag1"))


@query
def c8_older_share(spark: SparkSession, root: str) -> DataFrame:
    return rounded(fm.older_share(adapters.demographics(spark, root), adapters.OLDER_SEGMENTS))


@query
def c9_older_share_filled(spark: SparkSession, root: str) -> DataFrame:
    shares = fm.older_share(adapters.demographics(spark, root), adapters.OLDER_SEGMENTS)
    dated = fm.calendar(facts(spark, root))
    return rounded(fm.attach_older_share(dated, shares).select(
        "date", "trust_code", "procedure_code", "pop_65plus_share"))


@query
def c10_category_codes(spark: SparkSession, root: str) -> DataFrame:
    out = fm.encode_categories(adapters.procedures(spark, root))
    codes = [F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in fm.CATEGORICAL]
    return out.select("date", "trust_code", "procedure_code", *codes)


@query
def c11_feature_vector(spark: SparkSession, root: str) -> DataFrame:
    """The numeric feature contract as a vector, shown by its length and its number of known cells."""
    from pyspark.ml.functions import vector_to_array

    numeric = feature_table(spark, root).withColumns({c: F.col(c).cast("double") for c in fm.NUMERIC})
    cells = vector_to_array("features")
    return fm.assemble(numeric, fm.NUMERIC).select(
        "date", "trust_code", "procedure_code", F.size(cells).alias("n_features"),
        F.size(F.filter(cells, lambda v: ~F.isnan(v))).alias("n_known"))


@query
def c12_feature_table(spark: SparkSession, root: str) -> DataFrame:
    return rounded(feature_table(spark, root).select("date", *fm.FEATURE_COLUMNS, fm.TARGET, "proc_mix_share_lag1"))


@query
def c12_feature_table_compat(spark: SparkSession, root: str) -> DataFrame:
    return rounded(feature_table(spark, root, compat=True).select("date", *fm.FEATURE_COLUMNS, fm.TARGET))


# ---------------------------------------------------------------- forecasting

@query
def d1_tag(spark: SparkSession, root: str) -> DataFrame:
    return rounded(naive.tag(base_forecast(spark, root), model="naive", run_id="run-1").drop("actual"), 4)


@query
def d2_mae(spark: SparkSession, root: str) -> DataFrame:
    return rounded(base_forecast(spark, root).groupBy("procedure_code").agg(metrics.mae("actual", "yhat").alias("mae")))


@query
def d3_rmse(spark: SparkSession, root: str) -> DataFrame:
    return rounded(base_forecast(spark, root).groupBy("procedure_code").agg(
        metrics.rmse("actual", "yhat").alias("rmse")))


@query
def d4_mape(spark: SparkSession, root: str) -> DataFrame:
    return rounded(base_forecast(spark, root).groupBy("procedure_code").agg(
        metrics.mape("actual", "yhat").alias("mape")))


@query
def d5_evaluate(spark: SparkSession, root: str) -> DataFrame:
    return rounded(metrics.evaluate(base_forecast(spark, root), "actual", "yhat"))


@query
def d6_temporal_split(spark: SparkSession, root: str) -> DataFrame:
    train, test = metrics.temporal_split(facts(spark, root), "date", HORIZON)
    return naive.tag(train, part="train").unionByName(naive.tag(test, part="test"))


@query
def d7_training_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = pooled.training_rows(fm.lags_and_rolls(adapters.procedures(spark, root)))
    return rows.select("date", "trust_code", "procedure_code", "n_procedures", "n_procedures_lag12")


@query
def d8_pooled_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Pooled quantile model fitted before the cutoff, as its coefficients over the holdout's size."""
    train, test = metrics.temporal_split(materialise(feature_table(spark, root), "features"), "date", HORIZON)
    model = pooled.train(train)
    rows = [(name, i, b) for name, beta in zip(pooled.QUANTILES, model.coefficients) for i, b in enumerate(beta)]
    n_test = test.agg(F.count("*").alias("n")).scalar()
    return spark.createDataFrame(rows, "quantile string, slot int, coefficient double").withColumn("n_test", n_test)


@query
def d8_pooled_trees(spark: SparkSession, root: str) -> DataFrame:
    """Boosted-tree forecast of the holdout months with conformal bands."""
    train, _ = metrics.temporal_split(materialise(feature_table(spark, root), "features"), "date", HORIZON)
    return pooled_trees.recursive_forecast(train, pooled_trees.train(train, HORIZON), HORIZON)


@query
def d8_quantile_trees(spark: SparkSession, root: str) -> DataFrame:
    """Boosted quantile forests (10, 50, 90 %) fitted before the cutoff, and their forecast of the holdout months."""
    train, _ = metrics.temporal_split(materialise(feature_table(spark, root), "features"), "date", HORIZON)
    return quantile_trees.forecast(train, HORIZON)


def given_forest() -> Forest:
    """Two trees for each quantile: last value above the level or not (missing: not), and first or second half-year."""
    at = {c: i for i, c in enumerate(quantile_trees.INPUTS)}
    edges = [np.array({"lag1": [1.0], "month": [6.0]}.get(c, [])) for c in quantile_trees.INPUTS]
    rows = []
    for q in range(3):
        for tree, (name, low, high) in enumerate((("lag1", -0.125, 0.125), ("month", 0.0625, -0.0625))):
            inner = dict(input=at[name], cut=0, missing_left=True, left=1, right=2, value=0.0)
            leaf = dict(input=-1, cut=0, missing_left=False, left=0, right=0)
            rows += [dict(quantile=q, tree=tree, node=n, **v) for n, v in enumerate((inner, leaf | {"value": low}, leaf | {"value": high}))]
    return forest_of(rows, tuple(pooled.QUANTILES.values()), edges, (0.5, 1.0, 1.5), 1.0)


@query
def d11_given_forest(spark: SparkSession, root: str) -> DataFrame:
    """Recursive forecast of all series by a given forest of two trees."""
    features = materialise(feature_table(spark, root), "features")
    none = spark.createDataFrame([], "kind string, name string, code double")
    model = quantile_trees.TreeForecaster(given_forest(), none, 1990)
    return rounded(quantile_trees.recursive_forecast(features, model, HORIZON), 3)


@query
def d9_ar_state(spark: SparkSession, root: str) -> DataFrame:
    base = adapters.procedures(spark, root)
    history = base.groupBy("trust_code", "procedure_code").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", F.col("n_procedures").cast("double").alias("v")))),
                    lambda s: s["v"]).alias("history"))
    ar = pooled.ar_features(F.col("history"))
    return rounded(history.select("trust_code", "procedure_code", *[c.alias(n) for n, c in ar.items()]))


@query
def d10_driver_state(spark: SparkSession, root: str) -> DataFrame:
    state = pooled.series_state(feature_table(spark, root))
    return rounded(state.select(
        "trust_code", "procedure_code", "last_date",
        *[F.col(f"last.{c}").alias(c) for c in ("region", "opcs_chapter", *pooled.DRIVERS)]))


@query
def d11_recursive_forecast(spark: SparkSession, root: str) -> DataFrame:
    train, _ = metrics.temporal_split(materialise(feature_table(spark, root), "features"), "date", HORIZON)
    return pooled.recursive_forecast(train, pooled.train(train), HORIZON)


@query
def d12_monotone_band(spark: SparkSession, root: str) -> DataFrame:
    """Three raw values per row, clipped at zero and ordered."""
    w = series_window(fm.SERIES, ["date"])
    y = F.col("n_procedures").cast("double")
    band = pooled.monotone(F.lag(y, 1).over(w) - 20, y - 40, F.lag(y, 2).over(w))
    known = F.lag(y, 2).over(w).isNotNull()
    rows = adapters.procedures(spark, root).select(
        "date", *fm.SERIES, F.when(known, band).alias("band")).where(F.col("band").isNotNull())
    return rows.select("date", *fm.SERIES, F.col("band")[0].alias("yhat_lower"),
                       F.col("band")[1].alias("yhat"), F.col("band")[2].alias("yhat_upper"))


@query
def d13_seasonal(spark: SparkSession, root: str) -> DataFrame:
    national = adapters.procedures(spark, root).groupBy("procedure_code", "date").agg(
        F.sum("n_procedures").alias("n_procedures"))
    return seasonal.forecast(national, HORIZON).where(F.col("error").isNull()).drop("error")


@query
def d14_seasonal_fanout(spark: SparkSession, root: str) -> DataFrame:
    """One fit per trust and code; short or failing series are reported with their reason."""
    return seasonal.forecast(adapters.procedures(spark, root), HORIZON, fm.SERIES)


@query
def d15_windows(spark: SparkSession, root: str) -> DataFrame:
    out = window_ar.windows(adapters.procedures(spark, root), fm.SERIES, "n_procedures", 12)
    return out.select(
        "date", *fm.SERIES, F.col("n_procedures").alias("next_value"), F.col("window")[0].alias("oldest"),
        F.col("window")[11].alias("newest"),
        F.aggregate("window", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("window_sum"))


@query
def d16_zscore(spark: SparkSession, root: str) -> DataFrame:
    return rounded(window_ar.standardise(facts(spark, root), fm.SERIES, "n_procedures"), 5)


@query
def d17_window_forecast(spark: SparkSession, root: str) -> DataFrame:
    return window_ar.forecast(facts(spark, root), HORIZON)


@query
def d17_network_forecast(spark: SparkSession, root: str) -> DataFrame:
    """The same by a small network on the windows of all series."""
    return window_net.forecast(facts(spark, root), HORIZON)


@query
def d18_backtest(spark: SparkSession, root: str) -> DataFrame:
    return backtest.backtest(materialise(feature_table(spark, root), "features"), HORIZON)


@query
def d19_full_forecast(spark: SparkSession, root: str) -> DataFrame:
    return pooled.forecast(materialise(feature_table(spark, root), "features"), HORIZON)


@query
def d20_bottom_up(spark: SparkSession, root: str) -> DataFrame:
    return rounded(hierarchy.bottom_up(base_forecast(spark, root)), 4)


@query
def d20_bottom_up_independent(spark: SparkSession, root: str) -> DataFrame:
    return rounded(hierarchy.bottom_up(base_forecast(spark, root), interval="independent"), 4)


@query
def d21_middle_out(spark: SparkSession, root: str) -> DataFrame:
    regional = hierarchy.bottom_up(base_forecast(spark, root)).where(F.col("level") == "regional")
    return rounded(hierarchy.middle_out(regional, adapters.procedures(spark, root)), 4)


@query
def d22_seasonal_naive(spark: SparkSession, root: str) -> DataFrame:
    return rounded(base_forecast(spark, root), 4)


@query
def d22_seasonal_naive_future(spark: SparkSession, root: str) -> DataFrame:
    return rounded(naive.seasonal_naive_forecast(
        facts(spark, root), LEAF_KEYS, fm.TARGET, HORIZON), 4)


# ---------------------------------------------------------------- mapping, demand, scenarios

@query
def e1_mapping_matrix(spark: SparkSession, root: str) -> DataFrame:
    """Weight matrix of the codes that occur in the data."""
    seen = adapters.table(spark, root, "part").select(F.col("p_brand").alias("procedure_code")).distinct()
    return demand.mapping_matrix(mapping(spark), adapters.EQUIPMENT_TYPES).join(seen, "procedure_code", "left_semi")


@query
def e2_apply_mapping(spark: SparkSession, root: str) -> DataFrame:
    levels = naive.tag(hierarchy.bottom_up(base_forecast(spark, root)), run_id="run-1", model="naive")
    return rounded(demand.apply_mapping(levels, mapping(spark)), 4)


@query
def e3_equipment_demand(spark: SparkSession, root: str) -> DataFrame:
    return rounded(demand.equipment_demand(hierarchy.bottom_up(base_forecast(spark, root)), mapping(spark)), 4)


@query
def e4_baseline(spark: SparkSession, root: str) -> DataFrame:
    return rounded(scenarios.baseline(base_forecast(spark, root)).drop("actual"), 4)


@query
def e5_backlog_clear(spark: SparkSession, root: str) -> DataFrame:
    out = scenarios.backlog_clear(base_forecast(spark, root), adapters.rtt(spark, root), clear_months=6)
    return rounded(out.drop("actual"), 4)


@query
def e6_capacity_cap(spark: SparkSession, root: str) -> DataFrame:
    return rounded(scenarios.capacity_cap(base_forecast(spark, root)).drop("actual"), 4)


@query
def e7_demand_shock(spark: SparkSession, root: str) -> DataFrame:
    return rounded(scenarios.demand_shock(base_forecast(spark, root), -0.15).drop("actual"), 4)


def equipment(spark: SparkSession, root: str) -> DataFrame:
    leaf = materialise(base_forecast(spark, root).drop("actual"), "leaf")
    return scenarios.sweep(leaf, scenarios.default_scenarios(adapters.rtt(spark, root)), mapping(spark))


@query
def e8_scenario_sweep(spark: SparkSession, root: str) -> DataFrame:
    return rounded(equipment(spark, root), 4)
