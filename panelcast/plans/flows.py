"""The two end-to-end jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import fixed_values
from panelcast.operators import backtest as bt
from panelcast.operators import count_model, pooled, risk, scenarios, sessions
from panelcast.operators.demand import load_equipment
from panelcast.operators.features_device import build_features
from panelcast.operators.features_monthly import build_feature_table
from panelcast.operators.hierarchy import bottom_up
from panelcast.operators.naive import tag
from panelcast.operators.quality import assert_no_errors, validate_all
from panelcast.schemas import DATASET_TABLE
from panelcast.sources import storage


@dataclass(frozen=True)
class DemandResult:
    run_id: str
    hierarchy: DataFrame
    equipment: DataFrame
    metrics: DataFrame
    report: DataFrame


def run_demand(
    datasets: Mapping[str, DataFrame], mapping: DataFrame, root: str, horizon: int = 12,
    chapter_table: Mapping[str, str] = fixed_values.CHAPTER_TO_FUNCTION,
    older_bands: Sequence[str] = fixed_values.OLDER_BANDS,
    provenance: Sequence[tuple[str, str, str]] = (), models: Sequence[str] = bt.FLOW_MODELS,
    run_scenarios: bool = True, run_id: str | None = None, equipment_dim: DataFrame | None = None,
) -> DemandResult:
    """Validate, land, load, build features, compare models, forecast, reconcile, map, store, report.

    Stages hand over through written tables: a lost executor costs at most the stage in hand.
    """
    spark = mapping.sparkSession
    run_id = run_id or storage.new_run_id()
    names = list(datasets)
    staged = dict(zip(names, storage.together(spark, *[partial(storage.materialise, datasets[n], n) for n in names])))
    assert_no_errors(validate_all(staged))

    lake, tables, artifacts = f"{root}/lake", f"{root}/tables", f"{root}/artifacts"

    def land(name: str) -> None:
        storage.write_snapshot(staged[name], lake, name)
        storage.replace_table(storage.read_latest(spark, lake, name), tables, DATASET_TABLE[name])

    storage.together(spark, *[partial(land, n) for n in names])
    stored = {t: storage.read_table(spark, tables, t) for t in DATASET_TABLE.values()}
    dim_date = storage.build_dim_date(
        stored[t] for t in ("fact_procedures", "fact_imaging", "fact_rtt", "fact_activity"))
    features_lazy = build_feature_table(
        stored["fact_procedures"], stored["fact_rtt"], stored["dim_demographics"], chapter_table, older_bands)
    features, *_ = storage.together(
        spark,
        partial(storage.materialise, features_lazy, "features"),
        partial(storage.replace_table, dim_date, tables, "dim_date"),
        partial(storage.replace_table, storage.build_dim_trust(stored["fact_procedures"]), tables, "dim_trust"),
        partial(storage.replace_table, mapping, tables, "dim_proc_equipment_map"),
        partial(storage.replace_table, load_equipment(spark) if equipment_dim is None else equipment_dim, tables, "dim_equipment"))
    if provenance:
        storage.record_provenance(spark, artifacts, run_id, provenance)

    metrics, leaf = storage.together(
        spark,
        lambda: storage.materialise(bt.backtest(features, horizon, models), "metrics"),
        lambda: storage.materialise(pooled.forecast(features, horizon), "leaf"))

    chosen = scenarios.default_scenarios(stored["fact_rtt"])
    if not run_scenarios:
        chosen = {"baseline": chosen["baseline"]}
    storage.together(
        spark,
        lambda: storage.append_run(
            tag(bottom_up(leaf), run_id=run_id, model="pooled"), tables, "forecast_procedures"),
        lambda: storage.append_run(
            tag(scenarios.sweep(leaf, chosen, mapping), run_id=run_id), tables, "forecast_equipment"))
    mine = F.col("run_id") == run_id
    hierarchy = storage.read_table(spark, tables, "forecast_procedures").where(mine)
    equipment = storage.read_table(spark, tables, "forecast_equipment").where(mine)

    model_entry = F.struct("mae", "rmse", "mape")
    sources = spark.createDataFrame(list(provenance) or [("none", "", "")], "source string, kind string, detail string")
    report = metrics.agg(
        F.map_from_entries(F.collect_list(F.struct("model", model_entry))).alias("backtest_metrics")).select(
            F.lit(run_id).alias("run_id"), F.current_timestamp().alias("generated_at"),
            F.lit(horizon).alias("horizon"),
            sources.agg(F.map_from_entries(F.collect_list(F.struct("source", "kind"))).alias("m")).scalar()
            .alias("data_provenance"),
            "backtest_metrics",
            hierarchy.agg(F.count("*").alias("n")).scalar().alias("n_procedure_forecast_rows"),
            equipment.agg(F.count("*").alias("n")).scalar().alias("n_equipment_forecast_rows"),
            F.array(*[F.lit(s) for s in chosen]).alias("scenarios"))
    storage.together(
        spark,
        lambda: storage.write_artifact(hierarchy.drop("run_id"), artifacts, "procedure_forecast", run_id),
        lambda: storage.write_artifact(equipment.drop("run_id"), artifacts, "equipment_forecast", run_id),
        lambda: storage.write_report(report, artifacts, "report", run_id))
    return DemandResult(run_id, hierarchy, equipment, metrics, spark.read.json(f"{artifacts}/report_latest"))


@dataclass(frozen=True)
class UnderwritingResult:
    run_id: str
    device_day: DataFrame
    forecast: DataFrame
    book: DataFrame
    portfolio: DataFrame
    report: DataFrame


def copula_loadings(device_day: DataFrame, lookback: int = 120) -> DataFrame:
    vectors = storage.materialise(risk.panel_vectors(risk.utilisation_panel(device_day, lookback)), "vectors")
    return risk.panel_loadings(vectors, risk.shrinkage(vectors))


def run_underwriting(
    devices: DataFrame, events: DataFrame, root: str, horizon_days: int = 28, n_sims: int = 4000,
    alpha: float = 0.05, seed: int = 8, quantiles: tuple[float, float, float] = (0.05, 0.5, 0.95),
    operators: DataFrame | None = None, run_id: str | None = None,
) -> UnderwritingResult:
    """Sessions, device-days, features, model, horizon forecast, simulation, price book, report."""
    spark = events.sparkSession
    run_id = run_id or storage.new_run_id()
    tables, artifacts = f"{root}/tables", f"{root}/artifacts"
    dimensions = [partial(storage.replace_table, devices, tables, "dim_device")]
    if operators is not None:
        dimensions.append(partial(storage.replace_table, operators, tables, "dim_operator"))
    storage.together(spark, partial(storage.replace_table, events, tables, "telemetry_event"), *dimensions)
    devices = storage.read_table(spark, tables, "dim_device")
    events = storage.read_table(spark, tables, "telemetry_event")

    billed = sessions.attach_billing(sessions.sessionise(events), devices)
    storage.replace_table(billed, tables, "fact_device_session")
    billed = storage.read_table(spark, tables, "fact_device_session")
    storage.replace_table(sessions.device_day(events, billed), tables, "fact_device_day")
    device_day = storage.read_table(spark, tables, "fact_device_day")

    features = storage.materialise(build_features(device_day, billed, devices), "device-features")
    def price() -> tuple[DataFrame, DataFrame, DataFrame]:
        model = count_model.fit(features)
        forecast = storage.materialise(
            risk.forecast_horizon(model, features, devices, horizon_days), "device-forecast")
        positions = storage.materialise(risk.book(forecast, devices, model.alpha, horizon_days), "positions")
        loadings = copula_loadings(device_day)
        draws = storage.materialise(risk.simulate(positions, loadings, n_sims, seed), "draws")
        storage.replace_run(risk.price_book(draws, positions, features, run_id), tables, "underwriting_device", run_id)
        return forecast, positions, draws

    metrics, (forecast, positions, draws) = storage.together(
        spark,
        lambda: storage.materialise(count_model.backtest(features, horizon_days, quantiles), "metrics"), price)
    book = storage.read_table(spark, tables, "underwriting_device").where(F.col("run_id") == run_id)
    portfolio = storage.materialise(risk.portfolio_summary(draws, positions, book, alpha), "portfolio")

    size = lambda df: df.agg(F.count("*").alias("n")).scalar()
    one_row = lambda df: df.select(F.struct("*").alias("s")).scalar()
    report = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("generated_at"),
        size(devices).alias("n_devices"), size(events).alias("n_events"), size(billed).alias("n_sessions"),
        size(device_day).alias("n_device_days"), F.lit(horizon_days).alias("horizon_days"),
        one_row(metrics).alias("backtest"), one_row(portfolio).alias("portfolio_risk"))
    outputs = {"telemetry_device_day": device_day, "telemetry_forecast": forecast, "underwriting": book.drop("run_id")}
    storage.together(
        spark,
        *[partial(storage.write_artifact, df, artifacts, name, run_id) for name, df in outputs.items()],
        partial(storage.write_report, report, artifacts, "telemetry_report", run_id))
    return UnderwritingResult(
        run_id, device_day, forecast, book, portfolio, spark.read.json(f"{artifacts}/telemetry_report_latest"))
