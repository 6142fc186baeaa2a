"""Reporting queries over forecasts, demand, the price book and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.panel import scalar

MAX_LIMIT = 20_000


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max("run_id").alias("run_id"))


def _select_run(df: DataFrame, run_id: str | None, predicates: dict[str, object | None]) -> DataFrame:
    chosen: Column = F.lit(run_id) if run_id is not None else scalar(df, F.max("run_id"))
    out = df.where(F.col("run_id") == chosen)
    for column, value in predicates.items():
        if value is not None:
            out = out.where(F.col(column) == value)
    return out


def _page(df: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    if not 0 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 0 and {MAX_LIMIT}")
    return df.orderBy(*order).limit(limit)


def equipment_demand(
    df: DataFrame, scenario: str = "baseline", level: str = "national", equipment_type: str | None = None,
    region: str | None = None, trust_code: str | None = None, run_id: str | None = None, limit: int = 1000,
) -> DataFrame:
    """One run's demand by date; the newest run unless one is named. Ties are broken by the keys."""
    rows = _select_run(df, run_id, {
        "scenario": scenario, "level": level, "equipment_type": equipment_type, "region": region,
        "trust_code": trust_code})
    return _page(rows, ["date", "equipment_type", "region", "trust_code"], limit)


def procedure_forecast(
    df: DataFrame, level: str = "national", procedure_code: str | None = None, trust_code: str | None = None,
    run_id: str | None = None, limit: int = 1000,
) -> DataFrame:
    rows = _select_run(df, run_id, {"level": level, "procedure_code": procedure_code, "trust_code": trust_code})
    return _page(rows, ["date", "procedure_code", "region", "trust_code", "model"], limit)


def demand_by_date(equipment: DataFrame) -> DataFrame:
    return equipment.groupBy("date", "equipment_type").agg(
        F.sum("demand").alias("demand"), F.sum("demand_lower").alias("lower"), F.sum("demand_upper").alias("upper"))


def horizon_totals(equipment: DataFrame) -> DataFrame:
    return equipment.groupBy("equipment_type").agg(F.sum("demand").alias("demand")).orderBy("demand", "equipment_type")


def top_concentration(book: DataFrame, k: int = 15) -> DataFrame:
    return book.orderBy(F.desc("op_herfindahl"), "device_id").limit(k)


def lowest_utilisation(book: DataFrame, k: int = 15) -> DataFrame:
    return book.orderBy("uar_p5_sessions", "device_id").limit(k)


def by_margin(book: DataFrame) -> DataFrame:
    return book.orderBy("expected_margin_gbp", "device_id")


def national_history(procedures: DataFrame) -> DataFrame:
    return procedures.groupBy("date").agg(F.sum("n_procedures").alias("n_procedures"))


def top_members(procedures: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest members by volume: a top-k over one row per member."""
    return procedures.groupBy(key).agg(F.sum("n_procedures").alias("volume")).orderBy(
        F.desc("volume"), key).limit(k).select(key)


def _history_and_band(history: DataFrame, forecast: DataFrame, key: str) -> DataFrame:
    past = history.groupBy(key, "date").agg(F.sum("n_procedures").cast("double").alias("history"))
    ahead = forecast.groupBy(key, "date").agg(*[F.sum(c).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])
    return past.join(ahead, [key, "date"], "full")


def top_codes(procedures: DataFrame, forecast: DataFrame, k: int = 4) -> DataFrame:
    """History and national band of the k largest codes."""
    chosen = top_members(procedures, "procedure_code", k)
    return _history_and_band(
        procedures.join(chosen, "procedure_code", "left_semi"),
        forecast.where(F.col("level") == "national").join(chosen, "procedure_code", "left_semi"), "procedure_code")


def top_trusts(procedures: DataFrame, forecast: DataFrame, k: int = 6) -> DataFrame:
    """History and summed band of the k largest trusts."""
    chosen = top_members(procedures, "trust_code", k)
    return _history_and_band(
        procedures.join(chosen, "trust_code", "left_semi"),
        forecast.where(F.col("level") == "trust").join(chosen, "trust_code", "left_semi"), "trust_code")


def _slice(equipment: DataFrame, level: str, scenario: str | None = "baseline") -> DataFrame:
    rows = equipment.where(F.col("level") == level)
    return rows if scenario is None else rows.where(F.col("scenario") == scenario)


def demand_pivot(equipment: DataFrame, equipment_types: Sequence[str]) -> DataFrame:
    return _slice(equipment, "national").groupBy("date").pivot("equipment_type", list(equipment_types)).agg(
        F.sum("demand"))


def scenario_totals(equipment: DataFrame) -> DataFrame:
    return _slice(equipment, "national", None).groupBy("scenario", "date").agg(F.sum("demand").alias("demand"))


def waiting_pressure(waiting: DataFrame) -> DataFrame:
    return waiting.groupBy("date").agg(
        (F.sum("waiting_list_size") / 1e6).alias("waiting_millions"), F.avg("pct_within_18wk").alias("pct_within_18wk"))


def regional_demand(equipment: DataFrame) -> DataFrame:
    return _slice(equipment, "regional").groupBy("region", "date").agg(F.sum("demand").alias("demand"))


def region_equipment_mean(equipment: DataFrame, equipment_types: Sequence[str]) -> DataFrame:
    return _slice(equipment, "regional").groupBy("region").pivot("equipment_type", list(equipment_types)).agg(
        F.avg("demand"))


def trust_ranking(equipment: DataFrame) -> DataFrame:
    return _slice(equipment, "trust").groupBy("trust_code", "region").agg(
        F.sum("demand").alias("demand")).orderBy("demand", "trust_code")


def regional_history_pivot(procedures: DataFrame, regions: Sequence[str]) -> DataFrame:
    return procedures.groupBy("date").pivot("region", list(regions)).agg(F.sum("n_procedures")).fillna(0)


def model_comparison(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("rmse", "model")


def portfolio_table(summary: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """The one-row summary as (metric, value) rows."""
    return summary.select(*[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [], list(metrics), "metric", "value")


def price_adequacy(book: DataFrame) -> DataFrame:
    return book.select(
        "device_id", "current_price_gbp", "suggested_price_gbp",
        (F.col("suggested_price_gbp") > F.col("current_price_gbp")).alias("under_priced"))
