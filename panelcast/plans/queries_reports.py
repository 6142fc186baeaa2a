"""Registered queries: reports, and the two end-to-end flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import metrics
from panelcast.functions.panel import rounded
from panelcast.operators import hierarchy, naive, reports, risk
from panelcast.plans import flows
from panelcast.plans.queries_demand import base_forecast, equipment, mapping
from panelcast.plans.queries_device import _given, given_book
from panelcast.plans.registry import query
from panelcast.plans.queries_sources import staged_feeds
from panelcast.sources import adapters, conform
from panelcast.sources.storage import scratch_path

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SUMMARY_METRICS = (
    "expected_revenue_gbp", "fixed_cost_gbp", "expected_margin_gbp", "var_loss_gbp", "cvar_loss_gbp",
    "prob_book_loss")


def _runs(df: DataFrame) -> DataFrame:
    """Two stored runs, the older one on half the scale."""
    columns = [c for c in ("yhat", "yhat_lower", "yhat_upper", "demand", "demand_lower", "demand_upper")
               if c in df.columns]
    older = df.withColumns({c: F.col(c) / 2 for c in columns})
    return naive.tag(older, run_id="20240101T000000-aaaaaa").unionByName(
        naive.tag(df, run_id="20240201T000000-bbbbbb"))


def _levels(spark: SparkSession, root: str) -> DataFrame:
    return hierarchy.bottom_up(base_forecast(spark, root))


@query
def i1_latest_run(spark: SparkSession, root: str) -> DataFrame:
    return reports.latest_run(_runs(equipment(spark, root)))


@query
def i2_equipment_demand(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.equipment_demand(
        _runs(equipment(spark, root)), level="regional", equipment_type="scope", limit=50), 4)


@query
def i3_procedure_forecast(spark: SparkSession, root: str) -> DataFrame:
    stored = _runs(naive.tag(_levels(spark, root), model="naive"))
    return rounded(reports.procedure_forecast(stored, level="trust", procedure_code="Brand#7", limit=100), 4)


@query
def i4_demand_by_date(spark: SparkSession, root: str) -> DataFrame:
    rows = equipment(spark, root).where((F.col("scenario") == "baseline") & (F.col("level") == "national"))
    return rounded(reports.demand_by_date(rows), 3)


@query
def i5_horizon_totals(spark: SparkSession, root: str) -> DataFrame:
    rows = equipment(spark, root).where((F.col("scenario") == "capacity_cap") & (F.col("level") == "national"))
    return rounded(reports.horizon_totals(rows), 3)


@query
def i6_top_concentration(spark: SparkSession, root: str) -> DataFrame:
    return reports.top_concentration(given_book(spark, root)).select("device_id", "specialty", "op_herfindahl")


@query
def i7_lowest_utilisation(spark: SparkSession, root: str) -> DataFrame:
    return reports.lowest_utilisation(given_book(spark, root)).select("device_id", "specialty", "uar_p5_sessions")


@query
def i8_by_margin(spark: SparkSession, root: str) -> DataFrame:
    return reports.by_margin(given_book(spark, root)).select(
        "device_id", "site_id", "region", "expected_sessions", "expected_revenue_gbp", "expected_margin_gbp")


@query
def i9_national_history(spark: SparkSession, root: str) -> DataFrame:
    return reports.national_history(adapters.procedures(spark, root))


@query
def i10_top_codes(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.top_codes(adapters.procedures(spark, root), _levels(spark, root)), 3)


@query
def i11_demand_pivot(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.demand_pivot(equipment(spark, root), adapters.EQUIPMENT_TYPES), 3)


@query
def i12_scenario_totals(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.scenario_totals(equipment(spark, root)), 3)


@query
def i13_waiting_pressure(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.waiting_pressure(adapters.rtt(spark, root)))


@query
def i14_regional_demand(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.regional_demand(equipment(spark, root)), 3)


@query
def i15_region_equipment_mean(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.region_equipment_mean(equipment(spark, root), adapters.EQUIPMENT_TYPES))


@query
def i16_trust_ranking(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.trust_ranking(equipment(spark, root)), 3)


@query
def i17_top_trusts(spark: SparkSession, root: str) -> DataFrame:
    return rounded(reports.top_trusts(adapters.procedures(spark, root), _levels(spark, root)), 3)


@query
def i18_regional_history_pivot(spark: SparkSession, root: str) -> DataFrame:
    return reports.regional_history_pivot(adapters.procedures(spark, root), REGIONS)


@query
def i19_model_comparison(spark: SparkSession, root: str) -> DataFrame:
    """Last year's month against last year's month damped towards zero."""
    fc = base_forecast(spark, root)
    rows = [metrics.evaluate(fc.withColumn("f", F.col("yhat") * k), "actual", "f").withColumn("model", F.lit(name))
            for name, k in (("naive", 1.0), ("damped", 0.5))]
    return rounded(reports.model_comparison(rows[0].unionByName(rows[1])))


@query
def i20_portfolio_table(spark: SparkSession, root: str) -> DataFrame:
    positions, draws = _given(spark, root)
    return rounded(reports.portfolio_table(risk.tail_risk(draws, positions), SUMMARY_METRICS), 3)


@query
def i20_price_adequacy(spark: SparkSession, root: str) -> DataFrame:
    return reports.price_adequacy(given_book(spark, root))


@query
def flow_national_demand(spark: SparkSession, root: str) -> DataFrame:
    """National equipment demand per month with its 80 % band, baseline scenario."""
    from panelcast.operators.demand import equipment_demand

    national = _levels(spark, root).where(F.col("level") == "national")
    return rounded(reports.demand_by_date(equipment_demand(national, mapping(spark))), 3)


@query
def flow_monthly_demand(spark: SparkSession, root: str) -> DataFrame:
    """The whole monthly job from its feeds, as its stored equipment forecast."""
    data, provenance = conform.load_all(spark, staged_feeds(spark, root))
    return flows.run_demand(
        data, mapping(spark), scratch_path(spark, "flow"), 12, adapters.CHAPTER_TO_FUNCTION,
        adapters.OLDER_SEGMENTS, provenance).equipment.drop("run_id")


@query
def flow_underwriting(spark: SparkSession, root: str) -> DataFrame:
    """The whole underwriting job, as its price book."""
    fleet = adapters.fleet(spark, root)
    return flows.run_underwriting(
        fleet.devices, fleet.events, scratch_path(spark, "flow"), 7, 4000, operators=fleet.operators).book.drop("run_id")
