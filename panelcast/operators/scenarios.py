"""What-if transforms of the leaf forecast and the sweep over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.panel import scalar, with_group_total
from panelcast.operators.demand import equipment_demand
from panelcast.operators.hierarchy import VALUES, bottom_up

Scenario = Callable[[DataFrame], DataFrame]


def baseline(forecast: DataFrame) -> DataFrame:
    return forecast.withColumn("scenario", F.lit("baseline"))


def latest_backlog(waiting: DataFrame) -> DataFrame:
    """Newest list size per trust and treatment function."""
    return waiting.where(
        F.col("trust_code").isNotNull() & F.col("treatment_function").isNotNull()).groupBy(
            "trust_code", "treatment_function").agg(
                F.max_by("waiting_list_size", "date").alias("waiting_list_size"))


def backlog_clear(
    forecast: DataFrame, waiting: DataFrame, clear_months: int = 12, clear_frac: float = 0.3,
    families: DataFrame | None = None,
) -> DataFrame:
    """Work off a fraction of the newest backlog over the first months, spread by forecast share.

    With `families` (procedure_code, treatment_function; one row per code) the backlog of a treatment function is spread over
    the forecast of its own codes only; codes of no family stay as they are.
    """
    if families is not None:
        return _cleared_by_family(forecast, waiting, clear_months, clear_frac, families)
    backlog = scalar(latest_backlog(waiting), F.coalesce(F.sum("waiting_list_size").cast("double"), F.lit(0.0)))
    extra = backlog * clear_frac / max(clear_months, 1)
    # The first distinct dates come from a top-k, not from a ranking window over all rows.
    cleared = forecast.select("date").distinct().orderBy("date").limit(clear_months).withColumn(
        "cleared", F.lit(True))
    shared = with_group_total(forecast, ["date"], {"date_total": F.sum("yhat")}).join(cleared, "date", "left")
    uplift = F.when(
        F.coalesce("cleared", F.lit(False)),
        F.try_divide(F.col("yhat"), F.nullif("date_total", F.lit(0.0))) * extra).otherwise(0.0)
    return shared.withColumns({c: F.col(c) + uplift for c in VALUES}).drop("date_total", "cleared").withColumn(
        "scenario", F.lit("backlog_clear"))


def _cleared_by_family(forecast, waiting, clear_months, clear_frac, families) -> DataFrame:
    extra = latest_backlog(waiting).groupBy("treatment_function").agg(
        (F.sum("waiting_list_size").cast("double") * clear_frac / max(clear_months, 1)).alias("extra"))
    cleared = forecast.select("date").distinct().orderBy("date").limit(clear_months).withColumn("cleared", F.lit(True))
    family = families.select("procedure_code", "treatment_function").join(extra, "treatment_function", "left")
    placed = forecast.join(family, "procedure_code", "left").join(cleared, "date", "left")
    shared = with_group_total(placed, ["date", "treatment_function"], {"family_total": F.sum("yhat")})
    uplift = F.when(F.coalesce("cleared", F.lit(False)) & F.col("treatment_function").isNotNull(), F.coalesce(
        F.try_divide(F.col("yhat"), F.nullif("family_total", F.lit(0.0))) * F.col("extra"), F.lit(0.0))).otherwise(0.0)
    return shared.withColumns({c: F.col(c) + uplift for c in VALUES}).select(*forecast.columns).withColumn(
        "scenario", F.lit("backlog_clear"))


def capacity_cap(forecast: DataFrame, max_growth: float = 0.05) -> DataFrame:
    """Cap every column at the series' first forecast grown by ``max_growth`` a year."""
    keys = [c for c in ("trust_code", "region", "procedure_code") if c in forecast.columns]
    w = Window.partitionBy(*keys).orderBy("date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.row_number().over(w) - 1
    ceiling = F.first("yhat", ignorenulls=True).over(whole) * F.pow(F.lit(1 + max_growth), step / 12.0)
    return forecast.withColumn("ceiling", ceiling).withColumns(
        {c: F.least(c, "ceiling") for c in VALUES}).drop("ceiling").withColumn("scenario", F.lit("capacity_cap"))


def demand_shock(forecast: DataFrame, pct: float = 0.15) -> DataFrame:
    return forecast.withColumns({c: F.col(c) * (1 + pct) for c in VALUES}).withColumn(
        "scenario", F.lit(f"demand_shock_{int(pct * 100):+d}pct"))


def default_scenarios(waiting: DataFrame) -> dict[str, Scenario]:
    return {
        "baseline": baseline,
        "backlog_clear": lambda fc: backlog_clear(fc, waiting),
        "capacity_cap": capacity_cap,
    }


def sweep(forecast: DataFrame, scenarios: Mapping[str, Scenario], mapping: DataFrame) -> DataFrame:
    """Equipment demand of every scenario at every level, stacked with a ``scenario`` column.

    Scenarios are stacked at the leaf, so that one roll-up and one mapping serve all of them. Every scenario reads
    ``forecast``: pass a stored table.
    """
    leaf = ("trust_code", "region", "procedure_code", "date", *VALUES)
    stacked = reduce(DataFrame.unionByName, [
        transform(forecast).select(*leaf, F.lit(name).alias("scenario")) for name, transform in scenarios.items()])
    return equipment_demand(bottom_up(stacked, extra_keys=["scenario"]), mapping, extra_keys=["scenario"])
