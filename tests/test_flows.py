import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelcast.operators import reports
from panelcast.plans import flows
from panelcast.plans.queries_demand import mapping
from panelcast.sources import adapters, storage


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["date", "equipment_type", "demand", "lower", "upper"] and out.count() == 36


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 90


@pytest.fixture(scope="module")
def demand(spark, root, tmp_path_factory):
    data = adapters.datasets(spark, root)
    base = str(tmp_path_factory.mktemp("flow"))
    return base, flows.run_demand(
        data, mapping(spark), base, 6, adapters.CHAPTER_TO_FUNCTION, adapters.OLDER_SEGMENTS,
        [("procedures", "live", "parquet")], models=("pooled", "window"))


def test_demand_flow(spark, demand):
    base, result = demand
    totals = {r.level: r.s for r in result.hierarchy.groupBy("level").agg(F.sum("yhat").alias("s")).collect()}
    assert totals["national"] == pytest.approx(totals["trust"], rel=1e-9)
    assert {r.scenario for r in result.equipment.select("scenario").distinct().collect()} == {
        "baseline", "backlog_clear", "capacity_cap"}
    assert "pooled" in {r.model for r in result.metrics.collect()}
    report = result.report.first()
    assert report.run_id == result.run_id and report.n_procedure_forecast_rows == result.hierarchy.count()
    assert storage.read_table(spark, f"{base}/tables", "dim_date").count() > 0
    page = reports.equipment_demand(storage.read_table(spark, f"{base}/tables", "forecast_equipment"), limit=5)
    assert page.count() == 5 and page.where(F.col("run_id") != result.run_id).count() == 0
    with pytest.raises(ValueError):
        reports.equipment_demand(result.equipment, limit=50_000)


def test_underwriting_flow(spark, root, tmp_path):
    fleet = adapters.fleet(spark, root)
    result = flows.run_underwriting(fleet.devices, fleet.events, str(tmp_path), 7, 400, operators=fleet.operators)
    assert result.book.count() <= fleet.devices.count() and result.book.count() > 0
    p = result.portfolio.first()
    assert p.cvar_loss_gbp >= p.var_loss_gbp and 1 <= p.effective_n_independent <= p.n_devices
    report = result.report.first()
    assert report.n_device_days == result.device_day.count()
    assert report.backtest is None or 0 <= report.backtest.coverage_90 <= 1


def test_queries_against_sql(spark, root):
    """A cross-section of the registry at the smallest scale; check_oracles.py runs all of it."""
    import check_oracles

    con, sqls = check_oracles.connect(root), entry.oracle_sql()
    for name in ("a5_top_down_allocation", "b8_default_specs", "c12_feature_table", "c12_feature_table_compat",
                 "e8_scenario_sweep", "f1_sessions", "f17_device_features", "h4_correlation", "h10_tail_risk", "i17_top_trusts"):
        assert check_oracles.compare(spark, con, entry.queries()[name], sqls[name], root).startswith("ok"), name
