import math

import pytest
from pyspark.sql import functions as F

from panelcast.operators import demand, hierarchy, scenarios
from panelcast.schemas import MAPPING


def forecast(spark, rows):
    return spark.createDataFrame(
        rows, "level string, trust_code string, region string, procedure_code string, date string, "
              "yhat double, yhat_lower double, yhat_upper double").withColumn("date", F.col("date").cast("date"))


def test_independent_variance(spark):
    fc = forecast(spark, [("national", None, None, c, "2025-01-01", 100.0, 80.0, 120.0) for c in ("H22", "G45")])
    rows = {r.equipment_type: r for r in demand.equipment_demand(fc, demand.load_mapping(spark)).collect()}
    scope = rows["endoscope"]
    assert scope.demand == pytest.approx(200.0)
    assert scope.demand_upper - scope.demand == pytest.approx(math.sqrt(2) * 20, abs=1e-6)


def test_lower_bound_and_absent_keys(spark):
    fc = spark.createDataFrame(
        [("national", "H22", "2025-01-01", 10.0, 0.0, 50.0)],
        "level string, procedure_code string, date string, yhat double, yhat_lower double, yhat_upper double")
    rows = demand.equipment_demand(fc, demand.load_mapping(spark)).collect()
    assert rows and all(r.demand_lower >= 0 for r in rows)


def test_mapping_rules(spark):
    mapping = demand.load_mapping(spark)
    assert mapping.count() == 17
    assert mapping.where("weight <= 0").count() == 0
    types = [r.equipment_type for r in demand.load_equipment(spark).collect()]
    matrix = demand.mapping_matrix(mapping, types)
    assert matrix.columns == ["procedure_code", *types]
    assert matrix.where("procedure_code = 'H22'").first()["endoscope"] == 1.0
    assert matrix.where("procedure_code = 'H22'").first()["surgical_kit"] == 0.0


def test_mapping_missing_column(spark):
    with pytest.raises(ValueError, match="missing columns"):
        demand.check_mapping(spark.createDataFrame([("a", 1.0)], "procedure_code string, weight double"))


def test_mapping_from_csv(spark, tmp_path):
    path = str(tmp_path / "mapping")
    spark.createDataFrame([("A", "scope", 0.5, "rule", "x"), ("A", "kit", 0.0, "rule", "x")], MAPPING).write.option(
        "header", "true").csv(path)
    assert [tuple(r)[:3] for r in demand.load_mapping(spark, path).collect()] == [("A", "scope", 0.5)]


def test_apply_mapping(spark):
    fc = forecast(spark, [("national", None, None, "H22", "2025-01-01", 100.0, 0.0, 0.0),
                          ("national", None, None, "G45", "2025-01-01", 50.0, 0.0, 0.0),
                          ("national", None, None, "none", "2025-01-01", 9.0, 0.0, 0.0)])
    out = {r.equipment_type: r.demand for r in demand.apply_mapping(fc, demand.load_mapping(spark)).collect()}
    assert out["endoscope"] == pytest.approx(150.0)
    assert set(out) == {"endoscope", "imaging_consumable"}


def leaf(spark):
    rows = []
    for i, (trust, region) in enumerate([("T1", "R1"), ("T2", "R1"), ("T3", "R2"), ("T4", None)]):
        for m in range(1, 7):
            y = 10.0 * (i + 1) + m
            rows.append(("trust", trust, region, "H22", f"2025-{m:02d}-01", y, y - 3, y + 4))
    return forecast(spark, rows).drop("level")


def test_bottom_up_coherence(spark):
    levels = hierarchy.bottom_up(leaf(spark))
    total = {r.level: r.s for r in levels.groupBy("level").agg(F.sum("yhat").alias("s")).collect()}
    assert total["national"] == pytest.approx(total["trust"])
    # The trust without a region counts nationally only.
    assert total["regional"] == pytest.approx(total["trust"] - sum(40.0 + m for m in range(1, 7)))
    assert levels.where("level = 'regional' and region is null").count() == 0
    assert levels.where("level = 'trust' and trust_code = 'T4'").count() == 6


def test_bottom_up_independent_is_tighter(spark):
    wide = hierarchy.bottom_up(leaf(spark)).where("level = 'national'").agg(F.sum(F.expr("yhat_upper - yhat"))).first()[0]
    tight = hierarchy.bottom_up(leaf(spark), "independent").where("level = 'national'").agg(
        F.sum(F.expr("yhat_upper - yhat"))).first()[0]
    assert tight == pytest.approx(wide / 2)
    with pytest.raises(ValueError):
        hierarchy.bottom_up(leaf(spark), "other")


def test_middle_out_shares(spark):
    history = spark.createDataFrame(
        [("R1", "T1", "H22", 30), ("R1", "T2", "H22", 10), ("R2", "T3", "H22", 0)],
        "region string, trust_code string, procedure_code string, n_procedures bigint")
    regional = hierarchy.bottom_up(leaf(spark)).where("level = 'regional'")
    out = hierarchy.middle_out(regional, history)
    jan = {r.trust_code: r.yhat for r in out.where("date = '2025-01-01'").collect()}
    assert jan["T1"] == pytest.approx((11 + 21) * 0.75)
    assert jan["T2"] == pytest.approx((11 + 21) * 0.25)
    assert jan["T3"] == 0.0


def test_backlog_clear_adds_the_planned_total(spark):
    waiting = spark.createDataFrame(
        [("2024-11-01", "T1", "A", 999), ("2024-12-01", "T1", "A", 100), ("2024-10-01", "T2", "A", 50)],
        "date string, trust_code string, treatment_function string, waiting_list_size bigint")
    base = leaf(spark)
    out = scenarios.backlog_clear(base, waiting, clear_months=4, clear_frac=0.4)
    added = (out.agg(F.sum("yhat")).first()[0] - base.agg(F.sum("yhat")).first()[0])
    assert added == pytest.approx(150 * 0.4)
    assert out.where("date >= '2025-05-01'").exceptAll(
        base.where("date >= '2025-05-01'").withColumn("scenario", F.lit("backlog_clear"))
        .select(out.columns)).count() == 0


def test_capacity_cap_ceiling(spark):
    rows = scenarios.capacity_cap(leaf(spark), 0.05).where("trust_code = 'T1'").orderBy("date").collect()
    for step, r in enumerate(rows):
        assert r.yhat <= 11.0 * 1.05 ** (step / 12) + 1e-9
        assert r.yhat_lower <= r.yhat <= r.yhat_upper + 1e-9


def test_demand_shock_label(spark):
    row = scenarios.demand_shock(leaf(spark), 0.15).where("trust_code = 'T1'").orderBy("date").first()
    assert row.scenario == "demand_shock_+15pct" and row.yhat == pytest.approx(11 * 1.15)
    assert scenarios.demand_shock(leaf(spark), -0.2).first().scenario == "demand_shock_-20pct"


def test_sweep_has_every_level_and_scenario(spark):
    waiting = spark.createDataFrame([("2024-12-01", "T1", "A", 100)],
                                    "date string, trust_code string, treatment_function string, waiting_list_size bigint")
    out = scenarios.sweep(leaf(spark), scenarios.default_scenarios(waiting), demand.load_mapping(spark))
    seen = {(r.scenario, r.level) for r in out.select("scenario", "level").distinct().collect()}
    assert len(seen) == 9
