"""Weighted code-to-equipment mapping and demand with propagated variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast import fixed_values
from panelcast.fixed_values import Z80
from panelcast.schemas import EQUIPMENT, MAPPING

MAPPING_KEYS = ("run_id", "model", "level", "trust_code", "region", "date")
DEMAND_KEYS = ("level", "trust_code", "region", "date")


def check_mapping(mapping: DataFrame) -> DataFrame:
    """Validate the columns, cast the weight and drop non-positive weights."""
    missing = sorted(set(MAPPING.fieldNames()) - set(mapping.columns))
    if missing:
        raise ValueError(f"mapping table missing columns: {missing}")
    return mapping.withColumn("weight", F.col("weight").cast("double")).where(F.col("weight") > 0)


def load_mapping(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Mapping from a CSV with a header, or the default table."""
    if path is None:
        return check_mapping(spark.createDataFrame(fixed_values.PROCEDURE_EQUIPMENT, MAPPING))
    return check_mapping(spark.read.option("header", "true").csv(path))


def load_equipment(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is None:
        return spark.createDataFrame(fixed_values.EQUIPMENT, EQUIPMENT)
    return spark.read.option("header", "true").schema(EQUIPMENT).csv(path)


def mapping_matrix(mapping: DataFrame, equipment_types: Sequence[str]) -> DataFrame:
    """Dense weight matrix, a row per code. Naming the columns spares the pivot a pass over the data."""
    return mapping.groupBy("procedure_code").pivot("equipment_type", list(equipment_types)).agg(
        F.sum("weight")).fillna(0.0)


def apply_mapping(forecast: DataFrame, mapping: DataFrame, value: str = "yhat") -> DataFrame:
    """Sum of value x weight per equipment and present key; codes without a mapping drop out."""
    keys = [c for c in MAPPING_KEYS if c in forecast.columns]
    weights = mapping.select("procedure_code", "equipment_type", "weight")
    return (forecast.select(*keys, "procedure_code", value).join(weights, "procedure_code")
            .groupBy(*keys, "equipment_type")
            .agg(F.coalesce(F.sum(F.col(value) * F.col("weight")), F.lit(0.0)).alias("demand")))


def equipment_demand(
    forecast: DataFrame, mapping: DataFrame, z: float = Z80, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """Demand and its band, adding code variances as independent errors."""
    keys = [*extra_keys, *[c for c in DEMAND_KEYS if c in forecast.columns]]
    weights = mapping.select("procedure_code", "equipment_type", "weight")
    sigma = (F.col("yhat_upper") - F.col("yhat_lower")) / (2 * z)
    summed = (forecast.join(weights, "procedure_code")
              .groupBy(*keys, "equipment_type")
              .agg(F.coalesce(F.sum(F.col("yhat") * F.col("weight")), F.lit(0.0)).alias("demand"),
                   F.coalesce(F.sum(F.pow(F.col("weight") * sigma, 2)), F.lit(0.0)).alias("variance")))
    half = z * F.sqrt(F.greatest("variance", F.lit(0.0)))
    return summed.withColumns({
        "demand_lower": F.greatest(F.col("demand") - half, F.lit(0.0)),
        "demand_upper": F.col("demand") + half,
    }).drop("variance")
