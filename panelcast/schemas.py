"""Table contracts. Everything is declared up front; nothing is inferred at read time."""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "date": DateType(), "timestamp": TimestampType(), "timestamp_ntz": TimestampNTZType(), "int": IntegerType(),
    "bigint": LongType(), "double": DoubleType(), "boolean": BooleanType(), "string": StringType(),
}


def schema_of(*columns: str) -> StructType:
    """Schema from "name type" strings; unlike a DDL parse it needs no running session."""
    pairs = [c.split() for c in columns]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Minimum column sets of the six curated datasets.
PROCEDURES = schema_of(
    "date date", "trust_code string", "region string",
    "opcs_chapter string", "procedure_code string", "n_procedures bigint")
IMAGING = schema_of("date date", "trust_code string", "region string", "modality string", "n_tests bigint")
RTT = schema_of(
    "date date", "trust_code string", "region string", "treatment_function string",
    "waiting_list_size bigint", "pct_within_18wk double")
ACTIVITY = schema_of(
    "date date", "trust_code string", "region string", "activity_type string", "n_activity bigint")
DEMOGRAPHICS = schema_of("year int", "region string", "age_band string", "population bigint")
SUPPLY = schema_of("quarter string", "category string", "spend_gbp double", "units bigint")

DATASETS = {
    "procedures": PROCEDURES,
    "imaging": IMAGING,
    "rtt": RTT,
    "activity": ACTIVITY,
    "demographics": DEMOGRAPHICS,
    "supply": SUPPLY,
}

MAPPING = schema_of(
    "procedure_code string", "equipment_type string", "weight double", "map_type string", "source string")
EQUIPMENT = schema_of(
    "equipment_type string", "category string", "unit_cost_gbp double", "reusable boolean")

# Stored tables: dimensions, facts, forecast outputs, telemetry.
TABLES = {
    "dim_date": schema_of(
        "date date", "year int", "quarter int", "month int", "month_name string", "fiscal_year string"),
    "dim_trust": schema_of("trust_code string", "region string"),
    "dim_equipment": EQUIPMENT,
    "dim_proc_equipment_map": MAPPING,
    "fact_procedures": PROCEDURES,
    "fact_imaging": IMAGING,
    "fact_rtt": RTT,
    "fact_activity": ACTIVITY,
    "dim_demographics": DEMOGRAPHICS,
    "fact_supply": SUPPLY,
    "forecast_procedures": schema_of(
        "run_id string", "model string", "level string", "trust_code string", "region string",
        "procedure_code string", "date date", "yhat double", "yhat_lower double", "yhat_upper double"),
    "forecast_equipment": schema_of(
        "run_id string", "scenario string", "level string", "trust_code string", "region string",
        "equipment_type string", "date date",
        "demand double", "demand_lower double", "demand_upper double"),
    "dim_device": schema_of(
        "device_id string", "device_type string", "site_id string", "region string", "specialty string",
        "install_date date", "contract_id string", "price_per_session_gbp double",
        "monthly_fixed_cost_gbp double", "min_monthly_floor_gbp double", "cap_sessions_day int"),
    "dim_operator": schema_of("operator_hash string", "site_id string", "specialty string", "role string"),
    "telemetry_event": schema_of(
        "event_id string", "device_id string", "site_id string", "operator_hash string",
        "event_type string", "ts_device timestamp_ntz", "seq_no bigint", "active_seconds double",
        "n_errors int", "procedure_code string", "ingest_quality string"),
    "fact_device_session": schema_of(
        "session_id string", "device_id string", "site_id string", "operator_hash string",
        "procedure_code string", "t_start timestamp_ntz", "t_end timestamp_ntz",
        "active_seconds double", "n_errors int", "billable boolean", "billed_amount_gbp double"),
    "fact_device_day": schema_of(
        "device_id string", "date date", "n_sessions int", "n_billable int", "active_seconds double",
        "exposure_hours double", "n_errors int", "n_operators int", "billed_gbp double"),
    "underwriting_device": schema_of(
        "run_id string", "device_id string", "site_id string", "region string", "specialty string",
        "expected_sessions double", "expected_revenue_gbp double", "cv double", "beta_book double",
        "suggested_price_gbp double", "current_price_gbp double", "uar_p5_sessions double",
        "floor_breach_prob double", "op_herfindahl double", "expected_margin_gbp double"),
}

# Tables that grow by runs; stored partitioned by run_id, so a run is one partition.
RUN_TABLES = ("forecast_procedures", "forecast_equipment", "underwriting_device")

# Curated dataset -> stored table.
DATASET_TABLE = {
    "procedures": "fact_procedures",
    "imaging": "fact_imaging",
    "rtt": "fact_rtt",
    "activity": "fact_activity",
    "demographics": "dim_demographics",
    "supply": "fact_supply",
}
