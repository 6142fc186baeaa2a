"""Registered queries: sources, conforming, storage and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.panel import rounded, scalar
from panelcast.operators import demand, quality
from panelcast.operators.naive import tag
from panelcast.plans.registry import query
from panelcast.schemas import DATASET_TABLE, EQUIPMENT, RTT, SUPPLY, TABLES
from panelcast.sources import adapters, conform, storage

CHAPTER_COST = {"F0": 1800.0, "F1": 950.0, "F2": 4200.0, "F3": 60.0}
# Per dataset the value and the label that its rows are shown by.
FEED_COLUMNS = {
    "procedures": ("n_procedures", "procedure_code"), "imaging": ("n_tests", "modality"),
    "rtt": ("waiting_list_size", "treatment_function"), "activity": ("n_activity", "activity_type"),
    "demographics": ("population", "age_band"), "supply": ("spend_gbp", "category")}
FIRST_SNAPSHOT, SECOND_SNAPSHOT = "2024-01-31", "2024-02-29"


@query
def a1_conform(spark: SparkSession, root: str) -> DataFrame:
    raw = adapters.table(spark, root, "orders").select(
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("treatment_function"),
        F.col("o_orderdate").alias("date"))
    return rounded(conform.conform(raw, RTT))


@query
def a2_modality_labels(spark: SparkSession, root: str) -> DataFrame:
    return conform.normalise_modality(adapters.imaging(spark, root), adapters.TYPE_ALIASES)


@query
def a3_activity_labels(spark: SparkSession, root: str) -> DataFrame:
    return conform.normalise_activity(adapters.activity(spark, root), adapters.STATUS_ALIASES)


@query
def a4_national_series(spark: SparkSession, root: str) -> DataFrame:
    return conform.national_series(adapters.national_sheet(spark, root))


@query
def a5_top_down_allocation(spark: SparkSession, root: str) -> DataFrame:
    sheet = adapters.national_sheet(spark, root)
    series = conform.national_series(sheet)
    places = adapters.places(spark, root)
    customer = adapters.table(spark, root, "customer").select("c_nationkey")
    shares = customer.join(places, customer.c_nationkey == places.n_nationkey).groupBy("trust_code", "region").agg(
        F.count("*").alias("size"))
    start = F.add_months(scalar(series, F.min("date")), -2)
    end = F.add_months(scalar(series, F.max("date")), 3)
    return conform.allocate_top_down(series, shares, adapters.FUNCTIONS, start, end)


@query
def a6_month_spine(spark: SparkSession, root: str) -> DataFrame:
    dates = adapters.table(spark, root, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return conform.month_spine(spark, scalar(dates, F.min("d")), scalar(dates, F.max("d")))


@query
def a7_future_index(spark: SparkSession, root: str) -> DataFrame:
    last = adapters.procedures(spark, root).groupBy("trust_code", "procedure_code").agg(F.max("date").alias("date"))
    return conform.future_months(last, 12)


@query
def a8_raw_lineage(spark: SparkSession, root: str) -> DataFrame:
    """Content hash and size of every landed table file."""
    return storage.raw_lineage(spark, "tables", f"{root}/*.parquet").select(
        F.substring_index("path", "/", -1).alias("file"), "digest", "bytes")


def staged_feeds(spark: SparkSession, root: str) -> dict[str, conform.Feed]:
    """Activity staged as a CSV feed, imaging only as a fallback file, the rest with both."""
    base = storage.scratch_path(spark, "feeds")
    data = adapters.datasets(spark, root)
    feeds = {}
    for name in data:
        data[name].write.parquet(f"{base}/{name}")
        feeds[name] = conform.Feed(f"{base}/absent-{name}", f"{base}/{name}")
    data["activity"].write.option("header", "true").csv(f"{base}/activity-csv")
    feeds["activity"] = conform.Feed(f"{base}/activity-csv", f"{base}/absent", "csv")
    return feeds


@query
def a9_provenance(spark: SparkSession, root: str) -> DataFrame:
    """Where each feed came from, and its rows."""
    frames, entries = conform.load_all(spark, staged_feeds(spark, root))
    base = storage.scratch_path(spark, "provenance")
    storage.record_provenance(spark, base, "run-1", entries)
    sizes = None
    for name, df in frames.items():
        part = df.agg(F.lit(name).alias("source"), F.count("*").alias("n_rows"))
        sizes = part if sizes is None else sizes.unionByName(part)
    return storage.provenance(spark, base, "run-1").select(
        "source", F.substring_index("provenance", " ", 1).alias("kind")).join(sizes, "source")


@query
def a11_load_feeds(spark: SparkSession, root: str) -> DataFrame:
    """All six datasets, a row for each of theirs."""
    frames, _ = conform.load_all(spark, staged_feeds(spark, root))
    out = None
    for name, df in frames.items():
        value, label = FEED_COLUMNS[name]
        part = df.select(F.lit(name).alias("dataset"), F.col(label).cast("string").alias("label"),
                         F.round(F.col(value).cast("double"), 6).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def a12_quarterly_supply(spark: SparkSession, root: str) -> DataFrame:
    facts = adapters.procedures(spark, root).select(
        "date", F.col("opcs_chapter").alias("category"), F.col("n_procedures").alias("units"))
    return conform.quarterly_supply(facts, CHAPTER_COST)


def _two_snapshots(spark: SparkSession, root: str) -> str:
    """Lake with an early part of the procedures as first snapshot and all of them as second."""
    lake = storage.scratch_path(spark, "lake")
    facts = adapters.procedures(spark, root)
    storage.write_snapshot(facts.where(F.year("date") < 1998), lake, "procedures", FIRST_SNAPSHOT)
    storage.write_snapshot(facts.where(F.year("date") < 1999), lake, "procedures", SECOND_SNAPSHOT)
    # A rerun of the same day replaces that day only.
    storage.write_snapshot(facts, lake, "procedures", SECOND_SNAPSHOT)
    return lake


@query
def a13_write_snapshot(spark: SparkSession, root: str) -> DataFrame:
    lake = _two_snapshots(spark, root)
    return spark.read.parquet(f"{lake}/procedures").groupBy(
        F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(
            F.count("*").alias("n_rows"), F.sum("n_procedures").alias("n_procedures"))


@query
def a14_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    lake = _two_snapshots(spark, root)
    label = storage.latest_snapshot(spark, lake, "procedures")
    absent = storage.latest_snapshot(spark, lake, "nothing")
    return storage.read_latest(spark, lake, "procedures").agg(
        F.lit(label).alias("latest"), F.lit(absent is None).alias("absent_is_null"), F.count("*").alias("n_rows"))


@query
def a15_read_latest(spark: SparkSession, root: str) -> DataFrame:
    return storage.read_latest(spark, _two_snapshots(spark, root), "procedures")


@query
def a16_list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The labels with the rows stored under each."""
    lake = _two_snapshots(spark, root)
    stored = spark.read.parquet(f"{lake}/procedures").groupBy(
        F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(F.count("*").alias("n_rows"))
    return storage.list_snapshots(spark, lake, "procedures").join(stored, "snapshot_date", "left")


@query
def a17_replace_table(spark: SparkSession, root: str) -> DataFrame:
    """A second load replaces the first; its extra column is ignored, its missing one becomes NULL."""
    base = storage.scratch_path(spark, "tables")
    supply = adapters.supply(spark, root)
    storage.replace_table(supply.where(F.col("units") % 2 == 0), base, "fact_supply")
    storage.replace_table(supply.drop("spend_gbp").withColumn("note", F.lit("x")), base, "fact_supply")
    return storage.read_table(spark, base, "fact_supply").select(*SUPPLY.fieldNames())


def _loaded_tables(spark: SparkSession, root: str) -> str:
    base = storage.scratch_path(spark, "tables")
    storage.init_tables(spark, base)
    for name, df in adapters.datasets(spark, root).items():
        storage.replace_table(df, base, DATASET_TABLE[name])
    return base


@query
def a18_table_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """All declared tables after the six datasets are loaded, with columns and rows."""
    base = _loaded_tables(spark, root)
    out = None
    for name, schema in TABLES.items():
        part = storage.read_table(spark, base, name).agg(
            F.lit(name).alias("table_name"), F.lit(len(schema.fields)).alias("n_columns"),
            F.count("*").alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def a19_dim_date(spark: SparkSession, root: str) -> DataFrame:
    data = adapters.datasets(spark, root)
    return storage.build_dim_date(data[n] for n in ("procedures", "imaging", "rtt", "activity"))


@query
def a20_dim_trust(spark: SparkSession, root: str) -> DataFrame:
    return storage.build_dim_trust(adapters.procedures(spark, root))


@query
def a21_adhoc_sql(spark: SparkSession, root: str) -> DataFrame:
    frames = {"fact_procedures": adapters.procedures(spark, root), "fact_rtt": adapters.rtt(spark, root)}
    return storage.query(frames, """
        SELECT p.region, year(p.date) AS year, p.volume, w.waiting
        FROM (SELECT region, date, sum(n_procedures) AS volume FROM {fact_procedures} GROUP BY region, date) p
        LEFT JOIN (SELECT region, date, sum(waiting_list_size) AS waiting FROM {fact_rtt} GROUP BY region, date) w
          ON p.region = w.region AND p.date = w.date
        WHERE month(p.date) = 12
    """)


def _forecast_levels(spark: SparkSession, root: str) -> DataFrame:
    from panelcast.operators.hierarchy import bottom_up
    from panelcast.plans.queries_demand import base_forecast

    return bottom_up(base_forecast(spark, root))


@query
def a22_append_forecasts(spark: SparkSession, root: str) -> DataFrame:
    base = storage.scratch_path(spark, "tables")
    levels = _forecast_levels(spark, root)
    for run_id in ("run-1", "run-2"):
        storage.append_run(tag(levels, run_id=run_id, model="naive"), base, "forecast_procedures")
    return rounded(storage.read_table(spark, base, "forecast_procedures").groupBy("run_id", "model", "level").agg(
        F.count("*").alias("n_rows"), F.sum("yhat").alias("yhat")), 3)


@query
def a23_replace_run(spark: SparkSession, root: str) -> DataFrame:
    """Loading run-1 again replaces it and leaves run-2 alone."""
    base = storage.scratch_path(spark, "tables")
    levels = tag(_forecast_levels(spark, root), model="naive")
    storage.replace_run(levels, base, "forecast_procedures", "run-1")
    storage.replace_run(levels, base, "forecast_procedures", "run-2")
    storage.replace_run(levels.where(F.col("level") == "national"), base, "forecast_procedures", "run-1")
    return rounded(storage.read_table(spark, base, "forecast_procedures").groupBy("run_id", "level").agg(
        F.count("*").alias("n_rows"), F.sum("yhat").alias("yhat")), 3)


@query
def a24_artifacts(spark: SparkSession, root: str) -> DataFrame:
    base = storage.scratch_path(spark, "artifacts")
    storage.write_artifact(_forecast_levels(spark, root), base, "procedure_forecast", "run-1")
    latest = spark.read.parquet(f"{base}/procedure_forecast_latest")
    return rounded(latest.groupBy("level").agg(F.count("*").alias("n_rows"), F.sum("yhat").alias("yhat")), 3)


@query
def a25_run_report(spark: SparkSession, root: str) -> DataFrame:
    base = storage.scratch_path(spark, "report")
    counts = _forecast_levels(spark, root).agg(
        F.count("*").alias("n_procedure_forecast_rows"), F.lit("run-1").alias("run_id"), F.lit(12).alias("horizon"),
        F.struct(F.lit("parquet").alias("procedures")).alias("data_provenance"))
    storage.write_report(counts, base, "report", "run-1")
    return spark.read.json(f"{base}/report_latest").select(
        "run_id", "horizon", "n_procedure_forecast_rows", F.col("data_provenance.procedures").alias("procedures_source"))


@query
def a26_mapping(spark: SparkSession, root: str) -> DataFrame:
    """Positive weights of the mapping with the volume they apply to."""
    mapping = demand.check_mapping(adapters.mapping_rows(spark))
    volume = adapters.procedures(spark, root).groupBy("procedure_code").agg(F.sum("n_procedures").alias("volume"))
    return mapping.join(volume, "procedure_code").select(
        "procedure_code", "equipment_type", "weight", "map_type", "volume")


@query
def a27_equipment_spend(spark: SparkSession, root: str) -> DataFrame:
    """Units per equipment type and what they cost by the equipment dimension."""
    path = storage.scratch_path(spark, "equipment-csv")
    rows = [(kind, "device", cost, False) for kind, cost in adapters.EQUIPMENT_COST.items()]
    spark.createDataFrame(rows, EQUIPMENT).write.option("header", "true").csv(path)
    dim = demand.load_equipment(spark, path).select("equipment_type", "unit_cost_gbp")
    units = demand.apply_mapping(
        adapters.procedures(spark, root).select("procedure_code", "n_procedures"),
        demand.check_mapping(adapters.mapping_rows(spark)), "n_procedures")
    return rounded(units.join(dim, "equipment_type").select(
        "equipment_type", F.col("demand").alias("units"),
        (F.col("demand") * F.col("unit_cost_gbp")).alias("spend_gbp")), 3)


# ---------------------------------------------------------------- data checks

FEED_SPEC = quality.CheckSpec(
    required_cols=("key", "day", "amount", "absent"), non_negative=("amount",), unique_keys=("key", "part"),
    date_col="day", min_rows=1)


def dirty_feed(spark: SparkSession, root: str) -> DataFrame:
    """Line items as a text feed with bad dates, negative and junk amounts, NULL and repeated keys."""
    line = F.col("l_linenumber")
    return adapters.table(spark, root, "lineitem").select(
        F.when(line != 2, F.col("l_orderkey")).alias("key"), F.col("l_partkey").alias("part"),
        F.when(line == 7, "not a date").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"),
        F.when(line == 3, F.concat(F.lit("-"), F.col("l_quantity").cast("int").cast("string")))
        .when(line == 5, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("amount"))


def _feed_checks(spark: SparkSession, root: str, *names: str) -> DataFrame:
    checks = quality.validate("feed", dirty_feed(spark, root), FEED_SPEC)
    return checks.where(F.col("name").isin(*names))


@query
def b1_non_empty(spark: SparkSession, root: str) -> DataFrame:
    return _feed_checks(spark, root, "non_empty")


@query
def b2_has_col(spark: SparkSession, root: str) -> DataFrame:
    return _feed_checks(spark, root, *[f"has_col[{c}]" for c in FEED_SPEC.required_cols])


@query
def b3_non_negative(spark: SparkSession, root: str) -> DataFrame:
    return _feed_checks(spark, root, "non_negative[amount]")


@query
def b4_unique_keys(spark: SparkSession, root: str) -> DataFrame:
    return _feed_checks(spark, root, "unique_keys")


@query
def b5_valid_dates(spark: SparkSession, root: str) -> DataFrame:
    return _feed_checks(spark, root, "valid_dates")


@query
def b6_validate(spark: SparkSession, root: str) -> DataFrame:
    return quality.validate("procedures", adapters.procedures(spark, root), quality.SPECS["procedures"])


@query
def b7_error_gate(spark: SparkSession, root: str) -> DataFrame:
    return quality.failed_errors(quality.validate("feed", dirty_feed(spark, root), FEED_SPEC))


@query
def b8_default_specs(spark: SparkSession, root: str) -> DataFrame:
    return quality.validate_all(adapters.datasets(spark, root)).select("dataset", "name", "passed", "severity", "detail")


@query
def b8_snapshot_drift(spark: SparkSession, root: str) -> DataFrame:
    facts = adapters.procedures(spark, root)
    return rounded(quality.drift(facts, facts.where(F.year("date") < 1999), ["n_procedures"]))
