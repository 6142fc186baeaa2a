"""Shape the order/line-item and event tables into the canonical frames of ``schemas``.

Small dimensions are joined without hints: Spark broadcasts a side only when its size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.sources.storage import materialise, together

# Fixed values of the adapter: chapter -> treatment function, older segments, code -> equipment.
CHAPTER_TO_FUNCTION = {
    "F0": "1-URGENT", "F1": "2-HIGH", "F2": "3-MEDIUM", "F3": "4-NOT SPECIFIED", "F4": "5-LOW",
}
OLDER_SEGMENTS = ("BUILDING", "MACHINERY")
FUNCTIONS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# Aliases for the part-type and line-status labels; other labels keep their original text.
TYPE_ALIASES = {"economy": "Economy", "standard": "Standard", "promo": "Promotional"}
STATUS_ALIASES = {"o": "open"}
# Brands 1-20 map to equipment, 21-25 stay unmapped; brand 3 has an explicit zero weight.
EQUIPMENT_WEIGHTS = (
    [(f"Brand#{n}", "scope", 1.0, "rule", "stand_in") for n in range(1, 9)]
    + [(f"Brand#{n}", "kit", 0.35, "probabilistic", "stand_in") for n in range(5, 15)]
    + [(f"Brand#{n}", "implant", 0.8, "probabilistic", "stand_in") for n in range(13, 21)]
    + [("Brand#3", "implant", 0.0, "rule", "not_applicable")]
)
EQUIPMENT_TYPES = ("implant", "kit", "scope")
EQUIPMENT_COST = {"implant": 950.0, "kit": 120.0, "scope": 1800.0}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _month(column: str) -> Column:
    return F.trunc(F.to_date(column), "month")


def places(spark: SparkSession, root: str) -> DataFrame:
    nation = table(spark, root, "nation")
    region = table(spark, root, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("trust_code"), F.col("r_name").alias("region"))


def _lines(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """Line items with trust and region of the supplier and the part's labels."""
    located = places(spark, root)
    supplier = table(spark, root, "supplier").join(
        located, F.col("s_nationkey") == located.n_nationkey).select("s_suppkey", "trust_code", "region")
    part = table(spark, root, "part").select("p_partkey", "p_brand", "p_type")
    lineitem = table(spark, root, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", *columns)
    return (lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
            .join(part, lineitem.l_partkey == part.p_partkey)
            .withColumn("date", _month("l_shipdate")))


def _orders(spark: SparkSession, root: str) -> DataFrame:
    located = places(spark, root)
    customer = table(spark, root, "customer").join(
        located, F.col("c_nationkey") == located.n_nationkey).select(
            "c_custkey", "c_mktsegment", "trust_code", "region")
    orders = table(spark, root, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def procedures(spark: SparkSession, root: str) -> DataFrame:
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    chapter = F.concat(F.lit("F"), F.floor((brand_no - 1) / 5).cast("string"))
    return (_lines(spark, root, "l_quantity")
            .groupBy("date", "trust_code", "region", chapter.alias("opcs_chapter"),
                     F.col("p_brand").alias("procedure_code"))
            .agg(F.sum("l_quantity").cast("bigint").alias("n_procedures")))


def imaging(spark: SparkSession, root: str) -> DataFrame:
    return (_lines(spark, root)
            .groupBy("date", "trust_code", "region",
                     F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("modality"))
            .agg(F.count("*").alias("n_tests")))


def activity(spark: SparkSession, root: str) -> DataFrame:
    return (_lines(spark, root, "l_linestatus")
            .groupBy("date", "trust_code", "region", F.col("l_linestatus").alias("activity_type"))
            .agg(F.count("*").alias("n_activity")))


def rtt(spark: SparkSession, root: str) -> DataFrame:
    return (_orders(spark, root)
            .groupBy(_month("o_orderdate").alias("date"), "trust_code", "region",
                     F.col("o_orderpriority").alias("treatment_function"))
            .agg(F.count_if(F.col("o_orderstatus") != "F").alias("waiting_list_size"),
                 (100 * F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)))
                 .alias("pct_within_18wk")))


def demographics(spark: SparkSession, root: str) -> DataFrame:
    return (_orders(spark, root)
            .groupBy(F.year("o_orderdate").alias("year"), "region", F.col("c_mktsegment").alias("age_band"))
            .agg(F.countDistinct("o_custkey").alias("population")))


def quarter_label(date: Column | str) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def supply(spark: SparkSession, root: str) -> DataFrame:
    lineitem = table(spark, root, "lineitem").select(
        "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
    part = table(spark, root, "part").select("p_partkey", "p_type")
    return (lineitem.join(part, lineitem.l_partkey == part.p_partkey)
            .groupBy(quarter_label("l_shipdate").alias("quarter"), F.col("p_type").alias("category"))
            .agg(F.sum("l_extendedprice").alias("spend_gbp"),
                 F.sum("l_quantity").cast("bigint").alias("units")))


def _line_summary(spark: SparkSession, root: str) -> DataFrame:
    """Line items by month, place, brand, type and status; lines of unknown suppliers keep no place."""
    located = places(spark, root)
    supplier = table(spark, root, "supplier").join(
        located, F.col("s_nationkey") == located.n_nationkey).select("s_suppkey", "trust_code", "region")
    part = table(spark, root, "part").select("p_partkey", "p_brand", "p_type")
    lineitem = table(spark, root, "lineitem").select(
        "l_partkey", "l_suppkey", _month("l_shipdate").alias("date"), "l_quantity", "l_extendedprice", "l_linestatus")
    return (lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey, "left")
            .join(part, lineitem.l_partkey == part.p_partkey)
            .groupBy("date", F.col("s_suppkey").isNotNull().alias("placed"), "trust_code", "region", "p_brand", "p_type",
                     "l_linestatus")
            .agg(F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.count("*").alias("n")))


def _order_summary(spark: SparkSession, root: str) -> DataFrame:
    """Orders by customer, month and priority."""
    return (_orders(spark, root)
            .groupBy("o_custkey", "trust_code", "region", F.col("c_mktsegment").alias("age_band"),
                     _month("o_orderdate").alias("date"), F.col("o_orderpriority").alias("treatment_function"))
            .agg(F.count_if(F.col("o_orderstatus") != "F").alias("waiting"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count("*").alias("n")))


def datasets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six datasets from one stored summary of the line items and one of the orders, each read once."""
    lines, orders = together(spark, lambda: materialise(_line_summary(spark, root), "lines"),
                             lambda: materialise(_order_summary(spark, root), "orders"))
    placed = lines.where("placed")
    where = ("date", "trust_code", "region")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    chapter = F.concat(F.lit("F"), F.floor((brand_no - 1) / 5).cast("string"))
    return {
        "procedures": placed.groupBy(*where, chapter.alias("opcs_chapter"), F.col("p_brand").alias("procedure_code"))
        .agg(F.sum("quantity").cast("bigint").alias("n_procedures")),
        "imaging": placed.groupBy(*where, F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("modality"))
        .agg(F.sum("n").alias("n_tests")),
        "rtt": orders.groupBy(*where, "treatment_function").agg(
            F.sum("waiting").alias("waiting_list_size"),
            (100 * (F.sum("done").cast("double") / F.sum("n"))).alias("pct_within_18wk")),
        "activity": placed.groupBy(*where, F.col("l_linestatus").alias("activity_type")).agg(F.sum("n").alias("n_activity")),
        "demographics": orders.groupBy(F.year("date").alias("year"), "region", "age_band").agg(
            F.countDistinct("o_custkey").alias("population")),
        "supply": lines.groupBy(quarter_label("date").alias("quarter"), F.col("p_type").alias("category")).agg(
            F.sum("price").alias("spend_gbp"), F.sum("quantity").cast("bigint").alias("units")),
    }


def national_sheet(spark: SparkSession, root: str) -> DataFrame:
    """The waiting list as published workbook rows: text cells, gaps, junk dates, a re-issued month."""
    monthly = rtt(spark, root).groupBy("date").agg(F.sum("waiting_list_size").alias("total"))
    month_no = F.year("date") * 12 + F.month("date")
    rows = monthly.select(
        month_no.cast("bigint").alias("row_no"),
        F.when(month_no % 11 == 0, F.lit("not a date")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("c2"),
        F.col("total").cast("string").alias("c7"),
        F.when(month_no % 3 == 0, F.lit("-")).otherwise((F.col("total") + 5).cast("string")).alias("c8"))
    reissued = monthly.where(month_no % 7 == 0).select(
        (month_no + 1_000_000).cast("bigint").alias("row_no"),
        F.date_format(F.date_add("date", 14), "yyyy-MM-dd").alias("c2"),
        (F.col("total") * 2).cast("string").alias("c7"),
        F.lit(None).cast("string").alias("c8"))
    return rows.unionByName(reissued)


def mapping_rows(spark: SparkSession) -> DataFrame:
    from panelcast.schemas import MAPPING
    return spark.createDataFrame(EQUIPMENT_WEIGHTS, MAPPING)


@dataclass(frozen=True)
class Fleet:
    devices: DataFrame
    operators: DataFrame
    events: DataFrame


def _raw_events(spark: SparkSession, root: str) -> DataFrame:
    device_no = F.col("user_id") % 16
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, root, "events").select(
        "event_id", "ts", "event_type", "value",
        device_no.cast("int").alias("device_no"), k.alias("k"))


def _device_id(no: Column) -> Column:
    return F.concat(F.lit("dev"), no.cast("string"))


def devices(spark: SparkSession, root: str) -> DataFrame:
    no = F.col("device_no")
    site = no % 6
    price = (500 + 50 * no).cast("double")
    starts_per_day = F.col("n_starts") / F.col("n_days")
    return (_raw_events(spark, root)
            .groupBy("device_no")
            .agg(F.count_if(F.col("event_type").isin("view", "click")).alias("n_starts"),
                 F.countDistinct(F.to_date("ts")).alias("n_days"))
            .select(
                _device_id(no).alias("device_id"),
                F.concat(F.lit("type"), (no % 3).cast("string")).alias("device_type"),
                F.concat(F.lit("site"), site.cast("string")).alias("site_id"),
                F.concat(F.lit("region"), (site % 3).cast("string")).alias("region"),
                F.concat(F.lit("specialty"), (no % 4).cast("string")).alias("specialty"),
                F.lit("2023-01-01").cast("date").alias("install_date"),
                F.concat(F.lit("contract"), no.cast("string")).alias("contract_id"),
                price.alias("price_per_session_gbp"),
                (price * 20).alias("monthly_fixed_cost_gbp"),
                (price * 20 * 0.35).alias("min_monthly_floor_gbp"),
                (F.ceil(starts_per_day * 1.25) + no % 3).cast("int").alias("cap_sessions_day")))


def session_events(spark: SparkSession, root: str, active_only: bool = False) -> DataFrame:
    """Starts, ends and errors of the devices; with ``active_only`` no errors, a filter the scan takes.

    ``seq_no`` is twice the source event id: unique, increasing in time, no ranking pass needed.
    """
    raw = _raw_events(spark, root)
    if active_only:
        raw = raw.where(F.col("event_type").isin("view", "click", "purchase", "signup"))
    kind = F.when(F.col("event_type").isin("view", "click"), "active_start").when(
        F.col("event_type").isin("purchase", "signup"), "active_end").otherwise("error")
    is_end = F.col("event_type").isin("purchase", "signup")
    return raw.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        _device_id(F.col("device_no")).alias("device_id"),
        F.concat(F.lit("site"), (F.col("device_no") % 6).cast("string")).alias("site_id"),
        F.concat(F.lit("op"), (F.col("k") % 4).cast("string")).alias("operator_hash"),
        kind.alias("event_type"),
        F.col("ts").alias("ts_device"),
        (F.col("event_id") * 2).alias("seq_no"),
        F.when(is_end & (F.col("k") % 20 != 0), F.col("value") * 10).otherwise(0.0).alias("active_seconds"),
        (F.col("k") % 3).cast("int").alias("n_errors"),
        F.concat(F.lit("Brand#"), (1 + F.col("k") % 25).cast("string")).alias("procedure_code"),
        F.when(F.col("k") % 33 == 0, "suspect").otherwise("ok").alias("ingest_quality"))


def power_events(spark: SparkSession, root: str) -> DataFrame:
    """Two derived rows per device-day: on at its first event, off at its last."""
    span = _raw_events(spark, root).groupBy("device_no", F.to_date("ts").alias("day")).agg(
        F.min(F.struct("ts", "event_id")).alias("first"), F.max(F.struct("ts", "event_id")).alias("last"))
    return span.select(
        "device_no",
        F.explode(F.array(
            F.struct(F.lit("power_on").alias("kind"), F.col("first").alias("at"), F.lit(-1).alias("step")),
            F.struct(F.lit("power_off").alias("kind"), F.col("last").alias("at"), F.lit(1).alias("step")),
        )).alias("p")).select(
            F.concat(F.lit("p"), (F.col("p.at.event_id") * 2 + F.col("p.step")).cast("string")).alias("event_id"),
            _device_id(F.col("device_no")).alias("device_id"),
            F.concat(F.lit("site"), (F.col("device_no") % 6).cast("string")).alias("site_id"),
            F.lit(None).cast("string").alias("operator_hash"),
            F.col("p.kind").alias("event_type"),
            F.col("p.at.ts").alias("ts_device"),
            (F.col("p.at.event_id") * 2 + F.col("p.step")).alias("seq_no"),
            F.lit(0.0).alias("active_seconds"),
            F.lit(0).alias("n_errors"),
            F.lit(None).cast("string").alias("procedure_code"),
            F.lit("ok").alias("ingest_quality"))


def events(spark: SparkSession, root: str) -> DataFrame:
    """The whole device event log."""
    return session_events(spark, root).unionByName(power_events(spark, root))


def operators(spark: SparkSession, root: str) -> DataFrame:
    op = F.col("k") % 4
    return _raw_events(spark, root).select(op.alias("op")).distinct().select(
        F.concat(F.lit("op"), F.col("op").cast("string")).alias("operator_hash"),
        F.lit(None).cast("string").alias("site_id"),
        F.lit(None).cast("string").alias("specialty"),
        F.lit("clinician").alias("role"))


def fleet(spark: SparkSession, root: str) -> Fleet:
    return Fleet(devices(spark, root), operators(spark, root), events(spark, root))
