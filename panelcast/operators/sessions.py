"""Event log -> sessions -> device-day.

One device may own a large part of the log, so nothing here windows over a whole device. Ordinal
positions come from ``seq_no`` buckets: ``seq_no`` is unique per device, so a bucket of width B
holds at most B events, and the offset of a bucket is a running sum over one count per bucket (a
device with 10^12 events has 10^6 of them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import MIN_BILLABLE_SECONDS
from panelcast.operators.quality import CheckSpec, validate

BUCKET_WIDTH = 1_000_000


def ordinal(df: DataFrame, keys: list[str], seq: str, width: int = BUCKET_WIDTH, name: str = "ordinal",
            tie: str | None = None) -> DataFrame:
    """1-based position of each row within ``keys`` by ``seq``, without gathering a key's rows.

    A window sees at most ``width`` rows of a bucket; the running offsets are computed over one row
    per bucket. The counting pass reads the key and sequence columns only and combines map-side.
    Rows without a number come last; they and rows of equal number are ordered by ``tie``.
    """
    numbered = F.floor(F.col(seq) / F.lit(width))
    bucketed = df.withColumn("__b", F.coalesce(numbered, F.lit(2 ** 62)))
    counts = bucketed.groupBy(*keys, "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    local = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(F.asc_nulls_last(seq), *([tie] if tie else [])))
    return bucketed.withColumn("__local", local).join(offsets, [*keys, "__b"]).withColumn(
        name, F.col("__local") + F.col("__offset")).drop("__b", "__local", "__offset")


def _seconds_between(start: str, end: str) -> Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, {start}, {end})")
    return micros / 1e6


def sessionise(
    events: DataFrame, min_seconds: float = MIN_BILLABLE_SECONDS, mode: str = "ordinal",
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Pair starts with ends per device.

    ``ordinal`` pairs the i-th start with the i-th end. ``next`` pairs a start with the end that
    directly follows it among the device's active events, so a lost packet cannot shift later pairs.
    Both sides of a pair meet in one join by (device, pair number), a key no device can skew.
    """
    active = events.where(F.col("event_type").isin("active_start", "active_end"))
    is_start = F.col("event_type") == "active_start"
    if mode == "ordinal":
        ranked = ordinal(active, ["device_id", "event_type"], "seq_no", width, tie="event_id")
        pair_no = F.col("ordinal")
    elif mode == "next":
        ranked = ordinal(active, ["device_id"], "seq_no", width, tie="event_id")
        pair_no = F.when(is_start, F.col("ordinal") + 1).otherwise(F.col("ordinal"))
    else:
        raise ValueError(f"unknown pairing mode {mode!r}")
    starts = ranked.where(is_start).select("device_id", pair_no.alias("pair_no"), "site_id", "operator_hash",
                                           "procedure_code", F.col("ts_device").alias("t_start"))
    ends = ranked.where(~is_start).select("device_id", pair_no.alias("pair_no"), F.col("event_id").alias("session_id"),
                                          F.col("ts_device").alias("t_end"), F.col("active_seconds").alias("measured"),
                                          "n_errors", "ingest_quality")
    timed = starts.join(ends, ["device_id", "pair_no"])
    duration = F.when(F.col("measured") > 0, F.col("measured")).otherwise(
        _seconds_between("t_start", "t_end"))
    return timed.select(
        "session_id", "device_id", "site_id", "operator_hash", "procedure_code",
        "t_start", "t_end", duration.alias("active_seconds"), F.col("n_errors").cast("int").alias("n_errors"),
        F.coalesce((duration >= min_seconds) & (F.col("ingest_quality") == "ok"), F.lit(False)).alias("billable"))


def attach_billing(sessions: DataFrame, devices: DataFrame) -> DataFrame:
    """Device price on billable sessions, 0 otherwise."""
    price = devices.select("device_id", "price_per_session_gbp")
    return sessions.join(price, "device_id", "left").withColumn(
        "billed_amount_gbp", F.when(F.col("billable"), F.col("price_per_session_gbp")).otherwise(0.0)
    ).drop("price_per_session_gbp")


def exposure(events: DataFrame) -> DataFrame:
    """Powered-on hours per device-day from the first on and first off; days lacking one are dropped."""
    kind = F.col("event_type")
    first_of = lambda k: F.min_by(
        F.when(kind == k, F.col("ts_device")), F.when(kind == k, F.col("seq_no")))
    return (events.where(kind.isin("power_on", "power_off"))
            .groupBy("device_id", F.to_date("ts_device").alias("date"))
            .agg(first_of("power_on").alias("on_at"), first_of("power_off").alias("off_at"))
            .where(F.col("on_at").isNotNull() & F.col("off_at").isNotNull())
            .select("device_id", "date", (_seconds_between("on_at", "off_at") / 3600.0).alias("exposure_hours")))


#: Exposure is negative where a device is first switched off before it is first switched on.
EXPOSURE_SPEC = CheckSpec(required_cols=("device_id", "date", "exposure_hours"), non_negative=("exposure_hours",),
                          unique_keys=("device_id", "date"), date_col="date")


def check_exposure(exposed: DataFrame) -> DataFrame:
    """The check results of an exposure table; the feature step's floor would hide negative hours."""
    return validate("exposure", exposed, EXPOSURE_SPEC)


def session_rollup(sessions: DataFrame) -> DataFrame:
    """Per device and start day. Partial sums are formed per operator first, so the distinct
    operator count needs no second copy of the rows."""
    per_operator = sessions.groupBy("device_id", F.to_date("t_start").alias("date"), "operator_hash").agg(
        F.count("*").alias("n"), F.count_if("billable").alias("b"),
        F.sum("active_seconds").alias("s"), F.sum("n_errors").alias("e"),
        F.sum("billed_amount_gbp").alias("g"))
    return per_operator.groupBy("device_id", "date").agg(
        F.sum("n").alias("n_sessions"), F.sum("b").alias("n_billable"),
        F.coalesce(F.sum("s"), F.lit(0.0)).alias("active_seconds"), F.sum("e").alias("n_errors"),
        F.count("operator_hash").alias("n_operators"),
        F.coalesce(F.sum("g"), F.lit(0.0)).alias("billed_gbp"))


def device_day(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per device and powered day; sessions on days without a power pair are left out."""
    joined = exposure(events).join(session_rollup(sessions), ["device_id", "date"], "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    amount = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return joined.select(
        "device_id", "date", count("n_sessions"), count("n_billable"), amount("active_seconds"),
        "exposure_hours", count("n_errors"), count("n_operators"), amount("billed_gbp"))
