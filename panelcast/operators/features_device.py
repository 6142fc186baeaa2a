"""Device-day features: calendar, lags, health, operator concentration, peers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import DAILY_LAGS, DAILY_WINDOWS, EXPOSURE_FLOOR_HOURS
from panelcast.functions.panel import lag_columns, rolling_columns, scalar, series_window, trailing, with_group_total

TARGET = "n_billable"
NUMERIC_FEATURES = (
    "dow_sin", "dow_cos", "doy_sin", "doy_cos", "trend", "is_weekend",
    "op_herfindahl", "active_ops_28", "err_rate_28", "downtime_frac_28", "peer_util_lag1",
    *[f"{TARGET}_lag{k}" for k in DAILY_LAGS],
    *[f"{TARGET}_rollmean{w}" for w in DAILY_WINDOWS],
    *[f"{TARGET}_rollstd{w}" for w in DAILY_WINDOWS],
)


def calendar_columns(date: Column) -> dict[str, Column]:
    """Week and year cycles; weekday counts from Monday = 0."""
    week = F.weekday(date) * (2 * math.pi / 7)
    year = F.dayofyear(date) * (2 * math.pi / 365.25)
    return {
        "dow_sin": F.sin(week), "dow_cos": F.cos(week),
        "doy_sin": F.sin(year), "doy_cos": F.cos(year),
        "is_weekend": F.when(F.weekday(date) >= 5, 1).otherwise(0),
    }


def calendar(df: DataFrame) -> DataFrame:
    first = scalar(df, F.min("date"))
    return df.withColumns({
        **calendar_columns(F.col("date")), "trend": F.datediff("date", first) / F.lit(365.25)})


def autoregressive(df: DataFrame) -> DataFrame:
    w = series_window(["device_id"], ["date"])
    return df.withColumns({
        **lag_columns(TARGET, DAILY_LAGS, w), **rolling_columns(TARGET, DAILY_WINDOWS, w, min_obs=2)})


def error_rate(df: DataFrame) -> DataFrame:
    """Errors per session, and their 28-row trailing mean over at least 3 days that had sessions."""
    w = series_window(["device_id"], ["date"])
    return df.withColumn(
        "err_per_session", F.try_divide(F.col("n_errors").cast("double"), F.nullif("n_sessions", F.lit(0)))
    ).withColumn("err_rate_28", F.coalesce(trailing(F.avg, "err_per_session", 28, w, 3), F.lit(0.0)))


def active_operators(df: DataFrame) -> DataFrame:
    w = series_window(["device_id"], ["date"])
    most = trailing(F.max, "n_operators", 28, w, 3).cast("double")
    return df.withColumn("active_ops_28", F.coalesce(most, F.lit(1.0)))


def downtime(df: DataFrame, real: bool = False) -> DataFrame:
    """Constant 0 by default (exposure already carries same-day downtime); ``real`` gives the share
    of the last 28 calendar days, today included, without a row for the device."""
    if not real:
        return df.withColumn("downtime_frac_28", F.lit(0.0))
    days = F.datediff("date", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("device_id").orderBy(days).rangeBetween(-27, 0)
    return df.withColumn("downtime_frac_28", 1 - F.count("*").over(w) / 28)


def operator_herfindahl(sessions: DataFrame, days: int = 28) -> DataFrame:
    """Sum of squared operator shares over the trailing calendar days, today included.

    Rows exist for days with sessions only; sessions without a start or an operator do not count. A sweep: a daily
    operator count enters on its day and leaves `days` later, so there are two rows per operator-day whatever `days` is.
    The sums of counts and of squared counts change by what those rows change; both are running sums of whole numbers. An
    operator's rows on a device are bounded by its days, and so are a device's, which are summed per day first.
    """
    daily = sessions.where(F.col("operator_hash").isNotNull() & F.col("t_start").isNotNull()).groupBy(
        "device_id", F.to_date("t_start").alias("day"), "operator_hash").agg(F.count("*").alias("n"))
    moves = daily.select("device_id", "operator_hash", F.explode(F.array(
        F.struct(F.col("day").alias("date"), F.col("n").alias("change"), F.lit(True).alias("today")),
        F.struct(F.date_add("day", days).alias("date"), (-F.col("n")).alias("change"), F.lit(False).alias("today")),
    )).alias("m")).select("device_id", "operator_hash", "m.*")
    # Where an entry meets an exit on one day, the two changes of the square add up to the right one in either order.
    line = Window.partitionBy("device_id", "operator_hash").orderBy("date", "today").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    moves = moves.withColumn("held", F.sum("change").over(line))
    by_day = moves.groupBy("device_id", "date").agg(
        F.sum("change").alias("change"), F.max("today").alias("today"),
        F.sum(F.col("change") * (2 * F.col("held") - F.col("change"))).alias("square"))  # held^2 - (held - change)^2
    so_far = Window.partitionBy("device_id").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, squares = (F.sum(c).over(so_far).cast("double") for c in ("change", "square"))
    return by_day.select("device_id", "date", "today", total.alias("total"), squares.alias("squares")).where(
        "today").select("device_id", "date", (F.col("squares") / (F.col("total") * F.col("total"))).alias("op_herfindahl"))


def concentration(df: DataFrame, sessions: DataFrame) -> DataFrame:
    w = series_window(["device_id"], ["date"])
    joined = df.join(operator_herfindahl(sessions), ["device_id", "date"], "left").withColumn(
        "op_herfindahl", F.coalesce("op_herfindahl", F.lit(0.0)))
    return joined.withColumn("op_herfindahl_lag1", F.lag("op_herfindahl").over(w))


def peer_utilisation(df: DataFrame) -> DataFrame:
    """Mean of the other devices of the region that day, lagged one row."""
    w = series_window(["device_id"], ["date"])
    # Devices without a region have no peers, so they must not form a group of their own.
    total = with_group_total(
        df, ["region", "date"], {"region_sum": F.sum(TARGET), "region_n": F.count("*")})
    peers = (F.col("region_sum") - F.col(TARGET)) / F.greatest(F.col("region_n") - 1, F.lit(1))
    return total.withColumn("peer_util", F.when(F.col("region").isNotNull(), peers)).withColumn(
        "peer_util_lag1", F.coalesce(F.lag("peer_util").over(w), F.lit(0.0))).drop("region_sum", "region_n")


def build_features(device_day: DataFrame, sessions: DataFrame, devices: DataFrame) -> DataFrame:
    """The full device-day table, with the daily cap. Windows share the (device, date) order."""
    attributes = devices.select("device_id", "region", "specialty", "device_type", "cap_sessions_day")
    base = calendar(device_day.join(attributes, "device_id", "left"))
    joined = peer_utilisation(concentration(base, sessions))
    out = downtime(active_operators(error_rate(autoregressive(joined))))
    return out.withColumn("exposure_hours", F.greatest("exposure_hours", F.lit(EXPOSURE_FLOOR_HOURS)))
