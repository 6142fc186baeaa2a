"""Registered queries: sessions, device features, count model, risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import metrics
from panelcast.functions.panel import rounded, scalar
from panelcast.operators import count_model, features_device as fd, risk, sessions
from panelcast.operators.naive import weekly_naive
from panelcast.plans import flows
from panelcast.plans.registry import query
from panelcast.sources import adapters
from panelcast.sources.storage import materialise

HORIZON = 7
N_SIMS = 4000
GIVEN_SIMS = 4000
GIVEN_ALPHA = 0.1
# A fixed model for checks that take the coefficients as given.
GIVEN = count_model.CountModel(
    "negbin", (-1.2, 0.05, -0.03, 0.1, 0.02, 0.03), GIVEN_ALPHA,
    ("dow_sin", "dow_cos", "n_billable_lag1", "n_billable_rollmean7", "op_herfindahl"), 0.2)


def billed_sessions(spark: SparkSession, root: str, mode: str = "ordinal") -> DataFrame:
    return sessions.attach_billing(
        sessions.sessionise(adapters.session_events(spark, root, active_only=True), mode=mode), adapters.devices(spark, root))


def device_days(spark: SparkSession, root: str) -> DataFrame:
    return sessions.device_day(adapters.power_events(spark, root), billed_sessions(spark, root))


def days_and_features(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Device-days and their features. Sessions and days are written once, as several branches read them."""
    billed = materialise(billed_sessions(spark, root), "sessions")
    days = materialise(sessions.device_day(adapters.power_events(spark, root), billed), "device-day")
    return days, fd.build_features(days, billed, adapters.devices(spark, root))


def features(spark: SparkSession, root: str) -> DataFrame:
    return days_and_features(spark, root)[1]


def stored_features(spark: SparkSession, root: str) -> DataFrame:
    return materialise(features(spark, root), "device-features")


KEYS = ("device_id", "date")


def _show(df: DataFrame, *columns: str) -> DataFrame:
    return rounded(df.select(*KEYS, *columns))


@query
def f1_sessions(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sessions.sessionise(adapters.session_events(spark, root)))


@query
def f1_sessions_next(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sessions.sessionise(adapters.session_events(spark, root), mode="next"))


@query
def f2_duration(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sessions.sessionise(adapters.session_events(spark, root)).select(
        "session_id", "device_id", "active_seconds"))


@query
def f3_billable(spark: SparkSession, root: str) -> DataFrame:
    return sessions.sessionise(adapters.session_events(spark, root)).groupBy("device_id", "billable").agg(
        F.count("*").alias("n_sessions"))


@query
def f4_billing(spark: SparkSession, root: str) -> DataFrame:
    return rounded(billed_sessions(spark, root).select("session_id", "device_id", "billable", "billed_amount_gbp"))


@query
def f5_exposure(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sessions.exposure(adapters.power_events(spark, root)))


@query
def f6_session_rollup(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sessions.session_rollup(billed_sessions(spark, root)))


@query
def f7_device_day(spark: SparkSession, root: str) -> DataFrame:
    return rounded(device_days(spark, root))


@query
def f8_calendar(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.calendar(sessions.exposure(adapters.power_events(spark, root))),
                 "dow_sin", "dow_cos", "doy_sin", "doy_cos", "is_weekend", "trend")


@query
def f9_lags(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.autoregressive(device_days(spark, root)), "n_billable_lag1", "n_billable_lag7", "n_billable_lag14")


@query
def f10_rolling(spark: SparkSession, root: str) -> DataFrame:
    out = fd.autoregressive(device_days(spark, root))
    return _show(out, *[c for c in out.columns if "_roll" in c])


@query
def f11_error_rate(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.error_rate(device_days(spark, root)), "err_per_session", "err_rate_28")


@query
def f12_downtime(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.downtime(device_days(spark, root)), "downtime_frac_28")


@query
def f12_downtime_real(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.downtime(device_days(spark, root), real=True), "downtime_frac_28")


@query
def f13_herfindahl(spark: SparkSession, root: str) -> DataFrame:
    # A ratio of whole numbers is the same double everywhere, so it needs no rounding.
    return fd.operator_herfindahl(billed_sessions(spark, root))


@query
def f14_active_operators(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.active_operators(device_days(spark, root)), "active_ops_28")


@query
def f15_peers(spark: SparkSession, root: str) -> DataFrame:
    region = adapters.devices(spark, root).select("device_id", "region")
    return _show(fd.peer_utilisation(device_days(spark, root).join(region, "device_id")), "peer_util", "peer_util_lag1")


@query
def f16_exposure_floor(spark: SparkSession, root: str) -> DataFrame:
    return _show(features(spark, root), "exposure_hours")


@query
def f17_device_features(spark: SparkSession, root: str) -> DataFrame:
    rows = features(spark, root)
    shown = [c for c in fd.NUMERIC_FEATURES if c != "op_herfindahl"]
    labels = ("region", "specialty", "device_type", "cap_sessions_day", "n_billable")
    amounts = [F.round(c, 6).alias(c) if t == "double" else F.col(c)
               for c, t in rows.select("exposure_hours", *shown).dtypes]
    return rows.select(*KEYS, *labels, *amounts, "op_herfindahl")


# ---------------------------------------------------------------- count model

def _given_scores(spark: SparkSession, root: str) -> DataFrame:
    rows = features(spark, root).where(F.col("n_billable_rollmean7").isNotNull() & F.col("n_billable_lag1").isNotNull())
    scored = count_model.predict_mu(GIVEN, rows)
    return scored.withColumn("variance", count_model.predictive_variance(GIVEN_ALPHA)).withColumns({
        "lo": F.greatest(F.col("mu") - F.sqrt("variance"), F.lit(0.0)),
        "hi": F.col("mu") + F.sqrt("variance"), "y": F.col("n_billable").cast("double")})


@query
def g1_pinball(spark: SparkSession, root: str) -> DataFrame:
    return rounded(_given_scores(spark, root).groupBy("device_id").agg(
        metrics.pinball("y", "lo", 0.05).alias("p05"), metrics.pinball("y", "mu", 0.5).alias("p50"),
        metrics.pinball("y", "hi", 0.95).alias("p95")))


@query
def g2_coverage(spark: SparkSession, root: str) -> DataFrame:
    return rounded(_given_scores(spark, root).groupBy("device_id").agg(metrics.coverage("y", "lo", "hi").alias("coverage")))


@query
def g3_design(spark: SparkSession, root: str) -> DataFrame:
    """Design rows (intercept and features) by their length and sum."""
    cols = fd.NUMERIC_FEATURES
    rows = count_model.design(count_model.training_rows(features(spark, root)), cols)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return rounded(rows.select(*KEYS, F.size("x").alias("width"), total.alias("row_sum")), 4)


@query
def g4_training_rows(spark: SparkSession, root: str) -> DataFrame:
    return _show(count_model.training_rows(features(spark, root)), "n_billable", "n_sessions", "cap_sessions_day")


@query
def g5_poisson(spark: SparkSession, root: str) -> DataFrame:
    """Fitted mean of every training row under the Poisson model."""
    rows = stored_features(spark, root)
    model = count_model.fit_poisson(rows)
    return count_model.predict_mu(model, count_model.training_rows(rows)).select(
        *KEYS, F.lit(model.kind).alias("kind"), "n_billable", "mu")


@query
def g6_dispersion(spark: SparkSession, root: str) -> DataFrame:
    return rounded(_given_scores(spark, root).groupBy("device_id").agg(
        count_model.dispersion(F.col("y"), F.col("mu")).alias("alpha")))


@query
def g7_negative_binomial(spark: SparkSession, root: str) -> DataFrame:
    """Fitted mean of every training row under the negative-binomial model."""
    rows = stored_features(spark, root)
    model = count_model.fit(rows)
    return count_model.predict_mu(model, count_model.training_rows(rows)).select(
        *KEYS, F.lit(model.kind).alias("kind"), F.lit(model.alpha).alias("alpha"), "n_billable", "mu")


@query
def g8_fallback_ladder(spark: SparkSession, root: str) -> DataFrame:
    """With too few rows below their cap for a regression the model is a rate per exposure hour."""
    rows = stored_features(spark, root)
    last = F.col("date") == scalar(rows, F.max("date"))
    model = count_model.fit(rows.withColumn("cap_sessions_day", F.when(last, 1_000_000).otherwise(0)))
    return rounded(count_model.predict_mu(model, rows).select(*KEYS, F.lit(model.kind).alias("kind"), "mu"))


@query
def g9_predict_mu(spark: SparkSession, root: str) -> DataFrame:
    return _show(_given_scores(spark, root), "mu")


@query
def g10_predict_quantiles(spark: SparkSession, root: str) -> DataFrame:
    scored = _given_scores(spark, root).select(*KEYS, "mu")
    return rounded(count_model.predict_quantiles(GIVEN, scored, (0.05, 0.5, 0.95), names=["q05", "q50", "q95"]))


@query
def g11_predictive_variance(spark: SparkSession, root: str) -> DataFrame:
    return _show(_given_scores(spark, root), "variance")


@query
def g12_backtest(spark: SparkSession, root: str) -> DataFrame:
    return count_model.backtest(stored_features(spark, root), HORIZON)


@query
def d22_weekly_naive(spark: SparkSession, root: str) -> DataFrame:
    return _show(fd.autoregressive(device_days(spark, root)).withColumn("naive", weekly_naive()), "naive")


# ---------------------------------------------------------------- risk

@query
def h1_horizon_forecast(spark: SparkSession, root: str) -> DataFrame:
    rows = stored_features(spark, root)
    return risk.forecast_horizon(count_model.fit(rows), rows, adapters.devices(spark, root), HORIZON)


@query
def h1_horizon_forecast_given(spark: SparkSession, root: str) -> DataFrame:
    return rounded(given_forecast(spark, root))


@query
def h2_utilisation_panel(spark: SparkSession, root: str) -> DataFrame:
    return rounded(risk.utilisation_panel(device_days(spark, root)))


def _vectors(spark: SparkSession, root: str) -> DataFrame:
    days = materialise(device_days(spark, root), "device-day")
    return materialise(risk.panel_vectors(risk.utilisation_panel(days)), "vectors")


@query
def h3_shrunk_covariance(spark: SparkSession, root: str) -> DataFrame:
    return rounded(risk.shrunk_covariance(_vectors(spark, root)))


@query
def h4_correlation(spark: SparkSession, root: str) -> DataFrame:
    return rounded(risk.correlation(risk.shrunk_covariance(_vectors(spark, root))))


def given_forecast(spark: SparkSession, root: str, rows: DataFrame | None = None) -> DataFrame:
    """The recursion under a fixed model with the previous value and calendar as inputs."""
    model = count_model.CountModel("negbin", (-1.0, 0.05, 0.04), 0.1, ("dow_sin", "n_billable_lag1"), 0.0)
    rows = features(spark, root) if rows is None else rows
    return risk.forecast_horizon(model, rows, adapters.devices(spark, root), HORIZON)


def given_positions(spark: SparkSession, root: str, rows: DataFrame | None = None) -> DataFrame:
    return risk.book(materialise(given_forecast(spark, root, rows), "forecast"), adapters.devices(spark, root),
                     GIVEN_ALPHA, HORIZON)


def given_draws(spark: SparkSession, root: str, positions: DataFrame) -> DataFrame:
    """Session draws from integer arithmetic around each device's expected sessions."""
    number = F.regexp_extract("device_id", r"(\d+)", 1).cast("bigint")
    u = lambda sim: ((sim * 7919 + number * 104729) * (sim + 31 * number) % 1000003) / 1000003
    raw = F.transform(F.sequence(F.lit(1), F.lit(GIVEN_SIMS)),
                      lambda sim: F.floor(F.col("exp_sessions") * (u(sim) + 0.5)).cast("double"))
    return risk.cap_and_floor(positions.select("device_id", raw.alias("sessions")), positions)


def _given(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    positions = materialise(given_positions(spark, root), "positions")
    return positions, given_draws(spark, root, positions)


@query
def h5_book_moments(spark: SparkSession, root: str) -> DataFrame:
    return rounded(given_positions(spark, root))


@query
def h6_copula_factor(spark: SparkSession, root: str) -> DataFrame:
    """Loading of each device on the common draw of each panel date, and the weight of its own draw."""
    days = materialise(device_days(spark, root), "device-day")
    dates = risk.utilisation_panel(days).agg(F.array_sort(F.collect_set("date"))).scalar()
    return rounded(flows.copula_loadings(days).select("device_id", "idio", F.posexplode("loadings").alias("i", "loading"))
                   .select("device_id", F.element_at(dates, F.col("i") + 1).alias("date"), "loading", "idio"))


def _simulated(
    spark: SparkSession, root: str, days: DataFrame | None = None, rows: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    if days is None or rows is None:
        days, rows = days_and_features(spark, root)
    positions = materialise(given_positions(spark, root, rows), "positions")
    return positions, materialise(risk.simulate(positions, flows.copula_loadings(days), N_SIMS), "draws")


@query
def h7_correlated_draws(spark: SparkSession, root: str) -> DataFrame:
    return _simulated(spark, root)[1].select(
        "device_id", F.posexplode(F.arrays_zip("sessions", "revenue")).alias("sim", "v")).select(
            "sim", "device_id", "v.sessions", "v.revenue")


@query
def h8_nb_parameters(spark: SparkSession, root: str) -> DataFrame:
    return rounded(risk.nb_parameters(given_positions(spark, root)).select("device_id", "nb_r", "nb_p"), 5)


@query
def h9_cap_and_floor(spark: SparkSession, root: str) -> DataFrame:
    long = _given(spark, root)[1].select("device_id", F.posexplode(F.arrays_zip("sessions", "revenue")).alias("i", "v"))
    return rounded(long.select((F.col("i") + 1).alias("sim"), "device_id", "v.sessions", "v.revenue"), 4)


@query
def h10_tail_risk(spark: SparkSession, root: str) -> DataFrame:
    positions, draws = _given(spark, root)
    return rounded(risk.tail_risk(draws, positions), 4)


@query
def h11_device_statistics(spark: SparkSession, root: str) -> DataFrame:
    positions, draws = _given(spark, root)
    return rounded(risk.device_statistics(draws, positions).select(
        "device_id", "exp_revenue", "sigma", "cv", "beta", "exp_sessions"), 5)


@query
def h12_suggested_price(spark: SparkSession, root: str) -> DataFrame:
    positions, draws = _given(spark, root)
    priced = risk.suggested_price(risk.device_statistics(draws, positions), positions)
    return rounded(priced.select("device_id", "suggested_price"), 4)


@query
def h13_utilisation_at_risk(spark: SparkSession, root: str) -> DataFrame:
    positions, draws = _given(spark, root)
    return rounded(risk.device_statistics(draws, positions).select("device_id", "uar_p5", "floor_breach_prob"))


@query
def h14_latest_concentration(spark: SparkSession, root: str) -> DataFrame:
    return risk.latest_concentration(features(spark, root))


@query
def h15_diversification(spark: SparkSession, root: str) -> DataFrame:
    return rounded(risk.diversification(_given(spark, root)[1]))


def given_book(spark: SparkSession, root: str) -> DataFrame:
    days, rows = days_and_features(spark, root)
    positions = materialise(given_positions(spark, root, rows), "positions")
    return risk.price_book(given_draws(spark, root, positions), positions, rows, "run-1")


@query
def h16_price_book(spark: SparkSession, root: str) -> DataFrame:
    days, rows = days_and_features(spark, root)
    positions, draws = _simulated(spark, root, days, rows)
    return risk.price_book(draws, positions, rows, "run-1")


@query
def h16_portfolio_summary(spark: SparkSession, root: str) -> DataFrame:
    days, rows = days_and_features(spark, root)
    positions, draws = _simulated(spark, root, days, rows)
    priced = materialise(risk.price_book(draws, positions, rows, "run-1"), "book")
    return risk.portfolio_summary(draws, positions, priced)
