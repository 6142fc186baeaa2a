"""Horizon forecast, utilisation correlation, copula simulation and pricing of a device book."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import (
    BETA_LOADING, CV_LOADING, DAILY_LAGS, DAILY_WINDOWS, DAYS_PER_MONTH, DEFAULT_CAP,
    WEEKDAY_EXPOSURE_HOURS, WEEKEND_EXPOSURE_HOURS,
)
from panelcast.functions.distributions import law_quantiles, normal_cdf
from panelcast.functions.folds import bind, deviation_of, matrix, mean_of, summed, tail, vector
from panelcast.functions.panel import scalar
from panelcast.operators.count_model import MU_FLOOR, CountModel, predictive_variance
from panelcast.operators.features_device import TARGET, calendar_columns

SLOW_FEATURES = ("op_herfindahl", "active_ops_28", "err_rate_28", "downtime_frac_28", "peer_util_lag1")
BLOCK = 512
#: Largest share of a device's variance that it has in common with others.
MAX_COMMON = 0.999
#: Devices whose draws are worked on at once.
STRIPE = 64
DRAWS = "device_id string, sessions array<double>, revenue array<double>"


# ---------------------------------------------------------------- horizon forecast

def device_state(features: DataFrame) -> DataFrame:
    """One row per device: last date, frozen features and the last 28 target values, oldest first."""
    keep = max(*DAILY_LAGS, *DAILY_WINDOWS)
    newest = Window.partitionBy("device_id").orderBy(F.desc("date"))
    slow = [c for c in (*SLOW_FEATURES, "trend") if c in features.columns]
    recent = features.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= keep)
    value = F.coalesce(F.col(TARGET).cast("double"), F.lit(0.0))
    return recent.groupBy("device_id").agg(
        F.max("date").alias("last_date"),
        F.max_by(F.struct(*[F.col(c).cast("double").alias(c) for c in slow]), "date").alias("slow"),
        F.transform(F.array_sort(F.collect_list(F.struct("date", value.alias("v")))), lambda s: s["v"])
        .alias("history"))


def history_features(history: Column, ddof: int) -> dict[str, Column]:
    """Lags and trailing statistics at the end of a value array; short histories use their mean."""
    out: dict[str, Column] = {}
    for k in DAILY_LAGS:
        out[f"{TARGET}_lag{k}"] = F.coalesce(F.try_element_at(history, F.lit(-k)), mean_of(history))
    for w in DAILY_WINDOWS:
        out[f"{TARGET}_rollmean{w}"] = mean_of(tail(history, w))
        out[f"{TARGET}_rollstd{w}"] = deviation_of(tail(history, w), ddof)
    return out


def exposure_hours(date: Column) -> Column:
    return F.when(F.weekday(date) >= 5, WEEKEND_EXPOSURE_HOURS).otherwise(WEEKDAY_EXPOSURE_HOURS)


def forecast_horizon(
    model: CountModel, features: DataFrame, devices: DataFrame, horizon_days: int, compat: bool = False
) -> DataFrame:
    """Recursive daily mean per device, the prediction fed back into its own history.

    The recursion is a fold over the horizon inside one row per device, so it costs a single
    projection however many devices there are. ``compat`` uses the population deviation in the
    recursion; by default it matches the sample deviation of training.
    """
    state = device_state(features)

    def mean(day: Column, step: Column, history: Column) -> Column:
        if model.kind == "naive":
            return F.greatest(exposure_hours(day) * model.fallback_rate, F.lit(MU_FLOOR))
        values = {
            **calendar_columns(day), **history_features(history, 0 if compat else 1),
            "trend": F.col("slow.trend") + step / F.lit(365.25),
            **{c: F.col(f"slow.{c}") for c in SLOW_FEATURES},
        }
        eta = F.lit(float(model.params[0])) + F.log(exposure_hours(day))
        for b, c in zip(model.params[1:], model.feature_cols):
            eta = eta + F.lit(float(b)) * values[c]
        return F.greatest(F.exp(eta), F.lit(MU_FLOOR))

    def advance(history: Column, step: Column) -> Column:
        mu = bind(F.date_add(F.col("last_date"), step), lambda day: mean(day, step, history))
        return F.concat(history, F.array(mu))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(horizon_days)), F.col("history"), advance)
    days = state.select("device_id", "last_date", F.posexplode(tail(walked, horizon_days)).alias("pos", "mu"))
    date = F.date_add("last_date", F.col("pos") + 1)
    cap = devices.select("device_id", "cap_sessions_day")
    return days.join(cap, "device_id", "left").select(
        "device_id", date.alias("date"), "mu", exposure_hours(date).alias("exposure_hours"),
        F.coalesce("cap_sessions_day", F.lit(DEFAULT_CAP)).alias("cap_sessions_day"))


# ---------------------------------------------------------------- correlation

def utilisation_panel(device_day: DataFrame, lookback: int = 120) -> DataFrame:
    """Recent counts, long form. Missing device-days count as zero in every later moment."""
    newest = scalar(device_day, F.max("date"))
    return device_day.where(F.col("date") >= F.date_sub(newest, lookback)).groupBy("device_id", "date").agg(
        F.sum("n_billable").cast("double").alias("x"))


def panel_vectors(panel: DataFrame) -> DataFrame:
    """One centred vector per device over all dates of the panel, gaps filled with zero.

    The vector length is the number of dates in the lookback, a parameter-bound size.
    """
    dates = panel.select("date").distinct().agg(F.array_sort(F.collect_list("date")).alias("dates"))
    calendar = dates.scalar()
    seen = panel.groupBy("device_id").agg(F.map_from_entries(F.collect_list(F.struct("date", "x"))).alias("by_date"))
    raw = seen.select("device_id", "by_date", calendar.alias("dates"))
    filled = raw.select("device_id", F.transform(
        "dates", lambda d: F.coalesce(F.try_element_at(F.col("by_date"), d), F.lit(0.0))).alias("v"))
    centre = filled.withColumn("m", mean_of(F.col("v")))
    return centre.select("device_id", F.transform("v", lambda x: x - F.col("m")).alias("v"))


def shrinkage(vectors: DataFrame) -> tuple[int, int, float, float]:
    """(dates, devices, shrinkage, mean variance) of the Ledoit-Wolf estimate.

    All its moments follow from the date-by-date Gram matrix (the Gram trick): its size is the
    lookback squared, so the cost is linear in devices and no device pair is ever formed.
    """

    def fold(batch) -> np.ndarray:
        x = matrix(batch, "v")
        return np.append((x.T @ x).ravel(), len(x))

    flat = summed(vectors.select("v"), fold)
    if not len(flat):
        return 0, 0, 1.0, 1.0
    p, gram = int(flat[-1]), flat[:-1]
    n = math.isqrt(len(gram))
    gram = gram.reshape(n, n)
    m = np.trace(gram) / n / p
    sum_s2 = float((gram ** 2).sum()) / n ** 2
    d2 = sum_s2 - p * m * m
    b2 = (float((np.diag(gram) ** 2).sum()) / n - sum_s2) / n
    s = 0.0 if d2 <= 0 else min(max(b2, 0.0), d2) / d2
    return n, p, s, float(m)


def _blocks(devices: int) -> int:
    return max(1, math.ceil(devices / BLOCK))


def shrunk_covariance(vectors: DataFrame, stats: tuple[int, int, float, float] | None = None) -> DataFrame:
    """Long (dev_a, dev_b, cov) of the shrunk covariance: the matrix itself is the result.

    Devices are hashed into blocks; a task receives two blocks of vectors and multiplies them, so
    shuffle volume is devices x blocks and a task's memory is bounded by the block size. The
    simulation does not need this matrix (see ``panel_loadings``).
    """
    n, p, s, m = stats or shrinkage(vectors)
    blocks = _blocks(p)
    block = F.pmod(F.xxhash64("device_id"), F.lit(blocks)).cast("int")
    partners = F.sequence(F.lit(0), F.lit(blocks - 1))
    placed = vectors.withColumn("own", block).withColumn("other", F.explode(partners))
    # Distinct names on the two sides keep the self-pairing unambiguous for the analyser.
    left = placed.select(F.col("device_id").alias("dev_a"), F.col("v").alias("v_a"),
                         F.col("own").alias("a1"), F.col("other").alias("b1"))
    right = placed.select(F.col("device_id").alias("dev_b"), F.col("v").alias("v_b"),
                          F.col("other").alias("a2"), F.col("own").alias("b2"))
    identity = n < 10 or p < 2

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"dev_a": [], "dev_b": [], "cov": []})
        same = a["dev_a"].to_numpy()[:, None] == b["dev_b"].to_numpy()[None, :]
        if identity:
            cov = same.astype(float)
        else:
            cov = (1 - s) * (np.stack(a["v_a"].to_numpy()) @ np.stack(b["v_b"].to_numpy()).T) / n + s * m * same
        return pd.DataFrame({
            "dev_a": np.repeat(a["dev_a"].to_numpy(), len(b)),
            "dev_b": np.tile(b["dev_b"].to_numpy(), len(a)), "cov": cov.ravel()})

    return left.groupBy("a1", "b1").cogroup(right.groupBy("a2", "b2")).applyInPandas(
        multiply, "dev_a string, dev_b string, cov double")


def correlation(cov: DataFrame) -> DataFrame:
    """Long (dev_a, dev_b, corr): off-diagonal clipped to +-0.999, unit diagonal."""
    var = cov.where(F.col("dev_a") == F.col("dev_b")).select(
        F.col("dev_a").alias("d"), F.sqrt(F.greatest("cov", F.lit(1e-9))).alias("sd"))
    a = var.select(F.col("d").alias("dev_a"), F.col("sd").alias("sd_a"))
    b = var.select(F.col("d").alias("dev_b"), F.col("sd").alias("sd_b"))
    ratio = F.col("cov") / (F.col("sd_a") * F.col("sd_b"))
    clipped = F.least(F.greatest(ratio, F.lit(-0.999)), F.lit(0.999))
    return cov.join(a, "dev_a").join(b, "dev_b").select(
        "dev_a", "dev_b", F.when(F.col("dev_a") == F.col("dev_b"), 1.0).otherwise(clipped).alias("corr"))


# ---------------------------------------------------------------- copula loadings

def panel_loadings(vectors: DataFrame, stats: tuple[int, int, float, float]) -> DataFrame:
    """Loadings (device_id, loadings, idio) whose Gaussian law has the shrunk correlation, at every book size.

    The shrunk covariance is (1-s) X'X/n + s m I, so a device's normal is a combination of one
    common draw per panel date and one draw of its own: no factorisation, linear in devices. The common part of a
    device is at most ``MAX_COMMON`` of its variance, so that no two devices correlate beyond +-``MAX_COMMON``; this
    touches only devices above that share, and the law stays a correlation law without any lift.
    """
    n, p, s, m = stats
    if n < 10 or p < 2:
        return vectors.select("device_id", F.array().cast("array<double>").alias("loadings"), F.lit(1.0).alias("idio"))
    common = (1 - s) / n
    power = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    variance = F.greatest(common * power + s * m, F.lit(1e-9))
    share = common * power / variance
    scaled = vectors.withColumns({"share": F.least(share, F.lit(MAX_COMMON)), "scale": F.sqrt(
        common / variance * F.when(share > MAX_COMMON, MAX_COMMON / share).otherwise(1.0))})
    return scaled.select("device_id", F.transform("v", lambda x: x * F.col("scale")).alias("loadings"),
                         F.sqrt(1 - F.col("share")).alias("idio"))


# ---------------------------------------------------------------- simulation

def book(forecast: DataFrame, devices: DataFrame, alpha: float, horizon_days: int) -> DataFrame:
    """Per device: horizon mean and variance, session cap, price, floor and fixed cost."""
    frac = horizon_days / DAYS_PER_MONTH
    per_device = forecast.groupBy("device_id").agg(
        F.sum("mu").alias("exp_sessions"),
        F.sum(predictive_variance(alpha)).alias("var_sessions"),
        F.min("cap_sessions_day").alias("cap_day"))
    # Working days are counted over the distinct forecast dates of the whole book.
    weekdays = scalar(forecast.select("date").distinct(), F.count_if(F.weekday("date") < 5))
    working = F.when(weekdays > 0, weekdays).otherwise(horizon_days)
    econ = devices.select(
        "device_id", "site_id", "region", "specialty", "price_per_session_gbp",
        (F.col("min_monthly_floor_gbp") * frac).alias("floor_gbp"),
        (F.col("monthly_fixed_cost_gbp") * frac).alias("fixed_gbp"))
    return per_device.join(econ, "device_id").withColumn("cap_sessions", (F.col("cap_day") * working).cast("double"))


def nb_parameters(df: DataFrame, mean: str = "exp_sessions", var: str = "var_sessions") -> DataFrame:
    """Negative-binomial (r, p) by moments, guarded against under-dispersion."""
    m = F.col(mean)
    v = F.greatest(F.col(var), m + 1e-6)
    r = m * m / (v - m)
    return df.withColumns({
        "nb_r": F.greatest(r, F.lit(1e-3)),
        "nb_p": F.least(F.greatest(r / (r + m), F.lit(1e-6)), F.lit(1 - 1e-6))})


def _normals(seed: int, stream: int, size: int) -> np.ndarray:
    """Counter-based draws: a stream depends on its key only, not on the partition it is made in."""
    return np.random.Generator(np.random.Philox(key=[seed & (2**64 - 1), stream & (2**64 - 1)])).standard_normal(size)


def simulate(positions: DataFrame, loadings: DataFrame, n_sims: int = 4000, seed: int = 8) -> DataFrame:
    """Draws, one row of arrays per device: copula normals -> count quantile -> cap, floor.

    Tasks own devices. Common draws are regenerated from their keys in each task, so nothing is
    broadcast and a retried task repeats the same numbers. A device whose mean passes the largest number reaches its cap
    in every draw.
    """
    tasks = positions.sparkSession.sparkContext.defaultParallelism
    # A row costs n_sims quantiles, so rows are spread by count instead of by their small size.
    joined = nb_parameters(positions).join(loadings, "device_id", "left").repartition(tasks, "device_id").select(
        "device_id", F.xxhash64("device_id").alias("stream"), "exp_sessions", "nb_r", "nb_p", "cap_sessions",
        "price_per_session_gbp", "floor_gbp",
        F.coalesce("loadings", F.array().cast("array<double>")).alias("loadings"),
        F.coalesce("idio", F.lit(1.0)).alias("idio"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.zeros((0, n_sims))
        for pdf in batches:
            for at in range(0, len(pdf), STRIPE):
                part = pdf.iloc[at: at + STRIPE]
                factors = max(map(len, part["loadings"]), default=0)
                if len(common) < factors:
                    common = np.stack([_normals(seed, i, n_sims) for i in range(factors)])
                weights = np.zeros((len(part), len(common)))
                for i, w in enumerate(part["loadings"]):
                    weights[i, : len(w)] = w
                own = np.stack([_normals(seed + 1, int(k), n_sims) for k in part["stream"]])
                u = normal_cdf(part["idio"].to_numpy()[:, None] * own + weights @ common)
                r, p = part["nb_r"].to_numpy(), part["nb_p"].to_numpy()
                endless = np.isposinf(part["exp_sessions"].to_numpy(float))  # its moments have no parameters
                mean, r = np.where(endless, np.inf, r * (1 - p) / p), np.where(endless, 1.0, r)
                sessions = np.stack([law_quantiles(x, m, k) for x, m, k in zip(u, mean, r)])
                sessions = np.minimum(sessions, part["cap_sessions"].to_numpy()[:, None])
                revenue = np.maximum(sessions * part["price_per_session_gbp"].to_numpy()[:, None],
                                     part["floor_gbp"].to_numpy()[:, None])
                yield pd.DataFrame({"device_id": part["device_id"].to_numpy(), "sessions": list(sessions),
                                    "revenue": list(revenue)})

    return joined.mapInPandas(draw, DRAWS)


def cap_and_floor(draws: DataFrame, positions: DataFrame) -> DataFrame:
    """Contract terms applied to raw session draws (device_id, sessions array)."""
    terms = positions.select("device_id", "cap_sessions", "price_per_session_gbp", "floor_gbp")
    capped = F.transform("sessions", lambda x: F.least(x, F.col("cap_sessions")))
    return draws.join(terms, "device_id").withColumn("sessions", capped).select(
        "device_id", "sessions", F.transform("sessions", lambda x: F.greatest(
            x * F.col("price_per_session_gbp"), F.col("floor_gbp"))).alias("revenue"))


def book_revenue(draws: DataFrame) -> np.ndarray:
    """Revenue of the whole book in each simulation: one vector of their number, whatever the book's size."""
    return summed(draws.select("revenue"), lambda batch: matrix(batch, "revenue").sum(axis=0))


def portfolio_totals(draws: DataFrame, totals: np.ndarray | None = None) -> DataFrame:
    totals = book_revenue(draws) if totals is None else totals
    return draws.sparkSession.createDataFrame(
        [(i, float(v)) for i, v in enumerate(totals)], "sim int, book_revenue double")


def tail_risk(
    draws: DataFrame, positions: DataFrame, alpha: float = 0.05, totals: np.ndarray | None = None
) -> DataFrame:
    """One row: revenue mean and deviation, margin, VaR, CVaR and probability of loss."""
    fixed = scalar(positions, F.sum("fixed_gbp"))
    losses = portfolio_totals(draws, totals).select("book_revenue", (fixed - F.col("book_revenue")).alias("loss"))
    var = scalar(losses, F.percentile("loss", F.lit(1 - alpha)))
    flagged = losses.withColumn("var_loss", var)
    return flagged.agg(
        F.avg("book_revenue").alias("expected_revenue_gbp"),
        F.stddev_pop("book_revenue").alias("revenue_std_gbp"),
        F.max(F.col("loss") + F.col("book_revenue")).alias("fixed_cost_gbp"),
        (-F.avg("loss")).alias("expected_margin_gbp"),
        F.max("var_loss").alias("var_loss_gbp"),
        F.avg(F.when(F.col("loss") >= F.col("var_loss"), F.col("loss"))).alias("cvar_loss_gbp"),
        F.avg(F.when(F.col("loss") > 0, 1.0).otherwise(0.0)).alias("prob_book_loss"),
        F.lit(alpha).alias("alpha"))


# ---------------------------------------------------------------- pricing

def device_statistics(draws: DataFrame, positions: DataFrame, totals: np.ndarray | None = None) -> DataFrame:
    """Per device: mean, deviation and CV of revenue, beta to the rest of the book, downside sessions.

    ``totals`` is ``book_revenue(draws)``; a device meets it inside its own row.
    """
    totals = book_revenue(draws) if totals is None else totals
    terms = positions.select("device_id", "floor_gbp")

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), STRIPE):
                batch = whole.slice(at, STRIPE)
                revenue, sessions = matrix(batch, "revenue"), matrix(batch, "sessions")
                floor = vector(batch, "floor_gbp")
                n = revenue.shape[1]
                mean, sigma, rest = revenue.mean(axis=1), revenue.std(axis=1), totals - revenue
                away = rest - rest.mean(axis=1, keepdims=True)
                spread = (away ** 2).mean(axis=1)
                # Sample covariance over population variance, a ratio the published prices depend on.
                together = ((revenue - mean[:, None]) * away).sum(axis=1) / max(n - 1, 1)
                columns = {
                    "exp_revenue": mean, "sigma": sigma,
                    "cv": np.where(mean > 0, sigma / np.where(mean > 0, mean, 1.0), 0.0),
                    "beta": np.where(spread > 0, together / np.where(spread > 0, spread, 1.0), 0.0),
                    "exp_sessions": sessions.mean(axis=1), "uar_p5": np.quantile(sessions, 0.05, axis=1),
                    "floor_breach_prob": (revenue <= floor[:, None] + 1e-6).mean(axis=1)}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("device_id")), *map(pa.array, columns.values())],
                    ["device_id", *columns])

    names = "exp_revenue sigma cv beta exp_sessions uar_p5 floor_breach_prob".split()
    return draws.join(terms, "device_id").select("device_id", "sessions", "revenue", "floor_gbp").mapInArrow(
        figures, "device_id string, " + ", ".join(f"{c} double" for c in names))


def suggested_price(statistics: DataFrame, positions: DataFrame) -> DataFrame:
    """Cost-covering price loaded for own volatility and for moving with the book."""
    mean_sigma = scalar(statistics, F.avg("sigma"))
    pull = F.tanh(F.col("beta") / F.greatest(mean_sigma, F.lit(1e-9)) * F.col("sigma"))
    price = F.col("fixed_gbp") / F.greatest("exp_sessions", F.lit(1.0)) * (
        1 + CV_LOADING * F.col("cv") + BETA_LOADING * pull)
    fixed = positions.select("device_id", "fixed_gbp")
    return statistics.join(fixed, "device_id").withColumn("suggested_price", price)


def latest_concentration(features: DataFrame) -> DataFrame:
    """Last known operator concentration per device."""
    known = F.col("op_herfindahl").isNotNull()
    return features.groupBy("device_id").agg(F.coalesce(
        F.max_by(F.when(known, F.col("op_herfindahl")), F.when(known, F.col("date"))),
        F.lit(0.0)).alias("op_herfindahl"))


def price_book(
    draws: DataFrame, positions: DataFrame, features: DataFrame, run_id: str, totals: np.ndarray | None = None
) -> DataFrame:
    priced = suggested_price(device_statistics(draws, positions, totals), positions).drop("fixed_gbp")
    money = positions.select("device_id", "site_id", "region", "specialty", "price_per_session_gbp", "fixed_gbp")
    r = lambda c, n: F.round(c, n)
    return (priced.join(money, "device_id")
            .join(latest_concentration(features), "device_id", "left")
            .select(
                F.lit(run_id).alias("run_id"), "device_id", "site_id", "region", "specialty",
                r("exp_sessions", 2).alias("expected_sessions"),
                r("exp_revenue", 2).alias("expected_revenue_gbp"),
                r("cv", 4).alias("cv"), r("beta", 4).alias("beta_book"),
                r("suggested_price", 2).alias("suggested_price_gbp"),
                r("price_per_session_gbp", 2).alias("current_price_gbp"),
                r("uar_p5", 2).alias("uar_p5_sessions"),
                r("floor_breach_prob", 4).alias("floor_breach_prob"),
                r(F.coalesce("op_herfindahl", F.lit(0.0)), 4).alias("op_herfindahl"),
                r(F.col("exp_revenue") - F.col("fixed_gbp"), 2).alias("expected_margin_gbp")))


def diversification(draws: DataFrame, totals: np.ndarray | None = None) -> DataFrame:
    """Effective number of independent devices and its ratio to the book size."""
    totals = book_revenue(draws) if totals is None else totals
    book_var = F.lit(float(np.var(totals)) if len(totals) else None)
    sigma = draws.select("device_id", deviation_of(F.col("revenue"), 0).alias("sigma"))
    summed = sigma.agg(F.sum("sigma").alias("s"), F.count("*").alias("n_devices")).withColumn("book_var", book_var)
    n = F.col("n_devices").cast("double")
    effective = F.when(
        F.col("s") > 0, F.least(F.col("s") * F.col("s") / F.greatest("book_var", F.lit(1e-9)), n)).otherwise(n)
    return summed.select(
        "n_devices", effective.alias("effective_n_independent"),
        (effective / F.greatest(n, F.lit(1.0))).alias("diversification_ratio"))


def portfolio_summary(draws: DataFrame, positions: DataFrame, priced: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The tail, diversification and book figures as one row."""
    totals = book_revenue(draws)
    spread = diversification(draws, totals)
    field = lambda c: spread.select(c).scalar()
    return tail_risk(draws, positions, alpha, totals).withColumns({
        "n_devices": field("n_devices"),
        "effective_n_independent": F.round(field("effective_n_independent"), 2),
        "diversification_ratio": F.round(field("diversification_ratio"), 3),
        "mean_operator_herfindahl": F.round(scalar(priced, F.avg("op_herfindahl")), 4),
        "n_devices_negative_margin": scalar(priced, F.count_if(F.col("expected_margin_gbp") < 0)),
    })
