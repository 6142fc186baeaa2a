"""Pooled quantile forecaster of boosted trees over all series, and its recursive forecast in one job.

One forest per quantile (10, 50 and 90 %) is shared by all series. Values are divided by the series' trailing level and
weighted with it, as in ``pooled``: trees cannot reach beyond the values they have seen, shares of a level they can. A
category enters as the mean share of its training rows, drawn towards the overall mean where it has few; a new category is
missing. Missing inputs stay missing.

The forecast walks the horizon inside each batch of series: lags and statistics from the growing history, the three forests,
the ordered band, the median fed back. It is one Spark job at any horizon.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.fixed_values import MONTHLY_LAGS, MONTHLY_WINDOWS
from panelcast.functions.folds import vector
from panelcast.operators.boosting import Forest, Settings, train as boost
from panelcast.operators.features_monthly import CATEGORICAL, SERIES, TARGET
from panelcast.operators.pooled import DRIVERS, LOOKBACK, QUANTILES, series_state, training_rows
from panelcast.sources.storage import materialise

LEVEL = f"{TARGET}_rollmean{max(MONTHLY_WINDOWS)}"
#: Order of a model's inputs.
INPUTS = (
    "month", "quarter", "sin_month", "cos_month", "time_idx", "level", *DRIVERS,
    *(f"lag{k}" for k in MONTHLY_LAGS), *(f"rollmean{w}" for w in MONTHLY_WINDOWS if w != max(MONTHLY_WINDOWS)),
    *(f"rollstd{w}" for w in MONTHLY_WINDOWS), *CATEGORICAL)
#: Rows of the overall mean that a category's own mean is drawn towards.
PRIOR_ROWS = 20.0

FORECAST = ("trust_code string, region string, procedure_code string, last_date date, step int, yhat double, "
            "yhat_lower double, yhat_upper double")


@dataclass(frozen=True)
class TreeForecaster:
    forest: Forest
    categories: DataFrame  # (kind, name, code): a written table
    first_year: int


def _or_nan(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(float("nan")))


def _category_codes(rows: DataFrame) -> DataFrame:
    """(kind, name, code) of every category of the training rows; `rows` has the share `y`."""
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("name")) for c in CATEGORICAL]))
    mean = F.lit(rows.agg(F.avg("y")).first()[0] or 0.0)
    return (rows.select(kinds.alias("k"), "y").where("k.name IS NOT NULL").groupBy("k.kind", "k.name")
            .agg(((F.sum("y") + PRIOR_ROWS * mean) / (F.count("*") + PRIOR_ROWS)).alias("code")))


def with_codes(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """`rows` with a column `<category>_code`, NULL for a new category."""
    for kind in CATEGORICAL:
        one = categories.where(F.col("kind") == kind).select(F.col("name").alias(f"_{kind}"), F.col("code").alias(f"{kind}_code"))
        rows = rows.join(one, F.col(kind) == F.col(f"_{kind}"), "left").drop(f"_{kind}")
    return rows


def train(features: DataFrame, settings: Settings = Settings()) -> TreeForecaster:
    """Fit on the rows with a full set of lags."""
    known = training_rows(features)
    if "proc_mix_share_lag1" not in features.columns:
        known = known.withColumn("proc_mix_share_lag1", F.col("proc_mix_share"))
    level = F.greatest(F.coalesce(F.col(LEVEL).cast("double"), F.lit(1.0)), F.lit(1.0))
    known = known.withColumn("level", level).withColumn("y", F.col(TARGET) / level)
    categories = materialise(_category_codes(known), "tree-categories")
    drivers = dict(zip(DRIVERS, ("proc_mix_share_lag1", "wl_size_lag1", "wl_pct_18wk_lag1", "pop_65plus_share")))
    relative = {f"lag{k}": F.col(f"{TARGET}_lag{k}") / level for k in MONTHLY_LAGS}
    relative |= {f"{s}{w}": F.col(f"{TARGET}_{s}{w}") / level for s in ("rollmean", "rollstd") for w in MONTHLY_WINDOWS}
    cells = [relative[c] if c in relative else F.col(drivers.get(c, f"{c}_code" if c in CATEGORICAL else c)) for c in INPUTS]
    first_year = known.agg(F.min(F.year("date") - F.floor(F.col("time_idx") / 12))).first()[0]
    rows = with_codes(known, categories).select(
        F.array(*map(_or_nan, cells)).alias("x"), "y", F.col("level").alias("weight"), F.xxhash64(*SERIES, "date").alias("key"))
    return TreeForecaster(boost(rows, tuple(QUANTILES.values()), settings), categories, int(first_year or 0))


def _walk(forest: Forest, horizon: int, first_year: int):
    def statistics(tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean, and deviation (0 below two values), of what is known in each row."""
        known = ~np.isnan(tail)
        n = known.sum(axis=1)
        mean = np.where(n > 0, np.nansum(tail, axis=1) / np.maximum(n, 1), np.nan)
        square = np.where(known, (tail - mean[:, None]) ** 2, 0.0).sum(axis=1)
        return mean, np.where(n > 1, np.sqrt(square / np.maximum(n - 1, 1)), 0.0)

    def run(batches):
        for b in batches:
            n = b.num_rows
            column = lambda c: b.column(b.schema.get_field_index(c))
            history = np.full((n, LOOKBACK + horizon), np.nan)
            lists = column("history")
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(n), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + LOOKBACK - sizes[row]
            history[row, place] = lists.flatten().to_numpy(zero_copy_only=False)
            fixed = {c: vector(b, c) for c in (*DRIVERS, *(f"{c}_code" for c in CATEGORICAL))}
            year, month = vector(b, "year").astype(int), vector(b, "month").astype(int)
            bands = np.zeros((n, horizon, 3))
            for step in range(1, horizon + 1):
                past = history[:, : LOOKBACK + step - 1]
                m = (month - 1 + step) % 12 + 1
                y = year + (month - 1 + step) // 12
                stats = {w: statistics(past[:, -w:]) for w in MONTHLY_WINDOWS}
                level = np.fmax(stats[max(MONTHLY_WINDOWS)][0], 1.0)
                values = {"month": m, "quarter": (m + 2) // 3, "sin_month": np.sin(m * (2 * np.pi / 12)),
                          "cos_month": np.cos(m * (2 * np.pi / 12)), "time_idx": (y - first_year) * 12 + m - 1, "level": level,
                          **fixed, **{f"lag{k}": past[:, -k] / level for k in MONTHLY_LAGS}}
                for w, (mean, deviation) in stats.items():
                    values |= {f"rollmean{w}": mean / level, f"rollstd{w}": deviation / level}
                x = np.column_stack([values[f"{c}_code" if c in CATEGORICAL else c] for c in INPUTS]).astype(float)
                band = np.sort(np.maximum(forest.predict(x) * level[:, None], 0.0), axis=1)
                bands[:, step - 1] = band
                history[:, LOOKBACK + step - 1] = band[:, 1]
            take = pa.array(np.repeat(np.arange(n), horizon))
            flat = bands.reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(column(c).take(take) for c in ("trust_code", "region", "procedure_code", "last_date")),
                 pa.array(np.tile(np.arange(1, horizon + 1, dtype=np.int32), n)),
                 pa.array(flat[:, 1]), pa.array(flat[:, 0]), pa.array(flat[:, 2])],
                ["trust_code", "region", "procedure_code", "last_date", "step", "yhat", "yhat_lower", "yhat_upper"])
    return run


def recursive_forecast(features: DataFrame, model: TreeForecaster, horizon: int) -> DataFrame:
    """Every series `horizon` months ahead: (trust_code, region, procedure_code, date, yhat, yhat_lower, yhat_upper)."""
    state = series_state(features).select(*SERIES, "last.*", F.trunc("last_date", "month").alias("last_date"), "history")
    state = with_codes(state, model.categories)
    rows = state.select(
        *SERIES, "region", "last_date", F.year("last_date").cast("double").alias("year"),
        F.month("last_date").cast("double").alias("month"), "history",
        *[_or_nan(F.col(c)).alias(c) for c in (*DRIVERS, *(f"{c}_code" for c in CATEGORICAL))])
    steps = rows.mapInArrow(_walk(model.forest, horizon, model.first_year), FORECAST)
    return steps.select("trust_code", "region", "procedure_code", F.add_months("last_date", F.col("step")).alias("date"),
                        "yhat", "yhat_lower", "yhat_upper")


def forecast(features: DataFrame, horizon: int, settings: Settings = Settings()) -> DataFrame:
    """Train on the whole table and forecast from its end."""
    return recursive_forecast(features, train(features, settings), horizon)
