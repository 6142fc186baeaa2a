"""Pooled boosted-tree forecaster: a median model on the whole feature contract with conformal bands.

Spark's gradient-boosted trees fit the median (absolute loss). The band comes from split-conformal
calibration: quantiles of scaled residuals on the last months of the training data, which a model
fitted before them has not seen. Use it where interactions matter more than training time; the
linear model in ``pooled`` needs far fewer passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.fixed_values import MONTHLY_WINDOWS
from panelcast.functions.metrics import temporal_split
from panelcast.functions.panel import scalar
from panelcast.operators.features_monthly import CATEGORICAL, NUMERIC, SERIES, TARGET
from panelcast.operators.pooled import DRIVERS, ar_features, monotone, series_state, training_rows
from panelcast.sources.storage import iteration_input, materialise

# The same-month mix is unknown when forecasting, so its lag takes its place.
INPUTS = tuple("proc_mix_share_lag1" if c == "proc_mix_share" else c for c in NUMERIC)
LEVEL = f"{TARGET}_rollmean{max(MONTHLY_WINDOWS)}"


@dataclass(frozen=True)
class TreeModel:
    """Fitted pipeline and the band's lower and upper residual quantiles per unit of scale."""
    pipeline: PipelineModel
    low: float
    high: float


def _inputs(df: DataFrame) -> DataFrame:
    """Numeric inputs as doubles, a missing one as -1 with an indicator beside it."""
    cells: dict[str, Column] = {}
    for c in INPUTS:
        value = F.col(c).cast("double")
        cells[f"in_{c}"] = F.coalesce(value, F.lit(-1.0))
        cells[f"na_{c}"] = F.when(value.isNull(), 1.0).otherwise(0.0)
    return df.withColumns(cells)


def _scale(level: str = LEVEL) -> Column:
    return F.greatest(F.coalesce(F.col(level), F.lit(0.0)), F.lit(1.0))


# Most boosting rounds, their rate, and the least share by which a round must lower the validation error.
ROUNDS, STEP, TOLERANCE = 400, 0.05, 0.005


def _fit(rows: DataFrame, rounds: int, depth: int, held: str | None = None) -> PipelineModel:
    indexers = StringIndexer(
        inputCols=list(CATEGORICAL), outputCols=[f"{c}_code" for c in CATEGORICAL],
        stringOrderType="alphabetAsc", handleInvalid="keep").fit(rows)
    columns = [f"in_{c}" for c in INPUTS] + [f"na_{c}" for c in INPUTS] + [f"{c}_rank" for c in CATEGORICAL]
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    # Codes enter as ordered numbers, so the number of categories is not bound by the tree's bins.
    ready = _ranked(indexers.transform(rows))
    learner = GBTRegressor(
        lossType="absolute", labelCol=TARGET, maxIter=rounds, maxDepth=depth, stepSize=STEP,
        subsamplingRate=0.8, minInstancesPerNode=30, seed=7)
    if held:
        learner = learner.setValidationIndicatorCol(held).setParams(validationTol=TOLERANCE)
    trees = learner.fit(assembler.transform(ready))
    return PipelineModel([indexers, assembler, trees])


def _ranked(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_rank": F.col(f"{c}_code") + F.lit(0.0) for c in CATEGORICAL})


def _predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    indexers, assembler, trees = model.stages
    return trees.transform(assembler.transform(_ranked(indexers.transform(df))))


def train(
    features: DataFrame, horizon: int, rounds: int = ROUNDS, depth: int = 5, quantiles: Sequence[float] = (0.1, 0.9)
) -> TreeModel:
    """Calibrate on the last ``horizon`` months, then fit on everything.

    Boosting ends at ``rounds``, or when a round no longer lowers the error of the calibration months by the share
    ``TOLERANCE``; the final fit takes as many rounds.
    """
    rows = iteration_input(_inputs(training_rows(features)).withColumn(
        TARGET, F.col(TARGET).cast("double")), "tree-train")
    try:
        early, late = temporal_split(rows, "date", horizon)
        residual = (F.col(TARGET) - F.col("prediction")) / _scale()
        marked = rows.withColumn("held", F.col("date") > scalar(early, F.max("date")))
        first = _fit(marked, rounds, depth, "held")
        low, high = _predict(first, late).agg(
            F.percentile_approx(residual, list(quantiles), 10_000)).first()[0]
        return TreeModel(_fit(rows, first.stages[-1].getNumTrees, depth), float(low), float(high))
    finally:
        rows.unpersist()


def recursive_forecast(features: DataFrame, model: TreeModel, horizon: int, cut_every: int = 4) -> DataFrame:
    """Every series ``horizon`` months ahead, one pass over all series per month.

    The growing plan is cut through a written table every few steps.
    """
    first_year = scalar(features, F.min(F.year("date")))
    state = series_state(features).select(
        *SERIES, F.trunc("last_date", "month").alias("last_date"), "last.*", "history",
        F.array().cast("array<array<double>>").alias("bands"))
    state = materialise(state.withColumn("first_year", first_year), "tree-state")
    base = ("trust_code", "procedure_code", "region", "opcs_chapter", "last_date", "first_year", *DRIVERS)
    for step in range(1, horizon + 1):
        month = F.add_months("last_date", step)
        angle = F.month(month) * (2 * 3.141592653589793 / 12)
        rows = state.withColumns({
            "month": F.month(month), "quarter": F.quarter(month), "sin_month": F.sin(angle), "cos_month": F.cos(angle),
            "time_idx": (F.year(month) - F.col("first_year")) * 12 + F.month(month) - 1,
            "proc_mix_share_lag1": F.col("proc_mix_share"), "wl_size_lag1": F.col("wl_size"),
            "wl_pct_18wk_lag1": F.col("wl_pct_18wk"), **ar_features(F.col("history"))})
        scored = _predict(model.pipeline, _inputs(rows)).select(
            *base, "history", "bands",
            monotone(F.col("prediction") + model.low * _scale(), F.col("prediction"),
                     F.col("prediction") + model.high * _scale()).alias("band"))
        state = scored.select(
            *base, F.concat("history", F.array(F.col("band")[1])).alias("history"),
            F.concat("bands", F.array("band")).alias("bands"))
        if step % cut_every == 0 and step < horizon:
            state = materialise(state, "tree-state")
    steps = state.select("trust_code", "region", "procedure_code", "last_date", F.posexplode("bands").alias("pos", "band"))
    return steps.select(
        "trust_code", "region", "procedure_code", F.add_months("last_date", F.col("pos") + 1).alias("date"),
        F.col("band")[1].alias("yhat"), F.col("band")[0].alias("yhat_lower"), F.col("band")[2].alias("yhat_upper"))
