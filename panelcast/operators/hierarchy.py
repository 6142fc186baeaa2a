"""Moving forecasts between trust, regional and national levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUES = ("yhat", "yhat_lower", "yhat_upper")
COLUMNS = ("level", "trust_code", "region", "procedure_code", "date", *VALUES)


def bottom_up(leaf: DataFrame, interval: str = "comonotonic", extra_keys: Sequence[str] = ()) -> DataFrame:
    """Leaf, regional and national sums in one pass over the leaf, keys above a level NULL.

    Bounds are summed by default; ``independent`` adds half-widths in quadrature instead. Rows with
    a NULL region count nationally but form no region. ``extra_keys`` stay at every level.
    """
    if interval == "comonotonic":
        low, high = F.sum("yhat_lower"), F.sum("yhat_upper")
    elif interval == "independent":
        low = F.sum("yhat") - F.sqrt(F.sum(F.pow(F.col("yhat") - F.col("yhat_lower"), 2)))
        high = F.sum("yhat") + F.sqrt(F.sum(F.pow(F.col("yhat_upper") - F.col("yhat"), 2)))
    else:
        raise ValueError(f"unknown interval rule {interval!r}")

    keys = ["trust_code", "region", "procedure_code", "date"]
    zero = F.lit(0.0)
    level = F.when(F.grouping("trust_code") == 0, "trust").when(
        F.grouping("region") == 0, "regional").otherwise("national")
    extra = list(extra_keys)
    summed = leaf.groupingSets([extra + keys, extra + keys[1:], extra + keys[2:]], *extra, *keys).agg(
        level.alias("level"),
        F.coalesce(F.sum("yhat"), zero).alias("yhat"),
        F.coalesce(low, zero).alias("yhat_lower"),
        F.coalesce(high, zero).alias("yhat_upper"))
    return summed.where((F.col("level") != "regional") | F.col("region").isNotNull()).select(*extra, *COLUMNS)


def historic_shares(history: DataFrame, target: str = "n_procedures") -> DataFrame:
    """Share of each trust in its region's volume of a code."""
    volume = history.groupBy("region", "trust_code", "procedure_code").agg(F.sum(target).alias("volume"))
    total = history.groupBy("region", "procedure_code").agg(F.sum(target).alias("total"))
    return volume.join(total, ["region", "procedure_code"]).select(
        "region", "trust_code", "procedure_code",
        F.try_divide(F.col("volume").cast("double"), F.nullif("total", F.lit(0))).alias("share"))


def middle_out(regional: DataFrame, history: DataFrame, target: str = "n_procedures") -> DataFrame:
    """Split a regional forecast over trusts by historic share; an unknown share gives zero."""
    share = F.coalesce("share", F.lit(0.0))
    joined = regional.drop("trust_code", "level").join(
        historic_shares(history, target), ["region", "procedure_code"], "left")
    return joined.withColumns({c: F.col(c) * share for c in VALUES}).withColumn(
        "level", F.lit("trust")).select(*COLUMNS)
