"""Building blocks for keyed time series: lags, trailing windows, spines, shares.

Every window here is partitioned by a full series key, so a partition holds at most one row per
period of one series. Totals over wider groups go through ``with_group_total`` (aggregate + join):
the aggregate combines before the shuffle and a hot join key can be split by adaptive execution,
which a window over the wide group could not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def lag_columns(target: str, lags: Sequence[int], w: WindowSpec, prefix: str | None = None) -> dict[str, Column]:
    """Positional lags: the k-th previous row of the series, whatever its date."""
    return {f"{prefix or target}_lag{k}": F.lag(target, k).over(w) for k in lags}


def trailing(agg, column: str, rows: int, w: WindowSpec, min_obs: int) -> Column:
    """Aggregate of the ``rows`` rows before the current one, NULL below ``min_obs`` values."""
    frame = w.rowsBetween(-rows, -1)
    return F.when(F.count(column).over(frame) >= min_obs, agg(column).over(frame))


def rolling_columns(
    target: str, windows: Sequence[int], w: WindowSpec, min_obs: int | None = None, prefix: str | None = None
) -> dict[str, Column]:
    """Trailing mean and sample deviation; a full window is needed unless ``min_obs`` is given."""
    name = prefix or target
    out: dict[str, Column] = {}
    for rows in windows:
        need = rows if min_obs is None else min_obs
        out[f"{name}_rollmean{rows}"] = trailing(F.avg, target, rows, w, need)
        out[f"{name}_rollstd{rows}"] = trailing(F.stddev_samp, target, rows, w, need)
    return out


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` as a scalar subquery."""
    return df.agg(expr.alias("value")).scalar()


def with_group_total(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Attach group aggregates to every row. NULL keys form their own group, as in GROUP BY."""
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    renamed = totals.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[F.col(n) for n in aggs])
    condition = [df[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return df.join(renamed, condition, "left").drop(*[f"__{k}" for k in keys])


def month_range(start: Column, end: Column) -> Column:
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))


def densify_months(
    df: DataFrame, keys: Sequence[str], value: str, date: str = "date", fill: float | int = 0
) -> DataFrame:
    """One row per series and month between the overall first and last month, gaps filled."""
    first = scalar(df, F.min(date))
    last = scalar(df, F.max(date))
    grid = df.select(*keys).distinct().withColumn(date, F.explode(month_range(first, last)))
    return grid.join(df.select(*keys, date, value), [*keys, date], "left").withColumn(
        value, F.coalesce(value, F.lit(fill)))


def lookup(column: Column, table: Mapping[str, str]) -> Column:
    """Value of a fixed lookup table, NULL when absent."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), column)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for reports and comparisons."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields])
