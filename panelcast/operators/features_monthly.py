"""Monthly modelling table: trust x code x month with calendar, lag, mix and pressure features."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.fixed_values import CHAPTER_TO_FUNCTION, MONTHLY_LAGS, MONTHLY_WINDOWS, OLDER_BANDS
from panelcast.functions.panel import (
    densify_months, lag_columns, lookup, rolling_columns, scalar, series_window, with_group_total,
)
from panelcast.sources.storage import materialise

TARGET = "n_procedures"
SERIES = ("trust_code", "procedure_code")
CATEGORICAL = ("trust_code", "region", "opcs_chapter", "procedure_code")
FEATURE_COLUMNS = (
    "month", "quarter", "sin_month", "cos_month", "time_idx", "proc_mix_share",
    "wl_size_lag1", "wl_pct_18wk_lag1", "pop_65plus_share",
    *[f"{TARGET}_lag{k}" for k in MONTHLY_LAGS],
    *[f"{TARGET}_rollmean{w}" for w in MONTHLY_WINDOWS],
    *[f"{TARGET}_rollstd{w}" for w in MONTHLY_WINDOWS],
    *CATEGORICAL,
)
NUMERIC = tuple(c for c in FEATURE_COLUMNS if c not in CATEGORICAL)


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    angle = F.month(date) * (2 * math.pi / 12)
    first_year = scalar(df, F.min(F.year(date)))
    return df.withColumns({
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "sin_month": F.sin(angle),
        "cos_month": F.cos(angle),
        "time_idx": (F.year(date) - first_year) * 12 + F.month(date) - 1,
    })


def lags_and_rolls(
    df: DataFrame, keys: Sequence[str] = SERIES, target: str = TARGET, order: Sequence[str] = ("date",),
    densify: bool = False,
) -> DataFrame:
    """All lags and trailing statistics over one window spec, hence one shuffle and one sort.

    Lags are positional. With `densify` they are months: every series first gets a row for each month between the overall
    first and last one, with 0 for the target and NULL for the other columns where there was none.
    """
    if densify:
        grid = densify_months(df, keys, target)
        df = grid.join(df.drop(target), [*keys, "date"], "left").select(*df.columns)
    w = series_window(keys, order)
    return df.withColumns({
        **lag_columns(target, MONTHLY_LAGS, w), **rolling_columns(target, MONTHLY_WINDOWS, w)})


def mix_share(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Share of the code in its trust's month; NULL when the month's total is zero."""
    total = with_group_total(df, ["trust_code", "date"], {"month_total": F.sum(target)})
    return total.withColumn(
        "proc_mix_share", F.try_divide(F.col(target).cast("double"), F.nullif("month_total", F.lit(0)))
    ).drop("month_total")


def treatment_function(df: DataFrame, table: Mapping[str, str] = CHAPTER_TO_FUNCTION) -> DataFrame:
    return df.withColumn("treatment_function", lookup(F.col("opcs_chapter"), table))


def pressure(df: DataFrame, waiting: DataFrame) -> DataFrame:
    keyed = waiting.select(
        "date", "trust_code", "treatment_function",
        F.col("waiting_list_size").alias("wl_size"), F.col("pct_within_18wk").alias("wl_pct_18wk"))
    return df.join(keyed, ["date", "trust_code", "treatment_function"], "left")


def pressure_lag(df: DataFrame, compat: bool = False) -> DataFrame:
    """Previous-month pressure of the series.

    ``compat`` reproduces lagging over (trust, treatment function) rows ordered by code and date:
    the first row of a code then takes the last row of the preceding code. That carry is computed
    between per-series summaries, so the wide group is never gathered.
    """
    w = series_window(SERIES, ["date"])
    lagged = df.withColumns({
        "wl_size_lag1": F.lag("wl_size").over(w), "wl_pct_18wk_lag1": F.lag("wl_pct_18wk").over(w)})
    if not compat:
        return lagged
    ends = df.where(F.col("treatment_function").isNotNull()).groupBy(
        "trust_code", "treatment_function", "procedure_code").agg(
            F.min("date").alias("date"),
            F.max_by(F.struct("wl_size", "wl_pct_18wk"), "date").alias("tail"))
    by_code = Window.partitionBy("trust_code", "treatment_function").orderBy("procedure_code")
    carried = ends.select(
        *SERIES, "treatment_function", "date", F.lag("tail").over(by_code).alias("carried"))
    joined = lagged.join(carried, [*SERIES, "treatment_function", "date"], "left")
    first = F.col("carried").isNotNull()
    return joined.withColumns({
        "wl_size_lag1": F.when(first, F.col("carried.wl_size")).otherwise(F.col("wl_size_lag1")),
        "wl_pct_18wk_lag1": F.when(first, F.col("carried.wl_pct_18wk")).otherwise(F.col("wl_pct_18wk_lag1")),
    }).drop("carried")


def older_share(demographics: DataFrame, bands: Sequence[str] = OLDER_BANDS) -> DataFrame:
    old = F.when(F.col("age_band").isin(*bands), F.col("population")).otherwise(0)
    return demographics.groupBy("region", "year").agg(
        (F.sum(old) / F.sum("population")).alias("pop_65plus_share"))


def attach_older_share(df: DataFrame, shares: DataFrame) -> DataFrame:
    """Regional share of the year, carried forward within the region.

    The share is constant within (region, year), so the carry runs over the region's few years
    instead of over its rows.
    """
    years = df.select("region", "year").where(F.col("region").isNotNull()).distinct().join(
        shares, ["region", "year"], "left")
    w = Window.partitionBy("region").orderBy("year")
    filled = years.withColumn("pop_65plus_share", F.last("pop_65plus_share", ignorenulls=True).over(w))
    return df.join(filled, ["region", "year"], "left")


def build_feature_table(
    procedures: DataFrame, waiting: DataFrame, demographics: DataFrame,
    chapter_table: Mapping[str, str] = CHAPTER_TO_FUNCTION, older_bands: Sequence[str] = OLDER_BANDS,
    compat: bool = False,
) -> DataFrame:
    """The full table. Joins come first and the series windows last, sharing one shuffle by series."""
    base = treatment_function(calendar(procedures), chapter_table)
    joined = attach_older_share(
        pressure(mix_share(base), waiting), older_share(demographics, older_bands))
    out = pressure_lag(lags_and_rolls(joined), compat)
    if not compat:
        # The same-month mix is not known at forecast time; models use its lag.
        w = series_window(SERIES, ["date"])
        out = out.withColumn("proc_mix_share_lag1", F.lag("proc_mix_share").over(w))
    return out


def category_codes(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """(kind, name, code): the distinct values of each column in order, numbered from 0; a written table.

    Values are dealt to ordered partitions; a value's number is its place in its partition behind the sizes of the
    partitions before. The driver sees one size per partition and no value.
    """
    spark = df.sparkSession
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("name")) for c in columns]))
    values = df.select(pairs.alias("p")).select("p.*").where("name IS NOT NULL").distinct()
    dealt = materialise(values.repartitionByRange("kind", "name").withColumn("part", F.spark_partition_id()), "category-values")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    starts = accumulate((r.n for r in sizes), initial=0)
    before = spark.createDataFrame([(r.part, at) for r, at in zip(sizes, starts)], "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("kind", "name")) - 1
    numbered = dealt.withColumn("place", place).join(before, "part").select(
        "kind", "name", (F.col("before") + F.col("place")).alias("number"))
    first = numbered.groupBy("kind").agg(F.min("number").alias("first"))
    return materialise(numbered.join(first, "kind").select("kind", "name", (F.col("number") - F.col("first")).alias("code")),
                       "category-codes")


def encode_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL, codes: DataFrame | None = None) -> DataFrame:
    """Code per category in order, from 0; a NULL value, or one that `codes` does not know, gets the last code.

    `codes` is the result of ``category_codes`` for the data that a model was fitted on (default: `df` itself).
    """
    codes = category_codes(df, columns) if codes is None else codes
    for c in columns:
        one = codes.where(F.col("kind") == c).select(F.col("name").alias(f"__{c}"), F.col("code").alias("__code"))
        unknown = scalar(codes, F.count(F.when(F.col("kind") == c, 1)))
        df = df.join(one, F.col(c).cast("string") == F.col(f"__{c}"), "left").withColumn(
            f"{c}_idx", F.coalesce("__code", unknown).cast("double")).drop(f"__{c}", "__code")
    return df


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep").transform(df)
