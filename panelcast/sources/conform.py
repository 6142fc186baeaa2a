"""Conforming raw feeds to the dataset contracts, and the shaping that goes with it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.fixed_values import ACTIVITY_ALIASES, MODALITY_ALIASES, UNIT_COST_GBP
from panelcast.functions.panel import lookup, month_range
from panelcast.schemas import DATASETS
from panelcast.sources.adapters import quarter_label


def conform(df: DataFrame, required: StructType) -> DataFrame:
    """Required columns first (absent ones as typed NULLs), extras after, ``date`` at month start."""
    present = set(df.columns)
    names = set(required.fieldNames())

    def column(name: str) -> Column:
        if name == "date":
            return F.trunc(F.col(name).cast("date"), "month").alias(name)
        return F.col(name)

    front = [column(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
             for f in required.fields]
    return df.select(*front, *[column(c) for c in df.columns if c not in names])


def normalise_labels(df: DataFrame, column: str, aliases: Mapping[str, str]) -> DataFrame:
    """Canonical label for the trimmed lower-case text; unknown labels keep their original text."""
    known = lookup(F.lower(F.trim(column)), aliases)
    return df.withColumn(column, F.coalesce(known, F.col(column)))


def normalise_modality(df: DataFrame, aliases: Mapping[str, str] = MODALITY_ALIASES) -> DataFrame:
    return normalise_labels(df, "modality", aliases)


def normalise_activity(df: DataFrame, aliases: Mapping[str, str] = ACTIVITY_ALIASES) -> DataFrame:
    return normalise_labels(df, "activity_type", aliases)


def national_series(
    sheet: DataFrame, date_col: str = "c2", preferred: str = "c8", fallback: str = "c7", row_no: str = "row_no"
) -> DataFrame:
    """Monthly control total from workbook rows: dated rows only, last row wins within a month."""
    day = F.expr(f"try_cast(`{date_col}` AS date)")
    value = F.coalesce(
        F.expr(f"try_cast(`{preferred}` AS double)"), F.expr(f"try_cast(`{fallback}` AS double)"))
    parsed = sheet.select(day.alias("day"), value.alias("value"), F.col(row_no).alias("row_no")).where(
        F.col("day").isNotNull() & F.col("value").isNotNull())
    # Of several values in a month the one in the last row counts.
    return parsed.groupBy(F.trunc("day", "month").alias("date")).agg(
        F.max_by("value", F.col("row_no")).alias("value"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when the frame is empty (one bounded job: a single row is fetched)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def month_spine(spark: SparkSession, start: Column | str, end: Column | str) -> DataFrame:
    """Every month from start to end; bounds are dates or date columns (such as scalar subqueries)."""
    bound = lambda v: F.lit(v).cast("date")
    return spark.range(1).select(F.explode(month_range(bound(start), bound(end))).alias("date"))


def future_months(last: DataFrame, horizon: int, date: str = "date") -> DataFrame:
    """The ``horizon`` months after each row's date, one row each, with a 1-based ``step``."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return last.select("*", steps).withColumn(date, F.add_months(F.trunc(date, "month"), F.col("step")))


def fill_on_spine(spine: DataFrame, series: DataFrame, value: str = "value") -> DataFrame:
    """Series on the month spine, gaps carried forward and the head carried back.

    The spine is one national series, a row per month, so the unpartitioned window is bounded by
    the number of months.
    """
    w = Window.orderBy("date")
    joined = spine.join(series.select("date", value), "date", "left")
    forward = F.last(value, ignorenulls=True).over(w)
    backward = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return joined.select("date", F.coalesce(forward, backward).alias(value))


def allocate_top_down(
    national: DataFrame, shares: DataFrame, functions: Sequence[str], start: Column, end: Column
) -> DataFrame:
    """Split the national total over trusts (by size share) and evenly over treatment functions.

    ``shares`` has trust_code, region and size. The month grid grows out of the share rows
    themselves (``explode``), so no cross join is planned.
    """
    size_total = shares.agg(F.sum("size").alias("value")).scalar()
    filled = fill_on_spine(month_spine(shares.sparkSession, start, end), national)
    grid = shares.select(
        "trust_code", "region", (F.col("size") / size_total / len(functions)).alias("share"),
        F.explode(F.array(*[F.lit(f) for f in functions])).alias("treatment_function"),
    ).withColumn("date", F.explode(month_range(start, end)))
    return grid.join(filled, "date").select(
        "date", "trust_code", "region", "treatment_function",
        F.bround(F.col("value") * F.col("share"), 0).cast("bigint").alias("waiting_list_size"),
        F.lit(None).cast("double").alias("pct_within_18wk"))


def quarterly_supply(
    facts: DataFrame, unit_cost: Mapping[str, float] = UNIT_COST_GBP, category: str = "category", units: str = "units",
    date: str = "date",
) -> DataFrame:
    """Quarterly units per category and spend = units x unit cost."""
    cost = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in unit_cost.items() for x in kv]), F.col(category))
    return (facts.groupBy(quarter_label(date).alias("quarter"), F.col(category).alias("category"))
            .agg(F.sum(units).cast("bigint").alias("units"))
            .select("quarter", "category",
                    F.round(F.col("units") * cost, 2).alias("spend_gbp"), "units"))


@dataclass(frozen=True)
class Feed:
    """Where one dataset comes from: a preferred path and a fallback path.

    `build` turns what the preferred path holds into the dataset, as ``waiting_from_sheet`` does.
    """
    primary: str | None
    fallback: str
    fmt: str = "parquet"
    options: Mapping[str, str] | None = None
    build: Callable[[DataFrame], DataFrame] | None = None


#: Share of the cells of a typed column that may fail to parse.
UNPARSABLE = 0.1


def waiting_from_sheet(sheet: DataFrame, shares: DataFrame, functions: Sequence[str]) -> DataFrame:
    """The waiting list by trust and function from a national workbook: its series, required, split top-down."""
    series = require_rows(national_series(sheet), "no dated rows in the national waiting-list series")
    bounds = series.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
    return allocate_top_down(series, shares, functions, F.lit(bounds.low), F.lit(bounds.high))


LABEL_STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "imaging": normalise_modality,
    "activity": normalise_activity,
}


def _read(spark: SparkSession, path: str, feed: Feed, schema: StructType) -> DataFrame:
    reader = spark.read.format(feed.fmt).options(**dict(feed.options or {}))
    if feed.fmt != "csv":
        return reader.load(path)
    # Text feeds drift: columns are matched by header name, then cast to the contract's types.
    raw = reader.option("header", "true").load(path)
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def _checked(spark: SparkSession, path: str, feed: Feed, schema: StructType) -> DataFrame:
    """A feed with rows whose text cells parse: one pass of counts, so that bad content shows before the feed is chosen."""
    if feed.fmt == "csv":
        raw = spark.read.format("csv").options(**dict(feed.options or {})).option("header", "true").load(path)
        typed = [f for f in schema.fields if f.name in raw.columns]
        counts = raw.agg(F.count("*").alias("__n"), *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in typed]).first()
        bad = [f.name for f in typed if counts[f.name] > UNPARSABLE * counts["__n"]]
        if bad:
            raise ValueError(f"unparsable cells in {', '.join(bad)}")
        if not typed:
            raise ValueError("no known column")
    return require_rows(_read(spark, path, feed, schema), "empty feed")


def load_dataset(spark: SparkSession, name: str, feed: Feed) -> tuple[DataFrame, tuple[str, str, str]]:
    """Conformed dataset and its provenance (source, kind, detail).

    The preferred feed is used when its path resolves, it has rows, its cells parse and its `build` step succeeds; otherwise
    the fallback is read and the reason recorded.
    """
    schema = DATASETS[name]
    step = LABEL_STEPS.get(name, lambda d: d)
    if feed.primary is not None:
        try:
            if feed.build:
                raw = spark.read.format(feed.fmt).options(**dict(feed.options or {})).load(feed.primary)
                live = require_rows(feed.build(require_rows(raw, "empty feed")), "nothing built from the feed")
            else:
                live = _checked(spark, feed.primary, feed, schema)
            return conform(step(live), schema), (name, "live", feed.primary)
        except PySparkException as exc:
            reason = exc.getCondition() or type(exc).__name__
        except (Py4JJavaError, ValueError) as exc:
            reason = str(exc).splitlines()[0] if isinstance(exc, ValueError) else "UNREADABLE"
    else:
        reason = "no preferred feed"
    return conform(_read(spark, feed.fallback, feed, schema), schema), (name, "fallback", reason)


def load_all(
    spark: SparkSession, feeds: Mapping[str, Feed]
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    loaded = {name: load_dataset(spark, name, feed) for name, feed in feeds.items()}
    return {n: df for n, (df, _) in loaded.items()}, [p for _, p in loaded.values()]
