"""Declarative data checks. All conditional counts of a dataset come out of one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CheckSpec:
    required_cols: Sequence[str] = ()
    non_negative: Sequence[str] = ()
    unique_keys: Sequence[str] = ()
    date_col: str | None = None
    min_rows: int = 1


# Default specs of the six datasets (fixed values).
SPECS = {
    "procedures": CheckSpec(
        ("date", "trust_code", "procedure_code", "n_procedures"), ("n_procedures",),
        ("date", "trust_code", "procedure_code"), "date", 100),
    "imaging": CheckSpec(("date", "trust_code", "modality", "n_tests"), ("n_tests",), (), "date", 50),
    "rtt": CheckSpec(
        ("date", "trust_code", "treatment_function", "waiting_list_size"), ("waiting_list_size",), (), "date", 50),
    "activity": CheckSpec(
        ("date", "trust_code", "activity_type", "n_activity"), ("n_activity",), (), "date", 50),
    "demographics": CheckSpec(("year", "region", "age_band", "population"), ("population",), (), None, 10),
    "supply": CheckSpec(("quarter", "category", "spend_gbp", "units"), ("spend_gbp", "units"), (), None, 4),
}


def _result(name: str, passed: Column, severity: str, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"), passed.alias("passed"),
        F.lit(severity).alias("severity"), detail.alias("detail"))


def _says(count: Column, what: str) -> Column:
    return F.concat(count.cast("string"), F.lit(what))


def _count_if(condition: Column) -> Column:
    """Rows meeting the condition; 0 (not NULL) on an empty frame."""
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("bigint")


def validate(dataset: str, df: DataFrame, spec: CheckSpec) -> DataFrame:
    """Rows (dataset, name, passed, severity, detail) for one dataset.

    With unique keys the frame is first counted per key, which also carries the other counts as
    partial sums, so the data is still read once.
    """
    present = set(df.columns)
    measures: dict[str, Column] = {"rows": F.count("*")}
    for c in spec.non_negative:
        if c in present:
            measures[f"neg_{c}"] = _count_if(F.col(c).try_cast("double") < 0)
    if spec.date_col in present:
        measures["bad_dates"] = _count_if(F.col(spec.date_col).try_cast("date").isNull())

    keyed = bool(spec.unique_keys) and present.issuperset(spec.unique_keys)
    if keyed:
        per_key = df.groupBy(*[F.col(k).alias(f"k_{k}") for k in spec.unique_keys]).agg(
            *[c.alias(n) for n, c in measures.items()])
        counts = per_key.agg(
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in measures],
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("dupes"))
    else:
        counts = df.agg(*[c.alias(n) for n, c in measures.items()])

    checks = [_result("non_empty", F.col("rows") >= spec.min_rows, "error",
                      F.concat(F.lit("rows="), F.col("rows").cast("string")))]
    checks += [_result(f"has_col[{c}]", F.lit(c in present), "error", F.lit("")) for c in spec.required_cols]
    checks += [_result(f"non_negative[{c}]", F.col(f"neg_{c}") == 0, "error", _says(F.col(f"neg_{c}"), " negatives"))
               for c in spec.non_negative if c in present]
    if keyed:
        checks.append(_result("unique_keys", F.col("dupes") == 0, "warn", _says(F.col("dupes"), " duplicate keys")))
    if "bad_dates" in measures:
        checks.append(_result(
            "valid_dates", F.col("bad_dates") == 0, "error", _says(F.col("bad_dates"), " unparseable dates")))
    return counts.select(F.explode(F.array(*checks)).alias("c")).select(F.lit(dataset).alias("dataset"), "c.*")


def validate_all(frames: Mapping[str, DataFrame], specs: Mapping[str, CheckSpec] = SPECS) -> DataFrame:
    parts = [validate(name, df, specs[name]) for name, df in frames.items() if name in specs]
    return reduce(DataFrame.unionByName, parts)


def failed_errors(results: DataFrame) -> DataFrame:
    return results.where((~F.col("passed")) & (F.col("severity") == "error"))


def assert_no_errors(results: DataFrame) -> None:
    """Raise with every failed error-level check. The result frame has a few rows per dataset."""
    failed = failed_errors(results).collect()
    if failed:
        raise ValueError("data validation failed: " + "; ".join(
            f"{r.dataset}.{r.name}: {r.detail}" for r in failed))


def drift(current: DataFrame, previous: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and column means of two snapshots, side by side with their relative change."""

    def profile(df: DataFrame, tag: str) -> DataFrame:
        wide = df.agg(F.count("*").cast("double").alias("rows"),
                      *[F.avg(c).cast("double").alias(f"mean[{c}]") for c in columns])
        return wide.unpivot([], wide.columns, "metric", tag)

    change = F.try_divide(F.col("current") - F.col("previous"), F.abs("previous"))
    return profile(current, "current").join(profile(previous, "previous"), "metric").withColumn("change", change)
