"""Partition folds to a summed vector, and array helpers for recursions inside a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An array column of constant length as a 2-d numpy array."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def vector(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.to_numpy(zero_copy_only=False).astype(float)


def summed(df: DataFrame, fold: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of ``fold(batch)`` over all batches: partial sums per task, added by Spark.

    Only the vector itself reaches the driver. Its length must not depend on the row count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fold(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["slot", "value"])

    rows = df.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row.slot] = row.value
    return out


def solve_scaled(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Minimum-norm least squares from normal equations, columns scaled to unit length first.

    Constant-zero and collinear columns are allowed; a non-finite result raises.
    """
    scale = np.sqrt(np.clip(np.diag(gram), 0.0, None))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(gram / np.outer(scale, scale), rcond=1e-12, hermitian=True)
    beta = inverse @ (moment / scale) / scale
    if not np.isfinite(beta).all():
        raise ArithmeticError("non-finite coefficients")
    return beta


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(values: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(values, weights, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def literals(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def tail(values: Column, n: int) -> Column:
    """Last ``n`` elements, or all of a shorter array."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))


def mean_of(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total / F.greatest(F.size(values), F.lit(1)))


def deviation_of(values: Column, ddof: int = 1) -> Column:
    """Standard deviation of an array, 0 below two values."""
    def spread(v: Column) -> Column:
        n = F.size(v)
        return bind(mean_of(v), lambda m: F.when(n > 1, F.sqrt(F.aggregate(
            v, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m)) / F.greatest(n - ddof, F.lit(1)))).otherwise(0.0))

    return bind(values, spread)
