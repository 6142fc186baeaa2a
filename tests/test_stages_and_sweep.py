import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelcast.operators.features_device import operator_herfindahl
from panelcast.sources.storage import discard, materialise, scratch_path


def folders(spark, name):
    root = Path(scratch_path(spark, name).removeprefix("file:")).parent
    return set(root.glob(f"{name}-*"))


def test_discard_deletes_one_stage_and_no_other(spark):
    before = folders(spark, "stage-test")
    one, two = (materialise(spark.range(n), "stage-test") for n in (3, 5))
    copy = materialise(one.select("id"), "stage-test")
    discard(one, two.select("id"), spark.range(1))
    assert len(folders(spark, "stage-test") - before) == 2
    assert two.count() == 5 and copy.count() == 3
    discard(one)  # a second time does nothing
    discard(two, copy)
    assert folders(spark, "stage-test") == before


def test_rows_a_file(spark):
    written = materialise(spark.range(0, 10, 1, 1), "stage-files", 4)
    assert len(written.inputFiles()) == 3 and written.count() == 10
    discard(written)


def trailing_shares(rows, days):
    """By definition: all sessions of the device in the days up to each day with sessions."""
    out = {}
    for dev, day, _ in rows:
        if day is None:
            continue
        first = day - datetime.timedelta(days=days - 1)
        counts = {}
        for d, t, op in rows:
            if d == dev and t is not None and op is not None and first <= t <= day:
                counts[op] = counts.get(op, 0) + 1
        if any(d == dev and t == day and op is not None for d, t, op in rows):
            out[dev, day] = sum(n * n for n in counts.values()) / sum(counts.values()) ** 2
    return out


@pytest.mark.parametrize("days", [1, 2, 28])
def test_sweep_of_trailing_shares(spark, days):
    random.seed(days)
    start = datetime.date(2024, 1, 1)
    at = lambda k: start + datetime.timedelta(days=k)
    rows = [(random.choice(["a", "b"]), at(random.randrange(90)), random.choice(["x", "y", "z", None])) for _ in range(250)]
    # Edges: an exit meets an entry of the same operator, the last day inside and the first outside, a gap, no start.
    rows += [("c", at(k), op) for k, op in ((0, "x"), (days, "x"), (days, "x"), (days - 1, "y"), (3 * days + 5, "y"))]
    rows += [("c", None, "x"), (None, at(0), "x")] + [("hot", at(k % 3), "x") for k in range(300)]
    df = spark.createDataFrame(rows, "device_id string, day date, operator_hash string").select(
        "device_id", F.col("day").cast("timestamp").alias("t_start"), "operator_hash")
    got = {(r.device_id, r.date): r.op_herfindahl for r in operator_herfindahl(df, days).collect()}
    want = trailing_shares(rows, days)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_sweep_moves_two_rows_an_operator_day(spark, fleet):
    """No fan-out over the days of the window."""
    plan = operator_herfindahl(fleet["sessions"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and plan.count("Generate") == 1


def test_sweep_of_nothing(spark):
    df = spark.createDataFrame([], "device_id string, t_start timestamp, operator_hash string")
    assert operator_herfindahl(df).count() == 0
