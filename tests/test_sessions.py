import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import features_device as fd, sessions


def random_events(seed=3, n=600):
    """One device holds most of the log; starts and ends are unbalanced."""
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2024-01-01")
    rows = []
    for i in range(n):
        device = "hot" if rng.random() < 0.7 else f"d{rng.integers(3)}"
        kind = rng.choice(["active_start", "active_end", "error"])
        rows.append(dict(
            event_id=f"e{i}", device_id=device, site_id="s", operator_hash=f"op{rng.integers(4)}", event_type=kind,
            ts_device=start + pd.Timedelta(minutes=97 * i), seq_no=int(i * 3 + 1),
            active_seconds=float(rng.choice([0.0, 100.0, 400.0])), n_errors=int(rng.integers(3)),
            procedure_code="p", ingest_quality=str(rng.choice(["ok", "suspect"], p=[0.9, 0.1]))))
    return pd.DataFrame(rows)


SCHEMA = ("event_id string, device_id string, site_id string, operator_hash string, event_type string, "
          "ts_device timestamp_ntz, seq_no bigint, active_seconds double, n_errors int, procedure_code string, "
          "ingest_quality string")


def brute_pairs(ev):
    out = {}
    for dev, g in ev.sort_values("seq_no").groupby("device_id"):
        starts = g[g.event_type == "active_start"].to_dict("records")
        ends = g[g.event_type == "active_end"].to_dict("records")
        for s, e in zip(starts, ends):
            seconds = e["active_seconds"] or (e["ts_device"] - s["ts_device"]).total_seconds()
            out[e["event_id"]] = (dev, s["operator_hash"], s["ts_device"], seconds,
                                  seconds >= 180 and e["ingest_quality"] == "ok")
    return out


@pytest.mark.parametrize("width", [5, 64, 1_000_000])
def test_ordinal_pairing_against_brute_force(spark, width):
    ev = random_events()
    got = sessions.sessionise(spark.createDataFrame(ev, SCHEMA), width=width).toPandas()
    want = brute_pairs(ev)
    assert set(got.session_id) == set(want)
    for r in got.itertuples():
        assert (r.device_id, r.operator_hash, r.t_start, pytest.approx(r.active_seconds), r.billable) == want[r.session_id]


def test_ordinal_over_many_buckets(spark):
    df = spark.range(500).select(F.lit("k").alias("k"), (F.col("id") * 7).alias("seq"), (F.col("id") + 1).alias("want"))
    out = sessions.ordinal(df.repartition(7), ["k"], "seq", width=50)
    assert out.where("ordinal <> want").count() == 0 and out.count() == 500


def test_next_pairing_survives_a_lost_packet(spark):
    ev = pd.DataFrame([
        dict(event_id=f"e{i}", device_id="d", site_id="s", operator_hash="o", event_type=k,
             ts_device=pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i), seq_no=i, active_seconds=300.0,
             n_errors=0, procedure_code="p", ingest_quality="ok")
        for i, k in enumerate(["active_start", "active_start", "active_end", "active_start", "active_end"])])
    got = sessions.sessionise(spark.createDataFrame(ev, SCHEMA), mode="next").toPandas()
    assert sorted(zip(got.t_start.dt.minute, got.session_id)) == [(1, "e2"), (3, "e4")]
    with pytest.raises(ValueError):
        sessions.sessionise(spark.createDataFrame(ev, SCHEMA), mode="other")


def test_partition_count_does_not_matter(spark):
    df = spark.createDataFrame(random_events(), SCHEMA)
    one = sessions.sessionise(df.repartition(1))
    seven = sessions.sessionise(df.repartition(7))
    assert one.exceptAll(seven).count() == 0 and seven.exceptAll(one).count() == 0


def test_billing(spark, fleet):
    rows = fleet["sessions"].join(fleet["devices"].select("device_id", "price_per_session_gbp"), "device_id")
    wrong = rows.where("billed_amount_gbp <> if(billable, price_per_session_gbp, 0)")
    assert wrong.count() == 0 and rows.count() == fleet["sessions"].count()


def test_device_day_reconciles(fleet):
    days, ses = fleet["days"], fleet["sessions"]
    assert days.where("n_billable > n_sessions").count() == 0
    powered = ses.withColumn("date", F.to_date("t_start")).join(days.select("device_id", "date"), ["device_id", "date"])
    assert days.agg(F.sum("n_sessions")).first()[0] == powered.count()
    assert days.agg(F.sum("billed_gbp")).first()[0] == pytest.approx(powered.agg(F.sum("billed_amount_gbp")).first()[0])


def test_exposure_needs_both_power_events(spark):
    t = lambda h: pd.Timestamp("2024-01-01") + pd.Timedelta(hours=h)
    rows = [("a", "power_on", t(8), 1), ("a", "power_off", t(18), 9), ("a", "power_on", t(12), 5), ("b", "power_on", t(7), 1)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["device_id", "event_type", "ts_device", "seq_no"]),
                               "device_id string, event_type string, ts_device timestamp_ntz, seq_no bigint")
    assert [(r.device_id, r.exposure_hours) for r in sessions.exposure(df).collect()] == [("a", 10.0)]


def test_herfindahl_against_brute_force(spark):
    ev = random_events(seed=9)
    ses = sessions.sessionise(spark.createDataFrame(ev, SCHEMA)).toPandas()
    ses["date"] = ses.t_start.dt.normalize()
    got = {(r.device_id, pd.Timestamp(r.date)): r.op_herfindahl for r in fd.operator_herfindahl(
        sessions.sessionise(spark.createDataFrame(ev, SCHEMA))).collect()}
    assert set(got) == set(zip(ses.device_id, ses.date))
    for (dev, day), h in got.items():
        window = ses[(ses.device_id == dev) & (ses.date <= day) & (ses.date > day - pd.Timedelta(days=28))]
        share = window.operator_hash.value_counts(normalize=True)
        assert h == pytest.approx((share ** 2).sum())


def test_device_features_do_not_leak(spark, fleet):
    """Today's counts do not enter today's lagged inputs."""
    last = fleet["days"].agg(F.max("date")).first()[0]
    bump = lambda c: F.when(F.col("date") == last, F.col(c) + 50).otherwise(F.col(c))
    moved = fleet["days"].withColumns({c: bump(c) for c in ("n_billable", "n_sessions", "n_errors", "n_operators")})
    build = lambda days: fd.build_features(days, fleet["sessions"], fleet["devices"])
    cols = ["device_id", "date", *fd.NUMERIC_FEATURES]
    assert build(fleet["days"]).select(cols).exceptAll(build(moved).select(cols)).count() == 0
