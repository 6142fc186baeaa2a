import datetime
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import quality
from panelcast.schemas import ACTIVITY, IMAGING, PROCEDURES, TABLES
from panelcast.sources import conform, digests, storage

D = datetime.date


def test_conform(spark):
    df = spark.createDataFrame([("x", "2020-05-17", "T1")], "note string, date string, trust_code string")
    out = conform.conform(df, PROCEDURES)
    assert out.columns == [*PROCEDURES.fieldNames(), "note"]
    row = out.first()
    assert row.date == D(2020, 5, 1) and row.n_procedures is None and row.note == "x"
    assert dict(out.dtypes)["n_procedures"] == "bigint"


def test_labels(spark):
    df = spark.createDataFrame([(" X-Ray ",), ("MRI",), (" Odd One ",), (None,)], "modality string")
    assert [r.modality for r in conform.normalise_modality(df).collect()] == [
        "Plain Radiography", "MRI", " Odd One ", None]


def test_national_series_and_allocation(spark):
    sheet = spark.createDataFrame(
        [(1, "title", "x", "y"), (2, "2020-01-01", "100", "110"), (3, "2020-02-01", "200", "-"),
         (4, "2020-02-20", "300", None), (5, "2020-04-01", None, None), (6, "2020-05-01", "500", "510")],
        "row_no bigint, c2 string, c7 string, c8 string")
    series = conform.national_series(sheet)
    assert {r.date.month: r.value for r in series.collect()} == {1: 110.0, 2: 300.0, 5: 510.0}
    shares = spark.createDataFrame([("A", "R", 3), ("B", "R", 1)], "trust_code string, region string, size int")
    out = conform.allocate_top_down(
        series, shares, ["f1", "f2"], F.lit("2019-12-01").cast("date"), F.lit("2020-06-01").cast("date"))
    rows = {(r.date.month, r.trust_code, r.treatment_function): r.waiting_list_size for r in out.collect()}
    assert len(rows) == 7 * 2 * 2
    assert rows[12, "A", "f1"] == 41 and rows[12, "B", "f2"] == 14   # carried back; 41.25 and 13.75
    assert rows[4, "A", "f2"] == 112                                 # 112.5 rounds to even
    assert rows[6, "A", "f1"] == 191


def test_empty_series_is_an_error(spark):
    with pytest.raises(ValueError, match="no national"):
        conform.require_rows(spark.createDataFrame([], "date date, value double"), "no national values")


def test_future_months(spark):
    df = spark.createDataFrame([("a", D(2020, 11, 1))], "k string, date date")
    assert [r.date for r in conform.future_months(df, 3).orderBy("step").collect()] == [
        D(2020, 12, 1), D(2021, 1, 1), D(2021, 2, 1)]


def test_feed_fallback_and_csv(spark, tmp_path):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    spark.createDataFrame([("2020-03-09", "T", "Total Elective Admissions", "7", "zz")],
                          "date string, trust_code string, activity_type string, n_activity string, extra string"
                          ).write.option("header", "true").csv(csv)
    df, entry = conform.load_dataset(spark, "activity", conform.Feed(csv, "/nowhere", "csv"))
    row = df.first()
    assert entry[:2] == ("activity", "live")
    assert (row.date, row.activity_type, row.n_activity, row.region, row.extra) == (D(2020, 3, 1), "elective", 7, None, "zz")
    spark.createDataFrame([(D(2020, 1, 1), "T", "R", " ct ", 4)], IMAGING).write.parquet(parquet)
    df, entry = conform.load_dataset(spark, "imaging", conform.Feed(str(tmp_path / "gone"), parquet))
    assert entry[1] == "fallback" and df.first().modality == " ct "


def test_snapshots(spark, tmp_path):
    lake = str(tmp_path / "lake")
    df = lambda n: spark.createDataFrame([(D(2020, 1, 1), "T", "R", "a", n)], ACTIVITY)
    assert storage.latest_snapshot(spark, lake, "activity") is None
    assert storage.list_snapshots(spark, lake, "activity").count() == 0
    with pytest.raises(FileNotFoundError):
        storage.read_latest(spark, lake, "activity")
    storage.write_snapshot(df(1), lake, "activity", "2024-01-01")
    storage.write_snapshot(df(2), lake, "activity", "2024-02-01")
    storage.write_snapshot(df(3), lake, "activity", "2024-02-01")
    assert storage.read_latest(spark, lake, "activity").first().n_activity == 3
    assert storage.read_snapshot(spark, lake, "activity", "2024-01-01").first().n_activity == 1
    assert [r[0] for r in storage.list_snapshots(spark, lake, "activity").collect()] == ["2024-01-01", "2024-02-01"]
    plan = storage.read_latest(spark, lake, "activity")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_tables(spark, tmp_path):
    base = str(tmp_path / "tables")
    storage.init_tables(spark, base)
    assert all(storage.read_table(spark, base, t).schema == s for t, s in TABLES.items())
    storage.replace_table(spark.createDataFrame([("A", "1.5", "x")], "region string, trust_code string, other string"),
                          base, "dim_trust")
    assert [tuple(r) for r in storage.read_table(spark, base, "dim_trust").collect()] == [("1.5", "A")]
    storage.init_tables(spark, base)
    assert storage.query_tables(spark, base, "SELECT count(*) AS n FROM dim_trust").first().n == 1


def test_replace_run_is_idempotent(spark, tmp_path):
    base = str(tmp_path / "tables")
    book = spark.createDataFrame([("d1", 1.0), ("d2", 2.0)], "device_id string, cv double")
    for _ in range(2):
        storage.replace_run(book, base, "underwriting_device", "r1")
    storage.replace_run(book.limit(1), base, "underwriting_device", "r2")
    out = storage.read_table(spark, base, "underwriting_device")
    assert out.columns == TABLES["underwriting_device"].fieldNames()
    assert {r.run_id: r["count"] for r in out.groupBy("run_id").count().collect()} == {"r1": 2, "r2": 1}


def test_fiscal_year(spark):
    df = spark.createDataFrame([(D(2008, 4, 1),), (D(2008, 3, 1),), (D(2019, 12, 1),)], "date date")
    assert [r.fiscal_year for r in storage.build_dim_date([df, df]).orderBy("date").collect()] == ["2007/8", "2008/9", "2019/20"]


def test_provenance_and_lineage(spark, tmp_path):
    base = str(tmp_path)
    storage.record_provenance(spark, base, "r1", [("a", "live", "x"), ("b", "fallback", "")])
    storage.record_provenance(spark, base, "r2", [("a", "fallback", "y")])
    assert {r.source: r.provenance for r in storage.provenance(spark, base, "r1").collect()} == {"a": "live (x)", "b": "fallback"}
    (tmp_path / "raw.bin").write_bytes(b"abc")
    row = storage.raw_lineage(spark, "s", str(tmp_path / "raw.bin")).first()
    assert row.digest == "ba7816bf8f01" and row.bytes == 3


RAW = random.Random(4).randbytes(700_000)
STRETCH = 200_000
MARKED = digests.BOM + b"a,b\r\n1,2\n"
FILES = {
    "noise.parquet": RAW, "no-ending": RAW[:500_000], "ends\n": RAW[:99] + b"\n", "mark": b"\n", "marks": b"\n\n\n", "one": b"x",
    "bom.csv": MARKED, "bom only": digests.BOM, "bom and mark": digests.BOM + b"\n", "two boms": digests.BOM * 2 + b"\n\0",
    "zeros": bytes(400_000), "long zeros": b"a\n" + bytes(400_000) + b"\n", "bom zeros": digests.BOM + bytes(400_000),
    "neither": b"a\n\0" + b"z" * 400_000, "cut by 3": b"ab\n" * 33 + b"z" * (STRETCH + 3) + b"\n" + RAW,
    "cut by 1": b"ab\n" * 33 + b"z" * (STRETCH + 1) + b"\n" + RAW,
    "x.gz": gzip.compress(MARKED * 9), "plain.GZ": MARKED, "plain.bz2": b"q\n", "x.zst": RAW[:70]}


def test_digests_of_files_in_pieces(spark, tmp_path, monkeypatch):
    """Whatever the bytes, the endings and the splits, as hashlib has it; only files without a mark for long are read whole."""
    for name, data in FILES.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(digests, "WHOLE_BYTES", 0)
    monkeypatch.setattr(digests, "STRETCH_BYTES", STRETCH)
    monkeypatch.setattr(digests, "PIECE_BYTES", 50_000)
    parts, write = [], storage.materialise
    monkeypatch.setattr(storage, "materialise", lambda *a: parts.append(write(*a)) or parts[-1])
    small = {"spark.sql.files.maxPartitionBytes": "150k", "spark.sql.files.openCostInBytes": "64k"}
    wanted = {name: (hashlib.sha256(data).hexdigest()[:12], len(data)) for name, data in FILES.items()}
    whole = {"x.gz", "plain.GZ", "plain.bz2", "x.zst", "neither", "bom only", "cut by 3", "cut by 1"}
    for settings in ({}, small):
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            rows = storage.raw_lineage(spark, "s", str(tmp_path)).collect()
        finally:
            for k in settings:
                spark.conf.unset(k)
        streamed = [r.name for p in parts for r in p.select(F.url_decode(F.substring_index("file", "/", -1)).alias("name")).collect()]
        assert sorted(streamed) == sorted(FILES.keys() - whole) and len(rows) == len(FILES)
        parts.clear()
        assert {r.path.rsplit("/", 1)[1]: (r.digest, r.bytes) for r in rows} == wanted


def test_no_row_holds_a_file(spark, tmp_path, monkeypatch):
    """A file of 42 MB is never a row, and no batch of it that reaches Python is large."""
    (tmp_path / "raw.parquet").write_bytes(RAW * 60)
    chains = digests._chains

    def watched(mark, head):
        def run(batches):
            def seen():
                for b in batches:
                    assert b.nbytes < 20 << 20 and max(map(len, b.column(4).to_pylist())) <= 1 << 20
                    yield b
            yield from chains(mark, head)(seen())
        return run

    monkeypatch.setattr(digests, "_chains", watched)
    (tmp_path / "small.parquet").write_bytes(b"abc")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000000")  # the binary reader fails on larger files
    try:
        rows = {r.digest: r.bytes for r in storage.raw_lineage(spark, "s", str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert rows == {hashlib.sha256(RAW * 60).hexdigest()[:12]: 60 * len(RAW), "ba7816bf8f01": 3}


def test_scratch_path_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = storage.scratch_path(spark, "x")
    assert shared is None or path.startswith(shared.rstrip("/"))


SPEC = quality.CheckSpec(("k", "gone"), ("v",), ("k", "j"), "d", 3)


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", None, "-1", "2020-01-01"), ("a", None, "x", "bad"), (None, None, None, None), (None, None, "2", "2020-01-01")],
        "k string, j string, v string, d string")
    rows = {r.name: (r.passed, r.severity, r.detail) for r in quality.validate("t", df, SPEC).collect()}
    assert rows["non_empty"] == (True, "error", "rows=4")
    assert rows["has_col[k]"][0] and not rows["has_col[gone]"][0]
    assert rows["non_negative[v]"] == (False, "error", "1 negatives")
    assert rows["unique_keys"] == (False, "warn", "2 duplicate keys")
    assert rows["valid_dates"] == (False, "error", "2 unparseable dates")
    with pytest.raises(ValueError, match="t.valid_dates: 2 unparseable dates"):
        quality.assert_no_errors(quality.validate("t", df, SPEC))


def test_checks_on_an_empty_frame(spark):
    df = spark.createDataFrame([], "k string, j string, v string, d string")
    rows = {r.name: r.passed for r in quality.validate("t", df, SPEC).collect()}
    assert rows == {"non_empty": False, "has_col[k]": True, "has_col[gone]": False, "non_negative[v]": True,
                    "unique_keys": True, "valid_dates": True}


def test_warnings_do_not_abort(spark):
    df = spark.createDataFrame([("a", "b", "1", "2020-01-01")] * 3, "k string, j string, v string, d string")
    quality.assert_no_errors(quality.validate("t", df, quality.CheckSpec((), ("v",), ("k", "j"), "d", 1)))


def test_shuffle_files_go_with_the_write(spark):
    """What a written frame shuffled is removed; the setting is put back, a caller's own holds, and frames stay good."""
    key, seen = storage.SHUFFLES_GO, []
    frame = spark.range(100).repartition(3).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    with storage.shuffles_removed(spark):
        seen.append(spark.conf.get(key, None))
        with storage.shuffles_removed(spark):
            pass
        seen.append(spark.conf.get(key, None))
    assert seen == ["true", "true"] and spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    with storage.shuffles_removed(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)
    first, second = storage.materialise(frame, "once"), storage.materialise(frame, "twice")
    assert frame.count() == first.join(second, ["k", "n"]).count() == 7
