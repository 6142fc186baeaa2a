"""Every stage against a plain version of its own input; and on empty input."""

import base64
import random
import string

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import brute
from tests.llm.conftest import frame, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGE = dict(cp.STAGES)


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, crafted):
    docs = frame(spark, crafted).select(*COLUMNS)
    kept = STAGE["language"](spark, docs, "")
    assert kept.columns == COLUMNS and set(_rows(kept)) == {r[0] for r in crafted} - {1, 2, 3, 7}

    rows = [(r[0], r[1]) for r in crafted if r[1] is not None]
    docs = frame(spark, [r for r in crafted if r[1] is not None]).select(*COLUMNS)
    kept = STAGE["exact"](spark, docs, "")
    low = {}
    for d, t in rows:
        low[t] = min(low.get(t, d), d)
    assert kept.columns == COLUMNS and set(_rows(kept)) == set(low.values())

    kept = STAGE["near"](spark, docs, "")
    want = brute.jaccard(rows, 5, 8, 10)
    assert kept.columns == COLUMNS and set(_rows(kept)) == {d for d, (_, c) in want.items() if d == c}

    kept = STAGE["repeats"](spark, docs, "")
    assert kept.columns == COLUMNS
    got, sums = _rows(kept), dict(zip([d for d, _ in rows], brute.repeats([t for _, t in rows])))
    assert set(got) == set(sums)
    for d, t in rows:
        assert got[d].n_chars == len(got[d].text)
        if sums[d][1] == 0:
            assert got[d].text == t
        elif t.isascii():
            assert brute.sha(got[d].text) == sums[d][3]

    pieces = STAGE["packing"](spark, docs, "").collect()
    ids = brute.bpe([t for _, t in rows], public_tokenizers.path("word_bpe_49k.json"))
    assert sum(p.length for p in pieces) == sum(len(i) + 1 for i, _ in ids)
    assert max(p.offset + p.length for p in pieces) <= 4096


def test_copies_go_by_row(spark):
    """Repeated rows, copies without an id, and ids with two texts: one row of each text stays, and stays whole."""
    rng = random.Random(8)
    a, b, c, d, e, f, g = (prose(rng, 80) for _ in range(7))
    rows = [(1, a), (1, a), (None, b), (2, b), (None, b), (3, c), (4, c), (4, d), (None, e), (None, e),
            (5, f), (6, f + " more"), (None, f + " again"), (6, g)]
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows]).select(*COLUMNS)
    for name in ("exact", "near", "repeats"):
        docs = STAGE[name](spark, docs, "")
        assert docs.columns == COLUMNS
    left = {(r.doc_id, r.text) for r in docs.collect()}
    assert docs.count() == 7 and left == {(1, a), (2, b), (3, c), (4, d), (None, e), (5, f), (6, g)}


def test_rows_that_differ_in_nulls_and_no_copy_of_the_corpus(spark, monkeypatch):
    """Rows of one id and text that differ in which column is null are two rows, one goes; no stage writes the texts again."""
    rng = random.Random(9)
    a, b = prose(rng, 80), prose(rng, 80)
    rows = [(1, a, "x", None), (1, a, None, "x"), (2, b, "x", None), (2, b, "x", None), (2, b, "x", None)]
    docs = frame(spark, rows).select(*COLUMNS)
    written, write = [], cp.materialise
    monkeypatch.setattr(cp, "materialise", lambda df, name, *more: written.append(df.columns) or write(df, name, *more))
    for name in ("exact", "near"):
        left = STAGE[name](spark, docs, "").collect()
        assert sorted((r.doc_id, r.text) for r in left) == [(1, a), (2, b)]
    assert written and not any("text" in columns for columns in written)
    assert cp.numbered(docs).select(cp.ROW).distinct().count() == 3


def test_language_passes_texts_in_small_batches(spark, monkeypatch):
    """A partition of 40 MB never reaches Python in one batch, and no stage writes the texts again."""
    @F.arrow_udf("struct<lang string, score double>")
    def nearest(texts: pa.Array) -> pa.Array:
        assert texts.nbytes < 20 << 20, texts.nbytes
        found = pa.array([None if t.as_py().startswith("7 ") else 1.0 for t in texts], pa.float64())
        return pa.StructArray.from_arrays([pa.repeat(pa.scalar("en"), len(texts)), found], ["lang", "score"])

    written, write = [], cp.materialise
    monkeypatch.setattr(cp, "materialise", lambda df, name, *more: written.append(df.columns) or write(df, name, *more))
    monkeypatch.setattr(cp.langid, "train", lambda docs: {})
    monkeypatch.setattr(cp.langid, "predict", lambda text, profiles: nearest(text))
    text = F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("prose "), 40_000))
    docs = spark.range(0, 160, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"),
                                            F.lit("a").alias("source"), F.length(text).cast("long").alias("n_chars"))
    kept = STAGE["language"](spark, docs, "")
    assert kept.columns == COLUMNS and {r.doc_id for r in kept.select("doc_id").collect()} == set(range(160)) - {7}
    assert written == [[cp.TEXT]]


def test_noise_goes_and_short_prose_stays(spark, root):
    rng = random.Random(6)
    learn = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    noise, prose_ = [], []
    for n in (80, 100, 200, 1000, 20_000):
        for _ in range(4):
            noise += ["".join(rng.choices(string.ascii_lowercase, k=n)), rng.randbytes(n).hex()[:n],
                      base64.b64encode(rng.randbytes(n)).decode()[:n]]
    noise += ["".join(rng.choices(string.ascii_lowercase + " " * 5, k=n)) for n in (200, 1000, 20_000)]
    for lang in ("de", "en", "es", "fr"):
        for r in [r for r in learn if r.lang == lang and len(r.text) > 400][:10]:
            prose_ += [r.text[100: 100 + n] for n in (20, 40, 80, 199, 200)]
    prose_ = [t for t in prose_ if not any(c.isdigit() for c in t)]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in learn]
    rows += [(10**6 + i, t, None, "noise") for i, t in enumerate(noise)]
    rows += [(2 * 10**6 + i, t, None, "prose") for i, t in enumerate(prose_)]
    kept = set(_rows(STAGE["language"](spark, frame(spark, rows).select(*COLUMNS), "")))
    assert len(prose_) > 150 and {2 * 10**6 + i for i in range(len(prose_))} <= kept
    assert not [t[:60] for i, t in enumerate(noise) if 10**6 + i in kept]


def test_empty(spark):
    docs = frame(spark, []).select(*COLUMNS)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_whole_run(spark, root):
    pieces = cp.run(spark, root)
    assert pieces.count() > 0 and cp.ORACLE_SQL is None
