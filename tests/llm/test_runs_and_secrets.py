"""Periodic runs and secret scans against plain versions."""

import random
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast.llm import periodic_runs as pr, secret_scan as ss
from panelcast.llm.hashing import text_bytes
from tests.llm import brute
from tests.llm.conftest import frame, prose


def _repeated(rng):
    w = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(80))]
    if w and rng.random() < 0.6:
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        at = rng.randrange(len(w))
        w[at:at] = unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit) + 1)]
    return " ".join(w)


def test_transform_is_a_convolution():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 10**9, (3, 16)) % pr.PRIME, rng.integers(0, 10**9, (3, 16)) % pr.PRIME
    got = pr.transform(pr.transform(a) * pr.transform(b) % pr.PRIME, inverse=True)
    for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % pr.PRIME for k in range(16)]


@pytest.mark.parametrize("size", [1, 2, 4, 8])
def test_block_matches(size):
    rng = np.random.default_rng(size)
    x = rng.integers(0, 2, 200)
    starts = np.arange(0, 200 - 3 * size, size)
    a, d = pr.block_matches(x, starts, size)
    want = {(s, k) for s in starts.tolist() for k in range(size, 2 * size)
            if x[s: s + size].tolist() == x[s + k: s + k + size].tolist()}
    assert set(zip(a.tolist(), d.tolist())) == want


def test_runs_of_many_texts():
    rng = random.Random(3)
    texts = [_repeated(rng) for _ in range(1200)] + [None, "", " \n"]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    for text, got in zip(texts, pr._chunk(data, offsets).to_pylist()):
        words = (text or "").split()
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == brute.runs(words), text
        assert got["collapsed"] == brute.collapsed(words) and got["n_words"] == len(words)


def test_long_periods_and_hash_collisions(monkeypatch):
    unit = [str(i) for i in range(3000)]
    x = np.array([int(u) for u in unit * 5 + unit[:77]])
    assert pr.find_runs(x, len(x)).tolist() == [[0, 15077, 3000]]
    # Even if all hashes meet, runs are those found word by word.
    monkeypatch.setattr(pr.Extensions, "_hash", lambda self, a, b: np.zeros(np.broadcast(a, b).shape))
    x = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 5, 5, 5, 5, 5, 5, 5, 8])
    assert pr.find_runs(x, len(x)).tolist() == [[1, 9, 2], [9, 16, 1]]


def test_runs_on_spark(spark, crafted):
    rng = random.Random(5)
    rows = [(r[0], r[1], r[2], r[3]) for r in crafted] + [(100 + i, _repeated(rng), "en", "a") for i in range(60)]
    rows += [(100, rows[-60][1], "en", "a"), (None, "x y x y x y x y x y", None, None), (None, None, None, None)]
    rows.append((500, "la la la " + "Über naïve\x0bñ " * 2000 + "end", "en", "a"))
    got = pr.periodic_runs(frame(spark, rows).repartition(3), carry=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for g in got:
        if g.row.doc_id == 50:  # long, without repeats of this kind
            assert g.n_words == len(g.row.text.split()) and g.collapsed == " ".join(g.row.text.split())
            continue
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", g.row.text or "")]
        if len(words) < 3000:
            assert [tuple(r) for r in g.runs] == brute.runs(words) and g.collapsed == brute.collapsed(words)
    assert [tuple(r) for g in got if g.row.doc_id == 500 for r in g.runs] == [(3, 6000, 3)]
    assert pr.periodic_runs(frame(spark, [])).count() == 0


def _token(rng, kind, n):
    if kind == "hex":
        return "".join(rng.choices("0123456789abcdef", k=n))
    return "".join(rng.choices(string.ascii_letters + string.digits, k=n))


def _name(rng):
    parts = ["alpha", "beta", "customer", "index", "order", "value", "number", "update", "thing", "reader", "write"]
    return rng.choice("_-/").join(rng.choice(parts) for _ in range(rng.randrange(3, 7)))


def test_base_spans_and_nulls(spark, crafted):
    rng = random.Random(2)
    bits = ["token=", "TOKEN : '", 'api_key="', "ApiKey=", "secret", "passwd ==", "password: x", "AKIA", "AKIAAKIA", "deadbeef",
            "0" * 23, "f" * 24, "é", "\U0001f600", " ", "\n", "ABCDEF123456789012345", "abcdef", "ſecret=abcdefgh", "...", "=="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += [None, "", "token=abc token=abcdef", "token:token:abcdefgh", "x" + "token=abcdefg " * 2500]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(0, texts[0], "en", "a"), (None, "secret=abcdef", None, None)]
    rows += [(1000 + r[0], *r[1:]) for r in crafted]
    model = ss.train(ss.labelled_samples(frame(spark, rows)))
    docs = frame(spark, rows).repartition(3)
    got = docs.select("doc_id", "text", ss.scan(F.col("text"), model).alias("f")).collect()
    assert len(got) == len(rows)
    for g in got:
        assert [(ss.KINDS[s.kind], s.start, s.end) for s in g.f.base] == brute.secrets(g.text), g.text
        for s in [*g.f.base, *g.f.random]:
            assert g.text[s.start: s.end] == s.text
        assert not [1 for s in g.f.random for b in g.f.base if s.start < b.end and b.start < s.end]
    assert ss.train(ss.labelled_samples(frame(spark, []))).ratios == (0,) * ss.OTHER**2


def test_random_strings_are_told_from_names(spark):
    """Held-out accuracy: the models know tokens of `key = value` only; other tokens stand without a key."""
    rng = random.Random(4)
    learn = [(i, f"{_name(rng)} {prose(rng, 20)} token={_token(rng, rng.choice('ab'), 40)} {_name(rng)}", "en", "a")
             for i in range(400)]
    model = ss.train(ss.labelled_samples(frame(spark, learn)))
    secret = [_token(rng, "mixed", rng.randrange(24, 60)) for _ in range(200)]
    plain = [n for n in (_name(rng) for _ in range(400)) if len(n) >= 20]
    held = [(i, f"see {t} there", "en", "a") for i, t in enumerate(secret + plain)]
    got = {r.doc_id: [s.text for s in r.f.random] for r in
           frame(spark, held).select("doc_id", ss.scan(F.col("text"), model).alias("f")).collect()}
    hits = [got[i] == [t] for i, t in enumerate(secret)]
    false = [got[len(secret) + i] for i, t in enumerate(plain) if got[len(secret) + i]]
    assert sum(hits) >= 0.98 * len(secret) and len(false) <= 0.01 * len(plain)


def test_samples_are_bounded_and_apart(spark):
    rows = [(i, f"word{i} another_name token=abcdefgh{i}xyz tail", "en", "a") for i in range(2000)]
    few = ss.labelled_samples(frame(spark, rows), rows=100)
    assert 100 < few.count() < 2000
    values = {r["sample"] for r in few.where("random").collect()}
    assert values and all(v.startswith("abcdefgh") for v in values)
    assert not few.where("NOT random AND sample LIKE 'abcdefgh%'").count()
