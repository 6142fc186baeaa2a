"""Each text operator against its plain version on crafted rows, with nulls, ties, repeats, empty tables, clashes."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast.llm import bpe, exact_dedup, langid, license_scan, ngram_join, packing, sharding, suffix_dedup
from tests.llm import brute
from tests.llm.conftest import frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark, crafted):
    return frame(spark, crafted).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def test_exact(docs, crafted):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256)
           for r in exact_dedup.exact_groups(docs, keep="largest").collect()}
    assert got == brute.exact([r[:2] for r in crafted])
    low = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()}
    assert (low[1], low[2], low[11], low[8]) == (1, 1, 9, 8)


def test_exact_hot_group_nulls_and_repeats(spark, empty):
    rows = [(i, "same", None, None) for i in range(900)] + [(i, f"t{i % 500}", None, None) for i in range(900, 2000)]
    rows += [(1999, f"t{1999 % 500}", None, None), (None, "same", None, None), (None, "alone", None, None)]
    got = exact_dedup.exact_groups(frame(spark, rows), keep="largest").collect()
    assert len(got) == len(rows)
    hot = [r for r in got if r.group_size == 901]
    assert len(hot) == 901 and {r.keep_id for r in hot} == {899} and sum(r.kept for r in hot) == 1
    assert sum(r.kept for r in got if r.doc_id == 1999) == 2
    assert [(r.keep_id, r.kept) for r in got if r.doc_id is None and r.group_size == 1] == [(None, True)]
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_normalised(spark):
    df = frame(spark, [(1, "A b", None, None), (2, "a B", None, None)])
    assert [r.group_size for r in exact_dedup.exact_groups(df, normalise=F.lower).collect()] == [2, 2]


def test_bpe_round_trip(docs, crafted, empty):
    rows = docs.select("doc_id", bpe.encode(F.col("text"), PATH).alias("i"))
    got = {r.doc_id: (r.i, r.t) for r in rows.select("doc_id", "i", bpe.decode(F.col("i"), PATH).alias("t")).collect()}
    assert got == dict(zip([r[0] for r in crafted], brute.bpe([r[1] for r in crafted], PATH)))
    assert empty.select(bpe.encode(F.col("text"), PATH)).count() == 0


def test_language_training_adds_up_in_bounded_memory():
    """A task's n-grams are added up as they come; 3,000 texts at once took 16 bytes for each of their n-grams, some times over."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    pairs = [("ab"[i % 2], " ".join(rng.choices(words, k=120))) for i in range(3000)]
    want = {lang: langid._merged([langid.grams(t) for x, t in pairs if x == lang]) for lang in "ab"}
    for held in (langid.HELD, 700):  # the last is less than one language has
        tracemalloc.start()
        got = {}
        for lang, codes, n in langid.tallies(iter(pairs), held):
            got.setdefault(lang, []).append((codes, n))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        if held == langid.HELD:
            assert [len(v) for v in got.values()] == [1, 1] and peak < 20 << 20
        for lang, (codes, n) in want.items():
            total = langid._merged(got[lang])
            assert (total[0] == codes).all() and (total[1] == n).all()
    assert list(langid.tallies(iter([]))) == []


def test_bpe_any_text():
    rng = random.Random(1)
    alphabet = "aeinrst 'sSdDłßƁȺvelm\n\t0½²日Σςİé́ͅ ​\x00\x1c\x85!?#$<|endoftext|>\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["the" * 3000, "zqzqzq" * 2000, "x" * 5000, "<|endoftext|>" * 3, "'s't're" * 5]
    c = bpe.Codec(PATH)
    for text, (ids, back) in zip(texts, brute.bpe(texts, PATH)):
        got = c.encode(text)
        assert got == ids, text
        assert c.decode(np.array(got, int)) == back
    together, counts = c.encode_all(pa.array([None, *texts, ""]))
    want = brute.bpe(texts, PATH)
    assert counts.tolist() == [0, *(len(i) for i, _ in want), 0]
    assert together.tolist() == [i for ids, _ in want for i in ids]


def test_forced_boundaries_cut():
    c = bpe.Codec(PATH)
    assert "".join(c.fragments_of("zqjxthe")) == "zqjxthe" and len(c.fragments_of("zqjxqzthe")) > 1


def test_license(docs, crafted, empty):
    rows, spans = license_scan.scan(docs)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows.collect()}
    assert got == {r[0]: brute.phrases(r[1]) for r in crafted}
    assert {r.label for r in spans.where("doc_id = 51").collect()} >= {"apache", "cc-by", "mit", "gpl"}
    assert license_scan.scan(empty)[0].count() == 0


def test_license_changed_notice(spark):
    text = ("x y Permission is hereby granted, totally free of charge, to any person obtaining one copy of this software z")
    rows, spans = license_scan.scan(frame(spark, [(1, text, None, None), (1, text, None, None), (None, "plain", None, None)]))
    found = rows.collect()
    assert len(found) == 3 and sorted(r.labels for r in found) == ["", "mit", "mit"]
    assert all(r.n_base == 0 and 0.6 <= r.score < 1 for r in found if r.labels)
    assert {(r.start, r.end) for r in spans.collect()} == {(2, 19)}


def test_license_spans_are_verified(spark):
    """Reversed, scattered and repeated pairs are no notice; notices with changes are, as in a plain version."""
    rng = random.Random(12)
    notice, label = "permission to use copy modify and or distribute this software for any purpose", "isc"
    w = notice.split()
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:])]
    bad = [" x ".join(pairs[::-1]), " x y ".join(pairs[::-1]), "and or q q " * 500 + " x ".join(pairs[::-1]),
           (" " + "q " * 40).join(pairs), "and or q q " * 500, " ".join(w[::-1])]
    good = [notice, "and or q q " * 500 + notice, notice.replace("copy", "really copy"), notice + " z " + notice]
    rows, _ = license_scan.scan(frame(spark, [(i, t, None, None) for i, t in enumerate(bad + good)]))
    got = {r.doc_id: r.labels for r in rows.collect()}
    assert [got[i] for i in range(len(bad))] == [""] * len(bad)
    assert [got[len(bad) + i] for i in range(len(good))] == [label] * len(good)

    texts = []
    for _ in range(150):
        t = rng.choice(list(license_scan.NOTICES)).split()
        for _ in range(rng.randrange(0, 8)):
            at = rng.randrange(len(t))
            change = rng.randrange(4)
            if change == 0:
                t.insert(at, rng.choice(["q", "the", "and", "or", "license"]))
            elif change == 1:
                t.pop(at)
            elif change == 2:
                t[at:at + 3] = t[at:at + 3][::-1]
            else:
                t = t + ["q"] * rng.randrange(8) + t[at:at + 5]
        texts.append(" ".join(t))
    rows, spans = license_scan.scan(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]), phrases={})
    got = {r.doc_id: r.labels for r in rows.collect()}
    want = {i: ",".join(sorted(brute.notices(t, license_scan.NOTICES))) for i, t in enumerate(texts)}
    assert got == want and 20 < sum(bool(v) for v in want.values()) < 150
    longest = max(len(t.split()) for t in license_scan.NOTICES)
    assert spans.where(F.col("end") - F.col("start") > longest * 1.5 + 5).count() == 0


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 8, 10)])
def test_jaccard(docs, crafted, empty, k, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.jaccard_components(docs, k=k, num=num, den=den).collect()}
    assert got == brute.jaccard([r[:2] for r in crafted], k, num, den)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_jaccard_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = prose(rng, 150).split(" ")
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), None, None))
    rows += [(0, rows[0][1], None, None), (None, rows[1][1], None, None)]
    got = ngram_join.jaccard_components(frame(spark, rows), k=3, num=90, den=100).collect()
    want = brute.jaccard([r[:2] for r in rows[:300]], 3, 90, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len(got) == 302 and [r.component_id for r in got if r.doc_id is None] == [None]


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for num, den in ((9, 10), (8, 10)):
        for _ in range(400):
            n = int(rng.integers(1, 300))
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
            most = (2 * len(x)) * (den - num) // (den + num)
            drop = rng.permutation(len(x))[: int(rng.integers(0, most + 1))]
            add = rng.integers(0, 1 << 63, int(rng.integers(0, most - len(drop) + 1))).astype(np.uint64)
            y = np.unique(np.concatenate((np.delete(x, drop), add)))
            if not len(y):
                continue
            both = len(np.intersect1d(x, y))
            if den * both < num * (len(x) + len(y) - both) or both == len(x) == len(y):
                continue
            where = np.array([0, len(x), len(x) + len(y)])
            row, sig = ngram_join.signatures(np.concatenate((x, y)), where, num, den)
            assert set(sig[row == 0]) & set(sig[row == 1])


def test_chance_fragments_connect_no_candidates(spark, monkeypatch):
    """Texts that share a fragment by chance were one cluster, sent to each of its blocks; now only possible links connect."""
    rng = random.Random(21)
    rows = []
    for i in range(60):
        text = prose(rng, 60)
        rows += [(2 * i, text), (2 * i + 1, text.rsplit(" ", 1)[0] + " odd")]
    narrow = frame(spark, [(d, t, None, None) for d, t in rows]).select("doc_id", "text").mapInArrow(
        ngram_join._narrow(3), "doc_id long, n_shingles long, set_id long, bits binary").persist()
    sets = {r.doc_id: r.set_id for r in narrow.collect()}
    # One signature that all share, and one of each pair.
    shared = [(0, s) for s in sets.values()] + [(1 + d // 2, s) for d, s in sets.items()]
    for block in (1024, 16):  # whole, and in pairs of blocks
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        got = ngram_join.candidates(spark.createDataFrame(shared, "sig long, node long"), narrow, 8, 10).collect()
        assert {frozenset((r.a, r.b)) for r in got} == {frozenset((sets[2 * i], sets[2 * i + 1])) for i in range(60)}
    narrow.unpersist()


def _connected_groups(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_large_groups_make_rows_in_proportion(spark, monkeypatch):
    """Each pair of blocks of one signature made a forest of its own: rows with the square of a group of near copies.

    Versions that drift apart, and texts like no other, share the signature too; all that may link is connected as before.
    """
    rng = random.Random(31)
    base, texts = prose(rng, 150).split(" "), []
    for i in range(100):
        w = list(base)
        w[rng.randrange(len(w))] = f"e{i}"
        texts.append(" ".join(w))
    texts += [prose(rng, 150) for _ in range(30)]
    w = prose(rng, 80).split(" ")
    for i in range(60):  # each like the ones next to it only
        w[(7 * i) % 80] = f"v{i}"
        texts.append(" ".join(w))
    narrow = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).select("doc_id", "text").mapInArrow(
        ngram_join._narrow(3), "doc_id long, n_shingles long, set_id long, bits binary").persist()
    rows = narrow.toPandas()
    differ = ngram_join.different_bits(pa.array(rows.bits.tolist(), pa.binary()))
    x, y = np.triu_indices(len(rows), 1)
    size, ids = rows.n_shingles.to_numpy(), rows.set_id.to_numpy()
    close = differ(x, y) <= (size[x] + size[y]) * 2 // 18
    want = _connected_groups(zip(ids[x[close]].tolist(), ids[y[close]].tolist()))
    assert 150 < len(want) < 165 and 2 <= len(set(want.values())) < 40
    shared = spark.createDataFrame([(0, s) for s in ids.tolist()], "sig long, node long")
    for reach, block, visitors in ((4, 8, 2), (2, 4, 1000)):
        monkeypatch.setattr(ngram_join, "REACH", reach, raising=False)
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "VISITORS", visitors, raising=False)
        made, write = [], ngram_join.materialise
        with monkeypatch.context() as m:
            def count(df, name, *more):
                made.extend([df.count()] * (df.columns == ["a", "b"]))
                return write(df, name, *more)
            m.setattr(ngram_join, "materialise", count)
            got = ngram_join.candidates(shared, narrow, 8, 10).collect()
        assert _connected_groups((r.a, r.b) for r in got) == want
        assert len(got) < len(ids) and sum(made) < 3 * len(ids)
    narrow.unpersist()


def test_bits_never_exceed_the_differences():
    rng = np.random.default_rng(3)
    whole = rng.integers(0, 1 << 63, 5000, np.uint64)
    for size, change in ((1, 0), (1, 1), (30, 4), (400, 60), (2000, 300), (4000, 900)):
        x, y = np.sort(whole[:size]), np.sort(whole[change:size + change // 2])
        bits = ngram_join.parities(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]))
        got = ngram_join.different_bits(pa.array(bits, pa.binary()))(np.array([0, 0, 1]), np.array([1, 0, 0]))
        assert got[0] == got[2] <= len(np.setxor1d(x, y)) and got[1] == 0 and (change < 60 or got[0] > change // 2)


def test_repeats(docs, crafted, empty):
    out = suffix_dedup.without_repeats(docs, carry=["doc_id"]).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in out.collect()}
    assert got == dict(zip([r[0] for r in crafted], brute.repeats([r[1] for r in crafted])))
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert "text_key" in suffix_dedup.without_repeats(docs).select("row.*").columns


def test_repeats_move_pieces():
    """A text meets its runs once; what goes on to be cut are the bytes that the runs cover, and each run's bytes are in them."""
    texts, runs = [bytes(range(60)), bytes(range(60, 160))], [[(40, 44), (3, 5), (6, 9)], [(0, 0), (30, 90)]]
    cells = [[{"low": low, "high": high, "at": low, "single": True} for low, high in r] for r in runs]
    lists = pa.array(cells, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64()), ("single", pa.bool_())])))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(texts, pa.binary()), lists], ["text_key", "text", "runs"])
    (got,) = suffix_dedup._pieces(10)([batch])
    assert got.column(0).to_pylist() == [7, 8] and got.column(3).to_pylist() == cells
    spans = [[(p["start"], p["size"]) for p in x] for x in got.column(2).to_pylist()]
    assert spans == [[(3, 16), (40, 14)], [(0, 10), (30, 70)]]
    assert got.column(1).to_pylist() == [b"".join(t[a:a + n] for a, n in x) for t, x in zip(texts, spans)]
    (cut,) = suffix_dedup._cut_runs(10, 5)([got])
    key, low, high, at, area = (cut.column(c).to_numpy() for c in ("text_key", "low", "high", "at", "area_a"))
    for k, text, own in zip((7, 8), texts, runs):
        some = key == k
        assert {w for a, b in zip(low[some], high[some]) for w in range(a, b + 1)} == {w for a, b in own for w in range(a, b + 1)}
        shape = (at - low).astype(np.uint64) * suffix_dedup.GOLDEN + (high - low).astype(np.uint64)
        whole = suffix_dedup.Substrings(np.frombuffer(text, np.uint8)).hash(low[some], high[some] + 10)
        assert (suffix_dedup.mix(whole + shape[some]).view(np.int64) == area[some]).all()


def test_repeats_random_overlaps(spark):
    rng = random.Random(11)
    pieces = ["".join(rng.choice("ab ") for _ in range(rng.randrange(30, 260))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 8))), None, None) for i in range(60)]
    rows += [(60, "é" * 450, None, None), (61, "ab" * 150, None, None), (62, "ab" * 99 + "x", None, None)]
    out = suffix_dedup.without_repeats(frame(spark, rows).repartition(4)).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in out.collect()}
    assert got == dict(zip([r[0] for r in rows], brute.repeats([r[1] for r in rows])))


def _packed(pieces, ids, length):
    for d, want in ids.items():
        own = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == want and all(p.doc_tokens == len(want) for p in own)
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
    rows = {}
    for p in pieces:
        rows.setdefault(p.sequence_id, []).append(p)
    for s in rows.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == list(np.cumsum([0] + [p.length for p in s])[:-1])
    fill = [sum(p.length for p in rows[s]) for s in sorted(rows)]
    assert sorted(rows) == list(range(len(rows))) and fill[:-1] == [length] * (len(fill) - 1) and fill[-1] <= length


def test_packing(docs, crafted, empty):
    ids = {r[0]: i + [2] for r, (i, _) in zip(crafted, brute.bpe([r[1] for r in crafted], PATH))}
    pieces = packing.pack(docs, bpe.encode(F.col("text"), PATH), end_id=2, length=128).collect()
    _packed(pieces, ids, 128)
    assert packing.pack(empty, bpe.encode(F.col("text"), PATH), end_id=2).count() == 0


def test_packing_keeps_the_mixture(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), None, "big" if i % 3 else "small") for i in range(600)]
    df, ids = frame(spark, rows), F.transform(F.split("text", " "), lambda w: F.lit(7))
    window = packing.WINDOW_SEQUENCES * 8
    for targets in (None, {"big": 1, "small": 1}):
        pieces = packing.pack(df, ids, end_id=2, length=8, targets=targets).collect()
        _packed(pieces, {r[0]: [7] * (r[0] % 7 + 1) + [2] for r in rows}, 8)
        stream = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
        flat = np.array([p.source == "small" for p in stream for _ in range(p.length)])
        share = 0.5 if targets else flat.mean()
        for at in range(0, len(flat) // 2 // window * window, window):
            assert abs(flat[at: at + window].mean() - share) < 0.02


def test_packing_phases():
    made = packing.phases_of({"a": 100, "b": 30, None: 10, "d": 0}, {"a": 1, "b": 1}, 16)
    assert [sum(p[1] for p in made[s]) for s in ("a", "b", None)] == [100, 30, 10]
    assert made["a"][0][1] == made["b"][0][1] == 30 and "d" not in made


def test_languages(spark, root, crafted, empty):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = langid.held_out(F.col("doc_id"))
    profiles = langid.train(docs.where(~out))
    assert set(profiles) == {"de", "en", "es", "fr"}
    p = docs.where(out & F.col("lang").isNotNull()).select("lang", langid.predict(F.col("text"), profiles).alias("p"))
    rows = p.select("lang", "p.*", F.col("p.lang").alias("guess")).collect()
    assert np.mean([r["guess"] == r[0] for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r.p for r in frame(spark, crafted).select("doc_id", langid.predict(F.col("text"), profiles).alias("p")).collect()}
    assert all((odd[d].lang, odd[d].score) == ("und", 0.0) for d in (1, 2, 3, 7))
    assert langid.train(empty) == {}
    assert {r.p.lang for r in docs.select(langid.predict(F.col("text"), {}).alias("p")).collect()} == {"und"}


def test_ngrams_of_a_text_do_not_depend_on_pieces(monkeypatch):
    text = prose(random.Random(2), 400)
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "PIECE", 97)
    parts = langid.grams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    codes, counts = langid.grams("ab")
    assert counts.sum() == 2 + 3 + 2 and len(codes) == 7  # a b, _a ab b_, _ab ab_


def test_shards(spark, crafted, docs, empty):
    rows = sharding.shard(docs, 5).collect()
    assert len(rows) == len(crafted)
    sizes = [sum(r.shard == s for r in rows) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(5):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    text = {r[0]: (r[1] or "").encode() for r in crafted}
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, brute.crc(text[r.doc_id])) for r in rows)
    again = sharding.shard(frame(spark, crafted).repartition(7), 5).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    twice = sharding.shard(frame(spark, [*crafted[:4], *crafted[:4], (None, "x", None, None)]), 2).collect()
    assert len({(r.shard, r.slot) for r in twice}) == 9
    assert sharding.shard(empty, 5).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4096, 70_001])
def test_permutation(n):
    assert sorted(sharding.permute(np.arange(n), n, 3)) == list(range(n))


def test_whole_characters_are_cut(spark):
    """A repeat that begins inside a character; with `whole` the rest of it goes, and a text without repeats stays."""
    same = "b" * 250
    docs = frame(spark, [(1, "x\u00e9" + same, "en", "s"), (2, "y\u00a9" + same, "en", "s"), (3, "\u00e9", "en", "s"),
                         (4, None, "en", "s")])
    kept = lambda whole: {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_repeats(
        docs, carry=["doc_id"], whole=whole).select("row.doc_id", "kept").collect()}
    assert kept(False) == {1: b"x\xc3", 2: b"y\xc2", 3: "\u00e9".encode(), 4: b""}
    assert kept(True) == {1: b"x", 2: b"y", 3: "\u00e9".encode(), 4: b""}


def test_remembered_fragments_do_not_change_ids(monkeypatch):
    """Few fragments are remembered: some are forgotten between slices, some stay, ids are those of a fresh encoder."""
    path, words = PATH, ["the", "theatre", "unbelievable", "zxqj", "Kolmogorov", "\u00e9t\u00e9", "12", "..."]
    texts = [" ".join(words[i % 8] + words[(i * j) % 8] for j in range(1, 9)) for i in range(40)] + ["", None, "<|"]
    fresh = [bpe.Codec(path).encode_all(pa.array([t], pa.string()))[0].tolist() for t in texts[:4]]
    whole, counts = bpe.Codec(path).encode_all(pa.array(texts, pa.string()))
    monkeypatch.setattr(bpe, "KNOWN", 6)
    codec = bpe.Codec(path)
    again = [codec.encode_all(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert again[:4] == fresh and sum(again, []) == whole.tolist() and [len(x) for x in again] == counts.tolist()
    assert all(len(known[0]) <= 6 for known in codec.known)
