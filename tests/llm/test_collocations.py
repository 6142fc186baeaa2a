"""Phrase mining against a plain version, with small blocks, nulls, ties, repeats and clashing columns."""

import random

import pytest

from panelcast.llm import collocations as co
from tests.llm import brute
from tests.llm.conftest import frame


def _rows():
    rng = random.Random(9)
    words = ["New", "york", "CITY", "of", "the", "Straße", "état", "x1", "a-b", "zzz"]
    fixed = [["new", "york", "city", "hall", "tower"], ["of", "the"], ["a", "b", "a", "b"]]
    rows = []
    for i in range(400):
        text = []
        for _ in range(rng.randrange(1, 12)):
            text += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(words)]
            if rng.random() < 0.3:
                text.append(rng.choice([".", ",;", "\n", "\x0b!", "?:"]))
        rows.append((i, rng.choice([" ", "\t", "  "]).join(text), rng.choice(["en", "de", None, "und"]), "a"))
    rows += [(5, rows[5][1], rows[5][2], "a")] * 3 + [(None, "new york city", "en", None), (900, None, "en", "a"),
                                                      (901, "", None, "a"), (902, " .,; \n", "fr", "a"), (903, "solo", "it", "a")]
    rows.append((904, "of the " * 3000 + "new york. " * 200, "en", "a"))
    return rows


@pytest.mark.parametrize(("block", "parts"), [(300, 4), (co.BLOCK_WORDS, 1)])
def test_collocations(spark, block, parts):
    rows = _rows()
    got = co.collocations(frame(spark, rows).repartition(parts), least=12, block_words=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute.collocations([(r[1], r[2]) for r in rows], least=12)
    assert len(want) > 15 and sorted(map(tuple, got.collect())) == sorted(want)


def test_only_the_first_of_each_language(spark):
    rows = _rows()
    got = co.collocations(frame(spark, rows), least=12, top=3)
    assert sorted(map(tuple, got.collect())) == sorted(brute.collocations([(r[1], r[2]) for r in rows], least=12, top=3))


def test_frequent_phrases_and_totals(spark):
    rows = [(i, "b a b a b. a", "en", "a") for i in range(4)]
    every, totals = co.frequent_phrases(frame(spark, rows), least=8, longest=3)
    assert {r.phrase: r.f for r in every.collect()} == {"a": 12, "b": 12, "b a": 8, "a b": 8, "b a b": 8}
    assert [tuple(r) for r in totals.collect()] == [("en", 24)]


def test_empty(spark):
    assert co.collocations(frame(spark, [])).count() == 0
    assert co.collocations(frame(spark, [(1, None, None, None)])).count() == 0
