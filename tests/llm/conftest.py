import random

import pytest

CLASH = dict(h=1, piece="x", node=2, sig=3, row="r", text_key=4, kept=False, ids=5, n=6, content="c", sample="s",
             spans="z", rep=7, cell=8, _block=9, row_number=10, place=11)
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, h int, piece string, node int, "
          "sig int, row string, text_key int, kept boolean, ids int, n int, content string, sample string, spans string, "
          "rep int, cell int, _block int, row_number int, place int")


def frame(spark, rows):
    """Documents (doc_id, text, lang, source) with columns whose names clash with those used inside the operators."""
    full = [(d, t, lang, src, None if t is None else len(t), *CLASH.values()) for d, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, words=None):
    words = words or ["alpha", "beta", "gamma", "delta", "of", "the", "Über", "naïve", "x1", "end."]
    return " ".join(rng.choice(words) + (str(rng.randrange(400)) if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture(scope="session")
def crafted():
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties, copies, near copies, shared passages."""
    rng = random.Random(4)
    passage = prose(rng, 60)
    base = prose(rng, 300)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "one", "en", "a"),
            (5, "One two", "en", "b"), (6, "one TWO", "en", "b"), (7, "!!! 123 ...", None, "b"),
            (8, "aaaa" * 300, "de", "c"), (9, base, "en", "c"), (10, base, "en", "c"), (11, base, "fr", None)]
    for i in range(12, 24):  # near copies
        w = base.split(" ")
        for _ in range(i - 11):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "a"))
    for i in range(24, 34):  # a passage that repeats
        rows.append((i, prose(rng, rng.randrange(5, 80)) + " " + passage + " " + prose(rng, 10), "en", f"s{i % 3}"))
    for i in range(34, 50):
        rows.append((i, prose(rng, rng.randrange(1, 400)), "en", "a"))
    rows.append((50, prose(rng, 60_000), "en", "long"))
    rows.append((51, "Licensed under the Apache License, Version 2.0. cc BY cc by, MIT license gnu GENERAL public license", "en", "a"))
    rows.append((52, "<|endoftext|>it's <|startoftext|> I'LL ½ ²3 日本語 İstanbul Σίσυφος é  x\u0085y \U0001f600", None, "a"))
    return rows
