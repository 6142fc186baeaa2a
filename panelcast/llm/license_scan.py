"""Licence scan by diagonal voting, in DataFrame operations only.

A text's words are numbered and all rolling word pairs are joined, by hash, to the positions of the same pairs in the
templates (compared in full after the hash). Each hit votes for a diagonal: its place in the text minus its place in the
template. Votes are summed per diagonal, diagonals of one template that lie close together are merged (words inserted or
left out shift the rest of a notice). A merged bundle is then verified: of its hits the longest chain counts in which both
the places in the text and those in the template increase and which is hardly longer than the template (`STRETCH`, `SLACK`).
So words in another order, or scattered over a text, make no notice. The chain is the span, and counts if it covers enough
of the template's pairs; a bundle gives one span. A diagonal that holds all pairs of a short phrase is one place of the
phrase, word for word.

One pass over the texts: a text without any hit keeps one row by a marker that every text carries. Templates are a fixed
list, so the joined side stays small whatever the corpus. Null texts count as empty: no words, no labels, score 0.
Rows that repeat are scanned each on its own, null ids too; other columns are ignored. Very long texts cost time and
memory in proportion to their words (to their hits, when a bundle is verified). An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose every place is counted, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Longer notices, found with words inserted, changed or left out, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided": "bsd",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution": "cc-by",
}

#: Diagonals of one notice at most this far apart are merged.
SLACK = 4
#: A span has at most so many times the words of its notice, and `SLACK` more.
STRETCH = 1.5
#: Part of a notice's pairs that a span must cover.
COVER = 0.6
MARK = "\n"


def _templates(spark, phrases: Mapping[str, str], notices: Mapping[str, str]) -> DataFrame:
    rows = [(-1, MARK, MARK, -1, 1, True, "")]
    for i, (text, label, whole) in enumerate([*((t, x, True) for t, x in phrases.items()),
                                              *((t, x, False) for t, x in notices.items())]):
        words = re.findall(WORD, text)
        rows += [(i, a, b, at, len(words) - 1, whole, label) for at, (a, b) in enumerate(zip(words, words[1:]))]
    made = spark.createDataFrame(rows, "template int, w1 string, w2 string, at int, pairs int, whole boolean, label string")
    return made.withColumn("h", F.xxhash64("w1", "w2"))


def longest_chain(hits: Column, pairs: Column) -> Column:
    """struct<size, start, end> of the longest chain of (place, at) in which both increase, within the bounded length.

    Per place of the template the state holds the best chain that ends there: its size and its first place (the latest, of
    equal sizes). Hits come by place; those of one place from the last of the template to the first, so that none
    follows another of the same place.
    """
    limit = F.ceil((pairs + 1) * STRETCH + SLACK)
    ordered = F.transform(F.array_sort(F.transform(hits, lambda h: F.struct(h["place"].alias("place"), (-h["at"]).alias("back")))),
                          lambda h: F.struct(h["place"].alias("place"), (-h["back"]).alias("at")))
    empty = F.struct(F.lit(0).alias("size"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def extended(best, hit):
        near = F.filter(F.slice(best, F.lit(1), hit["at"]),
                        lambda b: (b["size"] > 0) & (hit["place"] + 2 - b["first"] <= limit))
        before = F.coalesce(F.array_max(near), empty)
        one = F.struct((before["size"] + 1).alias("size"),
                       F.when(before["size"] > 0, before["first"]).otherwise(hit["place"]).alias("first"), hit["place"].alias("last"))
        return F.transform(best, lambda b, i: F.when((i == hit["at"]), F.greatest(b, one)).otherwise(b))

    # The best chain so far is kept beside the state, for a later hit may put a shorter, younger one in its place.
    state = F.struct(F.array_repeat(empty, pairs).alias("best"), empty.alias("top"))

    def step(acc, hit):
        return F.element_at(F.transform(F.array(extended(acc["best"], hit)), lambda best: F.struct(
            best.alias("best"), F.greatest(acc["top"], F.array_max(best)).alias("top"))), 1)

    top = F.aggregate(ordered, state, step, lambda acc: acc["top"])
    return F.element_at(F.transform(F.array(top), lambda t: F.struct(
        t["size"].alias("size"), t["first"].alias("start"), (t["last"] + 2).alias("end"))), 1)


def scan(docs: DataFrame, *, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per row, and per span.

    Rows: (row, doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score). Spans: (row, doc_id,
    label, whole, start, end, cover), in words from 0, end excluded.
    """
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    words = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        F.regexp_extract_all(lowered, F.lit(WORD), 0).alias("words"))
    # (w0, w1), (w1, w2), ...; the marker in front becomes pair 0.
    chained = words.select("row", "doc_id", F.size("words").alias("n_words"),
                           F.arrays_zip(F.concat(F.array(F.lit(MARK)), "words").alias("a"),
                                        F.concat(F.array(F.lit(MARK)), F.slice("words", 2, 2_000_000_000)).alias("b"))
                           .alias("pairs"))
    pairs = (chained.select("row", "doc_id", "n_words", F.posexplode("pairs").alias("place", "p"))
             .select("row", "doc_id", "n_words", (F.col("place") - 1).alias("place"), "p.a", "p.b")
             .withColumn("h", F.xxhash64("a", "b")))
    pairs = _with_hits(pairs, docs.sparkSession, phrases, notices)
    diagonals = (pairs.groupBy("row", "doc_id", "n_words", "template", "pairs", "whole", "label",
                               (F.col("place") - F.col("at")).alias("diagonal"))
                 .agg(F.count("*").alias("votes"), F.collect_list("place").alias("places"),
                      F.min("place").alias("low"), F.max("place").alias("high")))
    hits = F.transform("places", lambda p: F.struct(p.alias("place"), (p - F.col("diagonal")).alias("at")))
    # Neighbouring diagonals of a notice; a phrase's stay apart, and only full ones count.
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.col("whole") | (F.col("diagonal") - F.lag("diagonal").over(line) > SLACK)
    merged = (diagonals.where("template < 0 OR NOT whole OR votes = pairs")
              .withColumn("bundle", F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(line))
              .groupBy("row", "doc_id", "n_words", "template", "pairs", "whole", "label", "bundle")
              .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list(hits).alias("hits"))
              .withColumn("chain", F.when(~F.col("whole") & (F.col("template") >= 0),
                                          longest_chain(F.flatten("hits"), F.col("pairs"))))
              .withColumn("start", F.coalesce("chain.start", "low"))
              .withColumn("end", F.coalesce("chain.end", F.col("high") + 2))
              .withColumn("cover", F.coalesce(F.col("chain.size") / F.col("pairs"), F.lit(1.0)))
              .where((F.col("template") < 0) | (F.col("cover") >= F.when(F.col("whole"), 1.0).otherwise(COVER))))
    real = F.col("template") >= 0
    base = real & F.col("whole")
    names = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    rows = (merged.groupBy("row", "doc_id", "n_words")
            .agg(F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
                 F.max(F.when(base, F.col("start"))).alias("last_word"), names(base).alias("base_labels"),
                 names(real).alias("labels"), F.coalesce(F.max(F.when(real, F.col("cover"))), F.lit(0.0)).alias("score"))
            .withColumns({c: F.col(c).cast("long") for c in ("n_words", "first_word", "last_word")}))
    spans = merged.where(real).select("row", "doc_id", "label", "whole", "start", "end", "cover")
    return rows, spans


def _with_hits(pairs: DataFrame, spark, phrases, notices) -> DataFrame:
    """Pairs that stand in a template; the broadcast side has a row per template word, a fixed number."""
    t = _templates(spark, phrases, notices)
    joined = pairs.join(F.broadcast(t), (pairs.h == t.h) & (pairs.a == t.w1) & (pairs.b == t.w2) &
                        ((t.template >= 0) | (pairs.place == -1)))
    return joined.select("row", "doc_id", "n_words", "place", "template", "at", "pairs", "whole", "label")
