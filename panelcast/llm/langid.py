"""Language identification by rank-order profiles of character n-grams.

A language's profile is the ranked list of its most frequent n-grams (1 to 3 letters, words marked at both ends),
counted over all labelled training texts. A text is ranked the same way, over its whole length, and compared to each
profile by the out-of-place distance: for each of its n-grams the difference of the two ranks, or the profile length if
the language lacks it. The nearest language wins, ties by name.

Null texts and texts without a letter are `und` with score 0. The score is how far the text is from the greatest possible
distance (0: none of its n-grams is known to the language, 1: same ranks). Rows without a label do not train. With
no training rows every text is `und`. Letters are Unicode letters; case is folded. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.hashing import CHUNK
from panelcast.llm.shared import small_batches

#: Ranks of a language profile and n-grams of a text that are compared.
RANKS = 400
#: Characters counted at once.
PIECE = CHUNK
#: Entries (n-gram, count) of texts that a task adds up at once.
HELD = 1 << 18
UNKNOWN = "und"
SPACE = 1  # marks the ends of words


def letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or the word mark for everything that is not a letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(letter_table())
    return _letters[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes (three 21-bit fields), ascending, and counts of the n-grams of a text; empty if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    table = letters()
    parts = []
    for at in range(0, len(codes), PIECE):
        c = table[codes[max(0, at - 2): at + PIECE]]  # two letters of overlap
        if at == 0:
            c = np.concatenate(([np.uint32(SPACE)], c))
        if at + PIECE >= len(codes):
            c = np.concatenate((c, [np.uint32(SPACE)]))
        if len(c) > 2:
            parts.append(_count(c.astype(np.uint32), at == 0))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _count(c: np.ndarray, begins: bool) -> tuple[np.ndarray, np.ndarray]:
    # Alphabets with small numbers fit into half the width while they are counted.
    kind, bits = (np.uint32, 10) if c.max() < 1 << 10 else (np.uint64, 21)
    c = c.astype(kind, copy=False)
    one, two = kind(bits), kind(2 * bits)
    last, mid, first = c[2:], c[1:-1], c[:-2]
    letter = c != SPACE
    ends, inner = letter[2:], letter[1:-1]
    pair = (mid << one) | last
    found = [last[ends], pair[ends | inner], ((first << two) | pair)[inner & (ends | letter[:-2])]]
    if begins and inner[0]:  # the first letter closes no triple
        found += [mid[:1], (first[:1] << one) | mid[:1]]
    codes, counts = np.unique(np.concatenate(found), return_counts=True)
    if bits < 21:
        wide, low = codes.astype(np.uint64), np.uint64((1 << bits) - 1)
        codes = (((wide >> np.uint64(2 * bits)) << np.uint64(42)) | (((wide >> np.uint64(bits)) & low) << np.uint64(21))
                 | (wide & low))
    return codes, counts


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code (`codes` ascend)."""
    return codes[np.argsort(-counts, kind="stable")[:top]]


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([f[1] for f in found]), minlength=len(codes)).astype(np.int64)


def tallies(texts: Iterable[tuple[str, str]], held: int = HELD) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, n-gram codes, counts) of (language, text) pairs; a language may come more than once.

    About `held` entries, and those of one text, are in memory at a time.
    """
    found: dict[str, list] = {}
    size = 0
    for lang, text in texts:
        found.setdefault(lang, []).append(grams(text))
        size += len(found[lang][-1][0])
        if size > held:
            found = {lang: [_merged(parts)] for lang, parts in found.items()}
            size = sum(len(parts[0][0]) for parts in found.values())
            if size > held // 2:  # little in common
                yield from ((lang, *parts[0]) for lang, parts in found.items())
                found, size = {}, 0
    yield from ((lang, *_merged(parts)) for lang, parts in found.items())


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> dict[str, list[int]]:
    """Profiles: language -> ranked n-gram codes, counted over all rows with a label and a text."""

    def count(batches):
        for lang, codes, n in tallies((lang.as_py(), text.as_py()) for b in batches for lang, text in zip(b.column(0), b.column(1))):
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(codes)), pa.array(codes.astype(np.int64)),
                                              pa.array(n)], ["lang", "gram", "n"])

    totals = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col, text_col)
              .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # Top ranks of each language without ordering a language in one task: Spark's partial top-k per (lang, bucket).
    bucket = F.pmod(F.xxhash64("gram"), F.lit(64)).alias("bucket")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "gram"))), 1, ranks)
    top = totals.groupBy("lang", bucket).agg(best.alias("g")).select("lang", F.explode("g").alias("g"))
    with small_batches(docs.sparkSession):
        profiles = top.groupBy("lang").agg(F.transform(best_of("g", ranks), lambda s: s["gram"]).alias("grams")).collect()
    return {r.lang: list(r.grams) for r in sorted(profiles, key=lambda r: r.lang)}


def best_of(col: str, ranks: int) -> Column:
    return F.slice(F.sort_array(F.collect_list(col)), 1, ranks)


def predict(text: Column, profiles: dict[str, list[int]], ranks: int = RANKS) -> Column:
    """struct(lang string, score double) of each text."""
    langs = sorted(profiles)
    known = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
    # rank of each known n-gram in each language; the profile length where it has none
    table = np.full((len(langs), len(known) + 1), ranks, np.int32)
    for i, lang in enumerate(langs):
        table[i, np.searchsorted(known, np.array(profiles[lang], np.uint64))] = np.arange(len(profiles[lang]))

    @F.arrow_udf("struct<lang string, score double>")
    def nearest(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for t in texts:  # one at a time
            codes, counts = grams(t.as_py() or "")
            if not len(codes) or not len(langs):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            mine = ranked(codes, counts, ranks)
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            at = np.where(known[at] == mine, at, len(known))
            there = table[:, at]
            away = np.where(there < ranks, np.abs(there - np.arange(len(mine))), ranks).sum(axis=1)
            i = int(away.argmin())
            names.append(langs[i])
            scores.append(float(1 - away[i] / (ranks * len(mine))))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          ["lang", "score"])

    return nearest(text)


def held_out(doc_id: Column, fold: int = 5) -> Column:
    """True for the ids that do not train: checksum of the id's decimal text divisible by `fold`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % fold == 0, F.lit(False))
