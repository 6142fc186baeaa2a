"""Secret scan by two character Markov models, in DataFrame operations only.

Fixed patterns give the base spans (`BASE`). Beside them every long string of letters, digits and `+/_-` is a candidate.
Two first-order Markov models over characters, one of random strings and one of ordinary identifiers, are counted from
labelled samples; a candidate is reported as `random` if the sum of the log-likelihood ratios of its transitions
exceeds the log of the prior odds against a secret (`PRIOR_NATS`).

Labels come from the corpus itself (`labelled_samples`): what the base patterns found is random, words of the same alphabet
outside of these matches are ordinary. They are taken from at most about `SAMPLE_ROWS` rows, chosen by a hash of the text,
which bounds the training; scanning covers every row and whole texts. Ratios are rounded to thousandths of a nat, so that
sums are whole numbers and do not depend on their order. The model is one array of fixed length, 67 x 67 numbers, whatever
the corpus; it travels as a literal, so that the scan is one pass without a shuffle.

Positions count code points, ends are excluded. Null texts count as empty and have no spans. Rows that repeat and null ids
are scanned each on its own; other columns pass through the caller's select. Very long texts and candidates cost time in
proportion to their length. Without samples of one kind, both models are uniform and nothing is added to the base spans.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, least characters, and the group these are counted in (0: the whole match). The last two
#: ask for their length in the pattern: a shorter match leaves no later one inside it that is long enough.
BASE = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
)
KINDS = (*(b[0] for b in BASE), "random")

#: Characters of candidates; every other character of a sample counts as one more, the last.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
OTHER = len(ALPHABET) + 1
#: A candidate has so many characters; the look-behind only saves attempts inside of words.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Samples of both classes: the values in base matches, and words outside of them, of so many characters.
SAMPLE = r"[A-Za-z0-9+/_-]{6,}"
#: Rows that samples are taken from, about. Shares are kept in 2^20ths.
SAMPLE_ROWS, SHARES = 20_000, 1 << 20
#: Log of the odds that a candidate is no secret, in nats.
PRIOR_NATS = 7.0

#: Matches placed in one go.
BLOCK = 1000

SPAN = "struct<start:bigint,end:bigint,kind:int,text:string>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of the leftmost matches that do not overlap; the text is not null.

    Matches and what lies between them alternate, so positions are running sums of lengths.
    """
    def step(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        hit = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["hits"], F.array(hit)).alias("hits"))

    none_type = "array<struct<start:bigint,end:bigint,text:string>>"
    none = F.array().cast(none_type)

    def block(acc, pairs, number):
        begun = F.struct(acc["at"].alias("at"), none.alias("hits"))
        done = F.array(F.aggregate(F.slice(pairs, number * BLOCK + 1, F.lit(BLOCK)), begun, step))
        return F.element_at(F.transform(done, lambda d: F.struct(
            d["at"].alias("at"), F.concat(acc["parts"], F.array(d["hits"])).alias("parts"))), 1)

    def placed(hits):
        pairs = F.arrays_zip(hits.alias("hit"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("gap"))
        begun = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{none_type}>").alias("parts"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int"))
        parts = F.transform(F.array(pairs), lambda p: F.aggregate(blocks, begun, lambda acc, b: block(acc, p, b))["parts"])
        return F.flatten(F.element_at(parts, 1))

    # The matches are bound once; texts without any are not split. An array that grows is copied at every step, so it
    # grows in blocks.
    bound = F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
                        lambda hits: F.when(F.size(hits) > 0, placed(hits)).otherwise(none))
    return F.element_at(bound, 1)


def base_spans(text: Column) -> Column:
    """array<SPAN> by start, then kind: the matches of BASE that are long enough."""
    def of(number, pattern, least, group):
        def long(s):
            return F.length(F.regexp_extract(s["text"], pattern, group) if group else s["text"]) >= least

        found = F.filter(matches(text, pattern), long)
        return F.transform(found, lambda s: F.struct(s["start"], s["end"], F.lit(number).alias("kind"), s["text"]))

    parts = [of(number, *fixed) for number, (_, *fixed) in enumerate(BASE)]
    return _sorted(F.concat(*parts))


def _sorted(spans: Column) -> Column:
    by = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                               s["text"].alias("text")))
    return F.transform(F.array_sort(by), lambda s: F.struct(s["start"], s["end"], s["kind"], s["text"])).cast(
        f"array<{SPAN}>")


def _apart(items: Column, spans: Column) -> Column:
    """Those items that touch none of `spans`."""
    return F.filter(items, lambda c: ~F.exists(spans, lambda s: (c["start"] < s["end"]) & (s["start"] < c["end"])))


def labelled_samples(docs: DataFrame, *, text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(sample, random): values of base matches, and words of the same alphabet outside of base matches.

    Taken from all rows if there are at most `rows`, else from a share of about so many, chosen by a hash of the text.
    """
    share = SHARES if (n := docs.count()) <= rows else rows * SHARES // n
    text = F.coalesce(F.col(text_col), F.lit(""))
    picked = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SHARES)) < share)
    spans = picked.select("text", base_spans(F.col("text")).alias("spans"))
    value = F.transform("spans", lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["text"], BASE[0][1], 2))
                        .otherwise(s["text"]))
    # Words outside: each stretch between base matches is searched by itself.
    rest = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    outside = F.aggregate(
        rest, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["parts"], F.array(F.substring(F.col("text"), (acc["at"] + 1).cast("int"),
                                                       F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")))).alias("parts")),
        lambda acc: F.concat(acc["parts"], F.array(F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text")))))
    words = F.flatten(F.transform(outside, lambda part: F.regexp_extract_all(part, F.lit(SAMPLE), F.lit(0))))
    both = F.concat(F.transform(value, lambda v: F.struct(v.alias("sample"), F.lit(True).alias("random"))),
                    F.transform(words, lambda w: F.struct(w.alias("sample"), F.lit(False).alias("random"))))
    return spans.select(F.explode(both).alias("s")).select("s.sample", "s.random")


def codes(text: Column) -> Column:
    """Numbers of a text's characters, from 1."""
    return F.transform(F.split(text, ""), lambda c: F.when(F.instr(F.lit(ALPHABET), c) == 0, OTHER)
                       .otherwise(F.instr(F.lit(ALPHABET), c)))


def transitions(text: Column) -> Column:
    """One number, from 0, per neighbouring pair of a text's characters; these are split and numbered once."""
    pairs = F.transform(F.array(codes(text)), lambda chars: F.transform(
        F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0))),
        lambda c, i: (F.get(chars, i) - 1) * OTHER + c - 1))
    return F.element_at(pairs, 1)


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios (random : ordinary) of all transitions, in thousandths of a nat, by (first, second)."""

    ratios: tuple[int, ...]

    def score(self, text: Column) -> Column:
        """The sum over a text's transitions, long."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")  # folded to one literal
        return F.aggregate(transitions(text), F.lit(0).cast("bigint"), lambda acc, t: acc + F.get(table, t))


def train(samples: DataFrame) -> Model:
    """The model of (sample, random) rows: add-one smoothed transition counts of each class.

    Equal samples are counted together before their characters are; what reaches the driver is one number for each of
    67 x 67 transitions and class at most.
    """
    kinds = samples.where("sample IS NOT NULL AND random IS NOT NULL").groupBy("sample", "random").agg(F.count("*").alias("n"))
    pairs = (kinds.select("random", "n", F.explode(transitions(F.col("sample"))).alias("t"))
             .groupBy("random", "t").agg(F.sum("n").alias("n")).collect())
    counts = {kind: {p.t: p.n for p in pairs if p.random is kind} for kind in (True, False)}
    if not (counts[True] and counts[False]):
        return Model((0,) * OTHER**2)
    def logs(found):
        out = []
        for first in range(OTHER):
            row = [found.get(first * OTHER + second, 0) + 1 for second in range(OTHER)]
            out += [math.log(n / sum(row)) for n in row]
        return out

    return Model(tuple(round(1000 * (r - o)) for r, o in zip(logs(counts[True]), logs(counts[False]))))


def scan(text: Column, model: Model, prior: float = PRIOR_NATS) -> Column:
    """struct<base: array<SPAN>, random: array<SPAN>> of a text; random spans touch no base span."""
    least = round(1000 * prior)

    def found(t):
        return F.element_at(F.transform(F.array(base_spans(t)), lambda base: F.struct(
            base.alias("base"),
            F.transform(F.filter(_apart(matches(t, CANDIDATE), base), lambda c: model.score(c["text"]) > least),
                        lambda c: F.struct(c["start"], c["end"], F.lit(len(BASE)).alias("kind"), c["text"]))
            .cast(f"array<{SPAN}>").alias("random"))), 1)

    return F.element_at(F.transform(F.array(F.coalesce(text, F.lit(""))), found), 1)


def all_spans(found: Column) -> Column:
    """Base and random spans of `scan` together, by start, then kind."""
    return _sorted(F.concat(found["base"], found["random"]))


def shown(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
