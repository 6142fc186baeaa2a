"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q and at least max(6, 4 q) words that no neighbouring word
extends. With B the power of two in q/2 < B <= q, a run holds a whole aligned block of B words whose copy lies q words
further on, inside the run. So at every dyadic scale B each aligned block is compared with all B places at the distances
B to 2 B - 1: the sum of squared differences of word numbers is

    sum u^2 + sum w^2 - 2 (u correlated with w),

where the correlation is a product of number-theoretic transforms modulo a prime. The sum is 0 wherever the block occurs;
no occurrence is missed, and a sum that is 0 by accident only seeds an extension that comes out too short. Every distance
found seeds an extension to both sides by prefix hashes (bisection), and a run is compared word by word before it counts.

Two things keep the work down without changing the result. A block with a word that does not recur within 2 B words occurs
nowhere at this scale, so only the other blocks are transformed (in prose nearly none). A block and copy that lie in a run
of a smaller period, found at a smaller scale, seed nothing new.

Texts are put end to end with a number of its own after each, so many short texts share each transform, and no run
crosses texts. The work on one text is near-linear in its length, in one row; there is no shuffle. Null and empty texts
have no words and no runs; a text without runs is returned as its words joined by one space. Repeated rows are each worked
on alone, other columns pass through, and an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from panelcast.llm.hashing import POWERS, chunks, mix, text_bytes
from panelcast.llm.wordarrays import byte_class, word_spans, word_strings

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Prime of the transforms, 119 * 2^23 + 1, and a generator of its multiplicative group.
PRIME, GENERATOR = 998244353, 3
#: Numbers transformed at once.
CELLS = 1 << 20
WORD = byte_class(b" \t\n\x0b\x0c\r")

RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))
RESULT = (StructField("n_words", LongType()), StructField("runs", RUNS), StructField("collapsed", StringType()))
FIELDS = tuple(f.name for f in RESULT)


@cache
def _plan(size: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Bit-reversed order, and the roots of every pass of a transform and of its inverse."""
    order = np.zeros(1, np.int64)
    while len(order) < size:
        order = np.concatenate((2 * order, 2 * order + 1))
    roots = []
    for base in (GENERATOR, pow(GENERATOR, -1, PRIME)):
        passes, half = [], 1
        while half < size:
            w, power = pow(base, (PRIME - 1) // (2 * half), PRIME), np.ones(1, np.int64)
            while len(power) < half:
                power = np.concatenate((power, power * pow(w, len(power), PRIME) % PRIME))
            passes.append(power)
            half *= 2
        roots.append(passes)
    return order, roots[0], roots[1]


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row; the width is a power of two."""
    m, size = rows.shape
    order, forward, backward = _plan(size)
    a = rows[:, order] % PRIME
    for power in backward if inverse else forward:
        half = len(power)
        a = a.reshape(m, size // (2 * half), 2, half)
        low, high = a[:, :, 0], a[:, :, 1] * power % PRIME
        a = np.stack(((low + high) % PRIME, (low - high) % PRIME), axis=2)
    a = a.reshape(m, size)
    return a * pow(size, -1, PRIME) % PRIME if inverse else a


def block_matches(x: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) wherever the block of `size` words at `start` occurs at a distance of `size` to 2 `size` - 1.

    `x` has at least 3 `size` numbers from every start on. A sum of squares that is a multiple of the prime also shows.
    """
    found = []
    step = max(1, CELLS // (2 * size))
    for at in range(0, len(starts), step):
        s = starts[at: at + step]
        block = x[s[:, None] + np.arange(size)] % PRIME
        window = x[s[:, None] + size + np.arange(2 * size)] % PRIME
        turned = np.zeros_like(window)
        turned[:, :size] = block[:, ::-1]
        both = transform(transform(turned) * transform(window) % PRIME, inverse=True)[:, size - 1: 2 * size - 1]
        squares = np.zeros((len(s), 2 * size + 1), np.int64)
        np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
        squares = squares[:, size: 2 * size] - squares[:, :size] + (block * block % PRIME).sum(axis=1)[:, None]
        row, distance = np.nonzero((squares - 2 * both) % PRIME == 0)
        found.append((s[row], distance + size))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Extensions:
    """How far two places of `x` agree to the right and to the left, by hashes of `x`'s stretches."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        up, self.down = POWERS[0].get(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(x.astype(np.uint64)) * up[:n], out=self.prefix[1:])

    def _hash(self, start, end):
        return (self.prefix[end] - self.prefix[start]) * self.down[start]

    def _longest(self, most, same):
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            yes = same(mid)
            low, high = np.where(yes, mid, low), np.where(yes, high, mid - 1)
        return low

    def right(self, a, b):
        return self._longest(len(self.x) - b, lambda k: self._hash(a, a + k) == self._hash(b, b + k))

    def left(self, a, b):
        return self._longest(a.copy(), lambda k: self._hash(a - k, a) == self._hash(b - k, b))

    def run(self, start: int, end: int, period: int, seed: int) -> tuple[int, int]:
        """The stretch itself if its words are `period` apart identical; else (two hashes met) found word by word."""
        x = self.x
        if np.array_equal(x[start: end - period], x[start + period: end]):
            return start, end
        equal = x[: len(x) - period] == x[period:]
        wrong = np.flatnonzero(~equal)
        after = np.searchsorted(wrong, seed)
        end = (wrong[after] if after < len(wrong) else len(equal)) + period
        return (wrong[after - 1] + 1 if after else 0), int(end)


def find_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs of `x`, in which no run has more than `longest` numbers; by start, period."""
    n = len(x)
    if n == 0:
        return np.zeros((0, 3), np.int64)
    order = np.argsort(x, kind="stable")
    gap = np.full(n, n, np.int64)  # to the next equal number
    same = x[order[1:]] == x[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    reach = np.zeros(n, np.int64)  # the furthest end of a run of a smaller scale over each place
    extend, runs, size = None, [], 1
    while LEAST_PERIODS * size <= longest:
        blocks = n // size
        starts = np.flatnonzero(gap[: blocks * size].reshape(blocks, size).max(axis=1) < 2 * size) * size
        if len(starts):
            padded = np.concatenate((x, np.full(3 * size, x.max() + 1)))
            a, d = block_matches(padded, starts, size)
            fresh = (reach[a] < a + d + size) & (a + d + size <= n)
            a, d = a[fresh], d[fresh]
            if len(a):
                extend = extend or Extensions(x)
                end = a + d + extend.right(a, a + d)
                start = a - extend.left(a, a + d)
                long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
                seeds = {(s, e, p): i for s, e, p, i in zip(*(v[long].tolist() for v in (start, end, d, a)))}
                new = {(*extend.run(s, e, p, i), p) for (s, e, p), i in seeds.items()}
                new = [(s, e, p) for s, e, p in new if e - s >= max(LEAST_WORDS, LEAST_PERIODS * p) and reach[s] < e]
                for s, e, _ in new:
                    reach[s:e] = np.maximum(reach[s:e], e)
                runs += new
        size *= 2
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _chunk(data: np.ndarray, offsets: np.ndarray) -> pa.StructArray:
    """FIELDS of the texts in `data`, whose `offsets` start at 0."""
    start, end, first = word_spans(data, offsets, WORD)
    words = word_strings(data, start, end, WORD)
    n_words, n_texts = np.diff(first), len(first) - 1
    text = np.repeat(np.arange(n_texts), n_words)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.zeros(len(codes) + n_texts, np.int64)
    at = np.arange(len(codes)) + text  # one number more after each text
    x[at] = codes + n_texts
    x[first[1:] + np.arange(n_texts)] = np.arange(n_texts)
    runs = find_runs(x, int(n_words.max(initial=0)))
    keep = np.ones(len(x), bool)
    for s, e, p in runs.tolist():
        keep[s + p: e] = False
    begin = first[:-1] + np.arange(n_texts)  # of each text in x
    owner = np.searchsorted(begin, runs[:, 0], side="right") - 1
    items = pa.StructArray.from_arrays(
        [pa.array(v) for v in (runs[:, 0] - begin[owner], runs[:, 1] - runs[:, 0], runs[:, 2])],
        ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n_texts + 1)).astype(np.int32)), items)
    kept = np.flatnonzero(keep[at])
    ends = np.searchsorted(text[kept], np.arange(n_texts + 1)).astype(np.int32)
    left = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(kept))), " ")
    return pa.StructArray.from_arrays([pa.array(n_words.astype(np.int64)), lists, left], list(FIELDS))


def _batches(batches):
    for b in batches:
        data, offsets = text_bytes(b.column(1))
        for i, j in chunks(offsets):
            found = _chunk(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *found.flatten()], ["row", *FIELDS])


def periodic_runs(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs`, its columns (or those in `carry`) in the struct `row`, with n_words, runs (by start, then
    period; in words from 0) and collapsed, the words without repetitions.

    A word goes if a run holds it after the run's first period. Words are runs of characters other than white space.
    """
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_batches, StructType([rows.schema["row"], *RESULT]))
