"""Vectorised hashing of bytes and words inside tasks: Arrow strings in, numpy arrays out.

Hashes are 64-bit polynomials over a table of random byte values, taken from prefix sums (so every substring costs one
subtraction and one product), then mixed. Nothing here depends on batch or partition borders.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once; a longer text is taken alone.
CHUNK = 1 << 18
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN + np.uint64(seed * 1_000_003 + 17))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            for name, b in (("up", self.base), ("down", self.inverse)):
                values = np.full(size, b, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up, self.down


POWERS = {0: Powers(0x5851F42D4C957F2D), 1: Powers(0xDA942042E4DD58B5)}


class Substrings:
    """Hashes of substrings of one run of bytes."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down = POWERS[seed].get(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values(seed)[data] * up[: len(data)], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of each text; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)
    if texts.null_count:
        texts = pc.fill_null(texts, "" if plain else b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()  # the bytes are not copied
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset: texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes together, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


@cache
def class_table(kind: str) -> np.ndarray:
    """Bytes that belong to words. `plain`: all but white space; `letters`: ASCII lower letters, digits, non-ASCII."""
    b = np.arange(256)
    if kind == "plain":
        return ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))
    return ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)


def words(data: np.ndarray, offsets: np.ndarray, kind: str = "plain") -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered) and the word offsets of each text. `offsets` start at 0."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    inside = class_table(kind)[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:n]
    start = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    end = np.flatnonzero(inside & ~after) + 1
    return Substrings(data).hash(start, end), np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of k-word shingles of each text, end to end, and the offsets of each text.

    A text of 1 to k - 1 words has one shingle, its whole sequence; a text without words has none.
    """
    w, first = words(data, offsets)
    n_words = np.diff(first)
    n_docs = len(n_words)
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    where = np.concatenate(([0], np.cumsum(counts)))
    if len(w) >= k:
        h = np.zeros(len(w) - k + 1, np.uint64)
        salt = GOLDEN * np.arange(1, k + 1, dtype=np.uint64)
        for j in range(k):
            h += mix(w[j: len(w) - k + 1 + j] + salt[j])
        h = mix(h)
    else:
        h = np.zeros(0, np.uint64)
    out = np.empty(where[-1], np.uint64)
    for d in range(n_docs):
        a, b = where[d], where[d + 1]
        if n_words[d] >= k:
            out[a:b] = h[first[d]: first[d] + b - a]
            out[a:b].sort()
        elif b > a:
            whole = w[first[d]: first[d + 1]]
            salt = GOLDEN * np.arange(101, 101 + len(whole), dtype=np.uint64)
            out[a:b] = mix(np.cumsum(mix(whole + salt))[-1:] + np.uint64(len(whole)))
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[where[:-1][counts > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return out[fresh], kept[where]
