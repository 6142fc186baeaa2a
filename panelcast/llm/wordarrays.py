"""Words of many texts as Arrow strings and numpy positions, for work inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_class(outside: bytes) -> np.ndarray:
    """True for every byte that belongs to words, given those that do not."""
    inside = np.ones(256, bool)
    inside[np.frombuffer(outside, np.uint8)] = False
    return inside


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """(start, end) of every word in `data`, and the number of the first word of each text (and of the end).

    Words are maximal runs of bytes that are True in `inside`; none reaches from one text into the next.
    """
    n = len(data)
    is_word = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    start = np.flatnonzero(is_word & (cut[:n] | ~before))
    end = np.flatnonzero(is_word & (cut[1:] | ~after)) + 1
    return start, end, np.searchsorted(start, offsets)


def word_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> pa.Array:
    """The words as one Arrow array. The spans are those of `word_spans`, so the word bytes in order are its values."""
    where = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(where), pa.py_buffer(data[inside[data]]))
