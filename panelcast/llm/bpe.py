"""BPE encoding and decoding by forced boundaries.

A merge joins two neighbouring tokens into a longer token of the vocabulary, so a pair of symbols that occurs inside no
token can never be merged across: a word may be cut there for certain. Words are cut at all such pairs, the distinct fragments
are encoded independently and their ids are put together again by index. A worker remembers the ids of a bounded number of
fragments, so that a common word is not encoded again in every slice of a batch; results do not depend on it.

Texts of common characters are cut into words on their bytes, many at once. A text with other characters, or with a
control string, takes the library's normaliser and splitter.

The text passes as one Arrow column through map-only expressions: no shuffle, any length of text, whole texts. Null or
empty texts give no ids; null ids give an empty text. Rows that repeat are encoded each, and other columns, whatever their
names, are the caller's.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from panelcast.llm.hashing import chunks, text_bytes

#: Texts handled at once in a batch when decoding, and bytes of texts when encoding.
SLICE, SLICE_BYTES = 256, 2 << 20
#: Fragments remembered of each kind, and their ids. When either is passed, those that came again since the last time stay.
KNOWN, KNOWN_IDS = 1 << 17, 1 << 20
#: Below this code point (the last with a two-byte lead under 0xC6) characters are composed already, and letters, digits and
#: lower case are the same in all Unicode versions.
STABLE = 0x180
#: White space below that point.
BLANK = "\t-\r \x85\xa0"
#: Classes of characters: white space, letters, digits and all else.
SPACE, LETTER, DIGIT, ELSE = range(4)


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies use them."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


_NOTHING = (pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool))


class Codec:
    """Encoder and decoder of one tokenizer file (byte-level BPE with an end-of-word suffix)."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        state = json.loads(tokenizer.to_str())
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        model = state["model"]
        suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) for m in model["merges"]]
        # Of fragments inside a word, and at its end.
        self.models = [Tokenizer(models.BPE(vocab=model["vocab"], merges=merges)),
                       Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix))]
        self.special = {t["content"]: t["id"] for t in state["added_tokens"] if t["special"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.tokens = np.array([tokenizer.id_to_token(i) or "" for i in range(size)], object)

        alphabet = byte_alphabet()
        self.back = {c: b for b, c in enumerate(alphabet)}
        spelled = [c.encode() for c in alphabet]  # one or two bytes each
        self.spelled = np.frombuffer(b"".join(s.ljust(2, b"\0") for s in spelled), np.uint8).reshape(256, 2)
        self.spelled_size = np.array([len(s) for s in spelled])
        self.joined = self._pairs(model["vocab"], suffix)
        # Characters that a token spells inside a word, and at its end.
        self.token_size = [np.array([len(t.removesuffix(s) if s else t) for t in self.tokens], np.int64) for s in ("", suffix)]
        # Of each kind: fragments, their ids end to end, where each one's begin (and the end), and which came again.
        self.known = [_NOTHING, _NOTHING]

        self.classes = np.full(STABLE, ELSE, np.uint8)
        self.lower = np.arange(STABLE, dtype=np.uint16)
        self.odd = np.zeros(STABLE, bool)  # characters whose lower case lies beyond
        for c in range(STABLE):
            small = chr(c).lower()
            self.odd[c] = len(small) > 1 or ord(small) >= STABLE
            self.lower[c] = c if self.odd[c] else ord(small)
            kind = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], ELSE)
            self.classes[c] = SPACE if re.match(f"[{BLANK}]", chr(c)) else kind

    def _pairs(self, vocab, suffix: str) -> np.ndarray:
        """[at the end?, first, second]: whether two bytes stand side by side inside some token.

        The last byte of a word carries the suffix and is a symbol of its own.
        """
        joined = np.zeros((2, 256, 256), bool)
        for token in vocab:
            final = bool(suffix) and token.endswith(suffix)
            body = [self.back.get(c) for c in (token[: -len(suffix)] if final else token)]
            for i, (a, b) in enumerate(zip(body, body[1:])):
                if a is not None and b is not None:
                    joined[int(final and i == len(body) - 2), a, b] = True
        if not suffix:
            joined[1] = joined[0]
        return joined

    def cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the words end to end, where their fragments start (and the end), and the first fragment of each word."""
        data, offsets = text_bytes(words)
        if not len(data):
            return data, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
        last = np.zeros(len(data), np.int8)
        last[offsets[1:] - 1] = 1
        begins = np.ones(len(data), bool)
        begins[1:] = ~self.joined[last[1:], data[:-1], data[1:]]
        begins[offsets[:-1]] = True
        starts = np.flatnonzero(begins)
        return data, np.append(starts, len(data)), np.searchsorted(starts, offsets)

    def fragments_of(self, word: str) -> list[str]:
        """`word` cut at every forced boundary (of characters of one byte)."""
        _, starts, _ = self.cut(pa.array([word]))
        return [word[a:b] for a, b in zip(starts[:-1], starts[1:])]

    def _model_ids(self, fragments: pa.Array, final: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of fragments in the byte alphabet, end to end, and how many each has."""
        if not len(fragments):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        found = self.models[final].encode(fragments.to_pylist(), is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.int32)
        # Tokens spell the fragments end to end, so each of a fragment's last characters ends a token.
        ends = np.cumsum(pc.utf8_length(fragments).to_numpy(zero_copy_only=False))
        spelled = np.cumsum(self.token_size[int(final)][ids])
        if len(ids) and spelled[-1] == ends[-1]:
            return ids, np.diff(np.searchsorted(spelled, ends, side="right"), prepend=0)
        of = np.fromiter((w for w in found.word_ids), np.int64, len(found))  # a vocabulary without some bytes
        return ids, np.bincount(of, minlength=len(fragments))

    def _remembered_ids(self, fragments: pa.Array, final: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct fragments in the byte alphabet, where each one's begin, and how many each has."""
        known, ids, begin, used = self.known[final]
        at = pc.fill_null(pc.index_in(fragments, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = np.flatnonzero(at < 0)
        new = fragments.take(pa.array(fresh))
        new_ids, n = self._model_ids(new, final)
        ids, begin = np.concatenate((ids, new_ids)), np.concatenate((begin, begin[-1] + np.cumsum(n)))
        used = np.concatenate((used, np.zeros(len(new), bool)))
        used[at[at >= 0]] = True
        at[fresh] = len(known) + np.arange(len(new))
        known = pa.concat_arrays([known, new])
        if len(known) <= KNOWN and len(ids) <= KNOWN_IDS:
            self.known[final] = known, ids, begin, used
        else:
            keep = np.flatnonzero(used)
            size = np.cumsum(begin[keep + 1] - begin[keep])
            keep = keep[(np.arange(len(keep)) < KNOWN // 2) & (size <= KNOWN_IDS // 2)]
            size = begin[keep + 1] - begin[keep]
            self.known[final] = (known.take(pa.array(keep)), _gather(ids, begin[keep], size),
                                 np.concatenate(([0], np.cumsum(size))), np.zeros(len(keep), bool))
        return ids, begin[at], begin[at + 1] - begin[at]

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of not empty words, end to end, and how many each has. Distinct words, then distinct fragments, are encoded once."""
        coded = words.dictionary_encode()
        data, starts, first = self.cut(coded.dictionary)
        # Spell all fragments in the byte alphabet.
        sizes = self.spelled_size[data]
        pairs = self.spelled[data]
        flat = pairs[np.arange(2) < sizes[:, None]]
        ends = np.concatenate(([0], np.cumsum(sizes)))[starts].astype(np.int32)
        fragments = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(flat))
        final = np.zeros(len(fragments), bool)
        final[first[1:] - 1] = True
        counts = np.zeros(len(fragments), np.int64)
        parts, base = [], np.zeros(len(fragments), np.int64)  # where a fragment's ids start among those of all
        at = 0
        for kind in (False, True):
            some = np.flatnonzero(final == kind)
            different = fragments.take(pa.array(some)).dictionary_encode()
            ids, begin, n = self._remembered_ids(different.dictionary, kind)
            index = different.indices.to_numpy(zero_copy_only=False)
            counts[some] = n[index]
            base[some] = (at + begin)[index]
            parts.append(ids)
            at += len(ids)
        of_word, per_word = _gather(np.concatenate(parts), base, counts), np.add.reduceat(counts, first[:-1]) if len(counts) else counts
        index = coded.indices.to_numpy(zero_copy_only=False)
        begin = np.cumsum(per_word) - per_word
        return _gather(of_word, begin[index], per_word[index]), per_word[index]

    def words_of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words of texts of common characters, and the number of the first word of each text and of the end."""
        n = len(data)
        if not n:
            return pa.array([], pa.string()), np.zeros(len(offsets), np.int64)
        code = data.astype(np.uint16)
        lead = np.flatnonzero(data >= 0xC0)  # of two bytes
        code[lead] = ((code[lead] & 0x1F) << 6) | (code[lead + 1] & 0x3F)
        code[lead + 1] = 0
        code = self.lower[code]
        kind = self.classes[code]
        kind[lead + 1] = kind[lead]
        small = code.astype(np.uint8)
        small[lead], small[lead + 1] = 0xC0 | (code[lead] >> 6), 0x80 | (code[lead] & 0x3F)
        start = np.ones(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        start[offsets[:-1][offsets[:-1] < n]] = True
        start[lead + 1] = False
        start &= kind != SPACE
        # A contraction: an apostrophe that starts a word, and the letters after it; the letters left are a word.
        mark = np.flatnonzero(start & (small == 39))
        end = offsets[np.searchsorted(offsets, mark, side="right")]
        follow = [np.where(mark + k < end, small[np.minimum(mark + k, n - 1)], 0) for k in (1, 2)]
        one = np.isin(follow[0], np.frombuffer(b"stmd", np.uint8))
        two = (((follow[0] == ord("r")) | (follow[0] == ord("v"))) & (follow[1] == ord("e"))
               | (follow[0] == ord("l")) & (follow[1] == ord("l")))
        rest = mark + np.where(one, 2, 3)
        start[mark[one | two] + 1] = False
        rest = rest[(one | two) & (rest < end)]
        start[rest] = kind[rest] != SPACE
        at, solid = np.flatnonzero(start), kind != SPACE
        place = np.concatenate(([0], np.cumsum(solid)))  # of each byte among those of words
        ends = np.concatenate((place[at], place[-1:])).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(small[solid]))
        return words, np.searchsorted(at, offsets)

    def _split(self, text: str) -> list[int | str]:
        """Words of any text, and ids of the control strings in it."""
        out: list[int | str] = []
        for piece in self.specials.split(text):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                pieces = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece))
                out += [bytes(map(self.back.__getitem__, w)).decode() for w, _ in pieces if w]
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has; null counts as empty."""
        data, offsets = text_bytes(texts)
        n = len(offsets) - 1
        odd = data >= 0xC6
        lead = np.flatnonzero((data >= 0xC0) & ~odd)
        odd[lead] |= self.odd[((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)]
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        apart = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1)
        plain = np.ones(n, bool)
        plain[apart] = False
        sizes = np.diff(offsets)
        if len(apart):
            data, offsets = data[np.repeat(plain, sizes)], np.concatenate(([0], np.cumsum(np.where(plain, sizes, 0))))
        words, first = self.words_of(data, offsets)
        of_words, per_word = self.ids_of(words)
        ends = np.concatenate(([0], np.cumsum(per_word)))[first]
        if not len(apart):
            return of_words, np.diff(ends)
        # The other texts' words, all of them together.
        lists = [self._split(t) for t in texts.take(pa.array(apart)).to_pylist()]
        items = [x for found in lists for x in found]
        is_word = np.array([isinstance(x, str) for x in items], bool)
        ids, count = self.ids_of(pa.array([x for x in items if isinstance(x, str)], pa.string()))
        per_item = np.ones(len(items), np.int64)
        per_item[is_word] = count
        mixed = np.zeros(per_item.sum(), np.int32)
        mixed[np.repeat(is_word, per_item)] = ids
        mixed[~np.repeat(is_word, per_item)] = [x for x in items if not isinstance(x, str)]
        edges = np.concatenate(([0], np.cumsum(per_item)))[np.concatenate(([0], np.cumsum([len(x) for x in lists])))]
        counts, begin = np.diff(ends), ends[:-1].copy()
        counts[apart], begin[apart] = np.diff(edges), len(of_words) + edges[:-1]
        return _gather(np.concatenate((of_words, mixed)), begin, counts), counts

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces: what a tokenizer file without a decoder asks for. Special tokens stay."""
        return " ".join(self.tokens[ids].tolist())


def _gather(values: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`counts` values from each place in `begin`, end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begin - (ends - counts), counts)]


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(text: Column, path: str) -> Column:
    """array<int> of the ids of each text, special strings in the text included, none added."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        c = codec(path)
        counts, values = [np.zeros(1, np.int64)], bytearray()
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in chunks(np.concatenate(([0], np.cumsum(sizes))), SLICE_BYTES):
            found, n = c.encode_all(texts.slice(i, j - i))
            values += found.tobytes()
            counts.append(n)
        offsets = np.cumsum(np.concatenate(counts)).astype(np.int32)
        flat = pa.Array.from_buffers(pa.int32(), len(values) // 4, [None, pa.py_buffer(values)])
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of each list of ids."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        c = codec(path)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        parts = []
        for at in range(0, len(lists), SLICE):
            ends = offsets[at: at + SLICE + 1]
            parts.append(pa.array([c.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return texts(ids)
