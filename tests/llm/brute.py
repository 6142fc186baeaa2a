"""Plain single-process versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    return {d: (max(g), len(g), d == max(g), sha(t)) for t, g in groups.items() for d in g}


def bpe(texts, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    out = []
    for x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        out.append((ids, t.decode(ids, skip_special_tokens=False)))
    return out


def vectors(rows, threshold=0.9):
    """rows: (id, list or None) -> id -> (n_links, component)."""
    good = {}
    for i, v in rows:
        if v is None or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        if len(x) and np.isfinite(x).all() and (x != 0).any():
            x = x / np.abs(x).max()
            good[i] = x / np.linalg.norm(x)
    links = [(a, b) for a in good for b in good
             if a < b and len(good[a]) == len(good[b]) and float(good[a] @ good[b]) >= threshold]
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components([i for i, _ in rows], links)
    return {i: (n[i], comp[i]) for i, _ in rows}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def phrases(text):
    words = WORD.findall(lower(text or ""))
    hits = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(words) - len(p) + 1) if words[i: i + len(p)] == p]
    starts = [i for i, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in hits})))


def notices(text, templates, slack=4, stretch=1.5, cover=0.6):
    """Labels of the notices of which some bundle of diagonals holds a long enough increasing chain in a bounded span."""
    words, found = WORD.findall(lower(text or "")), set()
    for template, label in templates.items():
        t = WORD.findall(template)
        pairs = len(t) - 1
        limit = -(-(pairs + 1) * stretch // 1) + slack
        hits = [(i, k) for i in range(len(words) - 1) for k in range(pairs) if words[i: i + 2] == t[k: k + 2]]
        bundles, last = [], None
        for d in sorted({i - k for i, k in hits}):
            if last is None or d - last > slack:
                bundles.append([])
            bundles[-1] += [h for h in hits if h[0] - h[1] == d]
            last = d
        for bundle in bundles:
            for first in {i for i, _ in bundle}:
                some = sorted(h for h in bundle if first <= h[0] and h[0] + 2 - first <= limit)
                best = [1] * len(some)
                for b, (i, k) in enumerate(some):
                    best[b] += max((best[a] for a in range(b) if some[a][0] < i and some[a][1] < k), default=0)
                if max(best) >= cover * pairs:
                    found.add(label)
    return found


def repeats(texts, length=200):
    """texts: list of str -> per text (n_bytes, n_removed, n_spans, kept sha)."""
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for d, b in enumerate(data):
        for i in range(len(b) - length + 1):
            seen[b[i: i + length]].append((d, i))
    cover = [np.zeros(len(b), bool) for b in data]
    for where in seen.values():
        if len(where) > 1:
            for d, i in where:
                cover[d][i: i + length] = True
    out = []
    for b, c in zip(data, cover):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], c.astype(int), [0]))) == 1)
        out.append((len(b), int(c.sum()), len(edges), sha(np.frombuffer(b, np.uint8)[~c].tobytes())))
    return out


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i: i + k]) for i in range(len(words) - k + 1))


def jaccard(docs, k, num, den):
    """docs: (id, text) -> id -> (n_shingles, component)."""
    sets = {d: shingles(t, k) for d, t in docs}
    ids = sorted(sets)
    index = defaultdict(list)
    links = []
    for d in ids:
        both = defaultdict(int)
        for s in sets[d]:
            for o in index[s]:
                both[o] += 1
            index[s].append(d)
        links += [(o, d) for o, n in both.items() if den * n >= num * (len(sets[o]) + len(sets[d]) - n)]
    comp = components(ids, links)
    return {d: (len(sets[d]), comp[d]) for d in ids}


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def runs(words):
    """(start, length, period) of every run, by trying each period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                w = words[i: j + q]
                if not any(w[p:] == w[:-p] for p in range(1, q)):
                    out.append((i, len(w), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words):
    gone = {i for s, length, q in runs(words) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


SECRET_BASE = (("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                     re.A), 6), ("access", re.compile("(AKIA[A-Z0-9]+)"), 20), ("hex", re.compile("([0-9a-f]+)"), 24))


def secrets(text):
    """Base spans as (kind, start, end) by start, then kind."""
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, least) in enumerate(SECRET_BASE)
             for m in p.finditer(text or "") if len(m[1]) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def collocations(rows, least=100, longest=5, top=2000):
    """rows (text, lang) -> (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(int), defaultdict(int)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, w[i: i + k]] += 1
    big = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inner = defaultdict(int)
    for (lang, p), a in big.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner[lang, p[i: i + k]] = max(inner[lang, p[i: i + k]], a)
    out = defaultdict(list)
    for (lang, p), a in big.items():
        if 100 * inner[lang, p] < 100 * a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(x)[:top])]
