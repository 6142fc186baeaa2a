"""N-gram Jaccard join by equal fragments of the n-gram order.

This is not the dealt method (partial overlaps of every fragment, shuffled and summed per pair): the fragments of the global
order only give candidates, and overlaps are counted inside tasks. The README has the reasons and figures.

A document is the set of its distinct k-word shingles, as 64-bit hashes. The order of hashes is the global order of
n-grams, and it is cut into fragments twice:

1. Candidates. Two sets of similarity >= t differ in at most D = (|x| + |y|)(1 - t) / (1 + t) n-grams. The order is cut
   into more than D fragments, so at least one fragment holds the same n-grams in both documents: only documents with
   an equal fragment are candidates, and a fragment is one number to ship. The number of fragments follows from the
   set's size band; a set also takes part in the band below if a partner may lie there. Cuts are spare, so that fragments
   of less than two n-grams (which many documents share by chance) need not be shipped: they are, for exactly those
   documents that have too many of them for the argument to hold.
2. Filter. A fragment that many texts share by chance would connect most of a corpus. Each set has parities of its n-grams over a
   number of bits that grows with it; two sets differ in at least as many n-grams as bits. Candidates with too many different
   bits cannot link and connect nothing, which is exact.
3. Verification. Sets connected by candidates are brought together. The partial overlaps of a pair are counted fragment
   by fragment and summed per pair, and a pair is given up as soon as the fragments left cannot lift it to the threshold.

Equal sets are one node. Pairs never leave the task that counts them: it returns a spanning forest of the links it
found, and a pair that is connected already is not counted. Many small groups (signatures, clusters) share a task; a large
one is cut into blocks, so that a task's memory is bounded, and is compared in rounds (`connected`): first each block in
itself and with a few members of the first, then blocks up to 3, 15, 63 ... apart. After each round, what is connected is
found, and only members outside a group's connected majority travel on to other blocks. So a group that is alike costs rows
in proportion to its members, not a forest for each pair of its blocks; one without links inside is compared whole, by its
nature, in bounded tasks. No link between components is lost.

Null and empty texts, and texts without words, have empty sets and link with nothing. Rows without an id link with
nothing and are their own component (null). Equal rows repeat. A text with fewer than k words is one shingle. Sets are
identified by 64 bits; a very long text has one row per fragment of its set, and its set is one array of 8 bytes per
n-gram in one row. Columns other than id and text are ignored, whatever their names. In a corpus of n distinct sets two differ unnoticed with probability n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.hashing import GOLDEN, chunks, mix, shingle_sets, text_bytes
from panelcast.llm.shared import components, sized, small_batches, with_roots
from panelcast.sources.storage import materialise

#: Fragments of verification.
FRAGMENTS = 4
#: Ratio of a size band's ends.
BAND = 1.5
#: Sets that a task remembers having shipped.
SEEN = 500_000
#: Sets of a block, of all small clusters in a task, and of those that visit a block in one.
BLOCK = 512
#: One in so many members of a large group's first block visits all its blocks in the first round.
VISITORS = 64
#: How many times farther the blocks of a round may lie apart than those of the round before.
REACH = 4
#: Least bits of a set; they bound the differences of two sets from below.
BITS = 1024
#: Members of signatures, about, that a task compares by their bits.
BIN = 20_000


def bands(top: int) -> list[int]:
    """Starts of the size bands up to size `top`, and one beyond."""
    starts = [1]
    while starts[-1] <= top:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    return starts


def scheme(starts: np.ndarray, i: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Most differences, and number of fragments, for pairs whose smaller set lies in band i."""
    small = starts[i + 1] - 1
    most = (small + small * den // num) * (den - num) // (den + num)
    return most, np.where(most > 0, ((most + 1) * (5 if num * 100 >= 88 * den else 6) + 3) // 4, 1)


def set_ids(tokens: np.ndarray, where: np.ndarray) -> np.ndarray:
    """One signed number per set."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(tokens), dtype=np.uint64)))
    return mix(sums[where[1:]] - sums[where[:-1]] + GOLDEN * np.diff(where).astype(np.uint64)).view(np.int64)


def parities(tokens: np.ndarray, where: np.ndarray) -> list[bytes]:
    """Bits of each set, `BITS` or more, a power of two not below its size: whether an odd number of its n-grams fall on each.

    One n-gram more or less changes one bit. Of twice the bits, the halves' difference are the bits.
    """
    out = []
    for i, j in zip(where[:-1], where[1:]):
        width = max(BITS, 1 << int(j - i - 1).bit_length()) if j > i else BITS
        odd = np.bincount((tokens[i:j] & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
        out.append(np.packbits(odd.astype(bool)).tobytes())
    return out


def different_bits(bits: pa.Array):
    """Function of two lists of rows of `bits`: in how many bits they differ, at the lesser width."""
    data, offsets = text_bytes(bits)
    words, offsets = data.view(np.uint64), offsets // 8
    width = np.diff(offsets)
    levels = np.unique(width)
    tables, place = {}, {}
    for w in levels:
        rows = np.flatnonzero(width >= w)
        place[w] = np.zeros(len(width), np.int64)
        place[w][rows] = np.arange(len(rows))
        tables[w] = np.empty((len(rows), w), np.uint64)
        for own in levels[levels >= w]:
            some = np.flatnonzero(width == own)
            flat = words[offsets[some][:, None] + np.arange(own)].reshape(len(some), own // w, w)
            tables[w][place[w][some]] = np.bitwise_xor.reduce(flat, axis=1)

    def differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        out, least = np.zeros(len(p), np.int64), np.minimum(width[p], width[q])
        for w in np.unique(least):
            some, step = np.flatnonzero(least == w), max(1, (1 << 18) // int(w))
            for k in range(0, len(some), step):
                at = some[k: k + step]
                pair = tables[w][place[w][p[at]]] ^ tables[w][place[w][q[at]]]
                out[at] = np.bitwise_count(pair).sum(axis=1, dtype=np.int64)
        return out
    return differ


def signatures(tokens: np.ndarray, where: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) of every fragment that must be shipped."""
    sizes = np.diff(where)
    if not len(tokens):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.array(bands(int(sizes.max()) + 1), np.int64)
    own = np.searchsorted(starts, sizes, side="right") - 1
    lowest = np.searchsorted(starts, np.maximum(1, -(-sizes * num // den)), side="right") - 1
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(tokens ^ GOLDEN), dtype=np.uint64)))
    docs_out, sig_out = [], []
    for step in range(int((own - lowest)[sizes > 0].max()) + 1):
        rows = np.flatnonzero((sizes > 0) & (own - step >= lowest))
        band = own[rows] - step
        most, m = scheme(starts, band, num, den)
        rows, band, most, m = rows[most > 0], band[most > 0], most[most > 0], m[most > 0]
        if not len(rows):
            continue
        n = sizes[rows]
        at = np.repeat(where[:-1][rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(np.arange(len(rows)), n)
        fragment = ((tokens[at] >> np.uint64(32)) * m[row].astype(np.uint64)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1]))))
        count = np.diff(np.concatenate((first, [len(at)])))
        r, f = row[first], fragment[first]
        filled = np.bincount(r, minlength=len(rows))
        large = np.bincount(r[count > 1], minlength=len(rows))
        # Fragments of at least two n-grams suffice if more than `most` of them exist; else all that are filled; else all.
        level = np.where(large > most, 2, np.where(filled > most, 1, 0))
        content = sums[at[first] + count] - sums[at[first]]
        keep = count >= level[r]
        r, f, content = r[keep], f[keep], content[keep]
        for bare in np.flatnonzero(level == 0):
            empty = np.setdiff1d(np.arange(m[bare]), fragment[row == bare]).astype(np.uint64)
            r = np.concatenate((r, np.full(len(empty), bare)))
            f, content = np.concatenate((f, empty)), np.concatenate((content, np.zeros(len(empty), np.uint64)))
        sig = mix(content + mix(f * np.uint64(1 << 20) + band[r].astype(np.uint64) + GOLDEN))
        docs_out.append(rows[r])
        sig_out.append(sig.view(np.int64))
    if not docs_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(docs_out), np.concatenate(sig_out)


def _per_chunk(texts: pa.Array, k: int):
    data, offsets = text_bytes(texts)
    for i, j in chunks(offsets):
        part = offsets[i: j + 1]
        yield i, j, *shingle_sets(data[part[0]: part[-1]], part - part[0], k)


def _narrow(k: int):
    def run(batches):
        for b in batches:
            n, ids, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for _, _, tokens, where in _per_chunk(b.column(1), k):
                n.append(np.diff(where))
                ids.append(set_ids(tokens, where))
                bits += parities(tokens, where)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(ids), pa.int64()),
                 pa.array(bits, pa.binary())],
                ["doc_id", "n_shingles", "set_id", "bits"])
    return run


def _postings(k: int, num: int, den: int):
    def run(batches):
        seen: set[int] = set()  # equal sets of one task are shipped once; emptied when large
        for b in batches:
            for _, _, tokens, where in _per_chunk(b.column(0), k):
                ids = set_ids(tokens, where)
                fresh = np.array([not (x in seen or seen.add(x)) for x in ids.tolist()], bool)
                if len(seen) > SEEN:
                    seen.clear()
                n = np.diff(where)
                tokens = tokens[np.repeat(fresh, n)]
                ids, where = ids[fresh], np.concatenate(([0], np.cumsum(n[fresh])))
                row, sig = signatures(tokens, where, num, den)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(ids[row])], ["sig", "node"])
    return run


def _sets(k: int):
    def run(batches):
        for b in batches:
            for _, _, tokens, where in _per_chunk(b.column(0), k):
                lists = pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(tokens, where)), lists], ["node", "tokens"])
    return run


class Block:
    """Sets brought together in a task: `rows` sets, whose tokens are numbered in the global order."""

    def __init__(self, tokens: pa.ListArray, num: int, den: int):
        self.num, self.den = num, den
        at, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
        flat, at = flat[at[0]: at[-1]], at - at[0]
        known = np.unique(flat)
        self.tokens = np.searchsorted(known, flat).astype(np.int32)  # less memory than an inverse of the sort
        self.size = np.diff(at)
        # Where each fragment of each set begins; the last column is the end.
        edges = np.linspace(0, len(known), FRAGMENTS + 1).astype(np.int64)
        row = np.repeat(np.arange(len(self.size)), self.size)
        cell = row * FRAGMENTS + np.searchsorted(edges[1:-1], self.tokens, side="right")
        counts = np.bincount(cell, minlength=len(self.size) * FRAGMENTS).reshape(-1, FRAGMENTS)
        self.edge = at[:-1, None] + np.concatenate((np.zeros((len(self.size), 1), np.int64), counts.cumsum(axis=1)), axis=1)
        self.mark = np.zeros(len(known), np.int64)

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` that link to `x`."""
        n = self.size[x] + self.size[others]
        least = -(-self.num * n // (self.num + self.den))  # the overlap that suffices
        mine = self.tokens[self.edge[x, 0]: self.edge[x, -1]]
        self.mark[mine] = 1
        both = np.zeros(len(others), np.int64)
        for f in range(FRAGMENTS):
            left = np.minimum(self.edge[x, -1] - self.edge[x, f], self.edge[others, -1] - self.edge[others, f])
            hope = both + left >= least
            others, both, least = others[hope], both[hope], least[hope]
            if not len(others):
                break
            start, count = self.edge[others, f], self.edge[others, f + 1] - self.edge[others, f]
            ends = np.cumsum(count)
            flat = np.repeat(start - (ends - count), count) + np.arange(ends[-1])
            total = np.concatenate(([0], np.cumsum(self.mark[self.tokens[flat]])))
            both = both + total[ends] - total[ends - count]
        self.mark[mine] = 0
        return others[both >= least]


def _classes(label: np.ndarray) -> np.ndarray:
    """Labels numbered from 0."""
    return np.unique(label, return_inverse=True)[1]


def forest(table: pa.Table, num: int, den: int, within: bool) -> pa.Table:
    """Links (a, b) that connect sets of one task not connected yet: all of a block, or those that visit with the block's.

    Those with `seek` 2 meet members of the majority only.
    """
    nodes, seek, rest = (table.column(c).to_numpy() for c in ("node", "seek", "rest"))
    here = seek == 0
    block = Block(table.column("tokens").combine_chunks(), num, den)
    sigs = table.column("sigs").combine_chunks()
    row = np.repeat(np.arange(len(nodes)), np.diff(sigs.offsets.to_numpy()))
    sig = sigs.flatten().to_numpy()
    order = np.lexsort((row, here[row], sig))  # those that visit first
    row, sig = row[order], sig[order]
    group = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    end = np.repeat(np.append(group[1:], len(sig)), np.diff(np.append(group, len(sig))))
    by_row = np.argsort(row, kind="stable")
    first = np.searchsorted(row[by_row], np.arange(len(nodes) + 1))
    label = _classes(table.column("label").to_numpy())
    a, b = [], []
    for x in range(len(nodes)) if within else np.flatnonzero(~here):
        spots = by_row[first[x]: first[x + 1]]
        parts = [row[s + 1: end[s]] for s in spots if s + 1 < end[s]]
        if not parts:
            continue
        others = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
        others = others[label[others] != label[x]]
        if not within:
            others = others[here[others] & ~((seek[x] == 2) & rest[others])]
        if not len(others):
            continue
        for y in block.linked(x, others):
            if label[x] != label[y]:
                label[label == label[y]] = label[x]
                a.append(nodes[x])
                b.append(nodes[y])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _inside(grp: np.ndarray):
    """All pairs of rows of one group, in arrays; rows are sorted by group."""
    rows, shift = np.arange(len(grp)), 0
    while len(rows):
        shift += 1
        rows = rows[rows + shift < len(grp)]
        rows = rows[grp[rows + shift] == grp[rows]]
        yield rows, rows + shift


def _visits(seek: np.ndarray, rest: np.ndarray):
    """Pairs of a row that visits and one of the block, in arrays."""
    here, seekers = np.flatnonzero(seek == 0), np.flatnonzero(seek)
    step = max(1, (1 << 14) // max(1, len(here)))
    for k in range(0, len(seekers), step):
        x, y = np.repeat(seekers[k: k + step], len(here)), np.tile(here, len(seekers[k: k + step]))
        meet = (seek[x] == 1) | ~rest[y]
        yield x[meet], y[meet]


def near_bits(table: pa.Table, num: int, den: int, within: bool) -> pa.Table:
    """Pairs (a, b) that connect the sets of one signature whose bits differ no more than those of a link may.

    Sets not connected yet: all of a block, or those that visit with the block's, as in `forest`.
    """
    table = table.combine_chunks()
    grp, node, seek, rest = (table.column(c).to_numpy() for c in ("grp", "node", "seek", "rest"))
    order = np.lexsort((node, grp))
    grp, seek, rest = grp[order], seek[order], rest[order]
    nodes, first, at = np.unique(node, return_index=True, return_inverse=True)
    at = at[order]
    size = table.column("size").to_numpy()[first]
    differ = different_bits(table.column("bits").take(pa.array(first)))
    own = _classes(table.column("label").to_numpy()[first])
    label = np.arange(own.max() + 1)
    a, b = [], []
    for x, y in _inside(grp) if within else _visits(seek, rest):
        x, y = at[x], at[y]
        fresh = label[own[x]] != label[own[y]]
        x, y = x[fresh], y[fresh]
        for k in range(0, len(x), 1 << 14):
            p, q = x[k: k + (1 << 14)], y[k: k + (1 << 14)]
            most = (size[p] + size[q]) * (den - num) // (num + den)
            close = np.abs(size[p] - size[q]) <= most
            p, q, most = p[close], q[close], most[close]
            close = differ(p, q) <= most
            for u, v in zip(p[close].tolist(), q[close].tolist()):
                r, t = own[u], own[v]
                while label[r] != r:
                    r = label[r]
                while label[t] != t:
                    t = label[t]
                if r != t:
                    label[max(r, t)] = min(r, t)
                    a.append(nodes[u])
                    b.append(nodes[v])
        while (label != label[label]).any():
            label = label[label]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`members` with `label`: what a node is connected to in `labels` (node, root), or itself."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def _merged(labels: DataFrame | None, pairs: DataFrame, name: str) -> DataFrame:
    """(node, root), written, of all nodes that `labels` (of the same form) or written `pairs` (a, b) connect."""
    if labels is not None:
        if pairs.isEmpty():
            return labels
        pairs = pairs.unionByName(labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    return materialise(with_roots(components(pairs, f"{name}-stars")), f"{name}-labels")


def connected(members: DataFrame, content, compare, bin_rows: int, name: str, labels: DataFrame | None = None) -> DataFrame:
    """(node, root), written: components of what `compare` finds close in one group of `members` (grp, node), written.

    content(nodes) has a row per node with what `compare` needs; `labels` (node, root) is what is connected already, and
    stays so. Small groups share a task, about `bin_rows` rows; a large one is compared in rounds, by the distance of its blocks.
    """
    hot = materialise(members.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                      .select("grp", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), f"{name}-hot")
    bins = max(1, -(-members.count() // bin_rows))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    large = F.col("blocks") > 1
    visitor = large & (F.col("own") == 0) & (F.pmod(F.xxhash64("node", F.lit(1)), F.lit(VISITORS)) == 0)
    placed = (_labelled(members, labels).join(sized(hot, 12), "grp", "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
              .select("grp", "node", "label", F.lit(0).alias("seek"), F.lit(False).alias("rest"), large.alias("large"),
                      F.when(large, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bins))).alias("bin"),
                      F.explode(F.when(visitor, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))).alias("own")))
    found = (placed.join(content(members.select("node")), "node").groupBy("large", "bin", "own")
             .applyInArrow(lambda t: compare(t, True), "a long, b long"))
    labels = _merged(labels, materialise(found, f"{name}-pairs"), name)
    if hot.isEmpty():
        return labels
    inside, low = materialise(members.join(sized(hot, 12), "grp").withColumn("own", own), f"{name}-large"), 1
    while True:
        # Blocks lie on a ring, up to half of it apart.
        state = materialise(_labelled(inside.where(F.col("blocks") >= 2 * low), labels), f"{name}-state")
        most = state.groupBy("grp", "label").agg(F.count("*").alias("n"), F.first("blocks").alias("blocks")).groupBy("grp").agg(
            F.max_by("label", "n").alias("label"), F.max("n").alias("most"), F.sum("n").alias("n"), F.first("blocks").alias("of"))
        major = 2 * F.col("most") > F.col("n")  # else all travel, one way round
        far = F.least(F.lit(low * REACH - 1), F.floor(F.col("of") / 2)).cast("int")
        visits = F.when(major, 2 * (F.col("n") - F.col("most"))).otherwise(F.col("n")) * (far - low + 1) / F.col("of")
        open_ = materialise(most.where("most < n").select(
            "grp", F.when(major, F.col("label")).alias("major"), far.alias("far"),
            F.greatest(F.lit(1), F.ceil(visits / BLOCK)).cast("int").alias("splits")), f"{name}-open")
        if open_.isEmpty():
            return labels
        state = state.join(sized(open_, 24), "grp").withColumn(
            "rest", F.col("major").isNull() | (F.col("label") != F.col("major")))
        here = state.select("grp", "node", "label", F.lit(0).alias("seek"), "rest", "own",
                            F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))
        ways = F.when(F.col("major").isNull() | (2 * F.col("d") == F.col("blocks")), F.array(F.lit(1))).otherwise(
            F.array(F.lit(1), F.lit(2)))
        go = (state.where("rest").withColumn("d", F.explode(F.sequence(F.lit(low), F.col("far")))).withColumn("seek", F.explode(ways))
              .withColumn("own", F.pmod(F.col("own") + F.when(F.col("seek") == 1, F.col("d")).otherwise(-F.col("d")), F.col("blocks")))
              .select("grp", "node", "label", "seek", "rest", "own",
                      F.pmod(F.xxhash64("node", "own"), F.col("splits")).cast("int").alias("split")))
        found = (here.unionByName(go).join(content(state.select("node").distinct()), "node").groupBy("grp", "own", "split")
                 .applyInArrow(lambda t: compare(t, False), "a long, b long"))
        labels = _merged(labels, materialise(found, f"{name}-pairs"), name)
        low *= REACH


def candidates(shared: DataFrame, narrow: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): each node that is connected by pairs of `shared` (sig, node), a written table, that may link, and the smallest such.

    Each set is compared in the signature that most others have first, then in those that hold unconnected sets still.
    """
    marks = (narrow.where("doc_id IS NOT NULL").select(F.col("set_id").alias("node"), F.col("n_shingles").alias("size"), "bits")
             .dropDuplicates(["node"]))
    compare = lambda t, within: near_bits(t, num, den, within)
    often = shared.groupBy("sig").agg(F.count("*").alias("n"))
    first = materialise(shared.join(often, "sig").groupBy("node").agg(F.max(F.struct("n", "sig")).alias("m"))
                        .select(F.col("m.sig").alias("grp"), "node"), "ngram-first")
    labels = connected(first, lambda nodes: marks, compare, BIN, "ngram-first")
    box = Window.partitionBy("sig")
    left = materialise(_labelled(shared, labels).withColumn("low", F.min("label").over(box)).withColumn(
        "high", F.max("label").over(box)).where("low <> high").select(F.col("sig").alias("grp"), "node").distinct(), "ngram-left")
    labels = connected(left, lambda nodes: marks, compare, BIN, "ngram-left", labels)
    return labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def links(docs: DataFrame, narrow: DataFrame, k: int, num: int, den: int, text_col: str) -> DataFrame | None:
    """(node, root): components of sets under links, for sets that link at all."""
    docs = docs.where("doc_id IS NOT NULL")
    rows = docs.select(text_col).mapInArrow(_postings(k, num, den), "sig long, node long")
    box = Window.partitionBy("sig")
    shared = (rows.withColumn("low", F.min("node").over(box)).withColumn("high", F.max("node").over(box))
              .where("low <> high").select("sig", "node"))
    with small_batches(docs.sparkSession):
        shared = materialise(shared, "ngram-postings")
        pairs = candidates(shared, narrow, num, den)
    clusters = materialise(with_roots(pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))), "ngram-clusters")
    if clusters.isEmpty():
        return None

    def content(nodes: DataFrame) -> DataFrame:
        """(node, sigs, tokens). One document speaks for each set; its text is read again for the set itself."""
        speak = materialise(narrow.where("doc_id IS NOT NULL").join(nodes, narrow.set_id == nodes.node)
                            .groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "ngram-speakers")
        sets = docs.join(sized(speak, 0), "doc_id", "left_semi").select(text_col).mapInArrow(
            _sets(k), "node long, tokens array<bigint>").dropDuplicates(["node"])
        members = shared.groupBy("node").agg(F.collect_set("sig").alias("sigs"))  # at most a set's own fragments
        return members.join(sets, "node")

    members = clusters.select(F.col("root").alias("grp"), "node")
    with small_batches(docs.sparkSession):
        return connected(members, content, lambda t, within: forest(t, num, den, within), BLOCK, "ngram-links")


def jaccard_components(docs: DataFrame, *, k: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; documents link at Jaccard similarity >= num / den."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, set_id long, bits binary"
    with small_batches(docs.sparkSession):
        narrow = materialise(docs.mapInArrow(_narrow(k), schema), "ngram-sets")
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    sets = narrow.where(linkable).groupBy("set_id").agg(F.min("doc_id").alias("low"))
    labels = links(docs, narrow, k, num, den, "text")
    if labels is not None:
        sets = sets.join(labels, sets.set_id == labels.node, "left").withColumn("root", F.coalesce("root", "set_id"))
        low = sets.groupBy("root").agg(F.min("low").alias("component_id"))
        sets = sets.join(low, "root").select("set_id", "component_id")
    else:
        sets = sets.select("set_id", F.col("low").alias("component_id"))
    key = F.when(linkable, F.col("set_id"))
    out = narrow.withColumn("key", key).join(sets.withColumnRenamed("set_id", "key"), "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
