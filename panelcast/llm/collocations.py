"""Phrase collocations by relational set mining (SETM).

Words are grouped into blocks: documents of one language that one task read, some millions of words. The occurrence
relation R(k) holds, for every occurrence of a frequent phrase of k words, its block, position and group (the phrase); it is
written sorted by block and position, one row per block, with the positions as steps from the one before. A step between
two words of a piece is 1, and larger from one piece to the next, so that words are neighbours only inside a piece.

For k = 1, 2, ...: merge-join R(k) with itself by adjacent position (two overlapping phrases of k words make one of k + 1),
group and count in the block, sum the groups over blocks, keep those that occur often enough, and semi-join the
occurrences with them, which gives R(k + 1). A block's rows never meet another block's; what Spark shuffles to sum up is the
groups of each block with their counts, dealt by a hash of the group into parts of bounded size, so a phrase that is
everywhere costs one entry per block. Groups are known by the numbers of the two groups they are made of, counted from 0
over all frequent ones, so equality is exact. Counts are over all documents.

Null texts count as empty, a null language is `UNKNOWN`. Rows that repeat all count. Document ids and other columns are not
read. A text of any length stays in one block, whose row grows with it. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.hashing import GOLDEN, chunks, mix, text_bytes
from panelcast.llm.wordarrays import byte_class, lowered, word_spans, word_strings
from panelcast.sources.storage import discard, materialise

UNKNOWN = "und"
LEAST, LONGEST, TOP = 100, 5, 2000
#: Words of a task's open blocks; they are closed together.
BLOCK_WORDS = 1_500_000
#: Blocks of a file: a reader holds what a file has at once.
FILE_BLOCKS = 4
#: Bits of a word's place: task, block of the task, word of the block.
TASK_BITS, BLOCK_BITS, CODE_BITS = 22, 14, 27
#: Bytes of text worked on at once.
TEXT_BYTES = 1 << 20

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD = byte_class(b" \t" + PIECE_ENDS)

FIRST = "block long, lang string, steps array<int>, codes array<int>, words array<string>, counts array<int>"
RELATION = "block long, steps array<int>, codes array<int>, ids array<long>"
#: Entries of one part, about, when groups are summed.
PART_ENTRIES = 4_000_000
FREQUENT = "block long, code int, part long, place long, first boolean, a long, b long, f long"
WORDS = "block long, code int, part long, place long, first boolean, lang string, phrase string, f long"
FREQUENT_FIELDS, WORD_FIELDS = ([f.split()[0] for f in schema.split(", ")] for schema in (FREQUENT, WORDS))


def _numbers(column, row: int) -> np.ndarray:
    """A list of an Arrow column as numpy."""
    offsets = column.offsets
    return column.values.slice(offsets[row].as_py(), offsets[row + 1].as_py() - offsets[row].as_py()).to_numpy(
        zero_copy_only=False)


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers with their bytes of equal weight together: what is seldom used compresses to nothing."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _list(values, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _first_relation(block_words: int):
    """All words of a task's documents, a row per block and language, numbered within the block."""
    def run(batches):
        task, closed = TaskContext.get().partitionId(), 0
        open_, size = defaultdict(list), 0

        def close():
            nonlocal closed, size
            for lang in sorted(open_):
                if task >> TASK_BITS or closed >> BLOCK_BITS:
                    raise ValueError("more tasks or blocks than identifiers")
                words = pa.chunked_array([w for w, _ in open_[lang]]).unify_dictionaries().combine_chunks()
                words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
                codes = words.indices.to_numpy(zero_copy_only=False)
                counts = np.bincount(codes, minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << BLOCK_BITS | closed) << CODE_BITS], pa.int64()), pa.array([lang]),
                     _list(np.concatenate([s for _, s in open_[lang]]), pa.int32()), _list(codes, pa.int32()),
                     _list(words.dictionary, pa.string()), _list(counts, pa.int32())],
                    ["block", "lang", "steps", "codes", "words", "counts"])
                closed += 1
            open_.clear()
            size = 0

        for b in batches:
            langs = b.column(0).dictionary_encode()
            names, lang_of = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(b.column(1))
            for i, j in chunks(offsets, TEXT_BYTES):
                part, own = lowered(data[offsets[i]: offsets[j]]), offsets[i: j + 1] - offsets[i]
                start, end, first = word_spans(part, own, WORD)
                if not len(start):
                    continue
                words = word_strings(part, start, end, WORD)
                ends = np.zeros(256, np.int32)
                ends[np.frombuffer(PIECE_ENDS, np.uint8)] = 1
                piece = np.cumsum(ends[part])[start]
                begins = np.concatenate(([True], piece[1:] != piece[:-1]))
                n_words = np.diff(first)
                begins[first[:-1][n_words > 0]] = True  # no piece reaches into the next text
                of_word = np.repeat(lang_of[i:j], n_words)
                order = np.argsort(of_word, kind="stable")
                edges = np.flatnonzero(np.diff(of_word[order])) + 1
                for some in np.split(order, edges):
                    open_[names[of_word[some[0]]]].append(
                        (words.take(pa.array(some)).dictionary_encode(), 1 + begins[some].astype(np.int32)))
                size += len(start)
                if size >= block_words:
                    yield from close()
        yield from close()
    return run


def _neighbours(steps, codes, n_groups):
    """Where an occurrence is followed by one at the next position, and the groups that the two make.

    (place of the first in the relation, its position, number of the group in order, per group: first code, second code,
    occurrences).
    """
    at = np.cumsum(steps)
    place = np.flatnonzero(steps[1:] == 1)
    pair = codes[place].astype(np.int64) * n_groups + codes[place + 1]
    groups, number, count = np.unique(pair, return_inverse=True, return_counts=True)
    return at[place], number, groups // max(n_groups, 1), groups % max(n_groups, 1), count


def _count(parts: int):
    """Groups of one word more, counted per block, a row per part. Ordered numbers travel as steps."""
    def run(batches):
        for b in batches:
            for row in range(len(b)):
                block, ids = b.column(0)[row].as_py(), _numbers(b.column(3), row)
                _, _, one, two, count = _neighbours(_numbers(b.column(1), row), _numbers(b.column(2), row), len(ids))
                first, second = ids[one], ids[two]
                part = (mix(first.astype(np.uint64) * GOLDEN + mix(second.astype(np.uint64))) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                used, start = np.unique(part[order], return_index=True)
                cells = [[] for _ in range(4)]
                for some in np.split(order, start[1:]) if len(order) else ():
                    for cell, v in zip(cells, (np.diff(first[some], prepend=0), second[some], np.diff(some, prepend=0), count[some])):
                        cell.append(_planes(v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), block)), *(pa.array(c, pa.binary()) for c in cells)],
                    ["part", "block", "a", "b", "code", "n"])
    return run


def _often(keys: tuple[np.ndarray, ...], block, code, n, least: int, part: int):
    """Rows whose group (equal `keys`) has a sum of at least `least`, ordered by group and block.

    (order of these rows, and columns block, code, part, place, first, f)
    """
    order = np.lexsort((block, *keys[::-1]))
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for k in keys:
        fresh[1:] |= k[order][1:] != k[order][:-1]
    start = np.flatnonzero(fresh)
    total = np.add.reduceat(n[order].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    place = np.cumsum(total >= least) - 1  # of the group among those that stay
    group = np.cumsum(fresh) - 1
    stays = (total >= least)[group]
    group, order = group[stays], order[stays]
    return order, {"block": block[order], "code": code[order].astype(np.int32), "part": np.full(len(order), part, np.int64),
                   "place": place[group].astype(np.int64), "first": fresh[stays], "f": total[group]}


def _sum(least: int):
    """Groups of one part that occur often enough, a row per block that holds them."""
    def run(table: pa.Table) -> pa.Table:
        cells = {c: [_from_planes(v) for v in table.column(c).to_pylist()] for c in ("a", "b", "code", "n")}
        a, code = (np.concatenate([np.cumsum(v) for v in cells[c]]) for c in ("a", "code"))
        b, n = (np.concatenate(cells[c]) for c in ("b", "n"))
        block = np.repeat(table.column("block").to_numpy(), [len(v) for v in cells["a"]])
        order, out = _often((a, b), block, code, n, least, table.column("part")[0].as_py())
        return pa.table({**out, "a": a[order], "b": b[order]}).select(FREQUENT_FIELDS)
    return run


def _sum_words(least: int):
    """The same for the words of one part; their strings stand in the first row of each."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("lang", "phrase")]
        block, code, n = (table.column(c).to_numpy() for c in ("block", "code", "n"))
        order, out = _often(tuple(keys), block, code, n, least, table.column("part")[0].as_py())
        some = pa.array(np.where(out["first"], order, 0), mask=~out["first"])
        return pa.table({**out, "lang": table.column("lang").take(some), "phrase": table.column("phrase").take(some)}).select(
            WORD_FIELDS)
    return run


def _kept(position, code, keep, ids, block):
    """Occurrences whose group is in `keep` (sorted codes), as a row of RELATION."""
    found = np.searchsorted(keep, code)
    yes = keep[np.minimum(found, len(keep) - 1)] == code if len(keep) else np.zeros(len(code), bool)
    steps = np.diff(position[yes], prepend=-1).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), _list(steps, pa.int32()), _list(found[yes].astype(np.int32), pa.int32()),
         _list(ids, pa.int64())], ["block", "steps", "codes", "ids"])


def _semi_join(extend: bool):
    """R(k + 1) from R(k) (or the first relation) and the frequent groups of each block."""
    def run(batches):
        for b in batches:
            steps, codes, ids, kept = (b.column(b.schema.get_field_index(c)) for c in ("steps", "codes", "ids", "kept"))
            for row in range(len(b)):
                lists = kept.slice(row, 1).flatten()
                order = np.argsort(lists.field(0).to_numpy(zero_copy_only=False))
                keep, new = (lists.field(f).to_numpy(zero_copy_only=False)[order] for f in (0, 1))
                s, c = _numbers(steps, row), _numbers(codes, row)
                if extend:
                    position, code, *_ = _neighbours(s, c, len(_numbers(ids, row)))
                else:
                    position, code = np.cumsum(s), c
                yield _kept(position, code, keep, new, b.column(0)[row].as_py())
    return run


def _numbered(frequent: DataFrame) -> DataFrame:
    """`frequent`, a written table, with `id`: groups numbered from 0 through all parts. The driver sees a count per part."""
    counts = {r.part: r.n for r in frequent.where("first").groupBy("part").agg(F.count("*").alias("n")).collect()}
    starts = accumulate((counts.get(p, 0) for p in range(max(counts, default=0) + 1)), initial=0)
    before = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")  # folded to one literal
    return frequent.withColumn("id", F.get(before, F.col("part").cast("int")) + F.col("place"))


def _lists(frequent: DataFrame) -> DataFrame:
    return frequent.groupBy("block").agg(F.collect_list(F.struct("code", "id")).alias("kept"))


def frequent_phrases(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, text_col: str = "text",
                     lang_col: str = "lang", block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to `longest` words that occur `least` times, and (lang, n) of words."""
    named = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    first = materialise(named.mapInArrow(_first_relation(block_words), FIRST), "phrases-words", FILE_BLOCKS)
    words = first.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select(
        "block", "lang", "code", F.col("w.words").alias("phrase"), F.col("w.counts").cast("long").alias("n"))
    totals = materialise(first.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
                         .groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    n_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_words // PART_ENTRIES)
    dealt = words.withColumn("part", F.pmod(F.xxhash64("lang", "phrase"), F.lit(parts)))
    frequent = _numbered(materialise(dealt.groupBy("part").applyInArrow(_sum_words(least), WORDS), "phrases-1"))
    groups = frequent.where("first").select("id", "lang", "phrase", F.col("phrase").alias("last"),
                                            F.array("phrase").alias("words"), "f")
    found = [groups]
    source = first.select("block", "steps", "codes", F.array().cast("array<long>").alias("ids"))
    for k in range(1, longest):
        joined = source.join(_lists(frequent), "block")
        relation = materialise(joined.mapInArrow(_semi_join(k > 1), RELATION), f"phrases-relation-{k}", FILE_BLOCKS)
        discard(first if k == 1 else source)  # the relation before this one
        counted = relation.mapInArrow(_count(parts), "part long, block long, a binary, b binary, code binary, n binary")
        frequent = _numbered(materialise(counted.groupBy("part").applyInArrow(_sum(least), FREQUENT), f"phrases-{k + 1}"))
        before, after = groups.select(F.col("id").alias("a"), "lang", "phrase", "words"), groups.select(
            F.col("id").alias("b"), "last")
        groups = (frequent.where("first").select("id", "a", "b", "f").join(before, "a").join(after, "b")
                  .select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
                          F.concat("words", F.array("last")).alias("words"), "f"))
        groups = materialise(groups, f"phrases-groups-{k + 1}")
        found.append(groups)
        source = relation
    discard(source)
    every = reduce(DataFrame.unionByName, [g.select("lang", "phrase", "words", "f") for g in found])
    return every, totals


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 absorb: tuple[int, int] = (100, 100), text_col: str = "text", lang_col: str = "lang",
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words.

    The score is the least, over all cuts in two, of floor(1000 a n / (l r)): how many thousandfold times more often the
    phrase occurs than its parts would meet by chance; of equal cuts the first counts. A phrase whose words lie inside a
    longer one goes if absorb[0] * f(longer) >= absorb[1] * f(phrase).
    """
    every, totals = frequent_phrases(docs, least=least, longest=longest, text_col=text_col, lang_col=lang_col,
                                     block_words=block_words)
    every = materialise(every, "phrases-all")
    counts = every.select("lang", "phrase", "f")
    some = every.where(F.size("words") > 1).withColumnRenamed("f", "a")

    # The longer phrases that hold a phrase: all their inner phrases, with the largest count of a holder.
    n = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice("words", i, k), " "))))
    holders = (some.where(n > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase")
               .agg(F.max("a").alias("held")))
    some = some.join(holders, ["lang", "phrase"], "left").where(
        F.col("held").isNull() | (absorb[0] * _wide(F.col("held")) < absorb[1] * _wide(F.col("a"))))

    part = lambda name, count: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = (some.join(totals, "lang").select("lang", "phrase", "words", "a", "n", F.explode(F.sequence(F.lit(1), n - 1)).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
                    F.array_join(F.slice("words", F.col("cut") + 1, n - F.col("cut")), " ").alias("right"))
            .join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]))
    above = F.lit(1000).cast("decimal(4,0)") * _wide(F.col("a")) * F.col("n").cast("decimal(15,0)")
    cuts = cuts.select("lang", "phrase", "a", "n", "cut", "l", "r", above.alias("above"),
                       (_wide(F.col("l")) * F.col("r").cast("decimal(18,0)")).alias("below"))
    scored = (cuts.withColumn("score", F.expr("above div below"))  # whole-number division of up to 38 digits
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score"))

    # The first of each share of a language, then of the language: no task orders all phrases of one.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))
    firsts = scored.withColumn("place", place).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    return firsts.select("lang", rank.cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)
