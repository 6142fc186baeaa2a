"""Removal of repeated byte strings by sampled places and recursive runs of windows.

This is not the dealt method: no order of suffixes and no common-prefix values are built. The README has the reason and figures.

A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text or another one.
Strings do not cross texts and are judged on the input.

The windows (suffixes cut to `length` bytes) are not sorted one by one: a sparse subset is grouped first and the others take
their verdict from it. The subset are the places that hold the smallest hash of any `GRAM`
bytes in some window (about one byte in 75). Equal windows hold it at the same offset, so a place stands for the run of
windows that hold it, and equal windows lie in runs of equal places. Runs are settled by recursion:

1. What all windows of a run have in common (their core; at first the gram) occurs once: none of them repeats.
2. What all of them cover together occurs twice, at the same offset from the place: all of them repeat.
3. Else one copy of the run is cut into shorter runs, at fixed offsets from the place, and these are settled likewise,
   down to single windows. Only runs in which a repeat begins or ends get that far.

Texts that are equal are one text; its copies go as a whole if it has `length` bytes. Verdicts are by 128-bit hash, the
core's by 64 bits, which can only cause needless work. Null and short texts keep everything; a null id keeps its row
and takes part. Rows that repeat are copies of each other; a very long text is hashed alone, in memory of some 30 bytes per
byte; other columns pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from panelcast.llm.hashing import GOLDEN, Substrings, chunks, mix, text_bytes
from panelcast.llm.shared import BATCH_BYTES, sized, small_batches
from panelcast.sources.storage import discard, materialise

LENGTH = 200
#: Bytes of a gram; a window of 200 bytes holds 151 of them.
GRAM = 50
#: Texts that a task remembers having sent.
SEEN = 100_000

#: Tables of keys are broadcast up to so many bytes; the rows they meet are narrow, so that a shuffle costs little.
NARROW = 1 << 20
#: Windows of the runs after the first cut; the second cut leaves single windows.
SHORT = 10

RUN = "text_key long, low long, high long, at long, single boolean, core long, area_a long, area_b long, spot long"


def minima(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Places, and their first and last window: (text, place, low, high) with positions in `data`."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    grams = n - gram + 1
    start = np.arange(grams)
    h = Substrings(data, 1).hash(start, start + gram)
    # Hash above, position below: the minimum is the smallest hash, ties to the left.
    key = (mix(h + GOLDEN) & np.uint64(0xFFFFFFFF00000000)) | start.astype(np.uint64)
    w = length - gram + 1
    blocks = -(-grams // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max)
    padded[:grams] = key
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(behind[:windows], ahead[w - 1: w - 1 + windows])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    ok = np.zeros(windows, bool)  # windows inside one text
    step = np.zeros(n + 1, np.int64)
    long = sizes >= length
    np.add.at(step, offsets[:-1][long], 1)
    np.add.at(step, offsets[1:][long] - length + 1, -1)
    ok = np.cumsum(step)[:windows] > 0
    low = np.flatnonzero(ok & np.concatenate(([True], (place[1:] != place[:-1]) | ~ok[:-1])))
    last = ok & np.concatenate((place[1:] != place[:-1], [True]))
    last[:-1] |= ok[:-1] & ~ok[1:]
    high = np.flatnonzero(last)
    return np.searchsorted(offsets, low, side="right") - 1, place[low], low, high


def _first_copies(batches):
    """Batches without the copies of texts that the task has met; what it remembers is bounded."""
    seen: set[int] = set()
    for b in batches:
        fresh = [not (x in seen or seen.add(x)) for x in b.column(0).to_pylist()]
        if len(seen) > SEEN:
            seen.clear()
        yield b if all(fresh) else b.filter(pa.array(fresh))


def _batch(keys, low, high, at, base, single, core, area, part, length):
    """Runs as rows. Positions are in `part`; the text's own start is `base`."""
    shape = (at - low).astype(np.uint64) * GOLDEN + (high - low).astype(np.uint64)
    end = high + length
    spot = mix(keys.view(np.uint64) + mix((low - base).astype(np.uint64) + GOLDEN))
    first, second = area
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(low - base), pa.array(high - base), pa.array(at - base), pa.array(single),
         pa.array(core.view(np.int64)), pa.array(mix(first.hash(low, end) + shape).view(np.int64)),
         pa.array(mix(second.hash(low, end) ^ shape).view(np.int64)), pa.array(spot.view(np.int64))],
        ["text_key", "low", "high", "at", "single", "core", "area_a", "area_b", "spot"])


def _places(length: int, gram: int):
    def run(batches):
        for b in _first_copies(batches):
            keys = b.column(0).to_numpy()
            data, offsets = text_bytes(b.column(1))
            for i, j in chunks(offsets):
                own = offsets[i: j + 1] - offsets[i]
                part = data[offsets[i]: offsets[j]]
                text, place, low, high = minima(part, own, length, gram)
                area = Substrings(part, 0), Substrings(part, 1)
                yield _batch(keys[i:j][text], low, high, place, own[text], np.ones(len(text), bool),
                             area[1].hash(place, place + gram), area, part, length)
    return run


def _pieces(length: int):
    """The bytes that each text's runs cover, end to end, and where these pieces stand: (text_key, text, pieces, runs)."""
    def run(batches):
        for b in _parts(_first_copies(batches)):
            data, offsets = text_bytes(b.column(1))
            items = b.column(2).flatten()
            text = np.repeat(np.arange(len(b)), np.diff(b.column(2).offsets.to_numpy()))
            low, high = (offsets[text] + items.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
            order = np.argsort(low, kind="stable")  # also by text
            text, low, end = text[order], low[order], high[order] + length
            far = np.maximum.accumulate(end)
            fresh = np.concatenate(([True], (text[1:] != text[:-1]) | (low[1:] > far[:-1])))[: len(low)]
            start, stop = low[fresh], far[np.concatenate((fresh[1:], [True]))[: len(low)]]
            count = np.bincount(text[fresh], minlength=len(b))
            begin = np.concatenate(([0], np.cumsum(stop - start)))
            edges = np.concatenate(([0], np.cumsum(count)))
            inside = np.zeros(len(data) + 1, np.int8)
            inside[start] += 1
            inside[stop] -= 1  # where the next text's piece may start
            kept = data[np.cumsum(inside, dtype=np.int8)[:-1].view(bool)]
            pieces = pa.StructArray.from_arrays([pa.array(start - offsets[text[fresh]]), pa.array(stop - start)], ["start", "size"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer(begin[edges].astype(np.int32)), pa.py_buffer(kept)]),
                 pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pieces), b.column(2)],
                ["text_key", "text", "pieces", "runs"])
    return run


def _cut_runs(length: int, step: int):
    """Runs of each text, given by its pieces, cut into runs of `step` windows, at multiples of `step` from the place."""
    def run(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            data, offsets = text_bytes(b.column(1))
            first_piece, pieces = b.column(2).offsets.to_numpy(), b.column(2).flatten()
            start, size = (pieces.field(c).to_numpy(zero_copy_only=False) for c in ("start", "size"))
            first_run, items = b.column(3).offsets.to_numpy(), b.column(3).flatten()
            columns = [items.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "at", "single")]
            for i, j in chunks(offsets):
                part = data[offsets[i]: offsets[j]]
                area = Substrings(part, 0), Substrings(part, 1)
                text = np.repeat(np.arange(j - i), np.diff(first_run[i: j + 1]))
                low, high, at, single = (c[first_run[i]: first_run[j]] for c in columns)
                base = _origins(i, j, text, low, first_piece, start, size)
                near, far = (at - high) // step, (at - low) // step
                n = far - near + 1
                row = np.repeat(np.arange(len(n)), n)
                block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[row]
                base, at = base[row], at[row]
                last, first = at - block * step, at - block * step - step + 1
                # The bytes that the block's windows share, whether or not all of them belong to the run.
                core = area[1].hash(base + last, base + first + length)
                low, high = np.maximum(low[row], first), np.minimum(high[row], last)
                core = mix(core + block.astype(np.uint64) * GOLDEN)
                for k in range(0, len(low), 100_000):
                    s = slice(k, k + 100_000)
                    yield _batch(keys[i:j][text[row[s]]], base[s] + low[s], base[s] + high[s], base[s] + at[s], base[s],
                                 single[row[s]], core[s], area, part, length)
    return run


def _origins(i: int, j: int, text, low, first_piece, start, size) -> np.ndarray:
    """Where the text of each run would start in the bytes of texts i to j, going by the piece that holds the run."""
    start, size = (c[first_piece[i]: first_piece[j]] for c in (start, size))
    of = np.repeat(np.arange(j - i), np.diff(first_piece[i: j + 1]))
    # Pieces and runs by text, then position; a run's piece is the last that does not start after it.
    both = np.lexsort((np.repeat((0, 1), (len(of), len(text))), np.concatenate((start, low)), np.concatenate((of, text))))
    piece = np.maximum.accumulate(np.where(both < len(of), both, 0))
    runs = both >= len(of)
    at = np.zeros(len(text), np.int64)
    at[both[runs] - len(of)] = piece[runs]
    return (np.cumsum(size) - size - start)[at]


def merged(intervals: DataFrame) -> DataFrame:
    """(text_key, spans): the maximal runs covered by (text_key, low, high), high excluded, sorted."""
    line = Window.partitionBy("text_key").orderBy("low", "high")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("low") > F.max("high").over(before), F.lit(True)).cast("int")
    runs = (intervals.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(line))
            .groupBy("text_key", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    return runs.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, text_col: str = "text") -> DataFrame:
    """(text_key, copies, spans) of every distinct text with repeats; `text_key` is `key_of` its text."""
    texts = docs.select(key_of(F.col(text_col)).alias("text_key"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    copies = materialise(texts.where(F.octet_length("text") >= length).groupBy("text_key")
                         .agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).cast("long").alias("size"))
                         .where("copies > 1"), "suffix-copies")
    spans, runs = _settled(texts.mapInArrow(_places(length, gram), RUN), "places")
    parts = [spans]
    # The texts move once, to meet their runs; what is cut after that are the pieces that runs cover.
    schema = f"text_key long, text binary, pieces array<struct<start long, size long>>, runs {runs.schema['runs'].dataType.simpleString()}"
    covered = pieces = materialise(texts.join(runs, "text_key").select("text_key", "text", "runs").mapInArrow(_pieces(length), schema),
                                   "suffix-pieces")
    for step, name in ((SHORT, "short"), (1, "single")):
        spans, runs = _settled(covered.mapInArrow(_cut_runs(length, step), RUN), name)
        parts.append(spans)
        covered = pieces.drop("runs").join(runs, "text_key")
    discard(pieces)
    all_spans = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("high", F.col("high") + length)
    known = copies.select("text_key", F.lit(0).cast("long").alias("low"), F.col("size").alias("high"))
    return merged(all_spans.unionByName(known))


def _settled(runs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Runs that repeat as a whole (text_key, low, high), and per text the runs to be cut further.

    A position counts once, however many copies of its text send it. Groups combine before each shuffle.
    """
    shared = (runs.groupBy("core").agg(F.min("spot").alias("x"), F.max("spot").alias("y")).where("x <> y")
              .select("core"))
    left = materialise(runs.join(sized(materialise(shared, f"suffix-{name}-cores"), 0, NARROW), "core"), f"suffix-{name}-runs")
    areas = (left.groupBy("core", "area_a", "area_b")
             .agg(F.min("spot").alias("x"), F.max("spot").alias("y"), F.max("single").alias("single"))
             .select("core", "area_a", "area_b", "x", (F.col("x") != F.col("y")).alias("several"), "single"))
    areas = materialise(areas, f"suffix-{name}-areas")
    several = sized(materialise(areas.where("several AND single").select("area_a", "area_b"), f"suffix-{name}-several"), 48, NARROW)
    spans = left.where("single").join(several, ["area_a", "area_b"]).select("text_key", "low", "high")
    # One copy of each different area of a core is cut if one of them has no equal and waits for a verdict.
    waits = ~F.col("several") & F.col("single")
    open_ = areas.groupBy("core").agg(F.count("*").alias("n"), F.max(waits).alias("any"))
    open_ = sized(materialise(open_.where("n > 1 AND any").select("core"), f"suffix-{name}-open"), 0, NARROW)
    speaks = areas.join(open_, "core").select(F.col("x").alias("spot"), waits.alias("waits"))
    speaks = sized(materialise(speaks, f"suffix-{name}-speaks"), 8, NARROW)
    cut = (left.join(speaks, "spot").groupBy("text_key", "spot")
           .agg(*(F.first(c).alias(c) for c in ("low", "high", "at", "waits"))))
    run = F.struct("low", "high", "at", F.col("waits").alias("single"))
    return spans, materialise(cut.groupBy("text_key").agg(F.collect_list(run).alias("runs")), f"suffix-{name}-cut")


def key_of(text: Column) -> Column:
    """A number that stands for a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(9))


def _parts(batches):
    """Batches cut so that the texts of one, and what is made of them, are bounded."""
    for b in batches:
        for i, j in chunks(text_bytes(b.column(1))[1], BATCH_BYTES):
            yield b.slice(i, j - i)


def _cut(whole: bool):
    def run(batches):
        for b in _parts(batches):
            data, offsets = text_bytes(b.column(1))
            removed, kept = [], []
            spans = b.column(2).to_pylist()
            for i, found in enumerate(spans):
                text = data[offsets[i]: offsets[i + 1]]
                keep = np.ones(len(text), bool)
                for s in found or ():
                    keep[s["low"]: s["high"]] = False
                removed.append(int(len(text) - keep.sum()))
                left = text[keep].tobytes()
                kept.append(left.decode("utf-8", "ignore").encode() if whole and removed[-1] else left)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array([len(s or ()) for s in spans], pa.int64()), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def without_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, text_col: str = "text",
                    carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Every row of `docs`, its columns (or those in `carry`) in the struct `row`, with n_bytes, n_removed, n_spans and
    the bytes left, `kept`. With `whole`, a character that lost some of its bytes goes from `kept`."""
    with small_batches(docs.sparkSession):
        found = materialise(repeated_spans(docs, length=length, gram=gram, text_col=text_col), "suffix-spans")
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), key_of(F.col(text_col)).alias("text_key"),
                       F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("bytes"))
    joined = rows.join(found, "text_key", "left").select("row", "bytes", "spans")
    schema = StructType([joined.schema["row"], *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                         StructField("kept", BinaryType())])
    return joined.mapInArrow(_cut(whole), schema)
