"""SHA-256 of raw files of any size, in bounded memory, through Spark's own readers.

Spark's binary reader hands over whole files (at most 2 GB each). Its text reader hands over the stretches between two
marks, as they are and from any store. They pass in small pieces to one task per file, which takes them in
order. The chain of a SHA-256 is sequential, so that task sees the whole file, but holds a piece at a time. What was read
is compared with the file's size: a file that the text reader did not hand over byte for byte gets no digest here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Smaller files are read whole, which needs no shuffle.
WHOLE_BYTES = 32 << 20
#: The text reader drops these bytes at the start of a file.
BOM = b"\xef\xbb\xbf"
#: Ways to read a file, tried in turn: the mark, and what the reader dropped at the start.
WAYS = ((b"\n", b""), (b"\n", BOM), (b"\0", b""), (b"\0", BOM))
#: A file with a longer stretch without the mark is left to the next way.
STRETCH_BYTES = 8 << 20
PIECE_BYTES = 128 << 10
LONGEST = "mapreduce.input.linerecordreader.line.maxlength"
PIECE = "file string, size long, start long, n long, data binary"


def file_of() -> Column:
    """A file's address, the same for every reader."""
    return F.col("_metadata.file_path")


def ending_of() -> Column:
    return F.regexp_extract("_metadata.file_name", r"\.[^.]*$", 0)


def unpacked_by_reader(spark: SparkSession, endings: Iterable[str]) -> list[str]:
    """Those of the endings by which the text reader takes a file for a compressed one, and unpacks it."""
    hadoop = spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark._jsparkSession.sessionState().newHadoopConf())
    return [x for x in endings if codecs.getCodec(hadoop.fs.Path(f"file{x}")) is not None]


def digests(spark: SparkSession, path: str, keep: Column, mark: bytes, head: bytes) -> DataFrame:
    """(file, digest) of the files under `path` that `keep` names and that can be read in this way."""
    read = spark.read.schema("stretch string").option("lineSep", mark.decode()).option(LONGEST, STRETCH_BYTES)
    meta = F.col("_metadata")
    stretches = read.format("text").load(path).where(keep).select(
        meta.file_path.alias("file"), meta.file_size.alias("size"), meta.file_block_start.alias("start"),
        F.col("stretch").cast("binary").alias("stretch"))
    pieces = stretches.mapInArrow(_pieces(mark, STRETCH_BYTES), PIECE)
    return (pieces.repartition("file").sortWithinPartitions("file", "start", "n")
            .mapInArrow(_chains(mark, head), "file string, digest string"))


def _pieces(mark: bytes, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stretches, each after a mark, joined and cut into pieces; no data where the reader may have cut a stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            code, start = (x.to_numpy(zero_copy_only=False) for x in (b.column(0).dictionary_encode().indices, b.column(2)))
            ends = np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1
            for i, j in zip([0, *ends], [*ends, b.num_rows]):
                own = b.column(3).slice(i, j - i)
                if pc.max(pc.binary_length(own)).as_py() >= longest - 1:
                    parts = [None]
                else:
                    row = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
                    data = mark + pc.binary_join(row, pa.scalar(mark, own.type))[0].as_py()
                    parts = [data[k:k + PIECE_BYTES] for k in range(0, len(data), PIECE_BYTES)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.repeat(b.column(k)[i], len(parts)) for k in range(3)),
                     pa.array(range(n, n + len(parts)), pa.int64()), pa.array(parts, pa.binary())],
                    ["file", "size", "start", "n", "data"])
                n += len(parts)

    return run


def _chains(mark: bytes, head: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The digest of each file whose pieces, in order, have its size; a mark at its end is no stretch of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, chain, left, cut = None, None, 0, False

        def ended() -> Iterator[pa.RecordBatch]:
            if file is not None and not cut and left in (0, len(mark)):
                chain.update(mark[:left])
                yield pa.RecordBatch.from_pydict({"file": [file], "digest": [chain.hexdigest()]})

        for b in batches:
            for name, size, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4)):
                first = name != file
                if first:
                    yield from ended()
                    file, chain, left, cut = name, hashlib.sha256(head), size - len(head) + len(mark), False
                if not data.is_valid:
                    cut = True
                    continue
                part = memoryview(data.as_buffer())
                left -= len(part)
                chain.update(part[len(mark):] if first else part)
        yield from ended()

    return run
