"""Reproducible shuffle into shards by a Feistel permutation over global row numbers.

Rows are numbered 0 to n - 1 in the order of (id, checksum, size): range partitions are numbered inside, their counts
are summed, and a row's number is its partition's start plus its place there. A balanced Feistel network permutes the
smallest even-bit domain that holds n; numbers that leave [0, n) walk on along their cycle until they are back, which
keeps the permutation exact. The permuted number gives the shard (remainder) and the slot (quotient), so shard sizes
differ by one row at most and a row's place can be computed from its number alone, without any table.

Null text has no bytes (size 1, checksum 0); null ids come first in the order. Rows that repeat get places of their
own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.sources.storage import materialise

ROUNDS = 4
#: Odd multipliers below 2^31, one a round; any values give a permutation.
MULTIPLIERS = (1_540_483_477, 668_265_261, 374_761_393, 1_103_515_245)


def half_bits(n: int) -> int:
    """Bits of each half of the smallest domain that holds n rows."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def feistel(x: np.ndarray, bits: int, key: int) -> np.ndarray:
    """One pass of the network over 2 x bits wide numbers."""
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for r in range(ROUNDS):
        value = (right + np.uint64(key + r + 1)) * np.uint64(MULTIPLIERS[r]) % np.uint64(1 << 32)
        left, right = right, left ^ ((value ^ (value >> np.uint64(15))) & low)
    return (left << np.uint64(bits)) | right


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The place of each row number under the cycle-walking permutation of [0, n)."""
    bits = half_bits(n)
    y = feistel(x.astype(np.uint64), bits, key)
    out = np.flatnonzero(y >= n)
    while len(out):
        y[out] = feistel(y[out], bits, key)
        out = out[y[out] >= n]
    return y.astype(np.int64)


def permuted(number: Column, n: int, key: int) -> Column:
    @F.arrow_udf("long")
    def place(rows: pa.Array) -> pa.Array:
        return pa.array(permute(rows.to_numpy(zero_copy_only=False), n, key))

    return place(number)


def numbered(rows: DataFrame, order: list[str], name: str = "numbered") -> DataFrame:
    """`rows`, written, with `row_number` from 0 without gaps in the given order, by range partitions."""
    ranged = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = materialise(ranged, name)
    # One row per partition.
    starts = (ranged.groupBy("_part").agg(F.count("*").alias("_n"))
              .select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start")))
    return (ranged.join(F.broadcast(starts), "_part")
            .withColumn("row_number", F.col("_start") + F.col("_place")).drop("_part", "_place", "_start"))


def shard(docs: DataFrame, n_shards: int, *, key: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row."""
    content = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"),
                       F.crc32(content).alias("text_crc32"))
    rows = numbered(rows, ["doc_id", "text_crc32", "size"], "shard-rows")
    n = rows.count()
    place = rows.withColumn("place", permuted(F.col("row_number"), n, key))
    return place.select("doc_id", "size", "text_crc32", "row_number",
                        F.pmod("place", F.lit(n_shards)).cast("int").alias("shard"),
                        F.floor(F.col("place") / n_shards).alias("slot"))
