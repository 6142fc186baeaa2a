"""Helpers shared by the operators: joins behind a size check, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.sources.storage import BATCH_BYTES, BATCH_SETTING, discard, materialise, small_batches  # noqa: F401

#: A side of a join is broadcast only if it was written, counted, and has at most so many bytes of plain values. The driver
#: holds it some times over (rows, hash table, blocks), and earlier ones until they are collected.
BROADCAST_BYTES = 8 << 20
ROW_OVERHEAD = 48


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, a written table, marked for broadcast if its counted rows stay within `limit`; else left to a shuffle.

    A row in a hash table takes about `ROW_OVERHEAD` bytes beside its values.
    """
    return F.broadcast(df) if df.count() * (row_bytes + ROW_OVERHEAD) <= limit else df


def without_ids(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """`docs` without the ids in `gone` (one column `key`, written by the caller)."""
    return docs.join(sized(gone, 16), key, "left_anti")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in `edges` (a, b); root is the smallest node reachable.

    Alternating stars: each round hangs the larger neighbours of a node, then the smaller ones, on its smallest
    neighbour. Minima combine before the shuffle, a hot node's join is split by adaptive execution, and each round is
    a written table, so neither lineage nor driver state grows. Stops when a round changes nothing.
    """
    star = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), name)
    seen = None
    while True:
        both = star.select("u", "v").unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        last, star = star, materialise(small, name)
        discard(last)
        state = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def with_roots(star: DataFrame) -> DataFrame:
    """`components` with the roots' own rows added."""
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
