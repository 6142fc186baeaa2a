"""Exact duplicates by content sort, in DataFrame operations only.

Sampled splitters range-partition the normalised bytes (their first bytes, then a hash, so that keys sampled on the
driver stay short); the external sort inside each range puts equal texts side by side; neighbouring rows are compared
in full. A group too large for its share of one range is cut into pieces first, and only one row per piece takes part
in a second full comparison.

Nulls in the text count as the empty text, which is a text like any other. A null id is never the one that stays
unless its whole group has none. Rows repeated with one id are all kept if that id stays. An empty table gives an empty
result. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.sources.storage import materialise

#: Bytes of the text that range splitters see.
PREFIX_BYTES = 32


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 normalise=None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    `keep` is "smallest" or "largest": the id that stays of equal texts. `normalise` maps the text column to the column
    that is compared (default: no change).
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("content"))
    keyed = keyed.select("doc_id", "content", F.xxhash64("content").alias("h"))

    # Hot groups: those above a quarter of an even partition. There are at most 4 x partitions of them.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = keyed.groupBy("h").agg(F.count("*").alias("n"))
    share = F.greatest(F.lit(64), F.ceil(F.lit(keyed.count() / (4 * parts))))
    hot = materialise(counts.where(F.col("n") > share)
                      .select("h", F.ceil(F.col("n") / share).cast("int").alias("pieces")), "exact-hot")
    salted = (keyed.join(F.broadcast(hot), "h", "left")
              .select("doc_id", "content", "h", F.substring(F.encode("content", "UTF-8"), 1, PREFIX_BYTES).alias("head"),
                      F.when(F.col("pieces").isNull(), F.lit(-1))
                      .otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int")).alias("piece")))

    near = Window.partitionBy("head", "h", "piece", "content")
    rows = (salted.repartitionByRange("head", "h", "piece")
            .withColumn("part_best", best("doc_id").over(near)).withColumn("part_n", F.count(F.lit(1)).over(near))
            .withColumn("place", F.row_number().over(near.orderBy("doc_id")))
            .select("doc_id", "h", "piece", "part_best", "part_n", F.sha2("content", 256).alias("text_sha256"),
                    F.when((F.col("piece") >= 0) & (F.col("place") == 1), F.col("content")).alias("sample")))
    rows = materialise(rows, "exact-rows")

    # One row per piece of a hot group; again compared in full. Their number is bounded by the number of pieces.
    whole = Window.partitionBy("sample")
    pieces = (rows.where("sample IS NOT NULL")
              .select("h", "piece", "text_sha256", best("part_best").over(whole).alias("all_best"),
                      F.sum("part_n").over(whole).alias("all_n")))
    keep_id = F.when(F.col("piece") < 0, F.col("part_best")).otherwise(F.col("all_best"))
    return (rows.join(F.broadcast(pieces), ["h", "piece", "text_sha256"], "left")
            .select("doc_id", keep_id.alias("keep_id"),
                    F.coalesce("all_n", "part_n").cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256"))
