"""A corpus from raw documents to packed sequences, in five stages, each on all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last keep the columns of `documents`.

1. language: rejects texts without language (no letters) and texts that resemble no learned language.
2. exact: of equal texts the row with the smallest id stays, one row whatever the ids.
3. near: of each group of near duplicates (five-word shingles, Jaccard 0.8) the row with the smallest id stays.
4. repeats: bytes of passages of 200 bytes and more that occur elsewhere among the rows left go, and a character that
   loses some of its bytes goes as a whole. Rows stay, with the text that is left.
5. packing: rows are cut into pieces of full sequences.

Stages 2 and 3 choose rows, not ids: rows that repeat with one id are copies of each other, one of them stays, and a row
goes without the other rows of its id. Rows without an id stay only if no row of their group has one. Null texts are
rejected by the first stage. Empty input gives empty output at every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, exact_dedup, langid, ngram_join, packing, suffix_dedup
from panelcast.llm.queries import END_ID, documents, tokenizer_path
from panelcast.llm.shared import sized, small_batches, without_ids
from panelcast.sources.storage import materialise

#: A text of n characters stays with a confidence (score x letters among letters and digits) of n ** -SHORT at least, but
#: never less than LEAST or more than MOST: one cut that falls with the length, without a step. See `confident`.
LEAST, SHORT, MOST = 0.24, 1 / 3, 0.45

#: The column that tells rows apart where ids do not, unless they are alike in all columns.
ROW = "_pipeline_row"
#: The column that stands for a text.
TEXT = "_pipeline_text"
#: The column that tells empty texts from none.
NO_TEXT = "_pipeline_no_text"


def confident(text: Column, score: Column) -> Column:
    """Whether a text scores as language does.

    Digits count against a text because hex leaves a few short groups of letters that every profile knows. Over the
    10,000 rows of `documents` at sf0.1, all labelled (profiles of the first 4,000), confidence by length in characters
    is at least, and at the first percentile: below 20: 0.46, 0.52; to 40: 0.41, 0.41; to 80: 0.32, 0.42; to 200: 0.18,
    0.28; to 1,000: 0.41, 0.52; to 5,000: 0.44, 0.60; above: 0.42, 0.69. One row falls below the cut (card number and
    hex token, 0.18). Noise, 1,000 texts of each length to 200 and 40 of the longer ones, at most at 20 / 40 / 80 / 100 /
    200 / 1,000 / 20,000 characters: letters 0.38 / 0.30 / 0.22 / 0.19 / 0.14 / 0.17 / 0.16; base64 0.42 / 0.32 / 0.26 /
    0.22 / 0.17 / 0.18 / 0.18; hex 0.34 / 0.26 / 0.19 / 0.18 / 0.12 / 0.06 / 0.03; letters in words 0.47 / 0.35 / 0.28 /
    0.28 / 0.19 / 0.22 / 0.21. So from 200 characters on the cut of 0.24 lies above all noise and below all prose but the one
    row. Below, what passes is 2 % of base64 and 13 % of letters in words at 40 characters, 0.3 % and 7 % at 80; of 1,500
    cuts of documents none is lost at 10 to 80 characters, and 7 at 5. Shorter noise cannot be told from prose by its n-grams.
    """
    letters, digits = (F.length(F.regexp_replace(text, other, "")) for other in (r"\P{L}+", r"\P{Nd}+"))
    n = F.length(text)
    least = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.pow(n.cast("double"), F.lit(-SHORT))))
    return score * letters / (letters + digits) >= least


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # What goes is written as keys of texts, so that texts pass to Python in small batches here, whoever writes the result.
    profiles = langid.train(docs)
    key = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(TEXT), "text").alias("b"))
    docs = docs.where(F.col("text").isNotNull()).withColumn(TEXT, key)  # null texts have no language
    found = docs.select(TEXT, "text", langid.predict(F.col("text"), profiles).alias("p"))
    stays = (F.col("p.lang") != langid.UNKNOWN) & confident(F.col("text"), F.col("p.score"))
    with small_batches(spark):
        gone = materialise(found.where(~F.coalesce(stays, F.lit(False))).select(TEXT).distinct(), "pipeline-no-language")
    return without_ids(docs, gone, TEXT).drop(TEXT)


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a column ROW that orders the rows by id, nulls last, and is equal only in rows alike in all columns.

    It follows from the row's content (two 64-bit hashes, the second also of which columns are null), so nothing is written.
    """
    nulls = F.concat(*(F.col(c).isNull().cast("string") for c in docs.columns))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                   F.xxhash64(*docs.columns).alias("content"), F.xxhash64(nulls, *docs.columns).alias("again"))
    return docs.withColumn(ROW, row)


def without_rows(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """`numbered` rows but those in `gone`; of rows alike in all columns one."""
    left = without_ids(docs, materialise(gone.select(F.col("doc_id").alias(ROW)), name), ROW)
    twins = materialise(docs.groupBy(ROW).agg(F.count("*").alias("n")).where("n > 1").select(ROW), f"{name}-twins")
    if not twins.isEmpty():
        once = left.join(sized(twins, 40), ROW, "left_semi").dropDuplicates([ROW])
        left = without_ids(left, twins, ROW).unionByName(once)
    return left.drop(ROW)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = numbered(docs)
    return without_rows(docs, exact_dedup.exact_groups(docs, id_col=ROW).where("NOT kept"), "pipeline-exact")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = numbered(docs)
    groups = ngram_join.jaccard_components(docs, k=5, num=8, den=10, id_col=ROW)
    return without_rows(docs, groups.where("doc_id <> component_id"), "pipeline-near")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The text passes once, as bytes; whether there was one goes with the row.
    rows = docs.withColumn(NO_TEXT, F.col("text").isNull())
    cut = suffix_dedup.without_repeats(rows, carry=[c for c in rows.columns if c != "text"], whole=True)
    left = F.when(~F.col(f"row.{NO_TEXT}"), F.col("kept").cast("string"))
    return (cut.select("row", left.alias("_left"))
            .select(*[F.col("_left").alias(c) if c == "text" else
                      F.length("_left").cast("long").alias(c) if c == "n_chars" else F.col(f"row.{c}")
                      for c in docs.columns]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, bpe.encode(F.col("text"), tokenizer_path()), end_id=END_ID)
    with small_batches(spark):
        return materialise(pieces.withColumn("ids_crc32", packing.ids_crc32(F.col("ids"))).drop("ids"), "pipeline-pieces")


STAGES = [("language", language), ("exact", exact), ("near", near), ("repeats", repeats), ("packing", pack)]

#: Profiles, component search and tokens are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
