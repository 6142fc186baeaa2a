"""Snapshot lake, stored tables, run outputs and lineage, all as plain Spark writes on a shared path."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime, timezone
from functools import reduce
from typing import TypeVar
from weakref import WeakKeyDictionary

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.schemas import RUN_TABLES, TABLES, schema_of
from panelcast.sources import digests

T = TypeVar("T")
POINTER = "_latest"
PROVENANCE = schema_of("run_id string", "source string", "kind string", "detail string", "ts timestamp")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder; where none is set, under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/stages"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]


#: The folder behind each frame that `materialise` returned and that is still in use.
_STAGES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


#: Spark removes an execution's shuffle files at its end, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go with them. A caller's own setting holds; frames computed later are left alone."""
    if spark.conf.get(SHUFFLES_GO, None) is not None:  # also by another thread: then these files may stay a while
        yield
        return
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO)


#: Bytes of an Arrow batch between Spark and Python where texts, token lists or raw bytes pass. Task and worker each hold it
#: some times over.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Writes inside hand at most about `BATCH_BYTES` to Python at once; the session's setting is put back after.

    Results do not depend on it. It does not reach frames that are computed later.
    """
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


def materialise(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Cut lineage by writing the frame to the shared folder and reading it back; at most `file_rows` rows a file, if set.

    What was shuffled for it is not read again once it is written, and is removed.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _STAGES[written] = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete the folders of frames that `materialise` returned, once nothing that is still to be computed reads them.

    What was written from them meanwhile stands on its own, so a lost executor needs no deleted stage. Other frames are
    left alone.
    """
    for df in written:
        if path := _STAGES.pop(df, None):
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def iteration_input(df: DataFrame, name: str) -> DataFrame:
    """Input of an iterative fit: written once, then cached. A lost executor re-reads its part."""
    return materialise(df, name).persist(StorageLevel.MEMORY_AND_DISK)


def _only_missing(exc: AnalysisException) -> None:
    """An absent path means "nothing stored yet"; any other fault is raised again."""
    if exc.getCondition() != "PATH_NOT_FOUND":
        raise exc


# ---------------------------------------------------------------- snapshots

def write_snapshot(df: DataFrame, lake: str, dataset: str, snapshot: str | None = None) -> str:
    """Write one dated snapshot (a rerun of the day replaces it), then move the latest pointer.

    The pointer is written last, so a failed load never becomes "latest".
    """
    snapshot = snapshot or date.today().isoformat()
    base = f"{lake}/{dataset}"
    (df.withColumn("snapshot_date", F.lit(snapshot)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(base))
    pointer = df.sparkSession.createDataFrame([(snapshot,)], "value string")
    pointer.coalesce(1).write.mode("overwrite").text(f"{base}/{POINTER}")
    return snapshot


def latest_snapshot(spark: SparkSession, lake: str, dataset: str) -> str | None:
    try:
        row = spark.read.text(f"{lake}/{dataset}/{POINTER}").first()
    except AnalysisException as exc:
        _only_missing(exc)
        return None
    return row.value.strip() if row else None


def _snapshots(spark: SparkSession, lake: str, dataset: str) -> DataFrame:
    # Snapshot labels are strings; without this setting the reader would guess a date type.
    return spark.read.option("mergeSchema", "false").parquet(f"{lake}/{dataset}").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("string"))


def read_snapshot(spark: SparkSession, lake: str, dataset: str, snapshot: str) -> DataFrame:
    """One snapshot; the literal filter prunes to its partition."""
    stored = spark.read.parquet(f"{lake}/{dataset}")
    return stored.where(F.col("snapshot_date") == snapshot).drop("snapshot_date")


def read_latest(spark: SparkSession, lake: str, dataset: str) -> DataFrame:
    snapshot = latest_snapshot(spark, lake, dataset)
    if snapshot is None:
        raise FileNotFoundError(f"no snapshot for dataset {dataset!r} in the lake")
    return read_snapshot(spark, lake, dataset, snapshot)


def list_snapshots(spark: SparkSession, lake: str, dataset: str) -> DataFrame:
    """Sorted snapshot labels; empty when the dataset is absent. Answered from partition metadata."""
    try:
        stored = _snapshots(spark, lake, dataset)
    except AnalysisException as exc:
        _only_missing(exc)
        return spark.createDataFrame([], "snapshot_date string")
    return stored.select("snapshot_date").distinct().orderBy("snapshot_date")


# ---------------------------------------------------------------- stored tables

def table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as exc:
        _only_missing(exc)
        return False
    return True


def init_tables(spark: SparkSession, root: str, tables: Mapping[str, StructType] = TABLES) -> None:
    """Create the missing tables, empty, with their declared types. Run tables begin with their first run."""
    for name, schema in tables.items():
        if name not in RUN_TABLES and not _exists(spark, table_path(root, name)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(table_path(root, name))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table; one that was never written is empty. A run_id filter prunes to its partition."""
    schema = TABLES[table]
    try:
        return spark.read.schema(schema).parquet(table_path(root, table)).select(*schema.fieldNames())
    except AnalysisException as exc:
        _only_missing(exc)
        return spark.createDataFrame([], schema)


def together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark actions side by side, so that small ones fill the cluster together."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def to_table_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Shared columns by name, cast to the table's types; absent ones NULL, extra ones dropped."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def replace_table(df: DataFrame, root: str, table: str) -> None:
    """Full refresh of a table."""
    to_table_schema(df, TABLES[table]).write.mode("overwrite").parquet(table_path(root, table))


def append_run(df: DataFrame, root: str, table: str) -> None:
    """Add a run's rows to a run table."""
    to_table_schema(df, TABLES[table]).write.mode("append").partitionBy("run_id").parquet(table_path(root, table))


def replace_run(df: DataFrame, root: str, table: str, run_id: str) -> None:
    """Idempotent load of one run: only that run's partition is replaced."""
    rows = to_table_schema(df, TABLES[table]).withColumn("run_id", F.lit(run_id))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(table_path(root, table)))


def fiscal_year(day: str):
    """April-to-March label such as 2018/19; the second part is not zero-padded."""
    y = F.year(day)
    start = F.when(F.month(day) >= 4, y).otherwise(y - 1)
    return F.concat(start.cast("string"), F.lit("/"), ((start + 1) % 100).cast("string"))


def build_dim_date(facts: Iterable[DataFrame]) -> DataFrame:
    """Calendar of all dates seen in the facts, de-duplicated per fact before the union."""
    days = None
    for fact in facts:
        part = fact.select("date").distinct()
        days = part if days is None else days.union(part)
    return days.where(F.col("date").isNotNull()).distinct().select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"), fiscal_year("date").alias("fiscal_year"))


def build_dim_trust(procedures: DataFrame) -> DataFrame:
    return procedures.select("trust_code", "region").where(F.col("trust_code").isNotNull()).distinct()


def query(frames: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Ad-hoc SQL over named frames."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(sql, **frames)


def query_tables(spark: SparkSession, root: str, sql: str, tables: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Ad-hoc SQL over the stored tables, which are registered as temporary views."""
    for name in tables:
        read_table(spark, root, name).createOrReplaceTempView(name)
    return spark.sql(sql)


# ---------------------------------------------------------------- lineage, provenance, artifacts

def raw_lineage(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Content hash (12 hex digits of SHA-256), size and landing stamp of raw files.

    Files above `digests.WHOLE_BYTES` are hashed piece by piece, whatever their size; of those only the ones that the
    text reader would unpack, or that have no mark for long, are held whole.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    raw = spark.read.format("binaryFile").load(path)
    digest = F.sha2("content", 256).alias("digest")
    if parts := _digests_in_pieces(spark, raw, path):
        pieces = reduce(DataFrame.unionByName, parts)
        done = digests.file_of().isin([r.file for r in pieces.select("file").collect()])
        found = raw.where(done).select(digests.file_of().alias("file"), "path", "length").join(pieces, "file")
        rows = raw.where(~done).select("path", "length", digest).unionByName(found.drop("file"))
    else:
        rows = raw.select("path", "length", digest)
    return rows.select(F.lit(source).alias("source"), "path", F.substring("digest", 1, 12).alias("digest"),
                       F.col("length").alias("bytes"), F.lit(stamp).alias("landed_at"))


def _digests_in_pieces(spark: SparkSession, raw: DataFrame, path: str) -> list[DataFrame]:
    """Written (file, digest) of the large files, by each way that was needed."""
    large = raw.where(F.col("_metadata.file_size") > digests.WHOLE_BYTES).select(
        digests.file_of().alias("file"), digests.ending_of().alias("ending")).collect()
    packed = digests.unpacked_by_reader(spark, {r.ending for r in large})
    left, parts = {r.file for r in large if r.ending not in packed}, []
    for mark, head in digests.WAYS:
        if left:
            with small_batches(spark):
                parts.append(materialise(
                    digests.digests(spark, path, digests.file_of().isin(sorted(left)), mark, head), "digests"))
            left -= {r.file for r in parts[-1].select("file").collect()}
    return parts


def record_provenance(
    spark: SparkSession, root: str, run_id: str, entries: Sequence[tuple[str, str, str]]
) -> None:
    """Append (source, kind, detail) of a run; a new run id starts a fresh set."""
    rows = spark.createDataFrame(list(entries), "source string, kind string, detail string").select(
        F.lit(run_id).alias("run_id"), "source", "kind", "detail", F.current_timestamp().alias("ts"))
    rows.write.mode("append").parquet(f"{root}/provenance")


def provenance(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """Latest record per source of a run, as ``kind (detail)``."""
    latest = spark.read.schema(PROVENANCE).parquet(f"{root}/provenance").where(F.col("run_id") == run_id).groupBy(
        "source").agg(F.max_by(F.struct("kind", "detail"), "ts").alias("p"))
    shown = F.when(F.coalesce("p.detail", F.lit("")) == "", F.col("p.kind")).otherwise(
        F.concat("p.kind", F.lit(" ("), "p.detail", F.lit(")")))
    return latest.select("source", shown.alias("provenance"))


def write_artifact(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """Per-run copy and the replaceable latest copy; the second is read from the first."""
    path = f"{root}/{name}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.read.parquet(path).write.mode("overwrite").parquet(f"{root}/{name}_latest")


def write_report(report: DataFrame, root: str, name: str, run_id: str) -> None:
    """One-row report as JSON, per run and latest; the second is read from the first."""
    path = f"{root}/{name}/run_id={run_id}"
    report.coalesce(1).write.mode("overwrite").json(path)
    report.sparkSession.read.schema(report.schema).json(path).coalesce(1).write.mode("overwrite").json(
        f"{root}/{name}_latest")
