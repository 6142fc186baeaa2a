"""Mixture-controlled packing into fixed-length sequences by deficit round-robin over source queues.

Every source is a queue of documents (each with an end token). The output is one stream of tokens cut into windows;
a window takes from every queue its share of the target mixture. Token counts are whole numbers, so a queue's quota in a
window is a rounded share: what rounding left over (its deficit) is carried, since the quota up to window w is the
rounded share of all windows so far. A queue that runs dry ends a phase and the others share its place in proportion.
Without targets the mixture is the corpus's own, all queues run dry together, and there is one phase.

All quotas are arithmetic, so a document's pieces follow from its queue position alone: partitions do not pass state on.
Positions are prefix sums in hash blocks, so that no task holds a source, however large. The stream is cut every
`length` tokens; only the last sequence is padded.

Null texts count as empty and hold only the end token. A null source is a queue of its own. Rows that repeat are packed
each; null ids too. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.shared import sized, small_batches
from panelcast.sources.storage import materialise

LENGTH = 4096
#: Tokens of a window: so many sequences, and so many tokens for each source at least.
WINDOW_SEQUENCES, WINDOW_TOKENS_A_SOURCE = 64, 64
#: Rows of a hash block that one task orders.
BLOCK_ROWS = 4096

PHASES = "array<struct<start:bigint,tokens:bigint,windows:bigint,first_window:bigint>>"


def phases_of(totals: Mapping[str, int], targets: Mapping[str, float], window: int) -> dict[str, list[tuple]]:
    """Per source its (queue start, tokens, windows, first window) in each phase, under the target proportions.

    Phases end where queues run dry. Sources without a target (or with 0) follow in their own proportion.
    """
    left = {s: n for s, n in totals.items() if n}
    done = dict.fromkeys(left, 0)
    out: dict[str, list[tuple]] = {s: [] for s in left}
    first = 0
    while left:
        weights = {s: Fraction(targets.get(s, 0)) for s in left}
        if not any(weights.values()):
            weights = {s: Fraction(n) for s, n in left.items()}
        active = {s: w for s, w in weights.items() if w > 0}
        end = min(left[s] / w for s, w in active.items())
        taken = {s: left[s] if left[s] / w == end else int(end * w) for s, w in active.items()}
        windows = max(1, -(-sum(taken.values()) // window))
        for s, n in taken.items():
            if n:
                out[s].append((done[s], n, windows, first))
                done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        first += windows
    return out


def quota(tokens: Column, windows: Column, w: Column) -> Column:
    """Tokens of a queue up to window `w` of its phase: the share, rounded to the nearest."""
    wide = lambda c: c.cast("decimal(19,0)")
    twice = wide(tokens) * wide(w) * F.lit(2).cast("decimal(1,0)") + wide(windows)
    return F.floor(twice / (wide(windows) * F.lit(2).cast("decimal(1,0)"))).cast("long")


def queue_positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` (source, n, ...), a written table, with `queue_at`: tokens ahead of each row in its source's queue."""
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sums = rows.groupBy("source", "_block").agg(F.sum("n").alias("_n"))
    # Blocks of one source, one small row each.
    ahead = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("source", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("n").over(within), F.lit(0)))
    starts = sized(materialise(sums, "queue-blocks"), 48)
    joined = placed.join(starts, placed.source.eqNullSafe(starts.source) & (placed["_block"] == starts["_block"]))
    return joined.select(*[placed[c] for c in rows.columns if c != "_block"],
                         (F.col("_ahead") + F.col("_within")).alias("queue_at"))


def pack(docs: DataFrame, ids: Column, *, end_id: int, length: int = LENGTH, id_col: str = "doc_id",
         source_col: str = "source", targets: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces: (doc_id, source, start, length, ids, doc_tokens, sequence_id, offset).

    `ids` is the array<int> of a row's tokens without `end_id`.
    """
    spark = docs.sparkSession
    with_end = F.concat(F.coalesce(ids, F.array().cast("array<int>")), F.array(F.lit(end_id)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       with_end.alias("ids"))
    with small_batches(spark):
        rows = materialise(rows.withColumn("n", F.size("ids").cast("long")), "pack-tokens")
    totals = materialise(rows.groupBy("source").agg(F.sum("n").alias("tokens")), "pack-sources")
    n_sources, n_tokens = totals.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    window = max(WINDOW_SEQUENCES * length, WINDOW_TOKENS_A_SOURCE * n_sources)
    if targets is None:
        windows = max(1, -(-n_tokens // window))
        plan = totals.select("source", F.array(F.struct(
            F.lit(0).cast("long").alias("start"), "tokens", F.lit(windows).cast("long").alias("windows"),
            F.lit(0).cast("long").alias("first_window"))).alias("phases"))
    else:
        # Targets name the sources, so the caller bounds their number; the others are one row each as well.
        made = phases_of({r.source: r.tokens for r in totals.collect()}, targets, window)
        plan = spark.createDataFrame(list(made.items()), f"source string, phases {PHASES}")
    plan = materialise(plan, "pack-plan")

    # Where each queue's part of each window starts in the stream.
    p = plan.select("source", F.explode("phases").alias("p")).select("source", "p.*")
    cells = p.select("source", "first_window", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("w"),
                     "tokens", "windows")
    cells = cells.select("source", (F.col("first_window") + F.col("w")).alias("window"),
                         (quota(F.col("tokens"), F.col("windows"), F.col("w") + 1)
                          - quota(F.col("tokens"), F.col("windows"), F.col("w"))).alias("n"))
    cells = materialise(cells, "pack-cells")
    sums = cells.groupBy("window").agg(F.sum("n").alias("total"))
    before = Window.orderBy("window").rowsBetween(Window.unboundedPreceding, -1)  # one number per window
    sums = sums.select("window", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("at"))
    inside = Window.partitionBy("window").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    layout = (cells.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, "window")
              .select("source", "window", (F.col("at") + F.col("inside")).alias("stream_at")))
    layout = sized(materialise(layout, "pack-layout"), 48)

    placed = queue_positions(rows, ["doc_id", "n", "ids"])
    plan = sized(plan, 256)
    placed = placed.join(plan, placed.source.eqNullSafe(plan.source)).select(placed["*"], plan.phases)
    # Cut a document where its queue passes from one window to the next. The estimate of the first and last window is
    # at most one off.
    a, n = F.col("queue_at"), F.col("n")
    by_phase = placed.select("doc_id", "source", "ids", n, a, F.explode("phases").alias("p")).where(
        (a < F.col("p.start") + F.col("p.tokens")) & (a + n > F.col("p.start")))
    low = F.greatest(a - F.col("p.start"), F.lit(0))
    high = F.least(a + n - F.col("p.start"), F.col("p.tokens"))
    guess = lambda x: F.floor(x / F.col("p.tokens") * F.col("p.windows")).cast("long")
    ws = F.sequence(F.greatest(guess(low) - 1, F.lit(0)), F.least(guess(high) + 1, F.col("p.windows") - 1))
    slices = F.filter(F.transform(ws, lambda w: F.struct(
        (F.col("p.first_window") + w).alias("window"),
        quota(F.col("p.tokens"), F.col("p.windows"), w).alias("from"),
        F.greatest(low, quota(F.col("p.tokens"), F.col("p.windows"), w)).alias("low"),
        F.least(high, quota(F.col("p.tokens"), F.col("p.windows"), w + 1)).alias("high"))),
        lambda s: s["low"] < s["high"])
    cut = (by_phase.select("doc_id", "source", "ids", "n", a, F.col("p.start").alias("base"), F.explode(slices).alias("s"))
           .select("doc_id", "source", "n", F.col("s.window").alias("window"),
                   (F.col("s.low") - F.col("s.from")).alias("inside"), (F.col("s.high") - F.col("s.low")).alias("size"),
                   (F.col("base") + F.col("s.low") - a).alias("start"), "ids"))
    cut = cut.withColumn("ids", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("size").cast("int")))
    at = cut.join(layout, cut.source.eqNullSafe(layout.source) & (cut.window == layout.window)).select(
        "doc_id", cut.source, "n", "start", "size", "ids", (F.col("stream_at") + F.col("inside")).alias("at"))
    # Then where the stream passes from one sequence to the next.
    size = F.lit(length)
    seq = lambda x: F.floor(x / size).cast("long")
    at = at.withColumn("sequence_id", F.explode(F.sequence(seq(F.col("at")), seq(F.col("at") + F.col("size") - 1))))
    first = F.greatest(F.col("at"), F.col("sequence_id") * size)
    last = F.least(F.col("at") + F.col("size"), (F.col("sequence_id") + 1) * size)
    return at.select("doc_id", "source", (F.col("start") + first - F.col("at")).alias("start"),
                     (last - first).alias("length"),
                     F.slice("ids", (first - F.col("at") + 1).cast("int"), (last - first).cast("int")).alias("ids"),
                     F.col("n").alias("doc_tokens"), "sequence_id", (first - F.col("sequence_id") * size).alias("offset"))


def ids_crc32(ids: Column) -> Column:
    """Checksum of ids as little-endian unsigned 32-bit numbers."""

    @F.arrow_udf("long")
    def crc(lists):
        import zlib

        import pyarrow as pa

        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64())

    return crc(ids)
