"""Near-duplicate vectors by an exact metric range join.

On unit vectors, cosine >= t is the same as Euclidean distance <= r = sqrt(2 - 2t). Pivots (a bounded sample of the
vectors) partition the vectors: each belongs to the cell of its nearest pivot. A vector x may have partners in another
cell c only if x lies within r of c's boundary; the triangle inequality bounds that from the cell's radii (distance to
pivot between r_min - r and r_max + r) and from the plane midway between x's own pivot and c's. x is copied to
exactly those cells as a query. Cells join independently: every ordered pair is seen once, in the second one's cell.

Equal vectors are collapsed first. A large cell is cut into data blocks and query chunks, so that a task holds two
bounded matrices whatever the cell's size; a task returns counts per query and a spanning forest of its links, never the
links themselves. In few hundred unclustered dimensions the bounds prune little (no metric index can); the join then
approaches blocks of all vectors against all, still in bounded tasks.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different length
do not link either. A null id keeps its row, with links counted for others, and is never a component's id unless
alone. Repeated rows count as vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.shared import components, with_roots
from panelcast.sources.storage import materialise

#: Vectors of a data block and of a query chunk in one task.
BLOCK, QUERIES = 2048, 8192
#: Rows of one matrix product inside a task.
STRIPE = 512
#: Bounds of the number of pivots; between them one pivot for every PER_CELL vectors.
PER_CELL, MIN_PIVOTS, MAX_PIVOTS = 4096, 1, 4096
#: Slack of the bounds for rounding; only candidates grow by it.
SLACK = 1e-6


def unit_rows(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column of equal length as unit vectors in double precision."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # Scaling by the largest component first keeps very large and very small vectors finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cell_targets(x: np.ndarray, pivots: np.ndarray, radii: np.ndarray | None, r: float):
    """Home cell and home distance of each row; with `radii` (min and max by cell) also a mask of cells to search."""
    cos = np.clip(x @ pivots.T, -1, 1)
    home = cos.argmax(axis=1)
    dist = np.sqrt(np.maximum(0, 2 - 2 * cos))
    own = dist[np.arange(len(x)), home]
    if radii is None:
        return home, own, None
    gap = np.sqrt(np.maximum(0, 2 - 2 * np.clip(pivots @ pivots.T, -1, 1)))[home]
    plane = dist ** 2 - own[:, None] ** 2 <= 2 * r * gap + SLACK
    ring = (dist >= radii[:, 0] - r - SLACK) & (dist <= radii[:, 1] + r + SLACK)
    mask = plane & ring
    mask[np.arange(len(x)), home] = True
    return home, own, mask


def join_block(table: pa.Table, dim: int, threshold: float) -> pa.Table:
    """One data block of one cell against one chunk of queries: weights linked per query, and a spanning forest."""
    query = table.column("query").to_numpy()
    ids, weights = table.column("rep").to_numpy(), table.column("weight").to_numpy()
    x = unit_rows(table.column("embedding"), dim)
    q, d = np.flatnonzero(query), np.flatnonzero(~query)
    if not len(q) or not len(d):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    d = d[np.argsort(ids[d], kind="stable")]
    data, data_ids, data_w = x[d], ids[d], weights[d].astype(np.float64)
    label = np.arange(len(d))
    counts, first = np.zeros(len(q), np.int64), np.full(len(q), -1)
    for at in range(0, len(q), STRIPE):
        rows = q[at: at + STRIPE]
        linked = (x[rows] @ data.T >= threshold) & (ids[rows][:, None] != data_ids)
        counts[at: at + len(rows)] = linked @ data_w
        for i in np.flatnonzero(linked.any(axis=1)):
            roots = np.unique(label[linked[i]])
            first[at + i] = roots[0]
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    hit = np.flatnonzero(first >= 0)
    joined = np.flatnonzero(label != np.arange(len(d)))
    a = np.concatenate((ids[q][hit], data_ids[joined]))
    b = np.concatenate((data_ids[label[first[hit]]], data_ids[label[joined]]))
    n = np.concatenate((counts[hit], np.zeros(len(joined), np.int64)))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})


def near_vectors(vectors: DataFrame, *, threshold: float = 0.9, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: direct links, and the smallest id reachable by links."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = (F.coalesce(F.size("embedding") > 0, F.lit(False)) & F.coalesce(finite, F.lit(False))
             & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False)))
    rows = rows.withColumn("valid", valid)
    # Equal vectors are one class; its key is a number, its smallest id speaks for it.
    classes = materialise(rows.where("valid").groupBy("embedding")
                          .agg(F.min("vec_id").alias("low_id"), F.count("*").alias("weight"))
                          .withColumn("rep", F.monotonically_increasing_id())
                          .withColumn("dim", F.size("embedding")), "vector-classes")
    parts, edges = [], []
    for dim, n in sorted((r.dim, r.n) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        hits = materialise(_join_dimension(spark, classes.where(F.col("dim") == dim), dim, n, threshold), "vector-links")
        parts.append(hits.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others")))
        edges.append(hits.select("a", "b"))
    if parts:
        others, links = parts[0], edges[0]
        for p, e in zip(parts[1:], edges[1:]):
            others, links = others.unionByName(p), links.unionByName(e)
        roots = with_roots(components(links, "vector-components"))
        classed = (classes.join(others, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                   .withColumn("root", F.coalesce("root", "rep")))
        low = classed.groupBy("root").agg(F.min("low_id").alias("component_id"))
        classed = classed.join(low, "root").select(
            F.col("embedding").alias("vector"), "component_id",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    else:
        classed = classes.select(F.col("embedding").alias("vector"), F.col("low_id").alias("component_id"),
                                 (F.col("weight") - 1).alias("n_links"))
    out = rows.join(classed, F.when(rows.valid, rows.embedding) == classed.vector, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _join_dimension(spark, classes: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    r = math.sqrt(max(0.0, 2 - 2 * threshold))
    n_pivots = min(MAX_PIVOTS, max(MIN_PIVOTS, n // PER_CELL))
    # A bounded sample of at most MAX_PIVOTS vectors reaches the driver; the choice does not depend on partitioning.
    picked = classes.orderBy(F.xxhash64("embedding"), "low_id").limit(n_pivots).select("embedding").toArrow()
    pivots = unit_rows(picked.column(0), dim)

    def assign(batches):
        for b in batches:
            home, own, _ = cell_targets(unit_rows(b.column("embedding"), dim), pivots, None, r)
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), pa.array(own)], ["cell", "dist"])

    cells = (classes.select("embedding").mapInArrow(assign, "cell int, dist double").groupBy("cell")
             .agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect())
    radii = np.full((len(pivots), 2), np.inf)  # an empty cell is never searched
    blocks = np.ones(len(pivots), np.int64)
    for c in cells:
        radii[c.cell] = c.low, c.high
        blocks[c.cell] = -(-c.n // BLOCK)

    def targets(batches):
        for b in batches:
            home, _, mask = cell_targets(unit_rows(b.column("embedding"), dim), pivots, radii, r)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pivots)), pa.int32()),
                                              pa.array(mask.sum(axis=0), pa.int64())], ["cell", "n"])

    asked = np.zeros(len(pivots), np.int64)
    for c in (classes.select("embedding").mapInArrow(targets, "cell int, n long").groupBy("cell")
              .agg(F.sum("n").alias("n")).collect()):
        asked[c.cell] = -(-c.n // QUERIES)
    asked = np.maximum(asked, 1)

    def place(batches):
        """A row for each block and chunk that a vector takes part in: once as data of its cell, else as a query."""
        for b in batches:
            home, _, mask = cell_targets(unit_rows(b.column("embedding"), dim), pivots, radii, r)
            rep = b.column("rep").to_numpy()
            spread = (rep * 2_654_435_761 + (rep >> 33)) & 0x7FFFFFFF
            index, cell, block, chunk, query = [], [], [], [], []
            rows_q, cells_q = np.nonzero(mask)
            for rows, where, asks in ((rows_q, cells_q, True), (np.arange(len(rep)), home, False)):
                copies = blocks[where] if asks else asked[where]
                at = np.repeat(np.arange(len(rows)), copies)
                k = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                own = spread[rows[at]] % (asked if asks else blocks)[where[at]]
                index.append(rows[at])
                cell.append(where[at])
                block.append(k if asks else own)
                chunk.append(own if asks else k)
                query.append(np.full(len(at), asks))
            taken = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(t)) for c, t in
                 ((cell, np.int32), (block, np.int64), (chunk, np.int64), (query, bool))],
                ["cell", "block", "chunk", "query"])
            index = pa.array(np.concatenate(index))
            for at in range(0, len(index), 20_000):
                part = b.select(["rep", "weight", "embedding"]).take(index.slice(at, 20_000))
                yield pa.RecordBatch.from_arrays([*taken.slice(at, 20_000).columns, *part.columns],
                                                 [*taken.schema.names, *part.schema.names])

    kind = dict(classes.dtypes)["embedding"]
    placed = classes.select("rep", "weight", "embedding").mapInArrow(
        place, f"cell int, block long, chunk long, query boolean, rep long, weight long, embedding {kind}")
    return (placed.groupBy("cell", "block", "chunk")
            .applyInArrow(lambda t: join_block(t, dim, threshold), "a long, b long, n long"))
