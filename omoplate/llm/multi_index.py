"""Nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised for themselves; a pair of
centroids is a cell. A query visits cells in the order of the sum of its
two squared centroid distances, popped from a heap over the two sorted
lists, until the cells hold ``SHARE`` of the entries; all entries of these
cells are then ranked by their true distance.

Equal vectors are one entry that keeps its smallest ids, one more than a
query can return, so a vector of very many copies costs what any other
does. Entries are cut into slices of neighbouring cells (a large cell over
several) and the queries into groups; a task ranks one slice for one group
and returns the best few of each query.

The centroids are fitted on ``SAMPLE`` entries at most, chosen by a hash;
every vector is indexed. On vectors without any cluster structure (the
bundled ones are spread evenly over the sphere) a cell says little, and
ten neighbours in ten need a large share: 0.6 gives a recall of 0.96 there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage, ready, table

CENTROIDS = 32
SAMPLE = 16_384
ROUNDS = 12
SHARE = 0.6
SLICE = 16_384
QUERY_GROUP = 16_384
QUERY_ROW = 256
EVERY = 100


def centroids(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from evenly spaced rows of the sample."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)


def visits(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells by summed distance until they hold ``wanted`` entries; a cell is left * len(right) + right."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, out, have = [(left[a[0]] + right[b[0]], 0, 0)], [], 0
    while heap and have < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(b) + int(b[j])
        if counts[cell]:
            out.append(cell)
            have += counts[cell]
        if j + 1 < len(b):
            heapq.heappush(heap, (left[a[i]] + right[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (left[a[i + 1]] + right[b[0]], i + 1, 0))
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, v``: rows with an id whose vector is not null, empty or zero and has finite components only."""
    v = F.col(vector).cast("array<double>")
    return vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def neighbours(vectors: DataFrame, top: int = 10, every: int = EVERY, key: str = "vec_id", vector: str = "embedding",
               k: int = CENTROIDS, share: float = SHARE, slice_rows: int = SLICE,
               query_group: int = QUERY_GROUP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest rows found for every row whose id is
    divisible by ``every``, by Euclidean distance, ties to the smaller id; a row is not its own neighbour.

    Rows without an id and vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do vectors whose length is
    not the most common one. Repeated rows count once; where an id has
    several vectors, two ids are as near as the nearest two of their
    vectors, and an id comes once in a list. With fewer than
    ``top`` other rows all are returned; an empty table gives no rows.
    Other columns are ignored.
    """
    spark = ready(vectors.sparkSession)
    good = usable(vectors, key, vector)
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    dim = sizes[0]["n"]
    good = good.filter(F.size("v") == dim)
    first = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = cut_lineage(good.withColumn("place", first).filter(F.col("place") <= top + 1)
                          .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))
    sample = entries.orderBy(F.xxhash64("v"), "ids").limit(SAMPLE).select("v").toArrow()
    x, half = _matrix(sample.column("v")), max(1, dim // 2)
    cells_of = [centroids(x[:, :half], k), centroids(x[:, half:], k) if dim > half else np.zeros((1, 0))]
    n_cells = len(cells_of[0]) * len(cells_of[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"))
            cell = nearest(m[:, :half], cells_of[0]) * len(cells_of[1]) + (nearest(m[:, half:], cells_of[1]) if dim > half else 0)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), b.column("v"), b.column("ids")],
                                             names=["cell", "v", "ids"])

    indexed = cut_lineage(entries.mapInArrow(assign, "cell int, v array<double>, ids array<long>"))
    counts = np.zeros(n_cells, np.int64)
    for cell, n in indexed.groupBy("cell").count().collect():  # n_cells rows at most
        counts[cell] = n
    # neighbouring cells share a slice of about slice_rows entries; a large cell takes several
    first_slice, parts, at, room = [], [], -1, 0
    for n in counts.tolist():
        if n > slice_rows or n > room:
            need = max(1, -(-n // slice_rows))
            first_slice.append(at + 1)
            parts.append(need)
            at, room = at + need, (slice_rows - n if need == 1 else 0)
        else:
            first_slice.append(max(at, 0))
            parts.append(1)
            room -= n
    n_slices = max(1, at + 1)
    lookup = lambda xs: F.element_at(F.array(*map(F.lit, xs)), F.col("cell") + 1)
    wanted = max(int(np.ceil(share * counts.sum())), top + 1)

    queries = good.filter(F.col("vec_id") % every == 0).distinct()
    n_queries = queries.count()
    groups = max(1, -(-n_queries // query_group))
    sliced = indexed.withColumn("slice", lookup(first_slice) + F.pmod(F.xxhash64("v"), lookup(parts)).cast("int")).select(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "cell", "v", "ids")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices_of = [set(range(s, s + p)) for s, p in zip(first_slice, parts)]
        for b in batches:
            for start in range(0, b.num_rows, QUERY_ROW):
                part = b.slice(start, QUERY_ROW)
                m, grp = _matrix(part.column("v")), part.column("grp").to_numpy()
                seen = np.zeros((len(m), n_cells), bool)
                left = ((m[:, None, :half] - cells_of[0][None]) ** 2).sum(2)
                right = ((m[:, None, half:] - cells_of[1][None]) ** 2).sum(2)
                for i in range(len(m)):
                    seen[i, visits(left[i], right[i], counts, wanted)] = True
                for g in np.unique(grp):
                    own = np.flatnonzero(grp == g)
                    slices = sorted(set().union(*(slices_of[c] for c in np.flatnonzero(seen[own].any(0)))))
                    yield pa.RecordBatch.from_pydict({
                        "grp": pa.array([g], pa.int32()), "slices": pa.array([slices], pa.list_(pa.int32())),
                        "ids": [part.column("vec_id").to_numpy()[own].tobytes()], "vectors": [m[own].tobytes()],
                        "cells": [np.packbits(seen[own], axis=1).tobytes()]})

    planned = queries.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).mapInArrow(
        plan, "grp int, slices array<int>, ids binary, vectors binary, cells binary")
    sent = planned.select(F.explode("slices").alias("slice"), "grp", "ids", "vectors", "cells")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            m, cell, ids = _matrix(left.column("v")), left.column("cell").to_numpy(), left.column("ids").to_pylist()
            norm = (m * m).sum(1)
            for q_ids, q, bits in zip(*(right.column(c).to_pylist() for c in ("ids", "vectors", "cells"))):
                q_ids, q = np.frombuffer(q_ids, np.int64), np.frombuffer(q, np.float64).reshape(-1, dim)
                seen = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(len(q_ids), -1), axis=1, count=n_cells).astype(bool)
                own = (q * q).sum(1)
                about = own[:, None] + norm[None] - 2 * q @ m.T
                about[~seen[:, cell]] = np.inf
                for i, row in enumerate(about):
                    found, reach = {}, top
                    while True:  # ids of several vectors may fill places with themselves: then look further
                        edge = np.partition(row, reach)[reach] if len(row) > reach else np.inf
                        # rounding of the expanded square is far below this
                        close = np.flatnonzero((row <= edge + 1e-9 * (own[i] + norm.max())) & np.isfinite(row))
                        true = np.sqrt(((m[close] - q[i]) ** 2).sum(1))
                        for d, v in sorted((d, v) for d, e in zip(true.tolist(), close.tolist()) for v in ids[e]):
                            if v != q_ids[i] and len(found) < top:
                                found.setdefault(v, d)
                        if len(found) == top or not np.isfinite(edge):
                            break
                        found, reach = {}, 4 * reach
                    out[0].extend([int(q_ids[i])] * len(found))
                    out[1].extend(found.keys())
                    out[2].extend(found.values())
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])

    ranked = sliced.groupBy("slice", "grp").cogroup(sent.groupBy("slice", "grp")).applyInArrow(
        rank, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    # one exchange by query serves the grouping and the ranks
    ranked = ranked.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = {}
