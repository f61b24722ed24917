"""SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are one node of the link graph. The nodes are split into
tiles of one bit count each; fingerprints within ``radius`` bits differ in
bit count by ``radius`` at most, so only tile pairs that close are formed.
A pair of tiles is compared in one task: both are sorted by the bit counts
of their four quarters and cut into blocks, block pairs whose quarter
counts differ by more than the radius in sum are skipped, and the rest are
compared by exclusive-or and bit count. A task returns a spanning forest of
the links it finds, at most one edge a node, so a group of near copies
never appears as all its pairs. Components over all forests are the
components over all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import broadcast_if_small, cut_lineage, doc_texts, ready, table
from omoplate.llm.components import connected_components
from omoplate.llm.exact_dedup import numbered

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
TILE = 1 << 15
BLOCK = 512


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash, unsigned. bytes.lower and bytes.split know ASCII letters and white space only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate([[0], ends[:n - 1] + 1]).tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = h[at:at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``row, doc_id, fp`` of rows (row, doc_id, text): the fingerprint's bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(fps.view(np.int64))],
                                             names=["row", "doc_id", "fp"])

    return rows.mapInArrow(run, "row long, doc_id long, fp long")


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(len(fps), 4)).astype(np.int16)


class _Side:
    """A tile sorted by quarter bit counts, in blocks that know their smallest and largest counts."""

    def __init__(self, fps: np.ndarray, block: int):
        q = _quarters(fps)
        self.order = np.lexsort(q.T[::-1])
        self.fps, q = fps[self.order], q[self.order]
        self.cuts = np.arange(0, len(fps), block)
        self.low = np.minimum.reduceat(q, self.cuts)
        self.high = np.maximum.reduceat(q, self.cuts)


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the components of ``i[k]`` and ``j[k]`` for all k; a label is the smallest index of its component."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def tile_links(x: np.ndarray, y: np.ndarray | None, radius: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between ``x`` and ``y``, or within ``x`` if ``y`` is None, as
    pairs of indices into x followed by y."""
    left = _Side(x, block)
    right = left if y is None else _Side(y, block)
    shift = 0 if y is None else len(x)
    label = np.arange(len(x) + (0 if y is None else len(y)))
    for k, a in enumerate(left.cuts):
        gap = np.maximum(0, np.maximum(right.low - left.high[k], left.low[k] - right.high)).sum(1)
        near = np.flatnonzero(gap <= radius)
        for m in near[near >= k] if y is None else near:
            b = right.cuts[m]
            far = np.bitwise_count(left.fps[a:a + block, None] ^ right.fps[None, b:b + block])
            i, j = np.nonzero(far <= radius)
            if len(i):
                merge_labels(label, left.order[a + i], right.order[b + j] + shift)
    nodes = np.flatnonzero(label != np.arange(len(label)))
    return nodes, label[nodes]


def links(classes: DataFrame, radius: int = MAX_BITS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect what all links within ``radius``
    bits connect."""
    counts = dict(classes.groupBy(F.bit_count("fp").cast("int").alias("ones")).count().collect())  # 65 rows at most
    split = {p: -(-n // tile) for p, n in counts.items()}
    first, at = {}, 0
    for p in range(66):
        first[p] = at
        at += split.get(p, 0)
    if not at:
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    lookup = lambda d: F.create_map(*[F.lit(x) for p in counts for x in (p, d(p))])
    ones = F.bit_count("fp").cast("int")
    tiled = classes.withColumn("tile", lookup(lambda p: first[p])[ones]
                               + F.pmod(F.xxhash64("fp"), lookup(lambda p: split[p])[ones]).cast("int"))

    def packed(t: pa.Table) -> pa.Table:
        fps = np.sort(t.column("fp").to_numpy())
        key = t.column("tile")[0].as_py()
        ones = int(np.bitwise_count(fps[:1].view(np.uint64))[0])
        return pa.table({"tile": pa.array([key], pa.int32()), "last": pa.array([first[min(ones + radius, 64) + 1] - 1], pa.int32()),
                         "fps": [fps.tobytes()]})

    tiles = cut_lineage(tiled.groupBy("tile").applyInArrow(packed, "tile int, last int, fps binary"))
    ahead = tiles.select("tile", "fps", F.col("tile").alias("x"), F.explode(F.sequence("tile", "last")).alias("y"))
    # a tile also goes to the pairs whose other tile has fewer bits
    before = tiles.select("tile", "last")
    behind = before.select(F.col("tile").alias("x"), F.explode(F.sequence("tile", "last")).alias("y")).filter("x < y")
    behind = behind.join(tiles.withColumnRenamed("tile", "y"), "y").select(F.col("y").alias("tile"), "fps", "x", "y")

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("tile")
        fps = [np.frombuffer(v.as_py(), np.uint64) for v in t.column("fps")]
        both = np.concatenate(fps).view(np.int64)
        i, j = tile_links(fps[0], fps[1] if len(fps) > 1 else None, radius, block)
        return pa.table({"a": pa.array(both[i], pa.int64()), "b": pa.array(both[j], pa.int64())})

    return ahead.unionByName(behind).groupBy("x", "y").applyInArrow(compare, "a long, b long")


def _components(classes: DataFrame, radius: int, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``classes`` (distinct ``fp``, other columns) with ``component``: the smallest fingerprint that links reach."""
    groups = connected_components(links(classes.select("fp"), radius, tile, block))
    return classes.join(groups, F.col("fp") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fp")).drop("node")


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = MAX_BITS,
                   tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Texts whose fingerprints differ in ``radius`` bits or fewer are linked;
    component_id is the smallest doc_id that links reach. Links are those of
    texts: rows without a doc_id connect others like any row, and rows that
    share a doc_id but not a text are linked to what is near their own. A
    component in which no row has a doc_id has a null component_id. A null
    or empty text has fingerprint zero and is linked like any other; a text
    of any length is read whole, with some 40 bytes a word in memory.
    Repeated rows repeat. An empty table gives no rows; other columns are
    ignored.
    """
    ready(docs.sparkSession)
    prints = cut_lineage(fingerprints(doc_texts(docs).withColumn("row", F.lit(0).cast("long")), shingle_words).drop("row"))
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    marks = cut_lineage(_components(classes, radius, tile, block))
    least = marks.groupBy("component").agg(F.min("least").alias("component_id"))
    marks = marks.join(least, "component").select("fp", "component_id")
    return prints.join(marks, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """``docs`` with exactly one row of each component: one of its smallest doc_id, or, where none has a
    doc_id, any. Rows that share a doc_id, or lack one, are different documents."""
    ready(docs.sparkSession)
    rows = numbered(docs)
    texts = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"))
    prints = cut_lineage(fingerprints(texts, shingle_words))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = cut_lineage(prints.groupBy("fp").agg(first))
    kept = _components(classes, radius).groupBy("component").agg(F.min("first").alias("first")).select("first.row")
    gone = cut_lineage(prints.select("row").join(kept, "row", "left_anti"))
    return rows.join(broadcast_if_small(gone), "row", "left_anti").select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


ORACLE_SQL = {}
