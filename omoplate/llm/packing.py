"""Packing documents into sequences: shortest pack first over the length histogram.

A document's ids are cut into full sequences and one rest. Lengths are
placed longest first; copies of a length join the shortest packs that still
have room for them, and only counts of packing patterns are kept, so the
work depends on the number of lengths and not of documents. The patterns
are then joined back: the pieces of a length are numbered, and each slot of
a pattern takes a range of those numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage, doc_texts, ready, table
from omoplate.llm.tokens import encoder, spaced_words

SEQUENCE = 1024
END_ID = 0


def cut(n_tokens: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    return [(at, min(sequence, n_tokens - at)) for at in range(0, n_tokens, sequence)]


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a pattern, times used)``, for ``counts`` pieces by length."""
    open_packs: dict[int, list] = {}  # by room left
    done = []

    def put(pattern: tuple, n: int, room: int) -> None:
        if room:
            open_packs.setdefault(room, []).append((pattern, n))
        else:
            done.append((pattern, n))

    for length in sorted(counts, reverse=True):
        left, room = counts[length], sequence
        while left:
            # the shortest pack has the most room; what this length fills now is not filled again by it
            # before all others had their turn
            room = max((r for r in open_packs if length <= r <= room), default=None)
            if room is None:
                put((length,), left, sequence - length)
                break
            packs = open_packs.pop(room)
            while packs and left:
                pattern, n = packs.pop()
                used = min(n, left)
                left -= used
                if n > used:
                    packs.append((pattern, n - used))
                put((*pattern, length), used, room - length)
            if packs:
                open_packs.setdefault(room, []).extend(packs)
    return done + [p for packs in open_packs.values() for p in packs]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, last rank, first sequence, offset)`` of every slot of every pattern."""
    out, taken, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            out.append((length, first, first + n - 1, sequence, offset))
            taken[length] = first + n
            offset += length
        sequence += n
    return out


def token_pieces(docs: DataFrame, path: str, pieces=spaced_words, sequence: int = SEQUENCE,
                 end_id: int | None = END_ID, memory: float = 1.0) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: every document's ids, with the end id, cut."""
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pieces, memory)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = coder.ids(text.as_py()) + tail
                n = len(ids) // 4
                rows += [(doc_id, at, m, zlib.crc32(ids[4 * at:4 * (at + m)]), n) for at, m in cut(n, sequence)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return doc_texts(docs).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers the rows from 0 in the order given, without bringing them into one task: rows are
    dealt by range, numbered in their partition and written; a partition's numbers begin after the
    rows of all before it. That table has one row a partition."""
    cols = [F.col(c).asc_nulls_first() for c in order]
    written = cut_lineage(df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                          .withColumn("_key", F.monotonically_increasing_id()))
    written = written.withColumn("_part", F.shiftright("_key", 33)).withColumn("_at", F.col("_key").bitwiseAND((1 << 33) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return written.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop(
        "_key", "_part", "_at", "_before")


def pack_documents(docs: DataFrame, path: str, pieces=spaced_words, sequence: int = SEQUENCE,
                   end_id: int | None = END_ID, memory: float = 1.0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Sequences are filled from offset 0 without gaps. A null or empty text
    has the end id alone; rows that repeat a doc_id are packed each for
    itself. An empty table gives no rows; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    written = cut_lineage(token_pieces(docs, path, pieces, sequence, end_id, memory))
    counts = {r["length"]: r["count"] for r in written.groupBy("length").count().collect()}  # `sequence` rows at most
    first, at = {}, 0
    for length in sorted(counts):
        first[length] = at
        at += counts[length]
    # a placement uses up a pack or a length, and a length splits one pack at most: the slots are bounded
    # by the number of lengths alone
    rows = [(n, a + first[n], b + first[n], s, o) for n, a, b, s, o in slots(pack_histogram(counts, sequence))]
    places = spark.createDataFrame(rows, "n long, first long, last long, sequence long, offset long")
    ranked = numbered(written, ["length", "doc_id", "start", "ids_crc32"], "rank")
    return ranked.join(F.broadcast(places), [F.col("length") == F.col("n"), F.col("rank").between(F.col("first"), F.col("last"))]
                       ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


ORACLE_SQL = {}
