"""Exact deduplication by composable polynomial fingerprints.

A text's UTF-8 bytes are hashed in chunks. The hash of a chunk is a
polynomial in a fixed base modulo a prime, so the hash of two chunks in a
row is ``h(a) * base**len(b) + h(b)``: chunk hashes can be made anywhere
and combined by shifting each by the length that follows it. Texts over
``LONG_BYTES`` are dealt out by chunk and their hashes summed; shorter
ones are hashed where they were read.

The rows are written once with a number of their own, since a doc_id may
be missing or repeated; the number is a row's identity in all that follows.
Texts of equal length and fingerprint are then compared for real. Each
group's chunks are sorted behind the chunk of the text that would stay
(the largest doc_id) and compared in one pass that holds one chunk at a
time. A group of many copies is salted, so that no task gets more than
about ``COPIES_PER_TASK`` copies of a chunk. Texts that only share a
fingerprint go through another round among themselves; the text that a
round holds the others against is settled by it, so the rounds end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import broadcast_if_small, cut_lineage, ready, table

CHUNK_BYTES = 1 << 14
LONG_BYTES = 1 << 22
COPIES_PER_TASK = 512
#: (prime, base) of the two polynomials of a fingerprint. Primes stay under 2**31: a byte times a
#: power of the base, summed over a chunk, then fits 64 bits.
MODULI = ((2147483647, 1000003), (2147483629, 998244353))

FINGERPRINT = ("n_bytes", "h1", "h2")


def _powers(prime: int, base: int, n: int) -> np.ndarray:
    """base**(n-1), ..., base, 1 modulo prime."""
    out, have = np.ones(1, np.int64), 1
    while have < n:
        out = np.concatenate([out * pow(base, have, prime) % prime, out])
        have *= 2
    return out[-n:]


class Polynomials:
    def __init__(self, moduli=MODULI, chunk: int = CHUNK_BYTES):
        self.moduli, self.chunk = moduli, chunk
        self.powers = [_powers(p, b % p, chunk) for p, b in moduli]

    def of_chunk(self, data: bytes) -> list[int]:
        a = np.frombuffer(data, np.uint8).astype(np.int64) + 1
        return [int((a * w[len(w) - len(a):]).sum() % p) for (p, _), w in zip(self.moduli, self.powers)]

    def of_text(self, data: bytes) -> list[int]:
        h = [0] * len(self.moduli)
        for at in range(0, len(data), self.chunk):
            piece = data[at:at + self.chunk]
            h = [(x * pow(b, len(piece), p) + y) % p for x, y, (p, b) in zip(h, self.of_chunk(piece), self.moduli)]
        return h

    def shifted(self, data: bytes, after: int) -> list[int]:
        """A chunk's share of its text's hash; ``after`` bytes follow the chunk."""
        return [x * pow(b, after, p) % p for x, (p, b) in zip(self.of_chunk(data), self.moduli)]


def _chunk_rows(df: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of the binary column ``data``; an empty text has one empty chunk."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk)).cast("int")
    return (df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("chunk", F.expr(f"substring(data, chunk_no * {chunk} + 1, {chunk})")).drop("data"))


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc``: the rows of ``docs``, written once, each with a number of its own."""
    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))


def _texts(rows: DataFrame) -> DataFrame:
    """``row, doc_id, text`` of numbered rows; a null text counts as empty."""
    return rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"))


def fingerprints(rows: DataFrame, moduli=MODULI, long_bytes: int = LONG_BYTES) -> DataFrame:
    """``row, doc_id, n_bytes, h1, h2, text_sha256`` for every one of the numbered rows."""
    (p1, _), (p2, _) = moduli
    poly = Polynomials(moduli)

    @F.pandas_udf("h1 long, h2 long")
    def whole(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([poly.of_text(x) for x in data], columns=["h1", "h2"], dtype="int64")

    @F.pandas_udf("h1 long, h2 long")
    def share(chunk: pd.Series, after: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([poly.shifted(x, n) for x, n in zip(chunk, after)], columns=["h1", "h2"], dtype="int64")

    base = _texts(rows).select("row", "doc_id", F.col("text").cast("binary").alias("data"),
                               F.octet_length("text").cast("long").alias("n_bytes"),
                               F.sha2("text", 256).alias("text_sha256"))
    columns = ["row", "doc_id", "n_bytes", "h.h1", "h.h2", "text_sha256"]
    short = base.filter(F.col("n_bytes") <= long_bytes).withColumn("h", whole("data")).select(*columns)
    chunks = _chunk_rows(base.filter(F.col("n_bytes") > long_bytes))
    after = F.greatest(F.lit(0), F.col("n_bytes") - (F.col("chunk_no") + 1) * CHUNK_BYTES)
    parts = (chunks.repartition("row", "chunk_no").withColumn("h", share("chunk", after))
             .groupBy("row", "doc_id", "n_bytes", "text_sha256")
             .agg((F.sum("h.h1") % p1).alias("h1"), (F.sum("h.h2") % p2).alias("h2")))
    return short.unionByName(parts.select("row", "doc_id", "n_bytes", "h1", "h2", "text_sha256"))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (keep_row, salt, chunk_no, member): the first chunk of each such key is the one
    that the rest are held against."""
    key, held = None, None
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("keep_row", "salt", "chunk_no")]
        chunk, out = b.column("chunk"), []
        for i, k in enumerate(zip(*cols)):
            x = chunk[i].as_py()
            if k != key:
                key, held = k, x
            out.append(x == held)
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("keep_row"), pa.array(out), b.column("counts")],
                                         names=["row", "keep_row", "same", "counts"])


def _compared(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (row, keep_row, n) held against the text of keep_row, chunk by chunk: ``row, keep_row, same``."""
    text = _texts(rows).select("row", F.col("text").cast("binary").alias("data"),
                               F.octet_length("text").cast("long").alias("n_bytes"))
    both = text.join(broadcast_if_small(members), "row")
    salts = F.ceil(F.col("n") / COPIES_PER_TASK).cast("int")
    first = F.col("row") == F.col("keep_row")
    both = both.withColumn("member", ~first).withColumn(
        "salt", F.explode(F.when(first, F.sequence(F.lit(0), salts - 1))
                          .otherwise(F.array(F.pmod(F.xxhash64("row"), salts).cast("int")))))
    # the text that stays goes to every salt; only salt 0 reports it
    dealt = _chunk_rows(both).withColumn("counts", F.col("member") | (F.col("salt") == 0))
    dealt = dealt.select("keep_row", "salt", "chunk_no", "member", "row", "counts", "chunk").repartition(
        "keep_row", "salt", "chunk_no").sortWithinPartitions("keep_row", "salt", "chunk_no", "member")
    verdicts = dealt.mapInArrow(_compare, "row long, keep_row long, same boolean, counts boolean").filter("counts")
    return verdicts.groupBy("row", "keep_row").agg(F.min("same").alias("same"))


def _marks(rows: DataFrame, moduli=MODULI, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One line per numbered row: ``row, doc_id, text_sha256, keep_row, keep_id, group_size``. keep_row is one
    row of the largest doc_id among the equal texts; all three last are null where no other text is equal."""
    prints = cut_lineage(fingerprints(rows, moduli, long_bytes))
    left, settled = prints.select("row", "doc_id", *FINGERPRINT), None
    while True:
        # a null doc_id sorts lowest
        groups = left.groupBy(*FINGERPRINT).agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        groups = groups.filter("n > 1" if settled is None else "n > 0").select(
            *FINGERPRINT, "n", F.col("keep.row").alias("keep_row"), F.col("keep.doc_id").alias("keep_id"))
        members = cut_lineage(left.join(groups, list(FINGERPRINT)))
        found = cut_lineage(_compared(rows, members.select("row", "keep_row", "n")))
        same = found.filter("same").join(members.select("row", "keep_id"), "row").select("row", "keep_row", "keep_id")
        settled = same if settled is None else settled.unionByName(same)
        other = found.filter(~F.col("same")).select("row")
        if other.isEmpty():
            break
        left = members.select("row", "doc_id", *FINGERPRINT).join(other, "row", "left_semi")
    sizes = settled.groupBy(F.col("keep_row").alias("z")).agg(F.count(F.lit(1)).alias("group_size"))
    settled = settled.join(sizes, F.col("keep_row") == F.col("z")).select("row", "keep_row", "keep_id", "group_size")
    return prints.select("row", "doc_id", "text_sha256").join(settled, "row", "left")


def exact_groups(docs: DataFrame, moduli=MODULI, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest doc_id stays. A null text equals an empty
    one. A null doc_id is smaller than any other: such a row stays only
    where all copies lack a doc_id, and then all of them are marked kept
    with a null keep_id. Repeated rows count one by one in group_size and
    carry the same marks. An empty table gives no rows; other columns are
    ignored.
    """
    ready(docs.sparkSession)
    alone = F.col("keep_row").isNull()
    return _marks(numbered(docs.select("doc_id", "text")), moduli, long_bytes).select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each distinct text: one of the largest doc_id. Rows that share a
    doc_id, or lack one, but differ in text are different documents."""
    ready(docs.sparkSession)
    rows = numbered(docs)
    copies = cut_lineage(_marks(rows).filter("row <> keep_row").select("row"))
    return rows.join(broadcast_if_small(copies), "row", "left_anti").select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """,
}
