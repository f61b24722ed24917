"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of its documents, in order and without gaps, in
blocks of ``BLOCK`` ids. A block stores its smallest id, the differences
to it in as many bits as a percentile of them needs, one bit plane after
another, and the differences that need more bits as a list of positions
and values. Behind the blocks come the documents (id, number of ids), the
place where each block starts, and a footer, so any run of ids can be read
by opening the blocks it lies in.

Documents are dealt to files by ranges of doc_id and encoded where they are
written. The name of a file carries the task attempt, and Spark's commit of
the manifest (one row a file) decides which attempt counts.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage, doc_texts, ensure_checkpoint_dir, ready, table
from omoplate.llm.tokens import encoder, words

BLOCK = 1024
#: Share of a block's differences that must fit the packed width.
PERCENTILE = 0.95
#: Blocks that are coded or read at once.
SLAB = 256
END_ID = 1
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IHHB")
_FOOT = struct.Struct("<QQQQ8s")


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of ``ids`` (uint32); only the last may be short."""
    out: list[bytes] = []
    whole = len(ids) // block
    for at in range(0, whole, SLAB):
        out += _pack_rows(ids[at * block:min(whole, at + SLAB) * block].reshape(-1, block), percentile)
    if len(ids) % block:
        out += _pack_rows(ids[whole * block:].reshape(1, -1), percentile)
    return out


def _pack_rows(rows: np.ndarray, percentile: float) -> list[bytes]:
    n = rows.shape[1]
    low = rows.min(1)
    diff = rows - low[:, None]
    kth = max(0, int(np.ceil(n * percentile)) - 1)
    fit = np.partition(diff, kth, axis=1)[:, kth]
    width = np.ceil(np.log2(fit.astype(np.float64) + 1)).astype(np.int64)
    out: list = [None] * len(rows)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        part = diff[which]
        over = (part >> np.uint32(w)) > 0 if w < 32 else np.zeros(part.shape, bool)
        planes = [np.packbits(((part >> np.uint32(b)) & np.uint32(1)).astype(np.uint8), axis=1) for b in range(w)]
        planes = np.concatenate(planes, axis=1) if planes else np.zeros((len(which), 0), np.uint8)
        for k, i in enumerate(which):
            at = np.flatnonzero(over[k])
            out[i] = b"".join((_HEAD.pack(int(low[i]), n, len(at), int(w)), planes[k].tobytes(),
                               at.astype("<u2").tobytes(), part[k][at].astype("<u4").tobytes()))
    return out


def unpack(blocks: list[bytes]) -> np.ndarray:
    heads = [_HEAD.unpack_from(b) for b in blocks]
    out = np.zeros(sum(h[1] for h in heads), np.uint32)
    starts = np.cumsum([0] + [h[1] for h in heads])
    kinds: dict = {}
    for i, (_, n, _, w) in enumerate(heads):
        kinds.setdefault((n, w), []).append(i)
    for (n, w), which in kinds.items():
        size = -(-n // 8)
        rows = np.zeros((len(which), n), np.uint32)
        if w:
            raw = np.frombuffer(b"".join(blocks[i][_HEAD.size:_HEAD.size + size * w] for i in which), np.uint8)
            raw = raw.reshape(len(which), w, size)
            for b in range(w):
                rows |= np.unpackbits(raw[:, b], axis=1, count=n).astype(np.uint32) << np.uint32(b)
        for k, i in enumerate(which):
            low, _, n_over, _ = heads[i]
            if n_over:
                at = _HEAD.size + size * w
                places = np.frombuffer(blocks[i], "<u2", n_over, at)
                rows[k, places] = np.frombuffer(blocks[i], "<u4", n_over, at + 2 * n_over)
            out[starts[i]:starts[i + 1]] = rows[k] + np.uint32(low)
    return out


class FileWriter:
    def __init__(self, uri: str, block: int = BLOCK, percentile: float = PERCENTILE):
        fs, path = pafs.FileSystem.from_uri(uri)
        if isinstance(fs, pafs.LocalFileSystem):
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.block, self.percentile = fs.open_output_stream(path), block, percentile
        self.out.write(MAGIC)
        self.at, self.starts = len(MAGIC), []
        self.docs, self.known, self.counts = [], [], []
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.counts.append(len(ids) // 4)
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= SLAB * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        n = len(ids) if last else len(ids) // self.block * self.block
        for data in pack(ids[:n], self.block, self.percentile):
            self.starts.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.n_ids += n
        self.waiting, self.n_waiting = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> None:
        self._flush(True)
        for part in (np.array(self.docs, "<i8"), np.array(self.known, "u1"), np.array(self.counts, "<u8"),
                     np.array([*self.starts, self.at], "<u8")):
            self.out.write(part.tobytes())
        self.out.write(_FOOT.pack(len(self.docs), self.n_ids, len(self.starts), self.at, MAGIC))
        self.out.close()


class FileReader:
    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n_docs, self.n_ids, self.n_blocks, tail, magic = _FOOT.unpack(self._read(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        rest = self._read(tail, size - _FOOT.size - tail)
        self.docs = np.frombuffer(rest, "<i8", n_docs)
        self.known = np.frombuffer(rest, "u1", n_docs, 8 * n_docs)
        self.counts = np.frombuffer(rest, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.starts = np.frombuffer(rest, "<u8", self.n_blocks + 1, 17 * n_docs).astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first .. last-1."""
        base = int(self.starts[first])
        raw = self._read(base, int(self.starts[last]) - base)
        cuts = (self.starts[first:last + 1] - base).tolist()
        return unpack([raw[a:b] for a, b in zip(cuts, cuts[1:])])

    def ids(self, first: int, n: int, block: int = BLOCK) -> np.ndarray:
        """``n`` ids from number ``first`` on, through the block index."""
        a, b = first // block, min(self.n_blocks, -(-(first + n) // block))
        return self.blocks(a, b)[first - a * block:first - a * block + n] if n else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, its ids as little-endian unsigned 32-bit integers), in order."""
        have, nxt = np.zeros(0, np.uint32), 0
        for doc, known, n in zip(self.docs.tolist(), self.known.tolist(), self.counts.tolist()):
            parts, missing = [have[:n]], n - len(have)
            have = have[n:]
            while missing > 0:
                have = self.blocks(nxt, min(self.n_blocks, nxt + SLAB))
                nxt = min(self.n_blocks, nxt + SLAB)
                parts.append(have[:missing])
                got = len(parts[-1])
                have, missing = have[got:], missing - got
            yield (doc if known else None), np.concatenate(parts).astype("<u4").tobytes()


def write_token_files(docs: DataFrame, folder: str, path: str, pieces=words, end_id: int | None = END_ID) -> DataFrame:
    """Writes the ids of all texts under ``folder`` in ascending doc_id order; returns the manifest:
    ``part, uri, n_docs, n_ids, before`` with the ids of all earlier files in ``before``. It has one row a file."""
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        uri = f"{folder}/part-{part:06d}-{context.taskAttemptId()}.ids"
        coder, out = encoder(path, pieces), None
        for b in batches:
            if b.num_rows and out is None:
                out = FileWriter(uri)
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                out.add(doc_id, coder.ids(text.as_py()) + tail)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [uri],
                                              "n_docs": [len(out.docs)], "n_ids": [out.n_ids]})

    # rows of one doc_id or without one are spread as well: by how their text begins, its hash, and equal rows by place
    order = [F.col("doc_id").asc_nulls_first(), F.col("head"), F.col("hash"), F.col("place")]
    dealt = doc_texts(docs).withColumns({"head": F.substring("text", 1, 64), "hash": F.xxhash64("text"),
                                         "place": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = cut_lineage(dealt.mapInArrow(run, "part int, uri string, n_docs long, n_ids long"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every document; ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, at in zip(b.column("uri").to_pylist(), b.column("before").to_pylist()):
                rows, size = ([], [], []), 0
                for doc_id, ids in FileReader(uri).documents():
                    for column, v in zip(rows, (doc_id, at, ids)):
                        column.append(v)
                    at += len(ids) // 4
                    size += len(ids)
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = ([], [], []), 0
                yield _batch(rows)

    def _batch(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.binary()))],
                                          names=["doc_id", "start", "ids"])

    # a stated number of partitions, as Spark would read all files in one task for the manifest's few bytes
    files = manifest.repartitionByRange(max(1, manifest.count()), "uri")
    return files.mapInArrow(run, "doc_id long, start long, ids binary")


def token_file_rows(docs: DataFrame, path: str, folder: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """One row per row of ``docs``, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    A null or empty text has the end id alone. Rows without a doc_id come
    first; rows that repeat a doc_id are ordered by their text's first 64
    characters, then by its xxhash64.
    A very long text is encoded in pieces and lies in one file. An empty
    table gives no file and no rows; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token_files/{uuid.uuid4().hex}"
    rows = read_token_files(write_token_files(docs, folder, path, end_id=end_id))
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_rows(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


ORACLE_SQL = {}
