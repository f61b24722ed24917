"""BPE encoding and decoding through a table of distinct words.

Texts are split at white space, which no token crosses. Documents are dealt
into chunks by doc_id and travel compressed. A chunk sends each of its
distinct words once to the word's bucket; a bucket encodes every distinct
word once and joins its ids to the pieces of the vocabulary (a table of
fixed size), and answers each chunk with the ids and pieces of its words in
the order in which they came. The chunk, dealt by the same exchange, joins
them back to its texts by position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import doc_texts, parts_for, ready, table

CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 24 << 20


class Vocabulary:
    """A tokenizer file: ids of words, and the table from id to piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None:
            raise ValueError("pieces joined by spaces are this decoder's result only where the file names no decoder")
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.pieces = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch([t.decode("utf-8", "surrogatepass") for t in texts],
                                                           add_special_tokens=False)]

    def decode(self, ids: list[int]) -> bytes:
        """Pieces of a word, joined as the file's decoding joins them."""
        return b" ".join([self.pieces[i] for i in ids])


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _by_bucket(own: set[bytes], n_buckets: int) -> dict[int, list[bytes]]:
    """Distinct words by bucket, in an order that depends on nothing else."""
    out: dict[int, list[bytes]] = {}
    for w in sorted(own):
        out.setdefault(xxhash.xxh3_64_intdigest(w) % n_buckets, []).append(w)
    return out


def _split(t: pa.Table) -> list[list[bytes]]:
    return [_opened(x.as_py()).split() for x in t.column("data")]


def encode_decode(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES,
                  bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids binary, decoded binary``. ids are little-endian
    unsigned 32-bit integers, decoded is UTF-8."""
    return _by_words(docs, path, chunk_bytes, bucket_bytes, "doc_id long, ids binary, decoded binary",
                     lambda ids, text: (ids, text))


def encode_decode_digests(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES,
                          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A null or empty text has no tokens and decodes to nothing. Rows without
    or with repeated doc_ids are encoded each for itself. An empty table
    gives no rows; other columns are ignored.
    """
    return _by_words(docs, path, chunk_bytes, bucket_bytes,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                     lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))


def _by_words(docs: DataFrame, path: str, chunk_bytes: int, bucket_bytes: int, schema: str, result) -> DataFrame:
    ready(docs.sparkSession)
    n_chunks, n_buckets = parts_for(docs, chunk_bytes), parts_for(docs, bucket_bytes)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [_squeezed(t.as_buffer()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("chunk"), pa.array(data, pa.binary())],
                                             names=["doc_id", "chunk", "data"])

    dealt = doc_texts(docs).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int")
                                       ).mapInArrow(squeeze, "doc_id long, chunk int, data binary")

    def send(t: pa.Table) -> pa.Table:
        chunk, own = t.column("chunk")[0].as_py(), set()
        for x in t.column("data"):
            own.update(_opened(x.as_py()).split())
        rows = [(bucket, _squeezed(b"\n".join(ws))) for bucket, ws in _by_bucket(own, n_buckets).items()]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "chunk": pa.array([chunk] * len(rows), pa.int32()),
                         "words": pa.array([r[1] for r in rows], pa.binary())})

    def encode(t: pa.Table) -> pa.Table:
        vocab, lists = vocabulary(path), [_opened(x.as_py()).split(b"\n") for x in t.column("words")]
        distinct = sorted(set().union(*lists))
        known = {}
        for at in range(0, len(distinct), 10_000):
            part = distinct[at:at + 10_000]
            for w, ids in zip(part, vocab.encode(part)):
                known[w] = (np.array(ids, "<u4").tobytes(), vocab.decode(ids))
        answers = []
        for own in lists:
            pairs = [known[w] for w in own]
            sizes = np.array([len(i) // 4 for i, _ in pairs], "<u4").tobytes()
            ids = np.frombuffer(b"".join([i for i, _ in pairs]), np.uint8).reshape(-1, 4).T.tobytes()  # bytes of a place together
            answers.append((_squeezed(sizes + ids), _squeezed(b"\n".join([d for _, d in pairs]))))
        return pa.table({"chunk": t.column("chunk").cast(pa.int32()), "bucket": t.column("bucket").cast(pa.int32()),
                         "ids": pa.array([a for a, _ in answers], pa.binary()),
                         "pieces": pa.array([b for _, b in answers], pa.binary())})

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = _split(left)
        own = _by_bucket(set().union(*texts), n_buckets)
        ids_of, pieces_of = {}, {}
        for bucket, ids, pieces in zip(*(right.column(c).to_pylist() for c in ("bucket", "ids", "pieces"))):
            ws, data = own[bucket], _opened(ids)
            ends = np.cumsum(np.frombuffer(data, "<u4", len(ws))).tolist()
            flat = np.frombuffer(data, np.uint8, offset=4 * len(ws)).reshape(4, -1).T.tobytes()
            for w, a, b, d in zip(ws, [0, *ends], ends, _opened(pieces).split(b"\n")):
                ids_of[w] = flat[4 * a:4 * b]
                pieces_of[w] = d
        rows = []
        for doc_id, ws in zip(left.column("doc_id").to_pylist(), texts):
            ids = b"".join(map(ids_of.__getitem__, ws))
            text = b" ".join([d for d in map(pieces_of.__getitem__, ws) if d])
            rows.append((doc_id, *result(ids, text)))
        return pa.table([pa.array([r[i] for r in rows], kinds[k]) for i, k in enumerate(types)], names=names)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, words binary")
    answers = sent.groupBy("bucket").applyInArrow(encode, "chunk int, bucket int, ids binary, pieces binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(join_back, schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


ORACLE_SQL = {}
