"""Substring deduplication by super-k-mers of words.

A window is ``k`` consecutive words. Its minimiser is the smallest hash of
the word pairs in it, and consecutive windows of a document that share
their minimiser travel as one string, a super-k-mer, to the minimiser's
bucket: about k + 5 words for six windows instead of 6 k. Equal windows
have equal minimisers, so a bucket sees every copy of its windows. There
the windows are sorted and the smallest doc_id of each is found exactly
(equal hashes are compared word by word).

A frequent word pair may be the minimiser of far more windows than a bucket
should hold. So windows are counted first, by their minimiser and by their
two smallest pair hashes. A task counts ``PIECE_BYTES`` of text at a time and
sends on what it met ``LEAST_COUNT`` times there, so the counts are a small
share of the text at any size, and a sum is too low by less than
``LEAST_COUNT`` a piece. Windows of a minimiser over ``HEAVY_WINDOWS`` go by
the two smallest hashes instead, and if that pair is over it too, each by the
hash of all its words. All of this follows from the window and the counts, so
equal windows still meet; the runs of super-k-mers are cut where it changes.

Rows are dealt into chunks by doc_id and text, so rows without a doc_id, or
of one that repeats, are spread; only equal rows stay together. A chunk sends each distinct
super-k-mer once, with the smallest and largest doc_id that hold it, so a
passage that very many documents share costs a bucket one row a chunk. A
bucket answers the chunk only where a window starts in a smaller document
than some document of the chunk. The chunk, dealt by the same exchange,
cuts its texts again and marks the words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import doc_texts, ready, table, tasks_for

WINDOW = 13
#: Words whose hash is a minimiser candidate.
SEED_WORDS = 2
#: Most windows of one super-k-mer; longer runs (a text of one word) are cut.
MOST_WINDOWS = 256
#: Most windows of a minimiser that are not split.
HEAVY_WINDOWS = 1 << 20
#: Bytes of text that are cut at a time while counting, and whose counts are summed before they are sent.
COUNT_BYTES, PIECE_BYTES = 2 << 20, 32 << 20
#: Windows of a key in one piece from which on they are reported.
LEAST_COUNT = 16
#: Bytes of text of a chunk, and for which there is a bucket; both are counted, not estimated.
CHUNK_BYTES = 10 << 20
BUCKET_BYTES = 10 << 20
#: Chunks or buckets of a task, where there are many.
GROUPS_A_TASK = 4
#: Bytes of words that are hashed at a time.
HASH_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max
TOP = np.uint64(np.iinfo(np.uint64).max)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def least_two(x: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the second smallest distinct value of every ``span`` consecutive ones; the second
    is ``TOP`` if all are equal."""
    a, b, width = x, np.full(len(x), TOP), 1
    while width < span:
        step = min(width, span - width)
        a0, a1 = a[:-step], a[step:]
        b = np.minimum(np.minimum(b[:-step], b[step:]), np.where(a0 == a1, TOP, np.maximum(a0, a1)))
        a = np.minimum(a0, a1)
        width += step
    return a, b


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BYTE_HASH = _mixed(np.arange(1, 257, dtype=np.uint64))


def word_hashes(joined: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each word of bytes that end in one space each, at ``at``."""
    begin = np.append(0, at[:-1] + 1)
    out = np.empty(len(at), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, len(joined), HASH_BYTES)), len(at)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        first, size = begin[a:b], at[a:b] + 1 - begin[a:b]
        powers = np.full(size.max(), 0x100000001B3, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        part = BYTE_HASH[joined[first[0]:at[b - 1] + 1]]
        part *= powers[np.arange(len(part)) - np.repeat(first - first[0], size)]
        out[a:b] = np.add.reduceat(part, first - first[0])
    return _mixed(out)


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which ``keys`` are in the sorted ``some``."""
    if not len(some):
        return np.zeros(len(keys), bool)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their ``n``."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(n, heads)


def key_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))  # neighbours mostly share their key
    return summed(keys[heads], np.diff(np.append(heads, len(keys))))


class Chunk:
    """The words, windows and super-k-mers of some documents, in order of doc_id."""

    def __init__(self, ids: list, texts: list[str], k: int):
        order = sorted(range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i], texts[i]))
        self.ids = np.array([NO_ID if ids[i] is None else ids[i] for i in order], np.int64)
        self.known = [ids[i] is not None for i in order]
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in order]
        last = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        raw = np.frombuffer(b" ".join([*raw, b""]), np.uint8)  # every text ends in a space
        space = SPACE[raw]
        end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        keep = ~space
        keep[end] = True
        self.bytes = np.where(space, np.uint8(32), raw)[keep]  # words, each with one space behind it
        self.joined = self.bytes.tobytes()
        self.at = np.flatnonzero(self.bytes == 32)  # a word's end
        self.n_words = len(self.at)
        self.counts = np.diff(np.searchsorted(end, last), prepend=0)
        self.first = np.cumsum(self.counts) - self.counts
        self.k = k

    def slice(self, first: int, n: int) -> bytes:
        return self.joined[self.at[first - 1] + 1 if first else 0:self.at[first + n - 1]]

    def windows(self) -> bool:
        """Sets word_hash, and for each window start and doc, its first word and document, and low and low_two,
        its smallest pair hash and that with the second smallest. False if there are none."""
        k, n = self.k, self.n_words
        n_windows = np.maximum(self.counts - k + 1, 0)
        total = int(n_windows.sum())
        if not total:
            return False
        h = word_hashes(self.bytes, self.at)
        seeds = h.copy()
        for j in range(1, SEED_WORDS):
            seeds[:n - j] = _mixed(seeds[:n - j] * np.uint64(3) + h[j:])
        least, second = least_two(seeds[:n - SEED_WORDS + 1], k - SEED_WORDS + 1)
        before = np.cumsum(n_windows) - n_windows
        self.word_hash = h
        self.doc = np.repeat(np.arange(len(self.counts)), n_windows)
        self.start = np.arange(total) - np.repeat(before - self.first, n_windows)
        self.low = least[self.start]
        self.low_two = _mixed(self.low * np.uint64(3) + second[self.start])
        return True

    def keys(self, heavy: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What decides a window's bucket, and the windows that are keyed by all their words. ``heavy``: by level,
        the sorted keys whose windows are split."""
        key = self.low.copy()
        split = np.flatnonzero(_among(key, heavy[0]))
        key[split] = self.low_two[split]
        split = split[_among(key[split], heavy[1])]
        whole = np.zeros(len(split), np.uint64)
        for j in range(self.k):
            whole = whole * np.uint64(0x100000001B3) + _mixed(self.word_hash[self.start[split] + j])
        key[split] = whole
        return key, split

    def superkmers(self, heavy: tuple[np.ndarray, np.ndarray]) -> None:
        """run_*: each occurrence's super-k-mer, first word, windows and document; text, bucket_key, low,
        high: the distinct ones, in order of first sight."""
        k = self.k
        if not self.windows():
            self.text, self.bucket_key = [], np.zeros(0, np.uint64)
            self.run_text = self.run_first = self.run_windows = self.run_doc = np.zeros(0, np.int64)
            self.low = self.high = np.zeros(0, np.int64)
            return
        start, doc, (low, single) = self.start, self.doc, self.keys(heavy)
        total = len(start)
        new = np.ones(total, bool)
        new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
        new[single] = True  # equal neighbours too, so that a chunk sends such a window once
        head = np.flatnonzero(new)
        new[np.flatnonzero((np.arange(total) - np.repeat(head, np.diff(np.append(head, total)))) % MOST_WINDOWS == 0)] = True
        head = np.flatnonzero(new)
        self.run_first, self.run_doc = start[head], doc[head]
        self.run_windows = np.diff(np.append(head, total))
        begin = np.where(self.run_first > 0, self.at[self.run_first - 1] + 1, 0).tolist()
        end = self.at[self.run_first + self.run_windows + k - 2].tolist()
        joined = self.joined
        number: dict[bytes, int] = {}
        self.run_text = np.fromiter((number.setdefault(joined[a:b], len(number)) for a, b in zip(begin, end)), np.int64, len(begin))
        self.text = list(number)
        self.bucket_key = np.zeros(len(self.text), np.uint64)
        self.bucket_key[self.run_text] = _mixed(low[head])
        ids = self.ids[self.run_doc]
        self.low, self.high = np.full(len(self.text), NO_ID), np.full(len(self.text), -NO_ID)
        np.minimum.at(self.low, self.run_text, ids)
        np.maximum.at(self.high, self.run_text, ids)

    def by_bucket(self, n_buckets: int):
        """(bucket, its distinct super-k-mers in their order)"""
        bucket = (self.bucket_key % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            yield int(bucket[order[a]]), order[a:b]

    def digests(self, removed: np.ndarray) -> tuple[list, list]:
        """Removed words and hash of the words that are left, by document."""
        lost = np.add.reduceat(np.append(removed, 0), np.minimum(self.first, len(removed)), dtype=np.int64) if len(self.ids) else []
        gone, sha = [], []
        for f, n, x in zip(self.first.tolist(), self.counts.tolist(), lost):
            x = int(x) if n else 0
            if not x:
                text = self.slice(f, n) if n else b""
            else:
                text = b" ".join([w for w, r in zip(self.slice(f, n).split(b" "), removed[f:f + n].tolist()) if not r])
            gone.append(x)
            sha.append(hashlib.sha256(text).hexdigest())
        return gone, sha


def window_lows(texts: list[bytes], low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For super-k-mers held by documents from ``low`` on: windows of each, and for every window the
    smallest document that holds it anywhere among them."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()).cast(pa.large_string(), safe=False), " ")
    n_words = pc.list_value_length(lists).to_numpy().astype(np.int64)
    codes = lists.flatten().dictionary_encode().indices.to_numpy()
    n_windows = n_words - k + 1
    total = int(n_windows.sum())
    start = np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows - (np.cumsum(n_words) - n_words), n_windows)
    mixed = _mixed(codes.astype(np.uint64) + np.uint64(1))
    h = np.zeros(total, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x100000001B3) + mixed[start + j]
    order = np.argsort(h)
    sorted_start, new = start[order], np.ones(total, bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    twin = np.flatnonzero(~new)  # same hash as the one before: same words?
    for j in range(k):
        if (codes[sorted_start[twin] + j] != codes[sorted_start[twin - 1] + j]).any():
            rows = np.lib.stride_tricks.sliding_window_view(codes, k)[start]
            order = np.lexsort(rows.T)
            new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(1)
            break
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(np.repeat(low, n_windows)[order], heads)
    out = np.empty(total, np.int64)
    out[order] = np.repeat(least, np.diff(np.append(heads, total)))
    return n_windows, out


def heavy_keys(docs: DataFrame, k: int, most: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """By level, the sorted keys of more than ``most`` windows, and the bytes of all texts. Only these keys come
    to the driver: of all windows there are at most one in ``most``, by each level."""
    least = min(LEAST_COUNT, most + 1)

    def reported(counted: list) -> pa.RecordBatch:
        levels, keys, sums = [], [], []
        for level in (0, 1):
            key, n = summed(*(np.concatenate([c[level][x] for c in counted]) for x in (0, 1)))
            levels.append(np.full((n >= least).sum(), level, np.int32))
            keys.append(key[n >= least].view(np.int64))
            sums.append(n[n >= least])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (levels, keys, sums)], names=["level", "key", "n"])

    def count(batches):
        counted, texts, size, piece, whole = [], [], 0, 0, 0

        def cut() -> None:
            c = Chunk(list(range(len(texts))), texts, k)
            if c.windows():
                counted.append((key_counts(c.low), key_counts(c.low_two)))

        for b in batches:
            for t in b.column("text"):
                texts.append(t.as_py())
                size += len(t.as_buffer())
                if size >= COUNT_BYTES:
                    cut()
                    texts, size, piece, whole = [], 0, piece + size, whole + size
                    if piece >= PIECE_BYTES and counted:
                        yield reported(counted)
                        counted, piece = [], 0
        cut()
        if counted:
            yield reported(counted)
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0]), pa.array([whole + size])], names=["level", "key", "n"])

    counts = (doc_texts(docs).select("text").mapInArrow(count, "level int, key long, n long")
              .groupBy("level", "key").agg(F.sum("n").alias("n")).filter((F.col("n") > most) | (F.col("level") == 2)))
    found = counts.collect()
    keys = tuple(np.sort(np.array([r["key"] for r in found if r["level"] == level], np.int64).view(np.uint64)) for level in (0, 1))
    return keys, sum(r["n"] for r in found if r["level"] == 2)


def _packed(*parts: bytes) -> bytes:
    sizes = np.array([len(p) for p in parts], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(parts))


def _unpacked(data: bytes, n: int) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    ends = 8 * n + np.cumsum(np.frombuffer(data, np.int64, n))
    return [data[a:b] for a, b in zip([8 * n, *ends], ends)]


def dealt_texts(docs: DataFrame, n_chunks: int) -> DataFrame:
    return doc_texts(docs).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int"))


def remove_repeats(docs: DataFrame, k: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_bytes: int = BUCKET_BYTES, heavy_windows: int = HEAVY_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``.

    Words covered by a window that also starts in a document with a smaller
    doc_id are removed; windows are judged on the input. A null or empty
    text has no words. A row without a doc_id counts as larger than any
    other; such rows lose what other documents hold, and nothing to one
    another. Rows that repeat a doc_id are one document. Texts of fewer than
    ``k`` words lose nothing. An empty table gives no rows; other columns
    are ignored.
    """
    ready(docs.sparkSession)
    heavy, n_bytes = heavy_keys(docs, k, heavy_windows)
    n_chunks, n_buckets = (max(1, -(-n_bytes // each)) for each in (chunk_bytes, bucket_bytes))
    chunk_tasks, bucket_tasks = (tasks_for(docs.sparkSession, n, GROUPS_A_TASK) for n in (n_chunks, n_buckets))
    dealt = dealt_texts(docs, n_chunks).repartition(chunk_tasks, "chunk")

    def send(t: pa.Table) -> pa.Table:
        c = Chunk(t.column("doc_id").to_pylist(), t.column("text").to_pylist(), k)
        c.superkmers(heavy)
        rows = [(b, _packed(b"\n".join([c.text[i] for i in own]), np.diff(c.low[own], prepend=0).tobytes(),
                            (c.high[own] - c.low[own]).tobytes())) for b, own in c.by_bucket(n_buckets)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "chunk": pa.array([t.column("chunk")[0].as_py()] * len(rows), pa.int32()),
                         "data": pa.array([r[1] for r in rows], pa.binary())})

    def count(t: pa.Table) -> pa.Table:
        chunks, texts, lows, highs = t.column("chunk").to_pylist(), [], [], []
        for data in t.column("data"):
            text, low, extra = _unpacked(data.as_py(), 3)
            texts.append(text.split(b"\n"))
            lows.append(np.cumsum(np.frombuffer(low, np.int64)))
            highs.append(lows[-1] + np.frombuffer(extra, np.int64))
        n_windows, least = window_lows([x for own in texts for x in own], np.concatenate(lows), k)
        begin = np.cumsum(n_windows) - n_windows
        worth = np.minimum.reduceat(least, begin) < np.concatenate(highs)
        rows, at = [], 0
        for chunk, own in zip(chunks, texts):
            own = np.arange(at, at + len(own))
            at += len(own)
            told = own[worth[own]]
            if len(told):
                lists = [least[begin[i]:begin[i] + n_windows[i]] for i in told]
                rows.append((chunk, _packed((told - own[0]).astype(np.int32).tobytes(), np.concatenate(lists).tobytes())))
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()),
                         "bucket": pa.array([t.column("bucket")[0].as_py()] * len(rows), pa.int32()),
                         "told": pa.array([r[1] for r in rows], pa.binary())})

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        c = Chunk(left.column("doc_id").to_pylist(), left.column("text").to_pylist(), k)
        removed = np.zeros(c.n_words, np.int64)
        if right.num_rows:
            c.superkmers(heavy)
            own = dict(c.by_bucket(n_buckets))
            windows = np.zeros(len(c.text), np.int64)
            windows[c.run_text] = c.run_windows
            at, lists, used = np.full(len(c.text), -1), [], 0
            for bucket, data in zip(right.column("bucket").to_pylist(), right.column("told").to_pylist()):
                told, least = _unpacked(data, 2)
                which = own[bucket][np.frombuffer(told, np.int32)]
                at[which] = used + np.cumsum(windows[which]) - windows[which]
                lists.append(np.frombuffer(least, np.int64))
                used += len(lists[-1])
            least = np.concatenate(lists)
            runs = np.flatnonzero(at[c.run_text] >= 0)
            n = c.run_windows[runs]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            smaller = least[np.repeat(at[c.run_text[runs]], n) + step] < np.repeat(c.ids[c.run_doc[runs]], n)
            first = (np.repeat(c.run_first[runs], n) + step)[smaller]
            steps = np.zeros(c.n_words + 1, np.int64)
            np.add.at(steps, first, 1)
            np.add.at(steps, first + k, -1)
            removed = (np.cumsum(steps[:-1]) > 0).astype(np.int64)
        gone, sha = c.digests(removed)
        return pa.table({"doc_id": pa.array([i if x else None for i, x in zip(c.ids.tolist(), c.known)], pa.int64()),
                         "n_words": pa.array(c.counts), "n_removed": pa.array(gone, pa.int64()),
                         "kept_sha256": pa.array(sha, pa.string())})

    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, data binary")
    told = sent.repartition(bucket_tasks, "bucket").groupBy("bucket").applyInArrow(count, "chunk int, bucket int, told binary")
    told = told.repartition(chunk_tasks, "chunk")
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        mark, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE_SQL = {}
