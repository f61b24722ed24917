"""Maximal periodic runs of words, by seeds on diagonals.

A run of period q and length at least max(12, 2q) holds a stretch of words
that agree with those q further on, at least max(6, q) of them: the
guaranteed overlap. So lags are taken in classes, below 8 and then from k
to 2k for k = 8, 16, 32 ...; a class indexes k-grams (6-grams below 8) by
name and looks at pairs of equal ones whose lag belongs to it.

A pair whose words before agree too lies on a stretch that the pair before
it starts, so its lag is covered beyond it and it is not extended. Such
pairs are not even formed: the occurrences of a gram are kept in blocks of
one preceding word, and only pairs of different blocks are looked at. In a
long repetition all occurrences are one block, so its pairs, of which there
would be as many as the square of its length, never appear; what does is a
pair for each multiple of its period. What starts is extended by names of
halving length, exactly, and a table of the furthest end that each lag has
covered drops what begins behind that end.

Of stretches that give the same words the smallest lag is the period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from omoplate.llm.common import crc32_sql, doc_texts, ready, table

LEAST = 12
FIRST_GRAM = 6
FIRST_LAGS = 8


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only."""
    keys = left.astype(np.int64) << 32 | right
    return np.unique(keys, return_inverse=True)[1].astype(np.int32)


def _doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of grams of twice the size."""
    return _pair_names(names[:-size], names[size:])


def _repeats(names: np.ndarray) -> bool:
    return len(names) > 0 and int(names.max()) + 1 < len(names)


def _starts(names: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of equal grams, ``low <= j - i < high``, whose words before differ or are missing."""
    order = np.argsort(names, kind="stable")
    name = names[order].astype(np.int64)
    word = np.where(order > 0, words[order - 1].astype(np.int64), -1)
    cut = np.flatnonzero((name[1:] != name[:-1]) | (word[1:] != word[:-1])) + 1
    first = np.concatenate([[0], cut])  # of each block
    last = np.concatenate([cut, [len(order)]])
    block = np.repeat(np.arange(len(first)), last - first)
    reach = len(names) + high
    place = name * reach + order
    left, right, at, ahead = [], [], np.arange(len(order)), 1
    while True:
        at = at[block[at] + ahead < len(first)]
        b = block[at] + ahead
        near = (name[first[b]] == name[at]) & (order[first[b]] - order[at] < high)
        at, b = at[near], b[near]
        if not len(at):
            break
        other = word[first[b]] != word[at]
        a, b = at[other], b[other]
        lo = np.maximum(first[b], np.searchsorted(place, place[a] + low))
        hi = np.minimum(last[b], np.searchsorted(place, place[a] + high))
        n = np.maximum(0, hi - lo)
        k = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        left.append(np.repeat(order[a], n))
        right.append(order[k])
        ahead += 1
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _agree(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i on agree with those from j on. ``levels[x]`` names grams of 2^x words; a
    longer agreement than the last level twice is impossible."""
    n, done = len(levels[0]), np.zeros(len(i), np.int64)
    for x in range(len(levels) - 1, -1, -1):
        size, names = 1 << x, levels[x]
        open_ = np.flatnonzero(j + done + size <= n)
        same = open_[names[i[open_] + done[open_]] == names[j[open_] + done[open_]]]
        done[same] += size
    return done


def _uncovered(lag: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marks the stretches that begin where their lag is not covered yet: the table of furthest ends."""
    keep, table_of = np.ones(len(lag), bool), {}
    for x in np.lexsort((begin, lag)).tolist():
        q = int(lag[x])
        if begin[x] < table_of.get(q, -1):
            keep[x] = False
        else:
            table_of[q] = int(end[x])
    return keep


def runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every maximal run of at least ``max(least, 2 * period)`` words, by
    start, then period. ``words`` holds a number for each word. ``least`` is 12 or more."""
    if least < LEAST:
        raise ValueError(f"runs of fewer than {LEAST} words have too short an overlap to be seeded")
    if len(words) < least:
        return []
    two = _doubled(words, 1)
    four = _doubled(two, 2)
    grams = _pair_names(four[:-2], two[4:])  # of 6 words
    if not _repeats(grams):
        return []
    levels, low, high = [words, two, four], 1, FIRST_LAGS
    while _repeats(levels[-1]) and 2 << (len(levels) - 1) <= len(words):  # nothing longer repeats beyond the last
        levels.append(_doubled(levels[-1], 1 << (len(levels) - 1)))
    found: dict[tuple[int, int], int] = {}
    while _repeats(grams):
        i, j = _starts(grams, words, low, high)
        end = i + _agree(levels, i, j)
        lag = j - i
        long = end + lag - i >= np.maximum(least, 2 * lag)
        i, end, lag = i[long], end[long], lag[long]
        new = _uncovered(lag, i, end)
        for s, e, q in sorted(zip(i[new].tolist(), (end + lag)[new].tolist(), lag[new].tolist()), key=lambda r: r[2]):
            found.setdefault((s, e), q)  # lags come in ascending order: the first is the smallest period
        low, high = high, 2 * high
        if low.bit_length() > len(levels):
            break
        grams = levels[low.bit_length() - 1]
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the repetition that the query's contract sets into every tenth document."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


def summary(words: list[bytes]) -> tuple:
    """n_runs; start, length, period, exponent_milli of the longest; digests of all runs and of the kept words."""
    found = runs(_numbers(words))
    gone = np.zeros(len(words) + 1, np.int64)
    for s, length, q in found:
        gone[s + q] += 1
        gone[s + length] -= 1
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    if found:
        s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
        top = (s, length, q, 1000 * length // q)
        kept = [words[x] for x in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    else:
        top, kept = (None,) * 4, words
    return (len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``.

    Words are what ASCII white space separates, compared as they are. A
    null or empty text has no word, no run, and the digests of nothing. Of
    equally long runs the first start, then the smaller period, is shown.
    Repeated rows repeat and a null doc_id stays null. A text is worked on
    whole in one task, whose memory grows with its words (about 4 bytes a
    word for each doubling that still repeats); time grows with words times
    doublings however often they repeat. An empty table gives no rows;
    other columns are ignored. With ``plant`` every tenth document by
    crc32 of its id first gets a repetition (none without a doc_id).
    """
    ready(docs.sparkSession)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                rows.append((doc_id, *summary(planted(words, doc_id) if plant else words)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return doc_texts(docs).mapInArrow(run, ", ".join(f"{n} long" for n in names[:6]) + ", runs_sha256 string, collapsed_sha256 string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


#: Pairs of equal six-word windows, gathered along each lag: another way to the same runs.
ORACLE_SQL = {"op13_periodic_runs": f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc32_sql("doc_id::VARCHAR")} AS h
  FROM documents),
params AS (
  SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[(a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8))) + 1] END) ELSE w END AS w
  FROM params),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM docs),
grams AS (
  SELECT doc_id, n, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS g
  FROM words QUALIFY i + 6 <= n),
pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM pairs GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, s, e, min(q) AS q FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e),
listed AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256,
         min_by(struct_pack(s := s, e := e, q := q), (s - e, s, q)) AS top
  FROM runs GROUP BY doc_id),
gone AS (
  SELECT DISTINCT w.doc_id, w.i FROM words w JOIN runs r ON w.doc_id = r.doc_id AND w.i >= r.s + r.q AND w.i < r.e),
kept AS (
  SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.e - top.s AS length, top.q AS period,
       1000 * (top.e - top.s) // top.q AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       coalesce(collapsed, sha256('')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""}
