"""Delimited records from text files that Spark splits anywhere.

A quoted field may hold line breaks, so where a record begins depends on all
quotes before it. No task reads a file whole for that: every split is a
function from "begins outside quotes" or "inside" to how it ends, both are
tried where the split is read, and the functions of a file's splits are
composed in order in a table of one short row a split. A second scan then
knows how each split begins, cuts its records and counts their fields. A
record that crosses splits arrives as fragments, which alone are shuffled
and joined. The texts themselves are never shuffled.
"""

from __future__ import annotations

import codecs
import csv
import io
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.operators.sizing import DEFAULT_BROADCAST_ROWS, fits
from omoplate.session import cut_lineage

#: Encodings in which a line break is not one byte of its own.
WIDE_ENCODINGS = ("utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be")


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str = '"'
    escape: str | None = None
    encoding: str = "utf-8"
    skip: int = 0

    def reader(self, lines):
        csv.field_size_limit(2 ** 31 - 1)
        quoting = {"quoting": csv.QUOTE_NONE} if not self.quote else {"quotechar": self.quote}
        return csv.reader(lines, delimiter=self.sep, doublequote=self.escape is None, escapechar=self.escape, **quoting)


def can_read(encoding: str, sep: str, quote: str, escape: str | None) -> bool:
    """Whether records can be cut line by line: one-character marks, an encoding that extends ASCII."""
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        return False
    return name not in WIDE_ENCODINGS and len(sep) == 1 and len(quote) <= 1 and (escape is None or len(escape) == 1)


class _Lines:
    """Feeds the reader and remembers the lines of the record at hand. ``inside`` opens a quote first."""

    def __init__(self, lines: Iterator[str], dialect: Dialect, inside: bool):
        self.lines, self.dialect, self.inside, self.held, self.ended = lines, dialect, inside, [], False

    def __iter__(self):
        return self

    def __next__(self) -> str:
        if self.ended:
            raise StopIteration
        line = next(self.lines, None)
        if line is None:
            # a record that is open takes in what follows the last line; a complete one does not
            self.ended = True
            return "\x00end"
        self.held.append(line)
        first, self.inside = self.inside, False
        return self.dialect.quote + line if first else line


def records(lines: Iterator[str], dialect: Dialect, inside: bool = False) -> Iterator[tuple[list[str], list[str], bool]]:
    """``(fields, lines, complete)`` of every record; the last may be incomplete. With ``inside`` the first
    is the end of a record that began before. Blank lines are records without fields."""
    feed = _Lines(lines, dialect, inside and bool(dialect.quote))
    for fields in dialect.reader(feed):
        if feed.ended:
            if feed.held:  # the mark behind the last line went into an open field
                yield fields, feed.held, False
            return
        own, feed.held = feed.held, []
        yield fields, own, True


def transition(lines: Iterator[str | None], dialect: Dialect) -> tuple[int, bool, bool, bool]:
    """Of a split: its lines; whether it ends inside quotes if it begins outside, and if inside; whether in the
    latter case the open field is closed at all. Lines are not kept beyond the record they belong to."""
    count = 0

    def counted():
        nonlocal count
        for t in lines:
            count += 1
            if t is not None:
                yield t

    texts = counted()
    # lines without a quote change nothing
    first = next((t for t in texts if dialect.quote and dialect.quote in t), None)
    if first is None:
        return count, False, True, False
    copies = itertools.tee(itertools.chain([first], texts))
    both = [records(c, dialect, inside) for c, inside in zip(copies, (False, True))]
    taken, end, closed, running = [0, 0], [False, True], False, {0, 1}
    while running:
        x = min(running, key=taken.__getitem__)  # in step, so that neither copy lags behind the other
        found = next(both[x], None)
        if found is None:
            running.discard(x)
            continue
        _, own, complete = found
        taken[x] += len(own)
        end[x] = not complete
        closed |= x == 1 and complete
        if complete and taken[0] == taken[1] and len(running) == 2 and not end[1 - x]:
            running = {0}  # both are outside quotes behind the same line: from here on they are one
            both[1].close()
            for _, _, complete in both[0]:
                end[0] = not complete
            return count, end[0], end[0], closed
    return count, end[0], end[1], closed


def _splits(batches: Iterator[pa.RecordBatch], dialect: Dialect) -> Iterator[tuple[tuple, Iterator[str]]]:
    """``(key, lines)`` of each split in turn; a key is the columns but the text. Lines keep their breaks."""

    def rows():
        at = 0
        last = None
        for b in batches:
            keys = zip(*[b.column(n).to_pylist() for n in b.schema.names if n != "value"])
            for key, raw in zip(keys, b.column("value")):
                at = at + 1 if key == last else 0
                last = key
                if key[1] == 0 and at < dialect.skip:
                    text = None  # not a record, but a line
                else:
                    raw = raw.as_py()
                    text = (raw[3:] if key[1] == 0 and at == 0 and raw[:3] == codecs.BOM_UTF8 else raw).decode(dialect.encoding) + "\n"
                yield key, text

    stream = rows()
    ahead = next(stream, None)
    while ahead is not None:
        key = ahead[0]

        def lines():
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                text = ahead[1]
                ahead = next(stream, None)
                yield text

        own = lines()
        yield key, own
        for _ in own:  # whatever the caller left
            pass


def _text(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").cast("binary").alias("value"))


def _entered(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame:
    """One row a split: ``file, block, inside`` (it begins within quotes), ``first`` (the number of its first
    line, from 0), ``lost`` (what is open at its end is not closed in the file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _splits(batches, dialect):
            n, f0, f1, closes = transition(lines, dialect)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file], pa.string()), pa.array([block], pa.int64()), pa.array([n], pa.int64()),
                 *(pa.array([x]) for x in (f0, f1, closes))], names=["file", "block", "n", "f0", "f1", "closes"])

    ends = cut_lineage(_text(spark, path).mapInArrow(
        run, "file string, block long, n long, f0 boolean, f1 boolean, closes boolean"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # composing: the last split whose end does not depend on its beginning, then the parity of those that turn it round
    fixed, turns = F.col("f0") == F.col("f1"), F.sum((F.col("f0") & ~F.col("f1")).cast("int"))
    so_far = ends.withColumn("turns", turns.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    known = F.last(F.when(fixed, F.struct(F.col("f0").alias("end"), "turns")), ignorenulls=True).over(before)
    so_far = so_far.withColumns({"known": known, "earlier": F.coalesce(F.lag("turns").over(order), F.lit(0)),
                                 "first": F.coalesce(F.sum("n").over(before), F.lit(0))})
    base = F.coalesce(F.col("known.end"), F.lit(False)).cast("int")
    inside = ((base + F.col("earlier") - F.coalesce(F.col("known.turns"), F.lit(0))) % 2 == 1).alias("inside")
    states = so_far.select("file", "block", "first", inside, "f0", "f1", "closes")
    end = F.last(F.when(F.col("inside"), F.col("f1")).otherwise(F.col("f0"))).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    later = F.max(~F.col("inside") | F.col("closes")).over(order.rowsBetween(1, Window.unboundedFollowing))
    return cut_lineage(states.select("file", "block", "inside", "first", (end & ~F.coalesce(later, F.lit(False))).alias("lost")))


_OUT = "file string, line long, kind string, fields array<string>, block long, raw string"


def _rows(file: str, block: int, found: list[tuple[int, str, list[str] | None, str | None]]) -> pa.RecordBatch:
    n = len(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * n, pa.string()), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()),
         pa.array([x[2] for x in found], pa.list_(pa.string())), pa.array([block] * n, pa.int64()),
         pa.array([x[3] for x in found], pa.string())], names=["file", "line", "kind", "fields", "block", "raw"])


def read_records(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame:
    """``file, line, kind, fields`` of every record of the files under ``path``.

    ``line`` counts the file's lines from 1. ``kind`` is "record", "header"
    for a file's first, or "open" for a record whose quote is not closed
    before the file ends (its fields are null). Blank lines are left out.
    An empty file has no records.
    """
    entered = _entered(spark, path, dialect)
    if not fits(entered):
        raise ValueError(f"{path} is cut into more than {DEFAULT_BROADCAST_ROWS} splits; raise spark.sql.files.maxPartitionBytes")
    joined = _text(spark, path).join(F.broadcast(entered), ["file", "block"], "left")
    # the splits of this scan are those of the first unless the session's settings changed in between
    moved = F.raise_error(F.lit("the files were split anew between two scans; fix spark.sql.files.minPartitionNum"))
    joined = joined.select("file", "block", F.when(F.col("first").isNull(), moved.cast("long")).otherwise(F.col("first")).alias("first"),
                           "inside", "lost", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block, first, inside, lost), lines in _splits(batches, dialect):
            found, at, begun = [], first, block > 0 or inside
            skipped = 0

            def texts():
                nonlocal skipped
                for t in lines:
                    if t is None:
                        skipped += 1
                    else:
                        yield t

            head = inside
            for fields, own, complete in records(texts(), dialect, inside):
                line = at + skipped + 1
                at += len(own)
                if not head and complete:
                    if fields:
                        found.append((line, "record" if begun else "header", fields, None))
                        begun = True
                elif head and complete:
                    found.append((line, "end", None, "".join(own)))
                else:  # open until the file's end: its text is not carried anywhere
                    found.append((line, "middle" if head else "begin" if begun else "begin header", None, None if lost else "".join(own)))
                head = False
                if len(found) >= 4096:
                    yield _rows(file, block, found)
                    found = []
            if found:
                yield _rows(file, block, found)

    out = joined.mapInArrow(run, _OUT)
    whole = out.filter(F.col("kind").isin("record", "header")).select("file", "line", "kind", "fields")
    # the few records that cross splits: a fragment a split at most at either end
    parts = cut_lineage(out.filter(~F.col("kind").isin("record", "header")).select("file", "line", "kind", "block", "raw"))
    if parts.isEmpty():
        return whole
    order = Window.partitionBy("file").orderBy("line")
    starts = F.col("kind").startswith("begin")
    chain = parts.withColumn("no", F.sum(starts.cast("int")).over(order))
    joined = chain.groupBy("file", "no").agg(
        F.min("line").alias("line"), F.min_by("kind", "line").alias("kind"), F.max_by("kind", "line").alias("last"),
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("line", "raw"))), lambda x: x["raw"])).alias("raw"))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fields = next(records(iter(io.StringIO(r["raw"], newline="\n")), dialect))[0] if r["last"] == "end" else None
                kind = "open" if fields is None else "header" if r["kind"] == "begin header" else "record"
                yield _rows(r["file"], 0, [(r["line"], kind, fields, None)])

    return whole.unionByName(joined.mapInArrow(mend, _OUT).select("file", "line", "kind", "fields"))


def header(spark: SparkSession, path: str, dialect: Dialect, lines: int = 1000) -> list[str]:
    """The fields of the first record of one of the files, within its first ``lines`` lines."""
    rows = _text(spark, path).filter("block = 0").limit(dialect.skip + lines)
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()],
                                       schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("value", pa.binary())]))
    for _, own in _splits(iter([batch]), dialect):
        for fields, _, _ in records((t for t in own if t is not None), dialect):
            if fields:
                return fields
    return []
