"""Projection and conformance operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omoplate.session import cut_lineage


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; every source name must exist (``ValueError`` otherwise)."""
    missing = set(mapping) - set(df.columns)
    if missing:
        raise ValueError(f"cannot rename {sorted(missing)}: no such columns")
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def rename_lenient(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what exists, ignore the rest."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _default_for(field: T.StructField) -> Column:
    if field.nullable:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return F.lit(0).cast(field.dataType)
    if isinstance(field.dataType, T.DoubleType):
        return F.lit(0.0).cast(field.dataType)
    if isinstance(field.dataType, T.StringType):
        return F.lit("")
    # A required date/time column has no usable default.
    raise ValueError(f"required column {field.name!r} ({field.dataType.simpleString()}) is missing")


def fill_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Append schema columns that ``df`` lacks, with typed defaults."""
    missing = {f.name: _default_for(f) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def reorder(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema columns, in schema order."""
    return df.select(*schema.names)


def _safe_cast(c: Column, name: str, src: T.DataType, dst: T.DataType) -> Column:
    out = c.cast(dst)
    if isinstance(dst, (T.LongType, T.IntegerType)) and isinstance(src, (T.DoubleType, T.FloatType)):
        # a safe cast refuses to drop a fraction; Spark would truncate silently
        out = F.when(c != F.floor(c), F.raise_error(F.lit(f"fractional value in integer column {name}"))).otherwise(out)
    return out


def cast_to(df: DataFrame, schema: T.StructType, check_nulls: bool = True) -> DataFrame:
    """Cast every column to the schema type (ANSI casts raise on bad values).

    With ``check_nulls`` a null in a NOT NULL field raises at run time.
    """
    src = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        c = _safe_cast(F.col(f.name), f.name, src[f.name], f.dataType)
        if check_nulls and not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"null in required column {f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def format_table(df: DataFrame, schema: T.StructType, check_nulls: bool = True) -> DataFrame:
    """Fill, reorder, cast."""
    return cast_to(reorder(fill_missing(df, schema), schema), schema, check_nulls)


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P5: constant columns; numbers become double (the schema cast follows)."""
    cols = {}
    for name, value in values.items():
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            cols[name] = F.lit(value).cast("string") if value is not None else F.lit(None).cast("string")
        else:
            cols[name] = F.lit(float(value))
    return df.withColumns(cols) if cols else df


def set_vocabulary(df: DataFrame, vocabulary_id: str, column: str = "vocabulary_id") -> DataFrame:
    """Constant vocabulary id, overwriting any existing column."""
    return df.withColumn(column, F.lit(vocabulary_id))


def keep_schema_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema columns that exist, in schema order."""
    return df.select(*[c for c in schema.names if c in df.columns])


def add_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """P20: suffix every column name."""
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


# Rows per range partition when numbering (a partition is sorted in one task).
DENSE_KEY_PARTITION_ROWS = 4_000_000


def _total_order(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    """``order``, then the remaining columns, so that only identical rows are ties."""
    named = {c for c in order if isinstance(c, str)}
    sortable = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    rest = [F.col(f.name).asc_nulls_last() for f in df.schema.fields
            if f.name not in named and isinstance(f.dataType, sortable)]
    return [*_order_cols(order), *rest]


def dense_key(df: DataFrame, name: str, order: Sequence[Column | str], num_partitions: int | None = None,
              first: int = 0) -> DataFrame:
    """A dense key ``first .. first+n-1`` following ``order``.

    No single-partition window: the rows are range-partitioned on the order,
    numbered inside each partition, and shifted by the row count of all
    earlier partitions. The input is first written to the shared checkpoint
    folder, so computing the range bounds (a sampling job) does not replay
    the plan that produced it, and its row count (from file metadata) sizes
    the partitions; the numbered rows are written too, so the partition
    numbers cannot change between the count and the numbering and a lost
    executor does not re-number anything. The offset table has one row per
    partition, a bound we set ourselves, which is why it may be broadcast.
    The remaining columns break ties, so the numbering is the same however
    many partitions there are, and a retried task numbers as before (only
    identical rows can swap). Input within a single partition's bound is
    sorted and numbered by one task directly.
    """
    base = cut_lineage(df)
    n = num_partitions or max(1, math.ceil(base.count() / DENSE_KEY_PARTITION_ROWS))
    cols = _total_order(base, order)
    if n == 1:
        one = base.coalesce(1).sortWithinPartitions(*cols)
        return one.withColumn(name, (F.monotonically_increasing_id() + F.lit(first)).cast("long"))
    staged = (base.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_okey", F.monotonically_increasing_id()))
    staged = cut_lineage(staged)
    staged = staged.withColumn("_blk", F.shiftright("_okey", 33)).withColumn(
        "_pos", F.col("_okey").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = staged.groupBy("_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = staged.join(F.broadcast(offsets), "_blk")
    keyed = out.withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(first)).cast("long"))
    return keyed.drop("_okey", "_blk", "_pos", "_off")


def rows_before(counts: DataFrame, lead: str, num_partitions: int | None = None) -> DataFrame:
    """``counts`` (``lead``, each value once, and ``_n``) with ``_before``: the rows of all smaller values. Range
    partitions are summed each for itself and shifted by the sum of those before, as in ``dense_key``."""
    n = num_partitions or max(1, math.ceil(counts.count() / DENSE_KEY_PARTITION_ROWS))
    ranged = cut_lineage(counts.repartitionByRange(n, F.col(lead).asc_nulls_last()).withColumn("_blk", F.spark_partition_id()))
    earlier = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_blk").agg(F.sum("_n").alias("_sum"))
    offsets = sums.select("_blk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_off"))
    smaller = Window.partitionBy("_blk").orderBy(F.col(lead).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
    return inside.join(F.broadcast(offsets), "_blk").select(lead, "_n", (F.col("_off") + F.col("_inside")).alias("_before"))


def person_key(df: DataFrame, name: str, order: Sequence[Column | str], counts: DataFrame, block_rows: int,
               first: int = 0) -> DataFrame:
    """W5 where a column that is never null leads the order and ``counts`` holds its rows per value: the same numbers
    as ``dense_key``'s.

    A row's number is its place among the rows of its value plus the rows of
    all smaller values. So rows need only lie together by that column, as
    they do after a join or window by it, and are neither written nor
    shuffled to be numbered. Values of more than ``block_rows`` rows are
    numbered among themselves by ``dense_key``, which splits them.
    """
    lead = order[0]
    counts = rows_before(counts, lead)
    hot = counts.filter(F.col("_n") > block_rows).select(lead, "_n")
    hot_rows = None
    if not hot.isEmpty():
        df = cut_lineage(df)
        hot_rows = df.join(F.broadcast(hot.select(lead)), lead, "left_semi")
        df = df.join(F.broadcast(hot.select(lead)), lead, "left_anti")
    columns = df.columns
    place = F.row_number().over(Window.partitionBy(lead).orderBy(*_total_order(df, order)[1:]))
    out = df.withColumn("_place", place).join(counts.select(lead, "_before"), lead).select(
        *columns, (F.col("_before") + F.col("_place") - 1 + F.lit(first)).cast("long").alias(name))
    if hot_rows is None:
        return out
    shift = counts.join(F.broadcast(rows_before(hot, lead).withColumnRenamed("_before", "_among").drop("_n")), lead).select(
        lead, (F.col("_before") - F.col("_among")).alias("_shift"))
    split = dense_key(hot_rows, name, order, first=first).join(F.broadcast(shift), lead)
    return out.unionByName(split.withColumn(name, F.col(name) + F.col("_shift")).select(*columns, name))
