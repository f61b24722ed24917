"""What the operators of this package share: reading, sizing, staging."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.operators.sizing import broadcast_if_small
from omoplate.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["broadcast_if_small", "crc32_sql", "cut_lineage", "ensure_checkpoint_dir", "doc_texts", "drop_ids", "parts_for",
           "plan_bytes", "ready", "table", "tasks_for"]


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the driver's path is visible to them, as in
    local mode; on a cluster the package is shipped with the job."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    ensure_checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id long, text string``; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of the bytes of ``df``: file sizes where the plan reads files. No job runs."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 50 else 1 << 30  # a plan without statistics claims the largest long


def parts_for(df: DataFrame, bytes_each: int) -> int:
    return max(1, -(-plan_bytes(df) // bytes_each))


def tasks_for(spark: SparkSession, n_groups: int, each: int) -> int:
    """Partitions for so many groups: ``each`` groups a task, so tasks do not grow with the input; fewer where the
    session's shuffles would have tasks without a group."""
    return max(1, -(-n_groups // each), min(n_groups, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``; rows without a doc_id stay. The ids
    are broadcast only if counted few, else both sides are shuffled."""
    return docs.join(broadcast_if_small(ids.select("doc_id")), "doc_id", "left_anti").select(*docs.columns)


def crc32_sql(text: str) -> str:
    """DuckDB has no crc32: bit by bit over the characters, which are digits."""
    bit = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = f"list_reduce([xor(c, d)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, i: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, d: {step}), 4294967295)"
