"""Standardise raw extract files as they arrive (T1 on a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from omoplate.operators.person import standardise_source
from omoplate.session import ensure_checkpoint_dir


def standardised_stream(spark: SparkSession, source_dir: str, schema: T.StructType, person_column: str,
                        start_column: str, end_column: str, type_concept: int) -> DataFrame:
    """A streaming DataFrame of standardised rows from parquet files landing
    in ``source_dir``. Start and end columns are given, not probed: a stream
    has no whole table to compare them over."""
    raw = spark.readStream.schema(schema).parquet(source_dir)
    return standardise_source(raw, person_column, [start_column, end_column], type_concept,
                              roles=(start_column, end_column))


def start_standardise(spark: SparkSession, source_dir: str, schema: T.StructType, person_column: str,
                      start_column: str, end_column: str, type_concept: int, out_dir: str,
                      name: str = "standardise", available_now: bool = True) -> StreamingQuery:
    """Run the stream into parquet files under ``out_dir``.

    The file sink and its checkpoint (in the shared checkpoint folder) make
    the output exactly-once across restarts; ``available_now`` processes
    what has landed and stops, as a scheduled job would.
    """
    stream = standardised_stream(spark, source_dir, schema, person_column, start_column, end_column, type_concept)
    location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
