"""Incremental ingestion with Structured Streaming.

The conversion itself is batch table-to-table work; the per-row
standardisation of raw extracts (T1) is the one step that is naturally
incremental, so arriving extract files can be standardised as a stream
into the parquet layout the table pipelines read.
"""
