"""Size-checked broadcast.

A side is broadcast only after its rows have been counted against a limit;
above the limit the plain (shuffle) join is left to Spark and AQE. The
count computes that side, so it is meant for sides that are cheap to
compute or already written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a lookup table we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. A plain scan stops early; an aggregate does not."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when it has at most ``max_rows`` rows."""
    return F.broadcast(df) if fits(df, max_rows) else df
