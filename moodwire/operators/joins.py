"""Join-side helpers: broadcast only a side whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest side, as JSON text, that is ever hinted.
MAX_BYTES = 8 << 20


def broadcast_if_bounded(df: DataFrame, max_rows: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes now.

    The check reads ``limit(max_rows + 1)`` rows only, so it stays cheap even
    when the side turns out to be large, and it is made for each plan anew, as
    tables grow. Beyond the bounds the frame is returned unhinted and the
    planner chooses the join from measured sizes (AQE may still broadcast it
    at run time, or shuffle both sides).
    """
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    rows, total = df.limit(max_rows + 1).select(size.alias("_size")).agg(F.count(F.lit(1)), F.sum("_size")).first()
    return F.broadcast(df) if rows <= max_rows and (total or 0) <= max_bytes else df
