"""Join helpers that broadcast a side only when its size is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
EVENT_ID_BYTES = 96  # 64 hex digits and the overhead of a row
ROW_BYTES = 64  # overhead and timestamps of a key row, beside its names


def is_small(max_bytes: int | None, limit: int = BROADCAST_BYTES) -> bool:
    """``max_bytes`` is a proven upper bound of a side's size, None if nothing is known."""
    return max_bytes is not None and max_bytes <= limit


def small(side: DataFrame, max_bytes: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(side) if is_small(max_bytes, limit) else side
