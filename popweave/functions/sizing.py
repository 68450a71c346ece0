"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A zone dimension (zones, PDs, pumas) has at most tens of thousands of rows.
DIMENSION_MAX_ROWS = 200_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows, else leave the join to
    the planner (sort-merge / AQE).

    The check is a bounded ``limit(max_rows + 1).count()``: it never scans past the bound.
    Use it for user-supplied dimensions (zone maps, vectors); derived tables whose row
    count is fixed by construction (one row per group id) are broadcast directly.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
