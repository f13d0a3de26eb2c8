"""Small sides of joins, with their size checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(table: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """The table with a broadcast hint if it has at most ``max_rows`` rows, and whether it has.

    Counting, up to the limit, runs a job: meant for dictionaries and other lookups.
    """
    small = table.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(table) if small else table), small

