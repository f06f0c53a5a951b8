"""Join of rows to a per-group statistics table.

The statistics side is an aggregate (one row per group), so its size is only
known once it is computed.  It is computed first, up to ``BROADCAST_ROWS``
rows: a smaller table is broadcast, so the rows are not shuffled, whatever
one group holds; a larger one is written, and both sides of the join are
plain exchanges, whose hot partitions adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.session import written

BROADCAST_ROWS = 100_000


def attach_small(df: DataFrame, small: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a per-group statistics table: broadcast when it has at most ``rows`` rows, else shuffled."""
    head = small.limit(rows + 1).toArrow()
    if head.num_rows <= rows:
        table = small.sparkSession.createDataFrame(head, small.schema) if head.num_rows else small.limit(0)
        return df.join(F.broadcast(table), on, how)
    return df.join(written(small, "stats"), on, how)


def attach_one(df: DataFrame, one: DataFrame) -> DataFrame:
    """Append the columns of a global aggregate (one row, broadcast) to every row."""
    return df.crossJoin(F.broadcast(one))
