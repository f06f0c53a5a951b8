"""Sinks: append, replace one day, truncate-and-load.

``replace_day`` makes a daily job idempotent on a table partitioned by
``day_key``: the day is computed first, then its folder is overwritten, also
when the result is empty (the original deletes the day before inserting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from bankspark.session import written


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Truncate and reload."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_day(df: DataFrame, path: str, day_key: int, column: str = "day_key") -> None:
    """Replace the rows of day ``day_key`` by ``df``'s rows for it.

    The new rows are written to the shared folder first, so a failed job or a frame that reads the
    same table leaves the old day in place; then only the day's own folder is overwritten (with an
    empty file if there are no rows).
    """
    rows = written(df.filter(df[column] == day_key).drop(column), "day")
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day_key}")
