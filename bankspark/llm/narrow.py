"""Rows of some documents, without moving the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20


def of_documents(source: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``source`` (doc_id, ...) whose doc_id is in ``ids`` (doc_id).

    The ids' hash slots, at most SLOTS rows, are broadcast and keep most other texts from the shuffle of the
    exact join; with very many ids every slot is set and only the exact join filters.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    slots = ids.select(slot.alias("slot")).distinct()
    near = source.withColumn("__at", slot)
    near = near.join(F.broadcast(slots), F.col("__at") == F.col("slot"), "left_semi").drop("__at")
    return near.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
