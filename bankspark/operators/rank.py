"""Global rank without a single-partition window.

``rank() over (order by v)`` with no PARTITION BY plans ``Exchange
SinglePartition``: every row goes to one task.  Here the rank is computed as
1 + (number of rows ordered strictly before), from:

1. counts per distinct value (partial aggregation before the shuffle, so a
   value held by a third of all rows costs one row per map task);
2. range partitioning of the distinct values, a running count inside each
   range partition, and per-partition totals (one row per partition) turned
   into offsets -- the only collected-to-one-task data is bounded by the
   partition count, and it is broadcast back;
3. an equi-join of the rows to their value's rank (AQE splits a hot value).

NULLs rank first or last as asked, like ``NULLS FIRST/LAST``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.session import checkpoint


def global_rank(df: DataFrame, value: str, out: str, ascending: bool = True,
                nulls_first: bool | None = None, partitions: int | None = None,
                weight: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Append ``out`` = SQL rank() of numeric column ``value``.

    ``by`` ranks within groups (``rank() over (partition by ...)``) in the same
    single pass, so several metrics stacked in one column are ranked together.
    With ``weight``, each row stands for ``weight`` rows of the ranked
    population (used to rank per-group values by the number of member rows).
    """
    if nulls_first is None:
        nulls_first = ascending  # Spark's default: ASC NULLS FIRST, DESC NULLS LAST
    by = list(by or [])
    k, z = "__rk_key", "__rk_null"
    key = F.col(value) if ascending else -F.col(value)
    # NULLs are one more distinct key, placed before or after every value
    is_null = F.col(value).isNull()
    null_pos = F.when(is_null, 0 if nulls_first else 1).otherwise(1 if nulls_first else 0)
    keyed = df.withColumn(k, key).withColumn(z, null_pos)

    n = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    counts = keyed.groupBy(*by, z, k).agg(n.alias("__n"))
    ranged = counts.repartitionByRange(*([partitions] if partitions else []), *by, z, k).withColumn("__pid", F.spark_partition_id())
    w_local = Window.partitionBy("__pid", *by).orderBy(z, k).rowsBetween(Window.unboundedPreceding, -1)
    # partition ids are physical: materialise the distinct values once so that the offsets
    # and the running counts below are computed from the same placement
    ranged = checkpoint(ranged.withColumn("__before", F.coalesce(F.sum("__n").over(w_local), F.lit(0))))
    # one row per (range partition, group present in it): at most partitions + groups - 1 rows
    per_part = ranged.groupBy("__pid", *by).agg(F.sum("__n").alias("__tot"))
    w_parts = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("__pid", *by, F.coalesce(F.sum("__tot").over(w_parts), F.lit(0))
                              .alias("__off"))
    offsets = F.broadcast(offsets) if not by else offsets
    ranks = (ranged.join(offsets, ["__pid", *by])
             .select(*by, F.col(z).alias("__rz"), F.col(k).alias("__rk"),
                     (F.col("__off") + F.col("__before") + 1).cast("int").alias(out)))
    cond = (keyed[z] == ranks["__rz"]) & keyed[k].eqNullSafe(ranks["__rk"])
    for b in by:
        cond = cond & keyed[b].eqNullSafe(ranks[b])
    joined = keyed.join(ranks, cond, "left")
    for b in by:
        joined = joined.drop(ranks[b])
    return joined.drop(k, z, "__rz", "__rk")
