"""Daily funding summary (J4, J5): deposits and loans by tenor, segment and total.

Plan: each fact is scanned once for the month to date (the ``day_key``
range filter reaches the parquet scan, and prunes partitions when the fact
is partitioned by ``day_key``).  Rows are summed by (day, tenor, segment),
with partial sums before the shuffle; only those few sums are repeated for
the three ids they feed (tenor, segment, side total) and summed by
``(day_key, funding_id)``.  A last, tiny aggregation by ``funding_id`` yields the day's figures and the month average of daily
sums.  Twelve fact scans and six unions of the original become one scan per
side and one shuffle of a few hundred rows.

``run_day`` keeps the sums by (day, tenor, segment) as a table, so a daily run reads one day of facts in place of the month
to date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.functions.exact import div_round
from bankspark.functions.funding_ids import (DEPOSIT_SEGMENT_IDS, DEPOSIT_TOTAL_ID, DERIVED_IDS,
                                             LOAN_SEGMENT_IDS, LOAN_TOTAL_ID, segment_id)
from bankspark.functions.scalars import default_process_date, py_day_key
from bankspark.session import written
from bankspark.sources.sinks import replace_day

RATE = "decimal(18,6)"
OUTPUT_COLUMNS = ("day_key", "process_dt", "funding_id", "interest_rate", "vof_rate",
                  "cof_rate", "balance", "avg_balance_month")


SUMS = ("day_key int, is_loan boolean, tenor int, segment int, bal decimal(38,0), ir_s decimal(38,6), ir_n long, "
        "own_s decimal(38,6), own_n long")


def _side(fact: DataFrame, is_loan: bool, side_rate: str, segment_col: str, segment_ids: tuple[int, int]) -> DataFrame:
    """Sums and counts per (day, tenor, segment) of one side."""
    def rate(name: str, out: str):
        c = F.col(name).cast(RATE) if name in fact.columns else F.lit(None).cast(RATE)
        return [F.sum(c).cast("decimal(38,6)").alias(f"{out}_s"), F.count(c).alias(f"{out}_n")]

    return (fact.groupBy(F.col("day_key").cast("int").alias("day_key"), F.col("funding_id").cast("int").alias("tenor"),
                         segment_id(F.col(segment_col), segment_ids).cast("int").alias("segment"))
            .agg(F.sum(F.col("balance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("bal"),
                 *rate("interest_rate", "ir"), *rate(side_rate, "own"))
            .select("day_key", F.lit(is_loan).alias("is_loan"), "tenor", "segment", "bal", "ir_s", "ir_n", "own_s", "own_n"))


def daily_sums(deposit: DataFrame, loan: DataFrame, first_key: int, last_key: int,
               deposit_segment_col: str = "account_type", loan_segment_col: str = "customer_type") -> DataFrame:
    """The sums of all accounts per day, side, tenor and segment, for the days from first_key to last_key.

    A few hundred rows a day.  All figures of the summary follow from them, also those of later days, so a day's facts need to be
    read once.
    """
    days = F.col("day_key") == first_key if first_key == last_key else F.col("day_key").between(first_key, last_key)
    return _side(deposit.filter(days), False, "vof_rate", deposit_segment_col, DEPOSIT_SEGMENT_IDS).unionByName(
        _side(loan.filter(days), True, "cof_rate", loan_segment_col, LOAN_SEGMENT_IDS))


def funding_summary(deposit: DataFrame, loan: DataFrame, process_dt: _dt.date | None = None,
                    deposit_segment_col: str = "account_type",
                    loan_segment_col: str = "customer_type",
                    with_derived: bool = True) -> DataFrame:
    """Rows of ``fact_summary_funding_daily`` for one day, from the facts of the month to date."""
    process_dt = process_dt or default_process_date()
    sums = daily_sums(deposit, loan, py_day_key(process_dt.replace(day=1)), py_day_key(process_dt),
                      deposit_segment_col, loan_segment_col)
    return summary_of_sums(sums, process_dt, with_derived)


def summary_of_sums(sums: DataFrame, process_dt: _dt.date, with_derived: bool = True) -> DataFrame:
    """Rows of ``fact_summary_funding_daily`` for one day, from the daily sums of the month to date.

    interest/vof/cof rates: unweighted mean of the day's accounts, rounded to
    2 places exactly; balance: the day's sum; avg_balance_month: mean over the
    days present in the month to date of the daily sums, rounded to 2.
    Total ids 1 and 2 always produce a row, like a global aggregate.
    """
    day = py_day_key(process_dt)
    first = py_day_key(process_dt.replace(day=1))
    spark = sums.sparkSession
    total_id = F.when(F.col("is_loan"), LOAN_TOTAL_ID).otherwise(DEPOSIT_TOTAL_ID)
    figures = ("bal", "ir_s", "ir_n", "own_s", "own_n")
    rows = (sums.filter(F.col("day_key").between(first, day))
            .select("day_key", F.explode(F.array("tenor", "segment", total_id)).alias("funding_id"), *figures))
    # the two side totals exist even on an empty day (global aggregates in the original)
    totals = spark.createDataFrame([(day, DEPOSIT_TOTAL_ID), (day, LOAN_TOTAL_ID)],
                                   "day_key int, funding_id int")
    rows = rows.unionByName(totals, allowMissingColumns=True)

    on_day = F.col("day_key") == day
    per_day = rows.groupBy("day_key", "funding_id").agg(*[F.sum(c).alias(c) for c in figures])
    per_id = per_day.groupBy("funding_id").agg(
        F.max(on_day).alias("present"),
        F.sum("bal").alias("month_sum"),
        F.count("bal").alias("month_days"),
        *[F.sum(F.when(on_day, F.col(c))).alias(c) for c in figures],
    ).filter(F.col("present"))

    def avg2(s: str, n: str):
        return div_round(F.col(s), F.col(n), 2, num_scale=6, den_scale=0)

    is_dp = F.col("funding_id").isin(DEPOSIT_TOTAL_ID, *range(7, 17), *DEPOSIT_SEGMENT_IDS)
    zero = F.lit(0).cast("decimal(38,2)")
    out = per_id.select(
        F.lit(day).cast("int").alias("day_key"),
        F.lit(process_dt).cast("date").alias("process_dt"),
        F.col("funding_id").cast("int").alias("funding_id"),
        avg2("ir_s", "ir_n").alias("interest_rate"),
        F.when(is_dp, avg2("own_s", "own_n")).otherwise(zero).alias("vof_rate"),
        F.when(is_dp, zero).otherwise(avg2("own_s", "own_n")).alias("cof_rate"),
        F.col("bal").cast("decimal(38,0)").alias("balance"),
        div_round(F.col("month_sum"), F.col("month_days"), 2).alias("avg_balance_month"),
    )
    if with_derived:
        out = derive_copies(out)
    return out


def stored_sums(spark: SparkSession, path: str) -> DataFrame:
    """The table of daily sums, which is partitioned by day; created empty if there is none."""
    spark.createDataFrame([], SUMS).write.mode("ignore").partitionBy("day_key").parquet(path)
    return spark.read.schema(SUMS).parquet(path)


def run_day(deposit: DataFrame, loan: DataFrame, process_dt: _dt.date, sums_path: str, with_derived: bool = True,
            deposit_segment_col: str = "account_type", loan_segment_col: str = "customer_type") -> DataFrame:
    """One day's run on the table of daily sums: reads that day's facts alone, replaces its sums, and returns its summary.

    Run again for a day whose facts were corrected, it replaces the day's sums, and later summaries of the month follow
    them.  The month's average covers the days that were run; ``backfill`` runs many at once.
    """
    spark, day = deposit.sparkSession, py_day_key(process_dt)
    stored_sums(spark, sums_path)
    replace_day(daily_sums(deposit, loan, day, day, deposit_segment_col, loan_segment_col), sums_path, day)
    return summary_of_sums(stored_sums(spark, sums_path), process_dt, with_derived)


def backfill(deposit: DataFrame, loan: DataFrame, first: _dt.date, last: _dt.date, sums_path: str,
             deposit_segment_col: str = "account_type", loan_segment_col: str = "customer_type") -> None:
    """Replace the sums of every day from first to last that has facts, in one pass over them."""
    stored_sums(deposit.sparkSession, sums_path)
    sums = daily_sums(deposit, loan, py_day_key(first), py_day_key(last), deposit_segment_col, loan_segment_col)
    (written(sums, "sums").repartition("day_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day_key").parquet(sums_path))


def derive_copies(summary: DataFrame) -> DataFrame:
    """Ids 3, 4 repeat id 1 and ids 5, 6 repeat id 2 (for the processed day only)."""
    fid = F.col("funding_id")
    ids = F.array(fid.cast("int"))
    for src, copies in DERIVED_IDS.items():
        ids = F.when(fid == src, F.array(fid.cast("int"), *[F.lit(c).cast("int") for c in copies])).otherwise(ids)
    return summary.withColumn("funding_id", F.explode(ids)).select(*OUTPUT_COLUMNS)
