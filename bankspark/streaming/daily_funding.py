"""Run the daily funding summary for every day that lands in the deposit fact folder.

The original procedure is called once per day (``call
fact_summary_funding_daily_prc(date)``).  Here a file stream over the
deposit fact (partitioned by ``day_key``) triggers it: each micro-batch
lists the day keys it brought (a handful of values), and for each of them
the batch job reads both facts -- of that month to date, or of the day alone
if a table of daily sums is kept -- and replaces that day in the output table.  The stream's progress is kept
under the shared ``spark.checkpoint.dir``, so a restarted driver resumes
where it stopped, and ``replace_day`` makes a re-run of a day idempotent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bankspark.plans.funding import funding_summary, run_day
from bankspark.session import ensure_checkpoint_dir
from bankspark.sources.contract import scan
from bankspark.sources.schemas import DEPOSIT, DEPOSIT_OPTIONAL, LOAN, LOAN_OPTIONAL
from bankspark.sources.sinks import replace_day


def _date_of(day_key: int) -> _dt.date:
    return _dt.date(day_key // 1000, 1, 1) + _dt.timedelta(days=day_key % 1000 - 1)


def start(spark: SparkSession, deposit_dir: str, loan_dir: str, out_dir: str, name: str = "funding_daily",
          available_now: bool = True, sums_dir: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops.

    With ``sums_dir``, the table of daily sums there is kept up to date, and the days of a batch are run in order on it.
    """
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    scan(spark, deposit_dir, DEPOSIT, DEPOSIT_OPTIONAL)  # a landed file that breaks the contract stops the start, not a batch
    landed = spark.readStream.schema(DEPOSIT).parquet(deposit_dir).select("day_key")

    def run_days(batch: DataFrame, _epoch: int) -> None:
        # the day keys of one micro-batch: a handful of values
        days = sorted(r[0] for r in batch.select("day_key").distinct().collect())
        deposit = scan(spark, deposit_dir, DEPOSIT, DEPOSIT_OPTIONAL)
        loan = scan(spark, loan_dir, LOAN, LOAN_OPTIONAL)
        for day in days:
            out = run_day(deposit, loan, _date_of(day), sums_dir) if sums_dir else \
                funding_summary(deposit, loan, _date_of(day))
            replace_day(out.withColumn("day_key", F.col("day_key").cast("int")), out_dir, day)

    writer = landed.writeStream.foreachBatch(run_days).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
