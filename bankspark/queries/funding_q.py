"""Queries for the daily funding summary."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from bankspark.functions.scalars import default_process_date
from bankspark.plans.funding import funding_summary, run_day
from bankspark.queries.common import portable
from bankspark.queries.oracle_views import round_quot, with_views
from bankspark.session import ensure_checkpoint_dir
from bankspark.sources.roles import Roles
from bankspark.sources.sinks import overwrite

# fixed values: the processed day of the reference call and its month start
PROCESS_DT = _dt.date(2023, 12, 15)
DAY_KEY = 2023349
MONTH_START_KEY = 2023335
THIRD_DAY_KEY = 2023337


def q_funding_daily(spark, sf_dir):
    r = Roles(spark, sf_dir)
    return portable(funding_summary(r.deposit(), r.loan(), PROCESS_DT))


def q_funding_default_day(spark, sf_dir):
    """I4: the daily job without a day of its own, run on the morning after ``PROCESS_DT``."""
    r = Roles(spark, sf_dir)
    return portable(funding_summary(r.deposit(), r.loan(), default_process_date(PROCESS_DT + _dt.timedelta(days=1))))


def q_funding_incremental(spark, sf_dir):
    """The third day of the month by daily runs on stored sums (J4, D2, A6): the second day is run twice, first on a part of
    its facts, as when corrections arrive."""
    r = Roles(spark, sf_dir)
    top = f"{ensure_checkpoint_dir(spark)}/funding-{uuid.uuid4().hex}"
    overwrite(r.deposit().filter(F.col("day_key").between(MONTH_START_KEY, THIRD_DAY_KEY)), f"{top}/deposit", ["day_key"])
    overwrite(r.loan().filter(F.col("day_key").between(MONTH_START_KEY, THIRD_DAY_KEY)), f"{top}/loan", ["day_key"])
    deposit, loan = spark.read.parquet(f"{top}/deposit"), spark.read.parquet(f"{top}/loan")
    day = lambda n: PROCESS_DT.replace(day=n)
    run_day(deposit, loan, day(1), f"{top}/sums")
    run_day(deposit.filter("account_id % 2 = 0"), loan.limit(0), day(2), f"{top}/sums")
    run_day(deposit, loan, day(2), f"{top}/sums")
    return portable(run_day(deposit, loan, day(3), f"{top}/sums"))


def q_deposit_tenor_mix(spark, sf_dir):
    """J1 bucket distribution over all deposit rows of all days (funding id, day key)."""
    r = Roles(spark, sf_dir)
    return (r.deposit().groupBy("day_key", "funding_id")
            .agg(F.count("*").alias("n_accounts"), F.sum("balance").alias("balance")))


def q_loan_tenor_mix(spark, sf_dir):
    """J2 bucket distribution over all loan rows (funding id, day key)."""
    r = Roles(spark, sf_dir)
    return (r.loan().groupBy("day_key", "funding_id")
            .agg(F.count("*").alias("n_accounts"), F.sum("balance").alias("balance")))


def _funding_sql(last_key: int = DAY_KEY, date: str = "2023-12-15") -> str:
    """All ids by grouping sets over one table of both sides, then the day's row of each id beside its month."""
    return with_views(["v_deposit", "v_loan"], f"""
with accounts as (
  select 0 as is_loan, day_key, funding_id as tenor, if(account_type = 'Business', 17, 18) as segment,
         interest_rate as ir, vof_rate as own, balance from v_deposit where day_key between {MONTH_START_KEY} and {last_key}
  union all
  select 1, day_key, funding_id, if(customer_type = 'Business', 32, 33), interest_rate, cof_rate, balance
  from v_loan where day_key between {MONTH_START_KEY} and {last_key}),
daily as (
  select is_loan, day_key, cast(case when grouping(tenor) = 0 then tenor when grouping(segment) = 0 then segment
                                     else 1 + is_loan end as integer) as id,
         sum(ir) as ir_sum, count(ir) as ir_n, sum(own) as own_sum, count(own) as own_n, sum(balance) as bal
  from accounts group by grouping sets ((is_loan, day_key, tenor), (is_loan, day_key, segment), (is_loan, day_key))),
monthly as (select id, {round_quot("sum(bal)", "count(bal)")} as avg_balance_month from daily group by id),
rates as (
  select id, is_loan, cast(bal as bigint) as balance, avg_balance_month,
         {round_quot("ir_sum * 1000000", "ir_n * 1000000")} as interest_rate,
         {round_quot("own_sum * 1000000", "own_n * 1000000")} as own
  from daily join monthly using (id) where day_key = {last_key}),
shown as (select id, id as funding_id from rates union all select * from (values (1, 3), (1, 4), (2, 5), (2, 6)))
select {last_key} as day_key, cast(date '{date}' as varchar) as process_dt, funding_id, interest_rate,
       if(is_loan = 0, own, 0.0) as vof_rate, if(is_loan = 1, own, 0.0) as cof_rate, balance, avg_balance_month
from rates join shown using (id)""")


QUERIES = {
    "funding_daily": q_funding_daily,
    "funding_default_day": q_funding_default_day,
    "funding_incremental": q_funding_incremental,
    "deposit_tenor_mix": q_deposit_tenor_mix,
    "loan_tenor_mix": q_loan_tenor_mix,
}

ORACLE = {
    "funding_daily": _funding_sql(),
    "funding_default_day": _funding_sql(),
    "funding_incremental": _funding_sql(THIRD_DAY_KEY, "2023-12-03"),
    "deposit_tenor_mix": with_views(["v_deposit"], """
select day_key, cast(funding_id as integer) as funding_id, count(*) as n_accounts,
       cast(sum(balance) as bigint) as balance
from v_deposit group by day_key, funding_id"""),
    "loan_tenor_mix": with_views(["v_loan"], """
select day_key, cast(funding_id as integer) as funding_id, count(*) as n_accounts,
       cast(sum(balance) as bigint) as balance
from v_loan group by day_key, funding_id"""),
}
