import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.functions.funding_ids import deposit_funding_id, loan_funding_id
from bankspark.functions.scalars import day_key
from bankspark.plans.funding import funding_summary
from bankspark.sources.sinks import replace_day

D = dt.date
DAY = D(2023, 12, 15)


def _deposit(spark, rows):
    df = spark.createDataFrame(rows, "process_dt date, account_type string, interest_rate decimal(18,6), "
                                     "vof_rate decimal(18,6), balance long, open_date date, maturity_date date")
    return df.withColumn("day_key", day_key(F.col("process_dt"))) \
             .withColumn("funding_id", deposit_funding_id(F.col("open_date"), F.col("maturity_date")))


def _loan(spark, rows):
    df = spark.createDataFrame(rows, "process_dt date, account_type string, customer_type string, "
                                     "interest_rate decimal(18,6), cof_rate decimal(18,6), balance long, "
                                     "open_date date, maturity_date date")
    return df.withColumn("day_key", day_key(F.col("process_dt"))) \
             .withColumn("funding_id", loan_funding_id(F.col("open_date"), F.col("maturity_date"),
                                                       F.col("account_type")))


def test_hand_worked_day(spark):
    o = D(2023, 1, 1)
    dp = _deposit(spark, [
        (DAY, "Business", Decimal("1.005"), Decimal("2"), 100, o, None),       # id 7
        (DAY, "Individual", Decimal("1.01"), Decimal("3"), 200, o, None),      # id 7
        (DAY, None, Decimal("5"), Decimal("1"), 50, o, D(2023, 1, 20)),          # id 8, segment 18
        (D(2023, 12, 14), "Business", Decimal("9"), Decimal("9"), 1000, o, None),  # earlier day, id 7
        (D(2023, 12, 1), "Business", Decimal("9"), Decimal("9"), 30, o, D(2023, 3, 1)),  # id 9 only in month
        (D(2023, 11, 30), "Business", Decimal("9"), Decimal("9"), 777, o, None),  # previous month: ignored
    ])
    ln = _loan(spark, [(DAY, "CV CCSTK", "Business", Decimal("7"), Decimal("4"), 500, o, D(2030, 1, 1))])
    got = {r.funding_id: r for r in funding_summary(dp, ln, DAY).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8, 17, 18, 20, 32}   # id 9 exists only earlier in the month
    r7 = got[7]
    assert r7.interest_rate == Decimal("1.01")        # mean 1.0075 -> 1.01 (half up)
    assert r7.vof_rate == Decimal("2.50") and r7.cof_rate == 0
    assert r7.balance == 300
    assert r7.avg_balance_month == Decimal("650.00")   # days present: 300 and 1000
    assert got[18].balance == 250 and got[17].balance == 100
    assert got[1].balance == 350 and got[1].avg_balance_month == Decimal("460.00")  # (350+1000+30)/3 days
    strip = lambda r: {k: v for k, v in r.asDict().items() if k != "funding_id"}
    assert strip(got[3]) == strip(got[1]) == strip(got[4])
    assert got[2].vof_rate == 0 and got[2].cof_rate == Decimal("4.00") and got[5].balance == 500


def test_totals_exist_on_empty_day(spark):
    dp = _deposit(spark, [(D(2023, 12, 3), "Business", Decimal("1"), Decimal("1"), 10, D(2023, 1, 1), None)])
    ln = _loan(spark, [(D(2023, 12, 3), "CV OTHER", "x", Decimal("1"), Decimal("1"), 10, D(2023, 1, 1), None)])
    got = {r.funding_id: r for r in funding_summary(dp, ln, DAY).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert got[1].balance is None and got[1].avg_balance_month == Decimal("10.00")


def test_replace_day_is_idempotent_and_clears(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="bankspark-sink-"), "summary")
    a = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "day_key int, v int")
    replace_day(a, path, 1)
    replace_day(a, path, 2)
    replace_day(a, path, 1)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("day_key", "v").collect()) == \
        [(1, 10), (1, 11), (2, 20)]
    empty = a.filter("day_key = 99")
    replace_day(empty.union(a.filter("false")), path, 1)     # empty result clears the day
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("day_key", "v").collect()) == [(2, 20)]


def test_month_range_prunes_day_partitions(spark, tmp_path):
    from bankspark.sources.roles import Roles
    from tests.conftest import SF001
    r = Roles(spark, SF001)
    dep, ln = str(tmp_path / "dep"), str(tmp_path / "ln")
    r.deposit().write.partitionBy("day_key").parquet(dep)
    r.loan().write.partitionBy("day_key").parquet(ln)
    out = funding_summary(spark.read.parquet(dep), spark.read.parquet(ln), DAY)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("PartitionFilters: [isnotnull(day_key") == 2
    assert "(day_key#" in plan and ">= 2023335" in plan and "<= 2023349" in plan
    direct = {x.funding_id: x for x in funding_summary(r.deposit(), r.loan(), DAY).collect()}
    stored = {x.funding_id: x for x in out.collect()}
    assert direct == stored


def test_append_and_overwrite(spark, tmp_path):
    from bankspark.sources.sinks import append, overwrite
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, 10)], "day_key int, v int")
    append(a, path, ["day_key"])
    append(a, path, ["day_key"])
    assert spark.read.parquet(path).count() == 2
    overwrite(a, path)
    assert spark.read.parquet(path).count() == 1


def _facts(spark, tmp_path):
    from bankspark.sources.roles import Roles
    from tests.conftest import SF001

    r = Roles(spark, SF001)
    for name, fact in (("deposit", r.deposit()), ("loan", r.loan())):
        fact.write.partitionBy("day_key").parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "deposit")), spark.read.parquet(str(tmp_path / "loan"))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_daily_runs_on_sums_equal_the_month_scan(spark, tmp_path):
    from bankspark.plans.funding import backfill, run_day, stored_sums, summary_of_sums

    deposit, loan = _facts(spark, tmp_path)
    sums = str(tmp_path / "sums")
    for n in (1, 2, 3):
        part = deposit.filter("account_id % 3 = 0") if n == 2 else deposit
        out = run_day(part, loan, D(2023, 12, n), sums)
        if n != 2:
            continue
        assert _rows(out) == _rows(funding_summary(deposit.filter("day_key <> 2023336 or account_id % 3 = 0"), loan, D(2023, 12, 2)))
    assert _rows(run_day(deposit, loan, D(2023, 12, 2), sums)) == _rows(funding_summary(deposit, loan, D(2023, 12, 2)))
    assert _rows(summary_of_sums(stored_sums(spark, sums), D(2023, 12, 3))) == _rows(funding_summary(deposit, loan, D(2023, 12, 3)))
    # the rest of the month in one pass; a day without facts has only the totals
    backfill(deposit, loan, D(2023, 12, 3), D(2023, 12, 18), sums)
    assert stored_sums(spark, sums).select("day_key").distinct().count() == 18
    assert _rows(run_day(deposit, loan, D(2023, 12, 19), sums)) == _rows(funding_summary(deposit, loan, D(2023, 12, 19)))
    assert _rows(run_day(deposit, loan, D(2024, 2, 1), sums)) == _rows(funding_summary(deposit, loan, D(2024, 2, 1)))


def test_a_daily_run_reads_one_day_of_facts(spark, tmp_path):
    from bankspark.plans.funding import daily_sums

    deposit, loan = _facts(spark, tmp_path)
    plan = daily_sums(deposit, loan, 2023349, 2023349)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 2 and all("2023349" in x.split("PartitionFilters: ")[1].split("]")[0] for x in scans)
    deposit.filter("day_key in (2023348, 2023349)").write.parquet(str(tmp_path / "flat"))  # the key as a column: pushed to the scan
    flat = spark.read.parquet(str(tmp_path / "flat"))
    plan = daily_sums(flat, loan, 2023349, 2023349)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day_key,2023349)" in plan
