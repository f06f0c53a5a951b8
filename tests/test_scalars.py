import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.functions.exact import div_round
from bankspark.functions.funding_ids import deposit_funding_id, loan_funding_id, segment_id
from bankspark.functions.scalars import (clean_header, day_key, lenient_number, magnitude_number,
                                         month_start_day_key, py_day_key, whole_months_between)

D = dt.date


def test_day_keys(spark):
    df = spark.createDataFrame([(D(2023, 12, 15),), (D(2024, 2, 29),)], "d date")
    r = df.select(day_key(F.col("d")).alias("k"), month_start_day_key(F.col("d")).alias("m")).collect()
    assert [(x.k, x.m) for x in r] == [(2023349, 2023335), (2024060, 2024032)]
    assert py_day_key(D(2023, 12, 15)) == 2023349


def test_whole_months_fixture_pairs(spark):
    pairs = [(D(2024, 1, 31), D(2024, 2, 29), 0), (D(2024, 1, 31), D(2024, 3, 1), 1),
             (D(2023, 1, 15), D(2023, 2, 15), 1), (D(2023, 1, 15), D(2023, 2, 14), 0)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "o date, m date")
    got = [r[0] for r in df.select(whole_months_between(F.col("m"), F.col("o"))).collect()]
    assert got == [p[2] for p in pairs]


def _dep(spark, rows):
    df = spark.createDataFrame(rows, "o date, m date")
    return [r[0] for r in df.select(deposit_funding_id(F.col("o"), F.col("m"))).collect()]


def test_deposit_buckets_edges(spark):
    o = D(2023, 1, 10)
    rows = [(o, None), (o, o + dt.timedelta(days=30)), (o, o + dt.timedelta(days=31))]
    for months in (1, 5, 6, 7, 8, 11, 12, 13, 14, 23, 24):
        y, m = divmod(o.month - 1 + months, 12)
        rows.append((o, D(o.year + y, m + 1, 10)))
    rows.append((None, D(2024, 1, 1)))
    assert _dep(spark, rows) == [7, 8, 9, 9, 9, 10, 11, 12, 12, 13, 14, 15, 15, 16, 16]


def test_deposit_month_ends(spark):
    assert _dep(spark, [(D(2023, 1, 31), D(2023, 3, 3))]) == [9]   # 31 days, 1 month 3 days
    assert _dep(spark, [(D(2023, 3, 1), D(2023, 4, 1))]) == [9]    # 31 days, 1 month
    assert _dep(spark, [(D(2023, 1, 31), D(2023, 3, 2))]) == [8]   # 30 days


def test_loan_buckets_edges(spark):
    o = D(2020, 6, 15)
    rows = [(o, o, "CV CCSTK"), (o, o, "CV VND LS USD")]
    for months in (11, 12, 60, 61, 120, 121, 180, 181):
        y, m = divmod(o.month - 1 + months, 12)
        rows.append((o, D(o.year + y, m + 1, 15), "CV OTHER"))
    rows += [(o, None, "CV OTHER"), (o, D(2019, 1, 1), "CV OTHER"), (o, D(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "o date, m date, t string")
    got = [r[0] for r in df.select(loan_funding_id(F.col("o"), F.col("m"), F.col("t"))).collect()]
    assert got == [20, 21, 22, 23, 23, 24, 24, 25, 25, 26, 26, 22, 22]


def test_segment(spark):
    df = spark.createDataFrame([("Business",), ("Individual",), (None,)], "s string")
    assert [r[0] for r in df.select(segment_id(F.col("s"), (17, 18))).collect()] == [17, 18, 18]


def test_lenient_numbers(spark):
    rows = [("1,234.5", "-1.2%", "3.4K"), ("12", "1,000.5%", "5M"), ("-", "", "1.5B"),
            ("", None, "7"), (None, "x%", "-"), ("abc", "2%", "2.5XM")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    r = df.select(lenient_number(F.col("a")), lenient_number(F.col("b"), "%,"),
                  magnitude_number(F.col("c"))).collect()
    assert [tuple(x) for x in r] == [(1234.5, -1.2, 3400.0), (12.0, 1000.5, 5_000_000.0),
                                     (None, None, 1_500_000_000.0), (None, None, 7.0),
                                     (None, None, None), (None, 2.0, None)]


def test_div_round_exact_ties(spark):
    rows = [(Decimal("10.03"), 2), (Decimal("-5.00"), 2), (Decimal("1.00"), 3), (Decimal("0.57"), 2),
            (Decimal("1.00"), 0)]
    df = spark.createDataFrame(rows, "s decimal(18,2), n long")
    r = [x[0] for x in df.select(div_round(F.col("s"), F.col("n"), 2, 2, 0)).collect()]
    assert r == [Decimal("5.02"), Decimal("-2.50"), Decimal("0.33"), Decimal("0.29"), None]


def test_clean_header():
    assert clean_header("2004 [YR2004]") == "2004"


def test_default_dates_with_fixed_clock():
    from bankspark.functions.scalars import default_month, default_process_date
    assert default_process_date(D(2024, 3, 1)) == D(2024, 2, 29)
    assert default_month(D(2024, 3, 5)) == 3
