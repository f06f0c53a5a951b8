"""Funding bucket ids (J1-J3), written as native ``when`` chains (M1: no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankspark.functions.scalars import days_between, whole_months_between

# fixed values: funding ids of the report
DEPOSIT_TOTAL_ID = 1
LOAN_TOTAL_ID = 2
DERIVED_IDS = {1: (3, 4), 2: (5, 6)}
DEPOSIT_SEGMENT_IDS = (17, 18)   # Business, other
LOAN_SEGMENT_IDS = (32, 33)      # Business, other
LOAN_PRODUCT_IDS = {"CV CCSTK": 20, "CV VND LS USD": 21}


def deposit_funding_id(open_date: Column, maturity_date: Column) -> Column:
    """Deposit tenor bucket 7..16.

    NULL maturity -> 7; under 31 days -> 8; whole months 1-5 -> 9, 6 -> 10,
    7 -> 11, 8-11 -> 12, 12 -> 13, 13 -> 14, 14-23 -> 15; anything else
    (including a NULL open date) -> 16.
    """
    days = days_between(maturity_date, open_date)
    months = whole_months_between(maturity_date, open_date)
    return (F.when(maturity_date.isNull(), 7)
            .when(days < 31, 8)
            .when(months.between(1, 5), 9)
            .when(months == 6, 10)
            .when(months == 7, 11)
            .when(months.between(8, 11), 12)
            .when(months == 12, 13)
            .when(months == 13, 14)
            .when(months.between(14, 23), 15)
            .otherwise(16).cast("int"))


def loan_funding_id(open_date: Column, maturity_date: Column, account_type: Column) -> Column:
    """Loan bucket 20..26 (J2): product overrides first, then term in whole months."""
    months = whole_months_between(maturity_date, open_date)
    out = None
    for product, fid in LOAN_PRODUCT_IDS.items():
        cond = account_type == product
        out = F.when(cond, fid) if out is None else out.when(cond, fid)
    return (out.when(months < 12, 22)
            .when(months <= 60, 23)
            .when(months <= 120, 24)
            .when(months <= 180, 25)
            .otherwise(26).cast("int"))


def segment_id(segment: Column, ids: tuple[int, int], business_value: str = "Business") -> Column:
    """Business -> ids[0], anything else including NULL -> ids[1]."""
    return F.when(segment == business_value, ids[0]).otherwise(ids[1]).cast("int")
