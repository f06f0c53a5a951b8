"""Measure catalogue of the monthly report, as data.

A GL account feeds a report line when its code is listed for the line or
starts with one of the line's prefixes.  One code may feed two lines
(790000050101 is in lines 27 and 9), so the catalogue is joined, never
turned into a CASE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: account codes per report line
LINE_CODES = {
    14: ("702000030002", "702000030001", "702000030102"),
    15: ("702000030012", "702000030112"),
    16: ("716000000001",),
    17: ("719000030002",),
    18: ("719000030003", "719000030103", "790000030003", "790000030103", "790000030004",
         "790000030104"),
    20: ("801000000001", "802000000001"),
    22: ("803000000001",),
    25: ("702000010001", "702000010002", "704000000001", "705000000001", "709000000001",
         "714000000002", "714000000003", "714037000001", "714000000004", "714014000001",
         "715000000001", "715037000001", "719000000001", "709000000101", "719000000101"),
    26: ("816000000001", "816000000002", "816000000003"),
    27: ("809000000002", "809000000001", "811000000001", "811000000102", "811000000002",
         "811014000001", "811037000001", "811039000001", "811041000001", "815000000001",
         "819000000002", "819000000003", "819000000001", "790000000003", "790000050101",
         "790000000101", "790037000001", "849000000001", "899000000003", "899000000002",
         "811000000101", "819000060001"),
    9: ("790000050001", "882200050001", "790000030001", "882200030001", "790000000001",
        "790000020101", "882200000001", "882200050101", "882200020101", "882200060001",
        "790000050101", "882200030101"),
}

# fixed values: account code prefixes per report line
LINE_PREFIXES = {30: ("85",), 31: ("86",), 32: ("87",)}

# fixed values: how the head-office amount of a line reaches the areas
SHARE_OF_AMOUNT = (14, 15, 16, 17, 18, 25, 26, 27, 9)   # rounded own-amount share
SHARE_OF_BALANCE = (20, 22)                              # NPL balance share
SHARE_OF_HEADCOUNT = (30, 31, 32)                        # distinct sales staff share

# fixed values: rollups (parent, first child, last child, rounded) in evaluation order
ROLLUPS = ((4, 14, 18, True), (5, 20, 22, True), (6, 25, 27, True), (8, 30, 32, False),
           (7, 4, 6, True), (1, 7, 9, False))

HEADCOUNT_LINE = 2
RATIO_LINES = (10, 11, 12, 13)

# our labels for the report lines (the original titles live in a table not in the source)
LINE_TITLES = {
    1: "pre-tax profit", 2: "headcount", 4: "total card income", 5: "net funding cost",
    6: "net other", 7: "total operating income", 8: "total operating cost", 9: "provision cost",
    10: "CIR %", 11: "margin %", 12: "return on funding %", 13: "profit per head",
    14: "in-term interest", 15: "overdue interest", 16: "insurance fee",
    17: "limit-increase fee", 18: "late fee and off-balance income",
    20: "funding cost, market 2", 22: "funding cost, certificates", 25: "business revenue",
    26: "commission", 27: "other net business cost", 30: "staff cost", 31: "management cost",
    32: "asset cost",
}


def measure_map(spark: SparkSession) -> DataFrame:
    """(sort_id, match_key) rows; match_key is 'C:<code>' or 'P<n>:<prefix>'."""
    rows = [(sid, f"C:{code}") for sid, codes in LINE_CODES.items() for code in codes]
    rows += [(sid, f"P{len(p)}:{p}") for sid, ps in LINE_PREFIXES.items() for p in ps]
    return spark.createDataFrame(rows, "sort_id int, match_key string")


def prefix_lengths() -> list[int]:
    return sorted({len(p) for ps in LINE_PREFIXES.values() for p in ps})


def report_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(LINE_TITLES.items()), "sort_id int, information string")
