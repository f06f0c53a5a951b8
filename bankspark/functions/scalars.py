"""Scalar date, key and text functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---- keys (I1-I4) ---------------------------------------------------------

def day_key(d: Column) -> Column:
    """yyyyDDD integer key, e.g. 2023-12-15 -> 2023349."""
    return (F.year(d) * 1000 + F.dayofyear(d)).cast("int")


def month_start_day_key(d: Column) -> Column:
    """Day key of the first day of d's month."""
    return day_key(F.trunc(d, "MM"))


def month_key(year: int | Column, month: int | Column) -> Column:
    """yyyyMM integer key."""
    y = year if isinstance(year, Column) else F.lit(year)
    m = month if isinstance(month, Column) else F.lit(month)
    return (y * 100 + m).cast("int")


def py_day_key(d: _dt.date) -> int:
    """Driver-side day key for a parameter date (I1 on a scalar)."""
    return d.year * 1000 + d.timetuple().tm_yday


def default_process_date(today: _dt.date | None = None) -> _dt.date:
    """Yesterday, resolved once on the driver (I4)."""
    return (today or _dt.date.today()) - _dt.timedelta(days=1)


def default_month(today: _dt.date | None = None) -> int:
    """Current calendar month, resolved once on the driver (I4)."""
    return (today or _dt.date.today()).month


# ---- date arithmetic (I5, I6) --------------------------------------------

def days_between(later: Column, earlier: Column) -> Column:
    """later - earlier in days as an int (I5); PostgreSQL date - date."""
    return F.datediff(later, earlier)


def _months_forward(a: Column, b: Column) -> Column:
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
            - F.when(F.dayofmonth(a) < F.dayofmonth(b), 1).otherwise(0))


def whole_months_between(later: Column, earlier: Column) -> Column:
    """Years*12 + months of the symbolic age(later, earlier).

    Not ``months_between``: 2024-01-31 -> 2024-02-29 is 0 here.  Negative
    spans are the negated forward span.
    """
    return F.when(later >= earlier, _months_forward(later, earlier)) \
        .otherwise(-_months_forward(earlier, later)).cast("int")


# ---- parsing (I7-I10, I13) -----------------------------------------------

def parse_date(c: Column, fmt: str = "dd/MM/yyyy") -> Column:
    """Text date to DateType; unparsable text gives NULL."""
    return F.try_to_date(c, fmt)


def month_date(year: Column, month: Column) -> Column:
    """First day of (year, month) (I8)."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def _nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def lenient_number(c: Column, strip: str = ",") -> Column:
    """Number text with thousands separators / percent signs -> double, junk -> NULL."""
    cleaned = c
    for ch in strip:
        cleaned = F.replace(cleaned, F.lit(ch), F.lit(""))
    return _nan_to_null(cleaned.try_cast("double"))


# fixed values: magnitude suffixes and their factors
MAGNITUDES = {"": 1.0, "K": 1_000.0, "M": 1_000_000.0, "B": 1_000_000_000.0}
_MAGNITUDE = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*([KMB]?)\s*$"


def magnitude_number(c: Column) -> Column:
    """'3.4M' / '1.5K' / '2B' / '1,234' -> double; junk (with or without suffix) -> NULL."""
    text = F.replace(c, F.lit(","), F.lit(""))
    number = F.regexp_extract(text, _MAGNITUDE, 1).try_cast("double")
    return number * map_codes(F.regexp_extract(text, _MAGNITUDE, 2), MAGNITUDES)


def clean_header(name: str) -> str:
    """'2004 [YR2004]' -> '2004' (I13); a driver-side rename of column names."""
    return name.split("[")[0].strip()


# ---- misc (I12, I15, I16) -------------------------------------------------

def area_code_of(analysis_code: Column, position: int = 9) -> Column:
    """Character at 1-based ``position`` of the analysis code; '0' means head office."""
    return F.substring(analysis_code, position, 1)


def map_codes(c: Column, mapping: dict) -> Column:
    """Code -> label lookup from a small literal map."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), c)
