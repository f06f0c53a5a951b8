"""Market and macro data preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.operators.joins import attach_small
from bankspark.functions.scalars import (lenient_number, magnitude_number, map_codes,
                                         month_date, parse_date)

# fixed values: macro series names and the short names used for them
MACRO_NAMES = {"GDP": "GDP", "Inflation": "Inflation", "Unemployment_rate": "Unemployment_rate"}
# fixed values: k-means stage labels by canonical cluster id
STAGE_LABELS = {0: "Trough", 1: "Recovery", 2: "Peak", 3: "Recession"}


def clean_prices(raw: DataFrame, date_col: str = "Date", date_format: str = "dd/MM/yyyy",
                 plain: tuple[str, ...] = ("Close", "Open", "High", "Low"),
                 percent: tuple[str, ...] = ("Change %",), magnitude: tuple[str, ...] = ("Volume",)
                 ) -> DataFrame:
    """Type the text columns of a price export: dates, '1,234.5', '-1.2%', '3.4M' (I7, I9, I10)."""
    out = raw
    if date_col in raw.columns:
        out = out.withColumn(date_col, parse_date(F.col(date_col), date_format))
    for c in plain:
        if c in raw.columns:
            out = out.withColumn(c, lenient_number(F.col(f"`{c}`"), ","))
    for c in percent:
        if c in raw.columns:
            out = out.withColumn(c, lenient_number(F.col(f"`{c}`"), "%,"))
    for c in magnitude:
        if c in raw.columns:
            out = out.withColumn(c, magnitude_number(F.col(f"`{c}`")))
    return out


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``isnull().sum()`` as one row: a count of NULLs per column."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def macro_wide(long: DataFrame, names: dict[str, str] | None = None, year: str = "year",
               series: str = "series_name", value: str = "value") -> DataFrame:
    """``pivot_table(index=Year, columns=Series Name, values=Value)`` with mean (H4).

    Columns are mapped by series name, not by position.
    """
    names = names or MACRO_NAMES
    wide = long.groupBy(year).pivot(series, list(names)).agg(F.avg(value))
    return wide.select(F.col(year).alias("Year"), *[F.col(k).alias(v) for k, v in names.items()])


def years_to_columns(long: DataFrame, years: list[int], year: str = "year",
                     series: str = "series_name", value: str = "value") -> DataFrame:
    """The workbook layout: one row per series, one column per year ('2004 [YR2004]')."""
    wide = long.groupBy(series).pivot(year, years).agg(F.first(value))
    return wide.select(F.col(series).alias("Series Name"),
                       *[F.col(str(y)).alias(f"{y} [YR{y}]") for y in years])


def sheet_to_long(sheet: DataFrame, keep_series: list[str]) -> DataFrame:
    """Workbook sheet -> (Series Name, Year, Value): clean headers, keep the wanted series,
    unpivot the year columns (I13, B11, H3)."""
    from bankspark.functions.scalars import clean_header
    renamed = sheet.withColumnsRenamed({c: clean_header(c) for c in sheet.columns[1:]})
    year_cols = [c for c in renamed.columns[1:]]
    kept = renamed.filter(F.col("Series Name").isin(keep_series))
    kept = kept.select("Series Name", *[F.col(f"`{c}`").cast("string").alias(c) for c in year_cols])
    long = kept.unpivot(["Series Name"], year_cols, "Year", "Value")
    # sheets mark missing cells with text such as '..': those become NULL
    return long.withColumn("Year", F.col("Year").try_cast("int")) \
               .withColumn("Value", F.col("Value").try_cast("double"))


def monthly_rate_table(rates: DataFrame, year: str = "Year", month: str = "Month",
                       rate: str = "Rate") -> DataFrame:
    """(month_start date, Rate) from Year/Month columns (I8).

    The original looks each month up in an index; a month given twice would be
    ambiguous, so duplicates fail the job instead of fanning out the join (C8).
    """
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate month in rate table"))
                 .cast("double")).otherwise(F.first(F.col(rate)).cast("double"))
    return (rates.groupBy(month_date(F.col(year), F.col(month)).alias("month_start"))
            .agg(one.alias("Rate")))


def attach_macro_and_rate(daily: DataFrame, macro: DataFrame, rates: DataFrame,
                          date_col: str = "Date") -> DataFrame:
    """Daily rows + macro by year (C7) + the month's rate (C8), both left joins.

    Both lookups are counted before they are broadcast; a year or month given twice raises, as it would double rows.
    """
    d = daily.withColumn("Year", F.year(date_col)).withColumn("__m", F.trunc(date_col, "MM"))
    out = attach_small(d, _one_row_each(macro, "Year"), "Year", "left")
    out = attach_small(out, _one_row_each(rates.withColumnRenamed("month_start", "__m"), "__m"), "__m", "left")
    return out.drop("__m")


def _one_row_each(lookup: DataFrame, key: str) -> DataFrame:
    twice = F.raise_error(F.concat(F.lit(f"{key} given twice: "), F.first(key).cast("string")))
    return lookup.groupBy(key).agg(*[F.when(F.count(F.lit(1)) > 1, twice.cast(lookup.schema[c].dataType)).otherwise(F.first(c)).alias(c)
                                     for c in lookup.columns if c != key])


def yearly_last(df: DataFrame, value: str, date_col: str, tiebreak: str,
                by: list[str] | None = None) -> DataFrame:
    """``groupby(Year).last()[value]``: the last non-null value of each year."""
    keys = [F.year(date_col).alias("Year"), *(by or [])]
    order = F.struct(F.col(date_col), F.col(tiebreak))
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.max_by(F.col(value), order).alias(value)))


def align_series(a: DataFrame, b: DataFrame, on: str, a_name: str, b_name: str,
                 value: str = "close") -> DataFrame:
    """Two series side by side, aligned by date rather than by row position (C11)."""
    return (a.select(on, F.col(value).alias(a_name))
            .join(b.select(on, F.col(value).alias(b_name)), on, "full"))


def label_stages(df: DataFrame, cluster_col: str, labels: dict[int, str] | None = None,
                 out: str = "Stage") -> DataFrame:
    """Cluster id -> economic stage name."""
    return df.withColumn(out, map_codes(F.col(cluster_col), labels or STAGE_LABELS))
