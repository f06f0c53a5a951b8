"""Text sources: localised price CSV exports and workbook sheets exported as CSV.

Files are read with an all-string schema (no inference pass over the data),
renamed by a header map, and typed by ``plans.market.clean_prices``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# fixed values: header names of the price export and the names used here
PRICE_HEADER_MAP = {
    "Ngày": "Date", "Lần cuối": "Close", "Mở": "Open", "Cao": "High", "Thấp": "Low",
    "KL": "Volume", "% Thay đổi": "Change %",
}


def read_text_table(spark: SparkSession, path: str, columns: list[str],
                    rename: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header row, every column read as string, then renamed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (spark.read.option("header", True).option("sep", sep).option("quote", '"')
          .option("escape", '"').option("mode", "PERMISSIVE").schema(schema).csv(path))
    return df.withColumnsRenamed(rename) if rename else df


def read_price_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, list(PRICE_HEADER_MAP), PRICE_HEADER_MAP)


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A workbook sheet exported to CSV (strings) or Parquet (typed) (A2)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)
