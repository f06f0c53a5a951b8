"""Role views: the driver's star schema recast into the reference's tables.

Each builder takes the driver tables (DataFrames) and returns a DataFrame with
the schema of one reference table (FIXTURES.md §3).  Work scales with the
driver tables: every view is a projection, a lookup from a fixed literal
array, or a join Spark plans by size.  The same shapes exist as SQL text in
``bankspark.queries.oracle_views`` for the DuckDB oracle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bankspark.functions.funding_ids import deposit_funding_id, loan_funding_id
from bankspark.functions.scalars import day_key
from bankspark.sources import schemas
from bankspark.sources.contract import conform
from bankspark.sources.tables import load_table

# fixed values: the seven report areas (code, name)
AREAS = (("B", "AREA_B"), ("C", "AREA_C"), ("D", "AREA_D"), ("E", "AREA_E"),
         ("F", "AREA_F"), ("G", "AREA_G"), ("H", "AREA_H"))
AREA_LETTERS = "BCDEFGH"

# fixed values: GL account codes the fixture assigns by (orderkey*7 + linenumber) % 17
GL_FIXTURE_CODES = ("702000030002", "702000030001", "702000030012", "716000000001",
                    "719000030002", "719000030003", "801000000001", "803000000001",
                    "702000010001", "816000000001", "809000000002", "790000050101",
                    "850000000001", "860000000001", "870000000001", "790000050001",
                    "999000000001")

_BASE_DATE = "2023-12-01"


def _letter(idx) -> F.Column:
    """1-based character of 'BCDEFGH'."""
    return F.substring(F.lit(AREA_LETTERS), idx.cast("int"), 1)


def _cents(x) -> F.Column:
    return F.floor(x).cast("decimal(18,2)")


def _dec(c, divisor: int, typ: str) -> F.Column:
    return (c.cast("decimal(20,0)") / F.lit(Decimal(divisor))).cast(typ)


def deposit(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Deposit fact with day_key and funding_id derived at read time."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    c = customer.select(F.col("c_custkey"), F.col("c_mktsegment"))
    k = F.col("o_orderkey")
    open_date = F.col("o_orderdate").cast("date")
    df = o.join(c, o.o_custkey == c.c_custkey).select(
        F.date_add(F.lit(_BASE_DATE).cast("date"), (k % 20).cast("int")).alias("process_dt"),
        k.alias("account_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Business").otherwise("Individual").alias("account_type"),
        _dec(k % 900, 100, "decimal(18,6)").alias("interest_rate"),
        _dec(k % 700, 100, "decimal(18,6)").alias("vof_rate"),
        F.floor("o_totalprice").cast("bigint").alias("balance"),
        open_date.alias("open_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("date"))
         .otherwise(F.date_add(open_date, ((k * 37) % 1000).cast("int"))).alias("maturity_date"),
    )
    return df.withColumn("day_key", day_key(F.col("process_dt"))) \
             .withColumn("funding_id", deposit_funding_id(F.col("open_date"), F.col("maturity_date")))


def loan(lineitem: DataFrame) -> DataFrame:
    """Loan fact with day_key and funding_id derived at read time."""
    k = F.col("l_orderkey")
    pk = F.col("l_partkey")
    open_date = F.col("l_shipdate").cast("date")
    df = lineitem.select(
        F.date_add(F.lit(_BASE_DATE).cast("date"), (k % 20).cast("int")).alias("process_dt"),
        (k * 10 + F.col("l_linenumber")).alias("account_id"),
        F.when(pk % 20 == 0, "CV CCSTK").when(pk % 20 == 1, "CV VND LS USD")
         .otherwise("CV OTHER").alias("account_type"),
        F.when(F.col("l_returnflag") == "R", "Business").otherwise("Individual").alias("customer_type"),
        _dec(k % 1500, 100, "decimal(18,6)").alias("interest_rate"),
        _dec(k % 1100, 100, "decimal(18,6)").alias("cof_rate"),
        F.floor("l_extendedprice").cast("bigint").alias("balance"),
        open_date.alias("open_date"),
        F.date_add(open_date, ((pk * 97) % 6500).cast("int")).alias("maturity_date"),
    )
    return df.withColumn("day_key", day_key(F.col("process_dt"))) \
             .withColumn("funding_id", loan_funding_id(F.col("open_date"), F.col("maturity_date"),
                                                       F.col("account_type")))


def area(spark: SparkSession) -> DataFrame:
    """Area dimension: 7 fixed rows (area_code, area_name)."""
    return spark.createDataFrame(list(AREAS), "area_code string, area_name string")


def city(nation: DataFrame) -> DataFrame:
    """Province dimension (tinh -> area_code)."""
    return nation.select(
        F.concat(F.lit("CITY_"), F.col("n_nationkey").cast("string")).alias("tinh"),
        _letter(1 + F.col("n_nationkey") % 7).alias("area_code"))


def loan_kpi(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Monthly loan KPI snapshot (outstanding, write-offs, max bucket per loan)."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = customer.select("c_custkey", "c_nationkey")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    wo = (k % 11 == 0)
    return o.join(c, o.o_custkey == c.c_custkey).select(
        (202301 + k % 3).cast("int").alias("kpi_month"),
        F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("pos_city"),
        _cents(F.col("o_totalprice")).alias("outstanding_principal"),
        F.when(wo, (202301 + ck % 3).cast("int")).alias("write_off_month"),
        F.when(wo, _cents(F.col("o_totalprice") / 10))
         .otherwise(F.lit(Decimal("0.00")).cast("decimal(18,2)")).alias("write_off_balance_principal"),
        F.when(k % 7 == 0, F.lit(None).cast("int"))
         .otherwise((1 + ck % 5).cast("int")).alias("max_bucket"),
    )


def gl(lineitem: DataFrame) -> DataFrame:
    """GL transactions: account code picked from a fixed 17-entry array (no join needed)."""
    i = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 17).cast("int")
    codes = F.array(*[F.lit(c) for c in GL_FIXTURE_CODES])
    sign = F.when(i.between(6, 15), -1).otherwise(1)
    return lineitem.select(
        F.element_at(codes, i + 1).alias("account_code"),
        (_cents(F.col("l_extendedprice")) * sign).cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.concat(F.lit("00000000"),
                 F.substring(F.lit("0" + AREA_LETTERS),
                             (1 + (F.col("l_suppkey") + F.col("l_linenumber")) % 8).cast("int"), 1)
                 ).alias("analysis_code"),
    )


def sales_kpi(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Sales KPI per person and month."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = customer.select("c_custkey", "c_name", "c_nationkey")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("sale_name"),
        F.concat(F.lit("p"), F.col("c_custkey").cast("string"), F.lit("@x")).alias("email"),
        F.concat(F.lit("AREA_"), _letter(1 + F.col("c_nationkey") % 7)).alias("area_name"),
        (1 + k % 12).cast("int").alias("month"),
        _cents(F.col("o_totalprice")).alias("loan_to_new"),
        (k % 97).cast("decimal(18,2)").alias("psdn"),
        _dec(k % 100, 100, "decimal(18,4)").alias("app_rate"),
    )


def tick(events: DataFrame) -> DataFrame:
    """One price series per event type, one point per event."""
    return events.select(F.col("event_type").alias("series_id"), "ts", "event_id",
                         F.col("value").alias("close"))


def bar(events: DataFrame) -> DataFrame:
    """Daily OHLCV bars per series."""
    return (events.groupBy(F.col("event_type").alias("series_id"),
                           F.col("ts").cast("date").alias("date"))
            .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                 F.count("*").alias("volume")))


def price_text(orders: DataFrame) -> DataFrame:
    """Localised price text as it would arrive from a CSV export (all strings)."""
    d = F.col("o_orderdate")
    k = F.col("o_orderkey")
    tp = F.col("o_totalprice")
    return orders.select(
        k.alias("row_id"),
        F.concat(F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit("/"),
                 F.lpad(F.month(d).cast("string"), 2, "0"), F.lit("/"),
                 F.year(d).cast("string")).alias("date_text"),
        F.concat(F.floor(tp / 1000).cast("bigint").cast("string"), F.lit(","),
                 F.lpad((F.floor(tp).cast("bigint") % 1000).cast("string"), 3, "0"),
                 F.lit(".5")).alias("close_text"),
        F.concat((k % 9).cast("string"), F.lit(".25%")).alias("change_text"),
        F.when(k % 6 == 0, "1.5K").when(k % 6 == 1, "2M").when(k % 6 == 2, "3.25B")
         .when(k % 6 == 3, k.cast("string")).when(k % 6 == 4, "-")
         .otherwise(F.lit(None).cast("string")).alias("volume_text"),
    )


def macro_long(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Yearly macro series in long form (year, series_name, value)."""
    gdp = orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(F.floor("o_totalprice").cast("bigint")).cast("double").alias("value")
    ).withColumn("series_name", F.lit("GDP"))
    infl = orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").cast("double").alias("value")).withColumn("series_name", F.lit("Inflation"))
    unemp = lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count("*").cast("double").alias("value")).withColumn("series_name", F.lit("Unemployment_rate"))
    cols = ["year", "series_name", "value"]
    return gdp.select(cols).unionByName(infl.select(cols)).unionByName(unemp.select(cols))


class Roles:
    """Lazy accessor of role views over one sf directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return load_table(self.spark, self.sf_dir, name)

    def _view(self, df: DataFrame, name: str, declared: StructType, optional: tuple[str, ...] = ()) -> DataFrame:
        return conform(df, declared, optional, name)

    def deposit(self):
        return self._view(deposit(self.t("orders"), self.t("customer")), "deposit", schemas.DEPOSIT, schemas.DEPOSIT_OPTIONAL)

    def loan(self):
        return self._view(loan(self.t("lineitem")), "loan", schemas.LOAN, schemas.LOAN_OPTIONAL)

    def area(self):
        return self._view(area(self.spark), "area", schemas.AREA)

    def city(self):
        return self._view(city(self.t("nation")), "city", schemas.CITY)

    def loan_kpi(self):
        return self._view(loan_kpi(self.t("orders"), self.t("customer")), "loan_kpi", schemas.LOAN_KPI)

    def gl(self):
        return self._view(gl(self.t("lineitem")), "gl", schemas.GL)

    def sales_kpi(self):
        return self._view(sales_kpi(self.t("orders"), self.t("customer")), "sales_kpi", schemas.SALES_KPI)

    def tick(self):
        return self._view(tick(self.t("events")), "tick", schemas.TICK)

    def bar(self):
        return bar(self.t("events"))

    def price_text(self):
        return price_text(self.t("orders"))

    def macro_long(self):
        return self._view(macro_long(self.t("orders"), self.t("lineitem")), "macro_long", schemas.MACRO_LONG)
