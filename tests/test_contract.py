import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark.sources import schemas
from bankspark.sources.contract import ContractError, conform, scan
from bankspark.sources.roles import Roles
from tests.conftest import SF001


def test_retyped_and_missing_columns_raise(spark, tmp_path):
    good, path = Roles(spark, SF001).gl(), str(tmp_path / "gl")
    good.write.parquet(path)
    assert sorted(scan(spark, path, schemas.GL).collect()) == sorted(good.collect())
    good.withColumn("amount", F.col("amount").cast("string")).write.parquet(f"{path}-text")
    with pytest.raises(ContractError, match="amount is string, not decimal"):
        scan(spark, f"{path}-text", schemas.GL)
    with pytest.raises(ContractError, match="analysis_code is missing"):
        conform(good.drop("analysis_code"), schemas.GL)
    both = good.drop("account_code").withColumn("amount", F.col("amount").cast("double"))
    with pytest.raises(ContractError, match="account_code is missing; amount is double"):
        conform(both, schemas.GL, what="gl")


def test_further_columns_are_named_and_left_out(spark, tmp_path):
    city, path = Roles(spark, SF001).city(), str(tmp_path / "city")
    city.withColumn("note", F.lit("x")).write.parquet(path)
    with pytest.warns(UserWarning, match="beyond the contract: note"):
        got = scan(spark, path, schemas.CITY)
    assert got.columns == ["tinh", "area_code"] and got.count() == city.count()


def test_optional_columns_are_null(spark, tmp_path):
    loan, path = Roles(spark, SF001).loan(), str(tmp_path / "loan")
    loan.write.partitionBy("day_key").parquet(path)
    got = scan(spark, path, schemas.LOAN, schemas.LOAN_OPTIONAL)
    assert got.columns == schemas.LOAN.names and got.filter("customer_id is not null or close_date is not null").isEmpty()
    assert got.count() == loan.count()


def test_names_are_compared_as_spark_resolves_them(spark):
    df = spark.createDataFrame([("c", "B")], "TINH string, area_code string")
    assert conform(df, schemas.CITY).columns == ["tinh", "area_code"]
    assert isinstance(schemas.TICK["ts"].dataType, T.TimestampNTZType)


def test_stream_refuses_a_fact_that_breaks_the_contract(spark, tmp_path):
    from bankspark.streaming.daily_funding import start

    r = Roles(spark, SF001)
    r.deposit().withColumn("balance", F.col("balance").cast("double")).write.partitionBy("day_key").parquet(str(tmp_path / "deposit"))
    r.loan().write.partitionBy("day_key").parquet(str(tmp_path / "loan"))
    with pytest.raises(ContractError, match="balance"):
        start(spark, str(tmp_path / "deposit"), str(tmp_path / "loan"), str(tmp_path / "out"), name="refused")
