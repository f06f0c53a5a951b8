import os
import tempfile

from pyspark.sql import functions as F

from bankspark.sources.roles import Roles
from bankspark.streaming.daily_funding import start
from tests.conftest import SF001


def test_stream_runs_each_landed_day(spark):
    base = tempfile.mkdtemp(prefix="bankspark-stream-")
    dep, ln, out = (os.path.join(base, n) for n in ("deposit", "loan", "summary"))
    r = Roles(spark, SF001)
    days = [2023348, 2023349]
    r.deposit().filter(F.col("day_key").isin(days)).write.partitionBy("day_key").parquet(dep)
    r.loan().write.partitionBy("day_key").parquet(ln)
    q = start(spark, dep, ln, out, name=os.path.basename(base))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert sorted(x[0] for x in got.select("day_key").distinct().collect()) == days
    assert got.filter("day_key = 2023349 and funding_id = 1").count() == 1


def test_stream_on_daily_sums(spark):
    from bankspark.plans.funding import funding_summary
    import datetime as dt

    base = tempfile.mkdtemp(prefix="bankspark-stream-")
    dep, ln, out, sums = (os.path.join(base, n) for n in ("deposit", "loan", "summary", "sums"))
    r = Roles(spark, SF001)
    days = [2023335, 2023336]
    r.deposit().filter(F.col("day_key").isin(days)).write.partitionBy("day_key").parquet(dep)
    r.loan().filter(F.col("day_key").isin(days)).write.partitionBy("day_key").parquet(ln)
    start(spark, dep, ln, out, name=os.path.basename(base), sums_dir=sums).awaitTermination(300)
    want = funding_summary(spark.read.parquet(dep), spark.read.parquet(ln), dt.date(2023, 12, 2))
    got = spark.read.parquet(out).filter("day_key = 2023336").select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
