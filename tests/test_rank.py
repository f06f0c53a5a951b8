import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bankspark.operators.rank import global_rank


@pytest.mark.parametrize("asc,nulls_first,parts", [(True, False, 3), (False, True, 5), (True, True, 1),
                                                   (False, False, 8)])
def test_global_rank_equals_window_rank(spark, asc, nulls_first, parts):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, 1.5, 2.0, 2.0, 3.25, 7.0, float(rnd.randint(0, 40))])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = global_rank(df, "v", "r", ascending=asc, nulls_first=nulls_first, partitions=parts)
    v = F.col("v")
    if asc:
        order = v.asc_nulls_first() if nulls_first else v.asc_nulls_last()
    else:
        order = v.desc_nulls_first() if nulls_first else v.desc_nulls_last()
    exp = df.withColumn("r", F.rank().over(Window.orderBy(order)))
    assert sorted(got.select("id", "r").collect()) == sorted(exp.select("id", "r").collect())


def test_weighted_rank(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("b", 2.0, 2), ("c", 1.0, 1)], "g string, v double, w long")
    r = {x.g: x.r for x in global_rank(df, "v", "r", weight="w").collect()}
    assert r == {"a": 1, "c": 1, "b": 5}
