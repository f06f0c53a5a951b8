import math
import random

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.operators import stats as ST


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 50))) for g in "abc" for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.q): r.quantile for r in ST.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], "g").collect()}
    for g in "abc":
        vals = np.array([v for gg, v in rows if gg == g])
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert math.isclose(got[(g, q)], float(np.percentile(vals, q * 100)), rel_tol=1e-12, abs_tol=1e-12)


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10, 10]], "v double")
    h = ST.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 0, 0, 2]
    assert math.isclose(sum(r.density * 2.0 for r in h), 1.0)


def test_box_summary(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    r = ST.box_summary(df, "v").first()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert (r.whisker_low, r.whisker_high, r.n_outliers) == (1.0, 8.0, 1)


def test_anova_matches_spark_ml(spark):
    rnd = random.Random(2)
    rows = [(float(g), rnd.gauss(g * 0.3, 1.0)) for g in range(4) for _ in range(25)]
    df = spark.createDataFrame(rows, "label double, x double")
    t = ST.anova_test(df, "x", "label")
    feats = VectorAssembler(inputCols=["x"], outputCol="f").transform(df)
    jvm_test = spark.sparkContext._jvm.org.apache.spark.ml.stat.ANOVATest
    ml = DataFrame(jvm_test.test(feats._jdf, "f", "label"), spark).first()
    assert math.isclose(t["f_stat"], float(ml.fValues[0]), rel_tol=1e-9)
    assert math.isclose(t["p_value"], float(ml.pValues[0]), rel_tol=1e-6, abs_tol=1e-12)


def test_f_distribution_tail():
    assert math.isclose(ST.f_sf(1.0, 1, 10), 0.34089313230206, rel_tol=1e-9)


def test_scaling_and_impute(spark):
    df = spark.createDataFrame([("a", 2.0, None), ("a", 4.0, 1.0), ("b", 5.0, 3.0), ("b", 5.0, None)],
                               "g string, x double, y double")
    z = {r.x_z for r in ST.zscore(df.filter("g = 'a'"), ["x"]).collect()}
    assert z == {-1.0, 1.0}
    fitted = ST.minmax_fit(df, "x", "g")
    sc = ST.minmax_scale(df, "x", "g", fitted=fitted)
    back = ST.minmax_inverse(sc.filter("x_scaled is not null"), "x_scaled", fitted, "g")
    assert all(math.isclose(r.x, r.x_scaled_inv) for r in back.collect())
    mi = {(r.g, r.x): r.y for r in ST.mean_impute(df, ["y"], "g").collect()}
    assert mi[("a", 2.0)] == 1.0 and mi[("b", 5.0)] == 3.0


def test_regression_metrics(spark):
    y, p = [1.0, 2.0, 3.0, 4.0], [1.5, 2.0, 2.0, 5.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    r = ST.regression_metrics(df, "y", "p").first()
    err = np.array(y) - np.array(p)
    assert math.isclose(r.mse, float(np.mean(err ** 2)))
    assert math.isclose(r.mae, float(np.mean(np.abs(err))))
    assert math.isclose(r.r2, 1 - float(np.sum(err ** 2) / np.sum((np.array(y) - np.mean(y)) ** 2)))


def test_corr_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.3)], "a double, b double")
    m = {(r.var_a, r.var_b): r.r for r in ST.corr_matrix(df, ["a", "b"]).collect()}
    exp = np.corrcoef([1.0, 2.0, 4.0], [2.0, 4.1, 8.3])[0, 1]
    assert math.isclose(m[("a", "b")], exp, rel_tol=1e-12) and math.isclose(m[("a", "a")], 1.0)


def test_hot_value_spreads_over_partitions(spark):
    from bankspark.operators.series import with_index
    rows = [(7.0,)] * 600 + [(float(i),) for i in range(1200)]
    df = spark.createDataFrame(rows, "v double").withColumn("g", F.lit("a")) \
        .withColumn("__tb", F.monotonically_increasing_id())
    idx = with_index(df, "g", ["v", "__tb"], partitions=6)
    sizes = [r[1] for r in idx.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.5 * len(rows)
    q = {r.q: r.quantile for r in ST.exact_quantiles(df.drop("__tb"), "v", [0.5]).collect()}
    assert q[0.5] == float(np.percentile([r[0] for r in rows], 50))


def test_zscore_fitted_on_other_rows(spark):
    df = spark.createDataFrame([(2.0, True), (4.0, True), (10.0, False)], "x double, tr boolean")
    got = {r.x: r.x_z for r in ST.zscore(df, ["x"], fit=df.filter("tr")).collect()}
    assert got == {2.0: -1.0, 4.0: 1.0, 10.0: 7.0}


def test_histogram_equals_numpy_on_edges(spark):
    vals = [i / 10 for i in range(31)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r["count"] for r in ST.histogram(df, "v", 30).orderBy("bin").collect()]
    assert got == np.histogram(vals, bins=30)[0].tolist()


def test_statistics_joins_do_not_shuffle_rows(spark, monkeypatch):
    """Whatever the planner's own broadcast limit, a counted statistics table is broadcast; a larger one is not."""
    from bankspark.operators import joins
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        for group in ("g", None):
            plan = ST.zscore(df, ["x"], group)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        few = ST.zscore(df, ["x"], "g")
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
        stats = df.groupBy("g").agg(F.avg("x").alias("m"))
        many = joins.attach_small(df, stats, "g", rows=2)
        assert many.count() == few.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quantiles_of_large_groups_use_brackets(spark, monkeypatch):
    monkeypatch.setattr(ST, "ACCURACY", 50)
    rnd = random.Random(6)
    vals = [round(rnd.expovariate(1), 2) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for r in ST.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.99, 1.0]).collect():
        assert math.isclose(r.quantile, float(np.percentile(vals, r.q * 100)), rel_tol=1e-12, abs_tol=1e-12)


def test_brackets_are_split_until_they_fit(spark, monkeypatch):
    """Few rows a bracket allowed: they are split at their own quantiles, hot values and ends included."""
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(ST, "ACCURACY", 100)
    monkeypatch.setattr(ST, "MAX_INSIDE", 60)
    monkeypatch.setattr(ST, "CUTS", 8)
    rng = np.random.default_rng(2)
    groups = {"even": rng.normal(size=6000), "hot": np.where(rng.random(5000) < 0.7, 3.0, rng.normal(size=5000)),
              "skew": rng.pareto(0.5, 4000), "few": rng.normal(size=5), "same": np.full(3000, 1.5)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("few", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    calls, inner = [], ST._split_brackets

    def split(*args):
        calls.append(1)
        return inner(*args)

    monkeypatch.setattr(ST, "_split_brackets", split)
    qs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {(r.g, r.q): r.quantile for r in ST.exact_quantiles(df, "v", qs, "g").collect()}
    assert calls and len(got) == len(groups) * len(qs)
    for g, vs in groups.items():
        for q in qs:
            assert np.isclose(got[g, q], pd.Series(vs).quantile(q), rtol=1e-12), (g, q)
