from itertools import product

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor

from bankspark.operators import forest_grid as FG
from bankspark.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = 2 * x[:, 0] + np.sin(3 * x[:, 1]) + 0.3 * rng.normal(size=400)
    data = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(data, "id long, a double, b double, c double, d double, y double")
    return MD.assemble(frame, ["a", "b", "c", "d"]).select("id", "features", "y").repartition(3).cache()


def _fit(rows, trees=12, depth=9, leaf=1):
    return RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf,
                                 featureSubsetStrategy="sqrt", seed=7, cacheNodeIds=True).fit(rows)


def _walk(tree, x, depth, split):
    """One tree, one row, node by node."""
    node = tree[0]
    for level in range(100):
        if node.left < 0 or level == depth or node["count"] < split:
            return node.prediction
        node = tree[node.left if x[node.feature] <= node.threshold else node.right]


def test_prefix_and_cuts_equal_a_plain_walk(spark, rows):
    model = _fit(rows)
    nodes = FG.forest_nodes(spark, model)
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.id] = r
    held = rows.filter("id < 60").select("id", vector_to_array("features").alias("x"), "y").orderBy("id").collect()
    sizes, depths, splits = [5, 12], [2, 6, 30], [2, 5, 40]
    want = {}
    for n, d, s in product(sizes, depths, splits):
        errors = [(np.mean([_walk(trees[t], r.x, d, s) for t in range(n)]) - r.y) ** 2 for r in held]
        want[n, d, s] = np.mean(errors)
    frame = rows.filter("id < 60").select(vector_to_array("features").alias("x"), "y")
    forest = FG.trees_of(nodes)
    for limit in (10 ** 6, max(len(t) for t in trees.values())):
        got = FG.squared_errors(frame, forest, sizes, depths, splits, limit)
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 * max(1, want[k]) for k in want)
    # nothing cut: Spark's own prediction
    own = model.transform(rows.filter("id < 60")).select("prediction", "y")
    assert abs(np.mean([(r.prediction - r.y) ** 2 for r in own.collect()]) - want[12, 30, 2]) < 1e-12
    with pytest.raises(ValueError):
        FG.chunks(forest, sizes, 3)


def test_cut_at_a_depth_equals_a_fit_of_that_depth(spark, rows):
    """Spark draws the features of a level's nodes in the same order whatever the depth, so both trees are one."""
    deep, shallow = FG.trees_of(FG.forest_nodes(spark, _fit(rows, 6, 9))), FG.trees_of(FG.forest_nodes(spark, _fit(rows, 6, 3)))
    x = np.array([r.x for r in rows.select(vector_to_array("features").alias("x")).collect()])
    assert np.allclose(FG.cut_sums(deep, x, [3], [2]), FG.cut_sums(shallow, x, [3], [2]), rtol=1e-12)


def test_grid_scores(spark, rows):
    grid = {"n_estimators": [4, 8], "max_depth": [None, 3], "min_samples_split": [2, 30], "min_samples_leaf": [1, 5]}
    got = FG.grid_scores(rows, "features", "y", "id", grid, folds=3, parallelism=3).collect()
    assert len(got) == 16 and [r["rank"] for r in got] == sorted(r["rank"] for r in got)
    by = {(r.n_estimators, r.max_depth, r.min_samples_split, r.min_samples_leaf): r.mean_mse for r in got}
    assert len(by) == 16 and by[8, None, 2, 1] < by[8, 3, 2, 1]
    # one fold by hand
    folded = rows.withColumn("fold", MD.md5_number("id") % 3)
    errors = []
    for fold in range(3):
        model = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=8, maxDepth=30, minInstancesPerNode=5,
                                      featureSubsetStrategy="sqrt", seed=42, cacheNodeIds=True, maxMemoryInMB=2048,
                                      checkpointInterval=10).fit(folded.filter(f"fold <> {fold}"))
        errors.append(MD.regression_scores(model.transform(folded.filter(f"fold = {fold}")), "y")["mse"])
    assert abs(by[8, None, 2, 5] / np.mean(errors) - 1) < 0.25  # another bootstrap of the same rows


def test_whole_grid_is_the_default():
    assert len(list(product(*FG.GRID.values()))) == 108
