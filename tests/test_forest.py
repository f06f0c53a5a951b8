import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor

from bankspark.operators import forest as FO
from bankspark.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = 100 + 2 * x[:, 0] + np.sin(3 * x[:, 1]) + 0.3 * rng.normal(size=600)
    data = [(i, *map(float, r), float(t), i % 5 != 0, True) for i, (r, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(data, "id long, a double, b double, c double, d double, y double, is_train boolean, every boolean")
    return MD.assemble(frame, ["a", "b", "c", "d"]).select("id", "features", "y", "is_train", "every").repartition(3, "id").cache()


def _by_id(rows, *args, **more):
    found = FO.predictions(rows, "features", "y", "id", "is_train", "every", *args, **more).collect()
    return {(r.min_leaf, r.id): r.predictions for r in found}


def test_branches_dealt_to_groups_are_the_same_trees(rows, monkeypatch):
    """Whatever a group may hold, how many trees are dealt at a time and how rows are partitioned."""
    args = ([1, 3], [2, 5], [3, 30], [2, 20])
    whole = _by_id(rows, *args)
    assert len(whole) == 1200 and all(len(p) == 8 for p in whole.values())
    monkeypatch.setattr(FO, "DEAL_ROWS", 12000)
    monkeypatch.setattr(FO, "OPEN_NODES", 40)
    cut = _by_id(rows.repartition(5, "id"), *args, group_rows=150)
    assert cut.keys() == whole.keys()
    assert all(np.allclose(cut[k], whole[k], rtol=1e-9) for k in whole)


def test_cuts_equal_forests_of_that_size(rows):
    both = _by_id(rows, [2], [2, 4], [3, 30], [2])
    for place, (n, d, _) in list(enumerate(FO.cut_keys([2, 4], [3, 30], [2])))[:2]:
        own = _by_id(rows, [2], [n], [d], [2])
        assert all(np.isclose(own[k][0], both[k][place], rtol=1e-12) for k in own)


def test_as_good_as_sparks_forest(rows):
    own = FO.predictions(rows, "features", "y", "id", "is_train", "every", [2], [40], [30], [2])
    model = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=40, maxDepth=30, minInstancesPerNode=2,
                                  featureSubsetStrategy="sqrt", seed=42).fit(rows.filter("is_train"))
    theirs = model.transform(rows)
    for part in ("is_train", "not is_train"):
        a = MD.regression_scores(own.filter(part).withColumn("prediction", own.predictions[0]), "y")
        b = MD.regression_scores(theirs.filter(part), "y")
        assert a["n"] == b["n"] and abs(a["mse"] / b["mse"] - 1) < 0.2


def test_one_tree_equals_a_plain_walk(rows):
    """The groups' growth against a recursive one over the same draws."""
    data = rows.select("id", vector_to_array("features").alias("x"), "y").orderBy("id").collect()
    x, y = np.array([r.x for r in data]), np.array([r.y for r in data])
    y = y - y.mean()
    bins = np.stack([np.searchsorted(np.quantile(c, np.arange(1, 32) / 32), c) for c in x.T], axis=1).astype(np.uint8)
    w = FO.draws(np.arange(len(y), dtype=np.int64), 7, 0).astype(float)
    root = FO._root(7, 0)
    got = FO.grow(bins, y, w, np.ones(len(y), bool), [], root, False, 4, [6], [2])[:, 0, 0]

    def plain(every, path, depth):
        own = every[w[every] > 0]
        mean = np.average(y[own], weights=w[own])
        best = (1e-9, None, None)
        for f in FO._features(path, 4)[0] if depth < 6 else []:
            for b in range(31):
                left, right = own[bins[own, f] <= b], own[bins[own, f] > b]
                if min(w[left].sum(), w[right].sum()) >= 4:
                    gain = sum(w[p].sum() * (np.average(y[p], weights=w[p]) - mean) ** 2 for p in (left, right))
                    best = max(best, (gain, -f, -b)) if best[1] is not None else ((gain, -f, -b) if gain > best[0] else best)
        if best[1] is None:
            return {i: mean for i in every}
        f, b = -best[1], -best[2]
        left, right = FO._children(path)[0]
        return (plain(every[bins[every, f] <= b], np.array([left]), depth + 1) | plain(every[bins[every, f] > b], np.array([right]), depth + 1))

    want = plain(np.arange(len(y)), root, 0)
    assert np.allclose(got, [want[i] for i in range(len(y))], rtol=1e-9)


def test_odd_rows(spark, rows):
    # equal rows cannot be split: a closed branch of more rows than a group may hold
    same = rows.limit(1).crossJoin(spark.range(50).withColumnRenamed("id", "n")).selectExpr("n as id", "features", "1.5D as y", "true as is_train", "true as every")
    assert all(p == [1.5] for p in _by_id(same, [1], [1], [5], [2], group_rows=10).values())
    # a key given twice or NULL is a row of its own
    twice = rows.unionAll(rows.limit(3)).unionAll(rows.limit(1).selectExpr("cast(null as long) as id", "features", "y", "is_train", "every"))
    assert FO.predictions(twice, "features", "y", "id", "is_train", "every", [1], [2], [5], [2]).count() == 604
    # neither trained on nor wanted
    assert FO.predictions(rows.selectExpr("id", "features", "y", "is_train", "id < 10 as every"), "features", "y", "id", "is_train", "every",
                          [1], [2], [5], [2]).count() == 10
    with pytest.raises(Exception, match="NULL"):
        _by_id(rows.selectExpr("id", "features", "if(id = 1, null, y) as y", "is_train", "every"), [1], [2], [5], [2])
    with pytest.raises(ValueError):
        _by_id(rows.selectExpr("id", "features", "y", "false as is_train", "every"), [1], [2], [5], [2])


def test_nothing_of_a_forest_is_collected(rows, monkeypatch):
    """A branch is bounded by its rows, the driver by the nodes above the branches."""
    seen = []
    real = FO._tops
    monkeypatch.setattr(FO, "_tops", lambda *a: seen.append(real(*a)) or seen[-1])
    _by_id(rows, [1], [2], [30], [2], group_rows=150)
    assert all(max(r for r, left in zip(t.rows, t.left) if left < 0) <= 150 for t in seen[0])
    assert all(len(t.rows) < 80 for t in seen[0])


def test_few_rows_split_as_by_histograms(monkeypatch):
    """Nodes of few rows find the split that histograms find, to the last bit, also among equally good ones; larger ones alone have histograms."""
    rng = np.random.default_rng(3)
    for least, values in ((1, 3), (2, 30), (4, 1000)):
        size = rng.integers(2, 17, 900)
        bins = rng.integers(0, rng.choice([2, 5, 32], size.sum())[:, None], (size.sum(), 9)).astype(np.uint8)
        y, w = rng.integers(0, values, size.sum()) / 7, rng.integers(1, 4, size.sum()).astype(float)
        choice, at, start = FO._features(np.arange(len(size), dtype=np.uint64), 9), np.arange(len(bins)) * 9, np.cumsum(size) - size
        want = FO._many(bins.ravel(), at, size, choice, w, w * y, least)
        found = FO._few(bins.ravel(), at, start, size, choice, w, w * y, least, 16)
        assert 100 < want[2].sum() and all((a == b)[want[2]].all() for a, b in zip(want, found)) and (want[2] == found[2]).all()
    seen, real = [], FO._many
    monkeypatch.setattr(FO, "_many", lambda flat, at, size, *a: seen.append(size.min()) or real(flat, at, size, *a))
    bins, y = rng.integers(0, 32, (4000, 9)).astype(np.uint8), rng.normal(size=4000)
    args = (bins, y, FO.draws(np.arange(4000), 7, 0).astype(float), np.ones(4000, bool), [], FO._root(7, 0), False, 1, [20], [2])
    few = FO.grow(*args)
    assert seen and min(seen) > 16
    monkeypatch.setattr(FO, "FEW", ())
    assert (FO.grow(*args) == few).all()


def test_draws_are_poisson_quantiles():
    row = np.random.default_rng(4).integers(-2 ** 63, 2 ** 63 - 1, 300_000)
    u = (FO._mix(row.view(np.uint64) ^ FO._root(7, 3)) >> np.uint64(11)) * 2.0 ** -53
    assert (FO.draws(row, 7, 3) == np.searchsorted(FO._POISSON, u, side="right")).all()


def test_rows_of_branches_are_counted(spark):
    """Also where the drawn rows are a bad guess: those that do not train lie in one corner."""
    table = spark.createDataFrame([(i, i * 7919, float(i % 50), i < 300, True, bytes([i % 30 if i < 300 else 31, i % 7])) for i in range(900)],
                                              "id long, draw long, y double, trains boolean, wanted boolean, bins binary")
    for top in FO._tops(table, 2, [(1, 0), (1, 1)], 900, 30, 42, 100):
        leaves = [i for i, left in enumerate(top.left) if left < 0]
        assert sum(top.rows[i] for i in leaves) == 900 and all(top.counted[i] for i in leaves)
        assert all(top.rows[i] <= 100 or top.closed[i] for i in leaves)
