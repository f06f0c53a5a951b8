"""Grid search over random forests by nested evaluation.

A grid of forest sizes, depths, split sizes and leaf sizes needs one fit per leaf size and fold, of the largest forest
without a lesser depth; the other axes are read off that forest:

* a forest of n trees is the first n of its trees, which are drawn independently of each other;
* a tree of depth d is the tree cut at depth d: a node that is cut becomes a leaf, and Spark stores every node's mean;
* a tree that does not split nodes of fewer than s rows is the tree cut at such nodes; Spark stores every
  node's row count (of its bootstrap sample).

The reference grid (108 combinations, 5 folds) takes 15 forests in place of 540.  ``grid_scores`` grows them with
``forest.predictions``, which gives the predictions of every cut.  ``squared_errors`` reads them off a fitted forest of Spark
ML: a walk down a tree meets the leaf of every (depth, split size) on its way; the driver holds that forest as Spark ML does, and
tasks get it in chunks of at most ``CHUNK_NODES`` nodes, one pass a chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.operators.forest import cut_keys, predictions
from bankspark.session import ensure_checkpoint_dir, written

# fixed values: the grid of the reference's search; a depth of None is no limit
GRID = {"n_estimators": [100, 150, 200], "max_depth": [None, 10, 20, 30], "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4]}
UNLIMITED = 30            # the greatest depth that Spark grows
CHUNK_NODES = 2_000_000   # about 64 MB
ROWS = 256                # walked at a time


class Trees(NamedTuple):
    """Consecutive trees of a forest as arrays over their nodes; children are places in the arrays, -1 for none."""
    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    prediction: np.ndarray
    count: np.ndarray


def forest_nodes(spark, model: RandomForestRegressionModel) -> DataFrame:
    """(tree, id, left, right, feature, threshold, prediction, count) of every node, from the model as Spark saves it."""
    path = f"{ensure_checkpoint_dir(spark)}/bankspark-forest-{uuid.uuid4().hex}"
    model.write().save(path)
    node, split = "nodeData.{}", "nodeData.split.{}"
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(node.format("id")).alias("id"), F.col(node.format("leftChild")).alias("left"),
        F.col(node.format("rightChild")).alias("right"), F.col(split.format("featureIndex")).alias("feature"),
        F.get(split.format("leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.col(node.format("prediction")).alias("prediction"), F.col(node.format("rawCount")).alias("count"))


def trees_of(nodes: DataFrame) -> Trees:
    """The whole forest in the driver's memory, as large as the fitted model there."""
    table = nodes.sort("tree", "id").toArrow()
    col = {n: table[n].to_numpy() for n in table.column_names}
    roots = np.searchsorted(col["tree"], np.arange(col["tree"].max() + 1))
    base = roots[col["tree"]]
    leaf = col["left"] < 0
    return Trees(roots, np.where(leaf, -1, base + col["left"]), np.where(leaf, -1, base + col["right"]),
                 np.where(leaf, 0, col["feature"]), np.where(leaf, 0.0, col["threshold"]), col["prediction"], col["count"])


def chunks(trees: Trees, cuts: list[int], limit: int = CHUNK_NODES) -> list[tuple[int, Trees]]:
    """(trees up to the chunk's end, chunk): consecutive trees of at most ``limit`` nodes, and never across a cut."""
    stops = np.append(trees.roots[1:], len(trees.left))
    out, first = [], 0
    for t in range(len(trees.roots)):
        if stops[t] - trees.roots[t] > limit:
            raise ValueError(f"a tree of {stops[t] - trees.roots[t]} nodes is larger than a chunk of {limit}")
        if t + 1 in cuts or t + 1 == len(stops) or stops[t + 1] - trees.roots[first] > limit:
            a, b = trees.roots[first], stops[t]
            part = Trees(trees.roots[first:t + 1] - a, *(np.where(x[a:b] < 0, -1, x[a:b] - a) for x in (trees.left, trees.right)),
                         *(x[a:b] for x in trees[3:]))
            out.append((t + 1, part))
            first = t + 1
    return out


def cut_sums(trees: Trees, x: np.ndarray, depths: list[int], splits: list[int]) -> np.ndarray:
    """Sum over the trees of each row's prediction under every (depth, split size): rows by depths by splits."""
    at = np.arange(len(x))[:, None]
    node = np.broadcast_to(trees.roots, (len(x), len(trees.roots))).copy()
    stop = [node.copy() for _ in splits]
    open_ = [np.ones(node.shape, bool) for _ in splits]
    out = np.zeros((len(x), len(depths), len(splits)))
    for depth in range(max(depths) + 1):
        leaf = trees.left[node] < 0
        count = trees.count[node]
        for j, s in enumerate(splits):
            stop[j] = np.where(open_[j], node, stop[j])
            open_[j] &= ~(leaf | (count < s))
            for i, d in enumerate(depths):
                if d == depth:
                    out[:, i, j] = trees.prediction[stop[j]].sum(axis=1)
        if leaf.all():  # nothing is deeper
            for j in range(len(splits)):
                for i, d in enumerate(depths):
                    if d > depth:
                        out[:, i, j] = trees.prediction[stop[j]].sum(axis=1)
            break
        goes_left = x[at, trees.feature[node]] <= trees.threshold[node]
        node = np.where(leaf, node, np.where(goes_left, trees.left[node], trees.right[node]))
    return out


def squared_errors(rows: DataFrame, trees: Trees, sizes: list[int], depths: list[int], splits: list[int],
                   limit: int = CHUNK_NODES) -> dict[tuple[int, int, int], float]:
    """Mean squared error of ``rows`` (x array<double>, y double) for every (trees, depth, split size)."""
    spark = rows.sparkSession
    parts = chunks(trees, sizes, limit)
    width = len(depths) * len(splits)
    schema = "x array<double>, y double, sums array<double>, errors array<double>"
    rows = rows.select("x", F.col("y").cast("double").alias("y"), F.array_repeat(F.lit(0.0), width).alias("sums"),
                       F.array().cast("array<double>").alias("errors"))
    for upto, chunk in parts:
        held = spark.sparkContext.broadcast(chunk)
        size = upto if upto in sizes else 0

        def walk(batches: Iterator[pa.RecordBatch], held=held, size=size) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(0, b.num_rows, ROWS):
                    part = b.slice(i, ROWS)
                    n = part.num_rows
                    x = part["x"].flatten().to_numpy().reshape(n, -1)
                    y = part["y"].to_numpy()
                    sums = part["sums"].flatten().to_numpy().reshape(n, width)
                    errors = part["errors"].flatten().to_numpy().reshape(n, -1) if len(part["errors"].flatten()) else np.zeros((n, 0))
                    sums = sums + cut_sums(held.value, x, depths, splits).reshape(n, width)
                    if size:
                        errors = np.hstack([errors, (sums / size - y[:, None]) ** 2])
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * v.shape[1]),
                                                      pa.array(np.ascontiguousarray(v).ravel())) for v in (sums, errors)]
                    yield pa.RecordBatch.from_arrays([part["x"], part["y"], *lists], ["x", "y", "sums", "errors"])

        rows = rows.mapInArrow(walk, schema)
        if len(parts) > 1:
            rows = written(rows, "forest-sums")
    keys = list(product(sorted(sizes), depths, splits))
    means = rows.agg(*[F.avg(F.col("errors")[k]).alias(f"e{k}") for k in range(len(keys))]).first()
    return dict(zip(keys, means))


def grid_scores(train: DataFrame, features: str, label: str, key: str, grid: dict | None = None, folds: int = 5,
                seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Cross-validated scores of the whole grid, one row a combination, best first.

    ``features`` is a vector column; folds come from the MD5 of ``key``.  mean_mse is the mean over the folds of the held-out
    rows' mean squared error, std_mse its population deviation; equal ranks for equal means.  The forests of a fold are grown
    by ``forest.predictions`` together, without collecting a tree.
    """
    from bankspark.operators.models import md5_number

    spark = train.sparkSession
    grid = grid or GRID
    rows = written(train.select(F.col(features).alias("features"), F.col(label).cast("double").alias("y"), F.col(key).alias("key"),
                                (md5_number(key) % folds).cast("int").alias("fold")), "forest-rows")
    depth_of = {d: UNLIMITED if d is None else d for d in grid["max_depth"]}
    depths = sorted(set(depth_of.values()))
    sizes, splits, leaves = sorted(grid["n_estimators"]), sorted(grid["min_samples_split"]), sorted(grid["min_samples_leaf"])
    keys = cut_keys(sizes, depths, splits)

    def one(fold: int) -> dict:
        parts = rows.withColumn("trains", F.col("fold") != fold).withColumn("held_out", F.col("fold") == fold)
        found = predictions(parts, "features", "y", "key", "trains", "held_out", leaves, sizes, depths, splits, seed)
        means = found.groupBy("min_leaf").agg(*[F.avg((F.col("predictions")[k] - F.col("y")) ** 2).alias(f"e{k}") for k in range(len(keys))])
        return {(r["min_leaf"], fold): dict(zip(keys, r[1:])) for r in means.collect()}  # one row a leaf size

    errors = dict.fromkeys(product(leaves, range(folds)), {})
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for found in pool.map(one, range(folds)):
            errors.update(found)
    table = []
    for n, d, s, leaf in product(sizes, grid["max_depth"], splits, sorted(grid["min_samples_leaf"])):
        by_fold = [errors[leaf, fold].get((n, depth_of[d], s)) for fold in range(folds)]
        if any(e is None for e in by_fold):
            raise ValueError("a fold has no rows")
        table.append((n, d, s, leaf, float(np.mean(by_fold)), float(np.std(by_fold))))
    means = [t[4] for t in table]
    ranked = sorted(((*t, 1 + sum(m < t[4] for m in means)) for t in table), key=lambda t: (t[6], t[0], t[1] or UNLIMITED + 1, t[2], t[3]))
    return spark.createDataFrame(ranked, "n_estimators int, max_depth int, min_samples_split int, min_samples_leaf int, "
                                         "mean_mse double, std_mse double, rank int")
