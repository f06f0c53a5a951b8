"""Clustering, splits and regression models on Spark ML.

The driver holds fitted models and their few parameters (centres,
coefficients); every pass over data runs on the executors.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- clustering (K4-K9) ------------------------------------------------------

NO_LIMIT = 2 ** 31 - 1  # the largest number of iterations that Spark takes


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Feature vector of ``cols``; a NULL or NaN feature is an error, not a dropped row."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def kmeans_canonical(df: DataFrame, cols: list[str] | None, k: int = 4, seed: int = 42,
                     out: str = "cluster"):
    """Spark ML's k-means, for vectors, with cluster ids renumbered by the lexicographic order of the centres (K4).

    ``cols=None``: ``df`` already has its vector in ``features``.  The iterations go on until the centres stand still:
    their number grows with the rows (25 for 2,000 embeddings, 408 for 51,282), and each lowers the cost, so they end.
    Returns (labelled DataFrame, centres in canonical order, training cost).
    """
    x = df if cols is None else assemble(df, cols)
    model = KMeans(k=k, seed=seed, maxIter=NO_LIMIT, featuresCol="features",
                   predictionCol="__raw").fit(x)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    remap = {raw: new for new, raw in enumerate(order)}
    pairs = []
    for raw, new in remap.items():
        pairs += [F.lit(raw), F.lit(new)]
    labelled = model.transform(x).withColumn(out, F.element_at(F.create_map(*pairs), F.col("__raw")))
    return labelled.drop("__raw"), [centres[i] for i in order], float(model.summary.trainingCost)


def _squared_distance(cols: list[str], centre: list[float]) -> Column:
    terms = [(F.col(c) - F.lit(float(m))) * (F.col(c) - F.lit(float(m))) for c, m in zip(cols, centre)]
    return reduce(lambda a, b: a + b, terms)


def farthest_first(df: DataFrame, cols: list[str], key: str, k: int) -> list[list[float]]:
    """Up to ``k`` seeds: the point farthest from the mean, then each time the one farthest from all seeds; ties go to the smallest key.

    One pass a seed, of which each task sends one row.  Ends early when every point is a seed.
    """
    mean = df.agg(*[F.avg(c) for c in cols]).first()
    if mean[0] is None:
        raise ValueError("no points")
    seeds: list[list[float]] = []
    while len(seeds) < k:
        distances = [_squared_distance(cols, c) for c in (seeds or [list(mean)])]
        far = F.least(*distances) if len(distances) > 1 else distances[0]
        top = df.select(*cols, key, far.alias("__far")).orderBy(F.col("__far").desc(), key).limit(1).first()
        if seeds and not top["__far"] > 0:
            break
        seeds.append([float(top[c]) for c in cols])
    return seeds


class Clustering(NamedTuple):
    """A k-means result: centres in lexicographic order, within-cluster sum of squares, rounds until they stood still."""
    centres: list[list[float]]
    inertia: float
    rounds: int


def kmeans_all(df: DataFrame, cols: list[str], ks: list[int], key: str, max_iter: int = 300, tol: float = 1e-12) -> dict[int, Clustering]:
    """k-means for every k at once, from the same farthest-first seeds (K4, K5).

    A round is one aggregate over the points for all k that still move: each point adds itself to its nearest centre (the
    first of equals) of each k, and one row a centre is shuffled.  A centre without points stays.  The result
    depends on the points and keys alone, not on partitioning; ``tol`` bounds the squared move of a centre that stands still.
    With fewer distinct points than k, every point is a centre.  A NULL or NaN coordinate raises.
    """
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) for c in cols])
    if not df.filter(bad).limit(1).isEmpty():
        raise ValueError(f"NULL or NaN among {cols}")
    seeds = farthest_first(df, cols, key, max(ks))
    centres, out, moving, rounds = {k: seeds[:k] for k in ks}, {}, sorted(ks), 0
    while moving:
        rounds += 1
        if rounds > max_iter:
            raise RuntimeError(f"k-means with k in {moving} has not converged after {max_iter} rounds")
        nearest = [F.struct(F.lit(k).alias("k"), F.array_min(F.array(*[
            F.struct(_squared_distance(cols, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centres[k])])).alias("near"))
            for k in moving]
        sums = (df.select(*cols, F.explode(F.array(*nearest)).alias("__near")).groupBy("__near.k", "__near.near.j")
                .agg(F.sum("__near.near.d").alias("d"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).collect())
        inertia = dict.fromkeys(moving, 0.0)
        moved = {k: list(centres[k]) for k in moving}
        for r in sums:  # one row a centre
            inertia[r["k"]] += r["d"]
            moved[r["k"]][r["j"]] = [float(r[f"m{i}"]) for i in range(len(cols))]
        for k in list(moving):
            step = max(sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(centres[k], moved[k]))
            centres[k] = moved[k]
            if step <= tol:
                out[k] = Clustering(sorted(moved[k]), inertia[k], rounds)
                moving.remove(k)
    return out


def assign_clusters(df: DataFrame, cols: list[str], centres: list[list[float]], out: str = "cluster") -> DataFrame:
    """The number of each row's nearest centre, the first of equals."""
    near = F.array_min(F.array(*[F.struct(_squared_distance(cols, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centres)]))
    return df.withColumn(out, near["j"].cast("int"))


def elbow(df: DataFrame, cols: list[str], key: str, ks=range(1, 11)) -> list[tuple[int, float]]:
    """(k, inertia) for the elbow plot (K5, K6)."""
    return [(k, c.inertia) for k, c in sorted(kmeans_all(df, cols, list(ks), key).items())]


def silhouette_sq_euclidean(labelled: DataFrame, label: str = "cluster") -> float:
    """Silhouette with squared Euclidean distance (Spark's evaluator, O(n k)) (K7).

    The Euclidean silhouette of the original needs every pair of points and
    is not offered.
    """
    ev = ClusteringEvaluator(featuresCol="features", predictionCol=label,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(labelled.withColumn(label, F.col(label).cast("double"))))


def davies_bouldin(labelled: DataFrame, cols: list[str], label: str = "cluster") -> float:
    """Davies-Bouldin index from centroids (avg) and mean distance to the centroid (K8)."""
    cent = labelled.groupBy(label).agg(*[F.avg(c).alias(f"__c_{c}") for c in cols])
    j = labelled.join(F.broadcast(cent), label)   # one row per cluster
    dist = F.sqrt(sum(((F.col(c) - F.col(f"__c_{c}")) ** 2 for c in cols[1:]),
                      (F.col(cols[0]) - F.col(f"__c_{cols[0]}")) ** 2))
    scat = j.groupBy(label).agg(F.avg(dist).alias("s"))
    rows = cent.join(scat, label).collect()        # k rows: model-sized
    k = len(rows)
    if k < 2:
        return float("nan")
    total = 0.0
    for a in rows:
        worst = 0.0
        for b in rows:
            if a[label] == b[label]:
                continue
            m = sum((a[f"__c_{c}"] - b[f"__c_{c}"]) ** 2 for c in cols) ** 0.5
            worst = max(worst, (a["s"] + b["s"]) / m if m > 0 else float("inf"))
        total += worst
    return total / k


def davies_bouldin_arrays(labelled: DataFrame, vector: str, label: str) -> float:
    """Davies-Bouldin index of points given as arrays (K8)."""
    dims = labelled.agg(F.max(F.size(vector))).first()[0]   # the model's width
    wide = labelled.select(label, *[F.col(vector)[i].alias(f"d{i}") for i in range(dims)])
    return davies_bouldin(wide, [f"d{i}" for i in range(dims)], label)


# ---- splits (K15) ------------------------------------------------------------


def hash_split(df: DataFrame, key: str, train_pct: int = 80, out: str = "is_train") -> DataFrame:
    """Stable 80/20 split by the MD5 of the key's text, independent of partitioning and engine."""
    return df.withColumn(out, md5_number(key) % 100 < train_pct)


def md5_number(key: str) -> Column:
    """The first four bytes of the MD5 of the key's text."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


# ---- regression (K19, K22) ----------------------------------------------


def regression_scores(pred: DataFrame, label: str, prediction: str = "prediction") -> dict:
    """MSE, RMSE, MAE, R^2 in one aggregate."""
    err = F.col(label) - F.col(prediction)
    r = pred.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                 F.sum(err * err).alias("sse"),
                 (F.var_pop(label) * F.count(label)).alias("sst"),
                 F.count(F.lit(1)).alias("n")).first()
    mse = r["mse"]
    return {"n": r["n"], "mse": mse, "rmse": mse ** 0.5 if mse is not None else None, "mae": r["mae"],
            "r2": (1.0 - r["sse"] / r["sst"]) if r["sst"] else None}


def recursive_forecast(last_windows: DataFrame, window_col: str, coefficients: list[float],
                       intercept: float, steps: int = 10, out: str = "forecast") -> DataFrame:
    """Predict, append, drop the oldest value, ``steps`` times, per row.

    Every step is linear in the window: its weights come from powers of the recursion's companion matrix, so a forecast is one dot
    product a step.
    """
    from bankspark.operators.lagged import forecast_weights

    window = F.col(window_col).cast("array<double>")
    ahead = [F.aggregate(F.zip_with(window, F.array(*[F.lit(float(w)) for w in row[:-1]]), lambda a, b: a * b),
                         F.lit(0.0), lambda s, v: s + v) + F.lit(float(row[-1]))
             for row in forecast_weights(coefficients, intercept, steps)]
    return last_windows.withColumn(out, F.array(*ahead))
