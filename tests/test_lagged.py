import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bankspark.operators import lagged as LG
from bankspark.operators import models as MD
from bankspark.operators import series as S


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = [(s, i, rng.gauss(50, 9), None if rng.random() < 0.2 else rng.gauss(-1e6, 1e5))
            for s, n in (("a", 700), (None, 90), ("c", 30), ("d", 1)) for i in range(n)]
    return S.with_index(spark.createDataFrame(rows, "sid string, t long, x double, v double"), "sid", ["t"], partitions=5), rows


@pytest.mark.parametrize("max_lag", [5, 64, 65, 200])
def test_products_of_stretches_add_up(max_lag):
    rng = np.random.default_rng(max_lag)
    values = rng.normal(size=(2, 500))
    channels, products = (lambda v: np.concatenate([v, v * v])), [(0, 1), (1, 0), (2, 3), (0, 0)]
    whole = LG.Stretch(values, channels, products, max_lag)
    mat = channels(values)
    for p, (a, b) in enumerate(products):
        for k in range(max_lag + 1):
            assert math.isclose(whole.sums[p, k], mat[a, k:] @ mat[b, :500 - k], rel_tol=1e-9, abs_tol=1e-9)
    cuts = [0, 1, 2, 30, 230, 231, 499, 500]
    total = None
    for i, j in zip(cuts, cuts[1:]):
        part = LG.Stretch(values[:, i:j], channels, products, max_lag)
        if total is None:
            total = part
        else:
            total.extend(part)
    assert np.allclose(total.sums, whole.sums, atol=1e-9) and total.n == 500
    assert (total.head == whole.head).all() and (total.tail == whole.tail).all()


def test_correlations_at_every_lag_equal_corr(spark, data):
    indexed, rows = data
    found = LG.lag_correlations(indexed, "sid", "x", ["v", "x"], 100)
    got = {(r.sid, r.variable, r.lag): r.r for r in found.collect()}
    assert len(got) == 4 * 2 * 100
    for s in ("a", None, "c", "d"):
        frame = pd.DataFrame([r[2:] for r in rows if r[0] == s], columns=["x", "v"], dtype="float64")
        for v in ("x", "v"):
            for k in range(1, 101):
                with np.errstate(all="ignore"):
                    want = frame["x"].corr(frame[v].shift(k))
                if want == want and (frame["x"].notna() & frame[v].shift(k).notna()).sum() > 2:
                    assert math.isclose(got[s, v, k], want, rel_tol=1e-9, abs_tol=1e-10), (s, v, k)
                elif want != want:
                    assert got[s, v, k] is None
    # the lags of a window column
    lagged = S.lags(indexed, "sid", ["v"], [7, 90], 200).groupBy("sid").agg(*[F.corr("x", f"v_lag_{k}").alias(f"r{k}") for k in (7, 90)])
    for r in lagged.filter("sid = 'a'").collect():
        assert math.isclose(r.r7, got["a", "v", 7], rel_tol=1e-9) and math.isclose(r.r90, got["a", "v", 90], rel_tol=1e-9)
    # order lost: as exact
    again = LG.lag_correlations(indexed.repartition(4), "sid", "x", ["v", "x"], 100)
    for r in again.collect():
        w = got[r.sid, r.variable, r.lag]
        assert (r.r is None and w is None) or math.isclose(r.r, w, rel_tol=1e-9, abs_tol=1e-10)


def test_rows_are_never_shuffled(spark, data):
    plan = LG.lag_correlations(data[0], "sid", "x", ["v"], 600)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan  # of the stretches' sums
    lines = [x for x in plan.splitlines() if "MapInArrow" in x or "Exchange hashpartitioning" in x]
    assert "Exchange" in lines[0] and "MapInArrow" in lines[1]


@pytest.mark.parametrize("steps", [1, 3, 20])
def test_least_squares_on_lags(spark, data, steps):
    indexed, rows = data
    x, y = [], []
    for s in ("a", None, "c", "d"):
        v = [r[2] for r in rows if r[0] == s]
        for t in range(steps, len(v)):
            x.append([*v[t - steps:t], 1.0])
            y.append(v[t])
    want = np.linalg.lstsq(np.array(x), np.array(y), rcond=None)[0]
    coefficients, intercept = LG.lag_least_squares(indexed, "sid", "x", steps)
    assert np.allclose([*coefficients, intercept], want, rtol=1e-6, atol=1e-8)
    with pytest.raises(Exception, match="gaps"):
        LG.lag_least_squares(indexed, "sid", "v", steps)


def test_forecast_weights_are_the_recursion(spark):
    rng = np.random.default_rng(4)
    coefficients, intercept, window = rng.normal(0, 0.2, 12), 0.7, rng.normal(size=12)
    w, want = list(window), []
    for _ in range(9):
        want.append(float(np.dot(w, coefficients) + intercept))
        w = [*w[1:], want[-1]]
    rows = LG.forecast_weights(list(coefficients), intercept, 9)
    assert np.allclose(rows[:, :-1] @ window + rows[:, -1], want)
    df = spark.createDataFrame([([float(v) for v in window],)], "w array<double>")
    assert np.allclose(MD.recursive_forecast(df, "w", list(coefficients), intercept, 9).first().forecast, want)
