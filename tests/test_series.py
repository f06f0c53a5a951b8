import math
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bankspark.operators import series as S

BLOCK = 7   # tiny blocks so every operator crosses block boundaries


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    rows = []
    for s, n in (("a", 53), ("b", 5), ("c", 31)):
        for i in range(n):
            v = None if rnd.random() < 0.15 else round(rnd.uniform(1, 100), 2)
            rows.append((s, i * 10 + rnd.randint(0, 5), i, v))
    return spark.createDataFrame(rows, "sid string, t long, eid long, x double"), rows


def _plain(rows):
    out = {}
    for s, t, e, v in sorted(rows):
        out.setdefault(s, []).append((t, e, v))
    return out


def test_with_index_positions(spark, data):
    df, rows = data
    idx = S.with_position(S.with_index(df, "sid", ["t", "eid"], partitions=4), "sid")
    got = {(r.sid, r.eid): (r["__pos"], r["__len"]) for r in idx.collect()}
    for s, pts in _plain(rows).items():
        for i, (_, e, _) in enumerate(pts):
            assert got[(s, e)] == (i, len(pts))


def test_lags_and_rolling_match_plain_window(spark, data):
    df, _ = data
    idx = S.with_index(df, "sid", ["t", "eid"], partitions=3)
    got = S.rolling_mean(S.lags(idx, "sid", ["x"], [1, 5], BLOCK), "sid", "x", [3, 6], BLOCK)
    w = Window.partitionBy("sid").orderBy("t", "eid")
    exp = df.select("sid", "eid", F.lag("x", 1).over(w).alias("x_lag_1"), F.lag("x", 5).over(w).alias("x_lag_5"),
                    *[F.when(F.count("x").over(w.rowsBetween(-(n - 1), 0)) == n,
                             F.avg("x").over(w.rowsBetween(-(n - 1), 0))).alias(f"SMA_{n}") for n in (3, 6)])
    cols = ["sid", "eid", "x_lag_1", "x_lag_5", "SMA_3", "SMA_6"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())


def test_forward_fill_across_blocks(spark, data):
    df, rows = data
    idx = S.with_index(df, "sid", ["t", "eid"], partitions=2)
    got = {(r.sid, r.eid): r.x for r in S.forward_fill(idx, "sid", ["x"], BLOCK).collect()}
    for s, pts in _plain(rows).items():
        last = None
        for _, e, v in pts:
            last = v if v is not None else last
            assert got[(s, e)] == last


def test_collect_lags(spark, data):
    df, rows = data
    idx = S.with_index(df.fillna(0.0, ["x"]), "sid", ["t", "eid"], partitions=2)
    got = {(r.sid, r.eid): list(r.xs) for r in S.collect_lags(idx, "sid", "x", 4, BLOCK, out="xs").collect()}
    for s, pts in _plain(rows).items():
        vals = [v if v is not None else 0.0 for _, _, v in pts]
        for i, (_, e, _) in enumerate(pts):
            if i >= 4:
                assert got[(s, e)] == vals[i - 4:i]
            else:
                assert (s, e) not in got


def test_ema_block_fold_equals_pandas(spark, data):
    df, rows = data
    full = df.fillna(1.0, ["x"])   # the reference fills gaps before smoothing
    idx = S.with_index(full, "sid", ["t", "eid"], partitions=3)
    got = {(r.sid, r.eid): r.EMA_5 for r in S.ema_span(idx, "sid", "x", 5, "EMA_5", BLOCK).collect()}
    for s, pts in _plain(rows).items():
        xs = pd.Series([v if v is not None else 1.0 for _, _, v in pts])
        exp = xs.ewm(span=5, adjust=False).mean().tolist()
        for (_, e, _), y in zip(pts, exp):
            assert math.isclose(got[(s, e)], y, rel_tol=1e-12)


def test_ema_across_gaps_equals_pandas(spark):
    rng = random.Random(8)
    values = [None, None] + [None if rng.random() < 0.4 else rng.uniform(-5, 5) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(values)), "t long, x double").withColumn("sid", F.lit("s"))
    idx = S.with_index(df, "sid", ["t"], partitions=3)
    for ignore in (False, True):
        want = pd.Series(values, dtype="float64").ewm(alpha=0.3, adjust=False, ignore_na=ignore).mean().tolist()
        for block in (2, 7, 1000):
            got = [r.e for r in S.ewm_adjust_false(idx, "sid", ["x"], [0.3], ["e"], block, ignore).orderBy("t").collect()]
            assert all((g is None and w != w) or math.isclose(g, w, rel_tol=1e-12) for g, w in zip(got, want))
    four = spark.createDataFrame(list(enumerate([1.0, 2.0, None, 4.0])), "t long, x double").withColumn("sid", F.lit("s"))
    last = S.ewm_adjust_false(S.with_index(four, "sid", ["t"]), "sid", ["x"], [0.5], ["e"], 2).orderBy("t").collect()[-1]
    assert math.isclose(last.e, 19 / 6)


def test_many_blocks_carry_in_one_pass(spark):
    df = spark.range(20_000).select(F.lit("s").alias("sid"), F.col("id").alias("t"), (F.col("id") % 17).cast("double").alias("x"))
    idx = S.with_index(df, "sid", ["t"], partitions=4)
    got = S.ewm_adjust_false(idx, "sid", ["x"], [0.1], ["e"], 200).orderBy("t").toPandas()["e"]
    want = pd.Series([float(i % 17) for i in range(20_000)]).ewm(alpha=0.1, adjust=False).mean()
    assert (got - want).abs().max() < 1e-9


def test_stacked_operators_read_the_index_once_each(spark):
    df = spark.range(100).select(F.lit("s").alias("sid"), F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    idx = S.with_index(df, "sid", ["t"], partitions=2)
    out = S.rolling_mean(S.lags(idx, "sid", ["x"], [1], 10), "sid", "x", [3], 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 3)], "sid string, t long")
    got = sorted((r.sid, r.t, r.back) for r in S.latest(df, "sid", ["t"], 2).collect())
    assert got == [("a", 7, 2), ("a", 8, 1), ("b", 3, 1)]


def _rsi_reference(close, window=14):
    diff = close.diff(1)
    up = diff.where(diff > 0, 0.0)
    dn = -diff.where(diff < 0, 0.0)
    eu = up.ewm(alpha=1 / window, min_periods=window, adjust=False).mean()
    ed = dn.ewm(alpha=1 / window, min_periods=window, adjust=False).mean()
    rsi = 100 - 100 / (1 + eu / ed)
    return rsi.where(ed != 0, 100.0).where(ed.notna())


def test_rsi_matches_pandas_formula(spark):
    rnd = random.Random(11)
    vals = [round(50 + rnd.gauss(0, 3), 2) for _ in range(60)] + [61.0] * 20
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(vals)], "sid string, t long, x double")
    idx = S.with_index(df, "sid", ["t"], partitions=2)
    got = [r.RSI_14 for r in S.rsi(idx, "sid", "x", 14, block_rows=9).orderBy("t").collect()]
    exp = _rsi_reference(pd.Series(vals)).tolist()
    for g, e in zip(got, exp):
        if e != e:
            assert g is None
        else:
            assert math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9)


def test_hot_series_is_cut_into_bounded_blocks(spark):
    from pyspark.sql import functions as F
    rows = [("hot", i, i, float(i % 13)) for i in range(900)] + [("cold", i, 10_000 + i, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "sid string, t long, eid long, x double")
    idx = S.with_index(df, "sid", ["t", "eid"], partitions=4)
    block, overlap = 100, 20
    b = S.blocked(idx, overlap, block)
    biggest = b.groupBy("sid", S.BLK).count().agg(F.max("count")).first()[0]
    assert biggest <= block + overlap
    got = S.lags(idx, "sid", ["x"], [20], block)
    bad = got.filter((F.col("sid") == "hot") & (F.col("eid") >= 20)
                     & (F.col("x_lag_20") != ((F.col("eid") - 20) % 13).cast("double"))).count()
    assert bad == 0


def test_affine_states_equal_a_loop():
    import numpy as np
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 64, 1000):
        d, l = rng.uniform(0, 1, n), rng.normal(size=n)
        big, small = S.affine_states(d, l)
        y = 3.0
        for i in range(n):
            y = d[i] * y + l[i]
            assert math.isclose(big[i] * 3.0 + small[i], y, rel_tol=1e-10, abs_tol=1e-12)
        assert np.allclose(S._composed(d, l), (big[-1], small[-1]))


def test_million_rows_of_one_series(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("s").alias("sid"), F.col("id").alias("t"),
                               F.when(F.col("id") % 11 != 3, (F.col("id") * 7919 % 1009).cast("double")).alias("x"))
    idx = S.with_index(df, "sid", ["t"], partitions=4)
    got = S.ewm_adjust_false(idx, "sid", ["x"], [0.01], ["e"], 150_000).select("t", "e").toPandas().sort_values("t")["e"].to_numpy()
    i = pd.Series(range(n))
    x = (i * 7919 % 1009).astype(float).where(i % 11 != 3)
    assert abs(got - x.ewm(alpha=0.01, adjust=False).mean().to_numpy()).max() < 1e-8


def test_smoothers_of_scattered_rows(spark, data):
    """Rows that no longer lie in their order: a row is a stretch, and the stretches of a block are joined first."""
    df, rows = data
    idx = S.with_index(df, "sid", ["t", "eid"], partitions=3)
    key = lambda r: (r.sid, r.eid)
    for scattered in (idx.repartition(5), idx.orderBy(F.col("eid").desc())):
        for f in (lambda x: S.ewm_adjust_false(x, "sid", ["x", "x"], [0.2, 0.9], ["e", "f"], BLOCK), lambda x: S.rsi(x, "sid", "x", 3, "e", BLOCK)):
            a, b = ({key(r): r.e for r in f(x).collect()} for x in (idx, scattered))
            assert a.keys() == b.keys() and all(a[k] == b[k] or math.isclose(a[k], b[k], rel_tol=1e-9) for k in a)


def test_rsi_against_plain_loop_with_nulls_and_types(spark):
    """Rows next to a NULL neither rise nor fall; other columns pass as they are; null series are a series."""
    import datetime as dt
    from decimal import Decimal
    rng = random.Random(6)
    rows = [(s, i, None if rng.random() < 0.2 else rng.randint(1, 30), Decimal("1.25"), dt.datetime(2024, 1, 1, 5), None)
            for s in (None, "a") for i in range(40)]
    df = spark.createDataFrame(rows, "sid string, t long, x int, d decimal(10,2), at timestamp, n long")
    idx = S.with_index(df, "sid", ["t"], partitions=2)
    out = S.rsi(idx, "sid", "x", 4, "r", BLOCK)
    assert out.columns == [*idx.columns, "r"]
    got = {(r.sid, r.t): r for r in out.collect()}
    for s in (None, "a"):
        xs = [x for sid, _, x, *_ in rows if sid == s]
        up = down = None
        for i, x in enumerate(xs):
            diff = x - xs[i - 1] if i and x is not None and xs[i - 1] is not None else 0
            u, v = max(diff, 0), max(-diff, 0)
            up, down = (u, v) if i == 0 else (up + (u - up) / 4, down + (v - down) / 4)
            r = got[s, i]
            assert (r.x, r.d, r["at"], r.n) == (x, Decimal("1.25"), dt.datetime(2024, 1, 1, 5), None)
            want = None if i < 3 else 100.0 if down == 0 else 100 - 100 / (1 + up / down)
            assert r.r is None if want is None else math.isclose(r.r, want, rel_tol=1e-9, abs_tol=1e-9)


def test_rows_move_once_to_rsi(spark, data):
    df, _ = data
    plan = S.rsi(S.with_index(df, "sid", ["t", "eid"], partitions=3), "sid", "x", 14, "r", BLOCK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange rangepartitioning") == 0
    assert plan.count("ArrowEvalPython") == 0 and "SortMergeJoin" not in plan
