"""Queries for statistics operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankspark.operators import series as S
from bankspark.operators import stats as ST
from bankspark.queries.oracle_views import with_views
from bankspark.sources.roles import Roles

ORDER = ["ts", "event_id"]
BINS = 30
IMPUTE_LAG = 360


def _r(c: str, d: int = 6):
    return F.round(F.col(c), d).alias(c)


def q_tick_describe(spark, sf_dir):
    df = ST.describe(Roles(spark, sf_dir).tick(), "close", "series_id")
    return df.select("series_id", "count", *[_r(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def q_orders_describe(spark, sf_dir):
    o = Roles(spark, sf_dir).t("orders")
    df = ST.describe(o, "o_totalprice", "o_orderpriority")
    return df.select("o_orderpriority", "count",
                     *[_r(c, 4) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def q_tick_box(spark, sf_dir):
    df = ST.box_summary(Roles(spark, sf_dir).tick(), "close", "series_id")
    return df.select("series_id", *[_r(c) for c in ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")],
                     "n_outliers")


def q_tick_histogram(spark, sf_dir):
    df = ST.histogram(Roles(spark, sf_dir).tick(), "close", BINS, "series_id")
    return df.select("series_id", "bin", _r("bin_low"), _r("bin_high"), "count", _r("density", 9))


def q_tick_normal_fit(spark, sf_dir):
    df = ST.normal_fit(Roles(spark, sf_dir).tick(), "close", "series_id")
    return df.select("series_id", _r("mu"), _r("sigma"), _r("pdf_at_mu", 9))


def q_tick_normal_curve(spark, sf_dir):
    df = ST.normal_curve(Roles(spark, sf_dir).tick(), "close", 100, "series_id")
    return df.select("series_id", F.col("i").cast("int").alias("i"), _r("x", 9), _r("pdf", 12))


def q_bar_corr(spark, sf_dir):
    df = ST.corr_matrix(Roles(spark, sf_dir).bar(), ["open", "high", "low", "close", "volume"])
    return df.select("var_a", "var_b", _r("r", 9))


def q_priority_mean_std(spark, sf_dir):
    o = Roles(spark, sf_dir).t("orders")
    df = ST.mean_std_by(o, "o_orderpriority", ["o_totalprice"])
    return df.select("o_orderpriority", _r("o_totalprice_mean", 4), _r("o_totalprice_std", 4))


def q_tick_zscore(spark, sf_dir):
    df = ST.zscore(Roles(spark, sf_dir).tick(), ["close"], "series_id")
    return df.select("series_id", "event_id", _r("close_z", 9))


def q_tick_minmax(spark, sf_dir):
    df = ST.minmax_scale(Roles(spark, sf_dir).tick(), "close", "series_id")
    return df.select("series_id", "event_id", "close_scaled")


def q_priority_anova(spark, sf_dir):
    o = Roles(spark, sf_dir).t("orders")
    df = ST.anova_oneway(o, "o_totalprice", "o_orderpriority")
    return df.select(_r("f_stat", 6), "df_between", "df_within")


def _lagged(spark, sf_dir):
    idx = S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)
    return S.lags(idx, "series_id", ["close"], [IMPUTE_LAG], name="close_lag_{k}")


def q_tick_regr_impute(spark, sf_dir):
    lag = f"close_lag_{IMPUTE_LAG}"
    df = ST.regression_impute(_lagged(spark, sf_dir), [lag], "close", "series_id")
    return df.select("series_id", "event_id", _r(lag, 6))


def q_tick_mean_impute(spark, sf_dir):
    idx = S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)
    df = S.rolling_mean(idx, "series_id", "close", [50])
    df = ST.mean_impute(df, ["SMA_50"], "series_id")
    return df.select("series_id", "event_id", _r("SMA_50", 6))


def q_sma_metrics(spark, sf_dir):
    idx = S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)
    df = S.rolling_mean(idx, "series_id", "close", [20])
    m = ST.regression_metrics(df, "close", "SMA_20", "series_id")
    return m.select("series_id", "n", *[_r(c, 6) for c in ("mse", "rmse", "mae", "r2")])


def q_bar_poly(spark, sf_dir):
    """Degree-2 polynomial terms of (open, close) in Spark's PolynomialExpansion order (K3)."""
    from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    bar = Roles(spark, sf_dir).bar()
    v = VectorAssembler(inputCols=["open", "close"], outputCol="v").transform(bar)
    p = PolynomialExpansion(degree=2, inputCol="v", outputCol="p").transform(v)
    arr = vector_to_array("p")
    return p.select("series_id", F.col("date").cast("string").alias("date"),
                    *[F.round(arr[i], 9).alias(f"p_{i}") for i in range(5)])


# ---------------------------------------------------------------- oracle text

def _quantiles(expr: str) -> str:
    return ", ".join(f"round(quantile_cont({expr}, {q}), 6) as {n}"
                     for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))


_BOX = """
with q as (select series_id, quantile_cont(close, 0.25) as q1, quantile_cont(close, 0.5) as median,
                  quantile_cont(close, 0.75) as q3 from v_tick group by series_id),
x as (select t.series_id, t.close, q.q1, q.median, q.q3, q.q3 - q.q1 as iqr from v_tick t join q using (series_id))
select series_id, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, round(iqr, 6) as iqr,
       round(min(case when close >= q1 - 1.5 * iqr then close end), 6) as whisker_low,
       round(max(case when close <= q3 + 1.5 * iqr then close end), 6) as whisker_high,
       cast(count_if(close < q1 - 1.5 * iqr or close > q3 + 1.5 * iqr) as bigint) as n_outliers
from x group by series_id, q1, median, q3, iqr"""

_HIST = f"""
with r as (select series_id, min(close) as lo, max(close) as hi, count(*) as n from v_tick group by series_id),
e as (select r.series_id, unnest(range(1, {BINS})) as i, r.lo, (r.hi - r.lo) / {BINS} as width from r where r.hi > r.lo),
b as (select t.series_id, 1 + cast((select count(*) from e where e.series_id = t.series_id
                                    and t.close >= e.lo + e.i * e.width) as integer) as bin
      from v_tick t where t.close is not null),
c as (select series_id, bin, count(*) as cnt from b group by series_id, bin),
g as (select r.*, cast(unnest(range(1, {BINS} + 1)) as integer) as bin from r)
select g.series_id, g.bin, round(g.lo + (g.bin - 1) * ((g.hi - g.lo) / {BINS}), 6) as bin_low,
       round(g.lo + g.bin * ((g.hi - g.lo) / {BINS}), 6) as bin_high,
       coalesce(c.cnt, 0) as count,
       round(cast(coalesce(c.cnt, 0) as double) / (g.n * ((g.hi - g.lo) / {BINS})), 9) as density
from g left join c on c.series_id = g.series_id and c.bin = g.bin"""

_W = "partition by series_id order by ts, event_id"

QUERIES = {
    "tick_describe": q_tick_describe,
    "orders_describe": q_orders_describe,
    "tick_box": q_tick_box,
    "tick_histogram": q_tick_histogram,
    "tick_normal_fit": q_tick_normal_fit,
    "tick_normal_curve": q_tick_normal_curve,
    "bar_corr": q_bar_corr,
    "priority_mean_std": q_priority_mean_std,
    "tick_zscore": q_tick_zscore,
    "tick_minmax": q_tick_minmax,
    "priority_anova": q_priority_anova,
    "tick_regr_impute": q_tick_regr_impute,
    "tick_mean_impute": q_tick_mean_impute,
    "sma_metrics": q_sma_metrics,
    "bar_poly": q_bar_poly,
}

ORACLE = {
    "tick_describe": with_views(["v_tick"], f"""
select series_id, count(close) as count, round(avg(close), 6) as mean, round(stddev_samp(close), 6) as std,
       round(min(close), 6) as min, {_quantiles("close")}, round(max(close), 6) as max
from v_tick group by series_id"""),
    "orders_describe": """
select o_orderpriority, count(o_totalprice) as count, round(avg(o_totalprice), 4) as mean,
       round(stddev_samp(o_totalprice), 4) as std, round(min(o_totalprice), 4) as min,
       """ + ", ".join(f"round(quantile_cont(o_totalprice, {q}), 4) as {n}"
                       for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))) + """,
       round(max(o_totalprice), 4) as max
from orders group by o_orderpriority""",
    "tick_box": with_views(["v_tick"], _BOX),
    "tick_histogram": with_views(["v_tick"], _HIST),
    "tick_normal_fit": with_views(["v_tick"], """
select series_id, round(avg(close), 6) as mu, round(stddev_pop(close), 6) as sigma,
       round(1.0 / (stddev_pop(close) * sqrt(2 * pi())), 9) as pdf_at_mu
from v_tick group by series_id"""),
    "tick_normal_curve": with_views(["v_tick"], """
with st as (select series_id, min(close) as lo, max(close) as hi, avg(close) as mu, stddev_pop(close) as sd
            from v_tick group by series_id),
g as (select st.*, cast(unnest(range(0, 100)) as integer) as i from st),
p as (select series_id, i, lo + i * ((hi - lo) / 99) as x, mu, sd from g)
select series_id, i, round(x, 9) as x,
       round(exp(-0.5 * ((x - mu) / sd) * ((x - mu) / sd)) / (sd * sqrt(2 * pi())), 12) as pdf
from p"""),
    "bar_corr": with_views(["v_bar"], " union all ".join(
        f"select '{a}' as var_a, '{b}' as var_b, round(corr(cast({a} as double), cast({b} as double)), 9) as r from v_bar"
        for a in ("open", "high", "low", "close", "volume") for b in ("open", "high", "low", "close", "volume"))),
    "priority_mean_std": """
select o_orderpriority, round(avg(o_totalprice), 4) as o_totalprice_mean,
       round(stddev_samp(o_totalprice), 4) as o_totalprice_std
from orders group by o_orderpriority""",
    "tick_zscore": with_views(["v_tick"], """
select series_id, event_id,
       round((close - avg(close) over (partition by series_id))
             / nullif(stddev_pop(close) over (partition by series_id), 0), 9) as close_z
from v_tick"""),
    "tick_minmax": with_views(["v_tick"], """
select series_id, event_id,
       (close - min(close) over (partition by series_id))
       / nullif(max(close) over (partition by series_id) - min(close) over (partition by series_id), 0)
       as close_scaled
from v_tick"""),
    "priority_anova": """
with g as (select o_orderpriority, count(*) as n, avg(o_totalprice) as m from orders group by 1),
w as (select sum((o.o_totalprice - g.m) * (o.o_totalprice - g.m)) as ssw from orders o join g using (o_orderpriority)),
t as (select sum(n) as nn, count(*) as k, sum(n * m) / sum(n) as grand from g),
b as (select sum(g.n * (g.m - t.grand) * (g.m - t.grand)) as ssb from g, t)
select round(b.ssb / (t.k - 1) / (w.ssw / (t.nn - t.k)), 6) as f_stat,
       cast(t.k - 1 as integer) as df_between, cast(t.nn - t.k as integer) as df_within
from b, t, w""",
    "tick_regr_impute": with_views(["v_tick"], f"""
with l as (select series_id, event_id, close, lag(close, {IMPUTE_LAG}) over ({_W}) as y from v_tick),
f as (select series_id, regr_slope(y, close) as b, regr_intercept(y, close) as a from l group by series_id)
select series_id, event_id, round(coalesce(y, a + b * close), 6) as close_lag_{IMPUTE_LAG}
from l join f using (series_id)"""),
    "tick_mean_impute": with_views(["v_tick"], f"""
with s as (select series_id, event_id,
                  case when count(close) over ({_W} rows between 49 preceding and current row) = 50
                       then avg(close) over ({_W} rows between 49 preceding and current row) end as sma
           from v_tick)
select series_id, event_id, round(coalesce(sma, avg(sma) over (partition by series_id)), 6) as SMA_50 from s"""),
    "sma_metrics": with_views(["v_tick"], f"""
with s as (select series_id, close,
                  case when count(close) over ({_W} rows between 19 preceding and current row) = 20
                       then avg(close) over ({_W} rows between 19 preceding and current row) end as yhat
           from v_tick),
x as (select *, avg(close) over (partition by series_id) as ybar from s where yhat is not null)
select series_id, count(*) as n, round(avg((close - yhat) * (close - yhat)), 6) as mse,
       round(sqrt(avg((close - yhat) * (close - yhat))), 6) as rmse, round(avg(abs(close - yhat)), 6) as mae,
       round(1 - sum((close - yhat) * (close - yhat)) / sum((close - ybar) * (close - ybar)), 6) as r2
from x group by series_id"""),
    "bar_poly": with_views(["v_bar"], """
select series_id, cast(date as varchar) as date, round(open, 9) as p_0, round(open * open, 9) as p_1,
       round(close, 9) as p_2, round(open * close, 9) as p_3, round(close * close, 9) as p_4 from v_bar"""),
}
