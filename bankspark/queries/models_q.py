"""Model queries (K4-K10, K15, K17, K19-K22, K24).  The seeds and rounds of k-means and the normal equations of the lag
model are written out in SQL; the forests and Spark's k-means on vectors have none and are checked in tests."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bankspark.operators import models as MD
from bankspark.operators import series as S
from bankspark.operators import stats as ST
from bankspark.plans import cycle as CY
from bankspark.plans import market as M
from bankspark.plans import price_model as PM
from bankspark.queries import market_q
from bankspark.queries.common import portable
from bankspark.queries.oracle_views import with_views
from bankspark.sources.roles import Roles

ORDER = ["ts", "event_id"]
EMB_K = 10


def _macro(spark, sf_dir):
    return M.macro_wide(Roles(spark, sf_dir).macro_long())


def _yearly_close(spark, sf_dir):
    from bankspark.queries.market_q import _prices
    return M.yearly_last(_prices(spark, sf_dir), "Close", "Date", "row_id")


def _r(name, digits=9):
    return F.round(name, digits).alias(name)


Z = ["GDP_z", "Inflation_z", "Unemployment_rate_z"]


def q_macro_stages(spark, sf_dir):
    stages, _, _ = CY.economic_stages(_macro(spark, sf_dir))
    return stages.select("Year", *map(_r, Z), "cluster", "Stage")


def q_macro_elbow(spark, sf_dir):
    pts = MD.elbow(CY.macro_zscores(_macro(spark, sf_dir)).select("Year", *Z), Z, "Year")
    return spark.createDataFrame(pts, "k int, inertia double").select("k", _r("inertia"))


def q_macro_cluster_quality(spark, sf_dir):
    stages, inertia, _ = CY.economic_stages(_macro(spark, sf_dir))
    lab = MD.assemble(stages, Z)
    row = (round(inertia, 9), round(MD.silhouette_sq_euclidean(lab), 9), round(MD.davies_bouldin(lab, Z), 9))
    return spark.createDataFrame([row], "inertia double, silhouette_sq_euclidean double, davies_bouldin double")


def q_embedding_clusters(spark, sf_dir):
    emb = Roles(spark, sf_dir).t("embeddings")
    points = emb.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    lab, _, cost = MD.kmeans_canonical(points, None, EMB_K, 42)
    return (lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                       F.countDistinct("label").alias("n_labels"))
            .withColumn("inertia", F.lit(cost)))


def q_stage_close(spark, sf_dir):
    stages, _, _ = CY.economic_stages(_macro(spark, sf_dir))
    _, per_stage, test = CY.stage_close(stages, _yearly_close(spark, sf_dir))
    f = round(test["f_stat"], 6)
    p = ST.f_sf(f, test["df_between"], test["df_within"])  # of the reported F
    return per_stage.select("Stage", *[_r(c, 6) for c in per_stage.columns if c != "Stage"], F.lit(f).alias("f_stat"),
                            F.lit(round(p, 9)).alias("p_value"), F.lit(test["reject_h0"]).alias("reject_h0"))


def q_stage_macro_stats(spark, sf_dir):
    stages, _, _ = CY.economic_stages(_macro(spark, sf_dir))
    found = CY.stage_macro_stats(stages)
    return found.select("Stage", "variable", "n", "n_outliers", *[_r(c, 4) for c in (
        "mean", "std", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high")])


def _features(spark, sf_dir):
    ev = Roles(spark, sf_dir).t("events").select(
        F.col("event_type").alias("series_id"), "ts", "event_id", F.col("value").alias("close"),
        F.col("user_id").cast("double").alias("user_id"))
    idx = S.with_index(ev, "series_id", ORDER)
    return PM.feature_table(idx, "series_id", "close", ["close", "user_id"])


def _fit(spark, sf_dir, trees, depth, leaf):
    feats, cols = _features(spark, sf_dir)
    return PM.forest_scores(feats, cols, "close", "event_id", trees, depth, leaf, keep=["series_id", "ts"])


def _forest(spark, sf_dir, trees, depth, leaf):
    _, rows = _fit(spark, sf_dir, trees, depth, leaf)
    return spark.createDataFrame(rows, "part string, n long, mse double, rmse double, mae double, r2 double")


def q_rf_metrics(spark, sf_dir):
    return _forest(spark, sf_dir, 150, 30, 4)


def q_rf_refit_metrics(spark, sf_dir):
    return _forest(spark, sf_dir, 200, 20, 1)


def q_rf_smoothed(spark, sf_dir):
    pred, _ = _fit(spark, sf_dir, 200, 20, 1)
    out = PM.smooth_predictions(pred, "series_id", ORDER, "ts")
    return portable(out.select("series_id", "event_id", "shown_at", "prediction", "pred_ema_10", "pred_sma_20"))


def q_lag_forecast(spark, sf_dir):
    idx = S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)
    return PM.lag_forecast(idx, "series_id", "close").select(
        "series_id", F.col("step").cast("int").alias("step"), F.round("forecast", 6).alias("forecast"))


QUERIES = {
    "macro_stages": q_macro_stages,
    "macro_elbow": q_macro_elbow,
    "macro_cluster_quality": q_macro_cluster_quality,
    "embedding_clusters": q_embedding_clusters,
    "stage_close": q_stage_close,
    "stage_macro_stats": q_stage_macro_stats,
    "rf_metrics": q_rf_metrics,
    "rf_refit_metrics": q_rf_refit_metrics,
    "rf_smoothed": q_rf_smoothed,
    "lag_forecast": q_lag_forecast,
}

STEPS, HORIZON = 60, 10  # fixed values: window and horizon of the reference's forecast

#: The normal equations of all windows, solved by Gauss-Jordan steps on lists, then the recursion step by step.
_LAG_FORECAST = f"""
with recursive p as materialized (
  select series_id, close, row_number() over w - 1 as pos, count(*) over (partition by series_id) as len
  from v_tick window w as (partition by series_id order by ts, event_id)),
f as (select series_id, min(close) as lo, max(close) as hi from p where pos < (len * 4) // 5 group by series_id),
y as materialized (select series_id, pos, len, (close - lo) / (hi - lo) as y from p join f using (series_id)),
x as materialized (
  select a.series_id, a.pos as t, k.i, b.y as v
  from y a, (select unnest(range(0, {STEPS + 1})) as i) k, y b
  where a.pos >= {STEPS} and a.pos < (a.len * 4) // 5 and b.series_id = a.series_id and b.pos = a.pos - k.i
  union all
  select series_id, pos, {STEPS + 1}, 1.0 from y where pos >= {STEPS} and pos < (len * 4) // 5),
g as (select a.i as i, b.i as j, sum(a.v * b.v) as s from x a join x b on a.series_id = b.series_id and a.t = b.t
      where a.i > 0 group by a.i, b.i),
solve as (
  select 1 as k, list(r order by i) as m from (select i, list(s order by j = 0, j) as r from g group by i)
  union all
  select k + 1, list_transform(m, lambda r, i: case
    when i = k then list_transform(r, lambda v: v / m[k][k])
    else list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) end)
  from solve where k <= {STEPS + 1}),
c as materialized (select list_reverse(list_transform(m[1:{STEPS}], lambda r: r[{STEPS + 2}])) as b, m[{STEPS + 1}][{STEPS + 2}] as a
      from solve where k = {STEPS + 2}),
r as (
  select series_id, 1 as step, list(y order by pos) as w from y where pos >= len - 1 - {STEPS} and pos < len - 1 group by series_id
  union all
  select series_id, step + 1, list_append(w[2:], a + list_dot_product(w, b)) from r, c where step <= {HORIZON})
select series_id, cast(step - 1 as integer) as step, round(w[{STEPS}] * (hi - lo) + lo, 6) as forecast
from r join f using (series_id) where step > 1"""

_GAP = "(x[1] - c[1]) * (x[1] - c[1]) + (x[2] - c[2]) * (x[2] - c[2]) + (x[3] - c[3]) * (x[3] - c[3])"
_ROUNDS = 50  # more than any k needs to stand still on a calendar of years


def _clusters_sql(select: str, more: str = "") -> str:
    """Farthest-first seeds and k-means rounds for k = 1..10 over the list of points; km has the centres of each k."""
    return with_views(["v_price_text", "v_macro_long"], f"""
with recursive mw as ({market_q._MACRO_WIDE}),
z as materialized (select "Year", {", ".join(f'("{c[:-2]}" - avg("{c[:-2]}") over ()) / stddev_pop("{c[:-2]}") over () as "{c}"' for c in Z)} from mw),
pts as materialized (select list([{", ".join(f'"{c}"' for c in Z)}] order by "Year") as p, [{", ".join(f'avg("{c}")' for c in Z)}] as mean from z),
seed as (
  select 1 as n, [p[list_position(d, list_max(d))]] as cs from (select p, list_transform(p, lambda x: list_min(list_transform([mean], lambda c: {_GAP}))) as d from pts)
  union all
  select n + 1, list_append(cs, p[list_position(d, list_max(d))])
  from (select n, cs, p, list_transform(p, lambda x: list_min(list_transform(cs, lambda c: {_GAP}))) as d from seed, pts)
  where n < 10 and list_max(d) > 0),
lloyd as (
  select 0 as it, k, (select arg_max(cs, n) from seed)[1:k] as cs from (select unnest(range(1, 11)) as k)
  union all
  select it + 1, k, list_transform(cs, lambda c, j: case when len(list_filter(a, lambda v: v = j)) = 0 then c else [
      list_avg(list_transform(list_filter(p, lambda x, i: a[i] = j), lambda x: x[1])),
      list_avg(list_transform(list_filter(p, lambda x, i: a[i] = j), lambda x: x[2])),
      list_avg(list_transform(list_filter(p, lambda x, i: a[i] = j), lambda x: x[3]))] end)
  from (select it, k, cs, p, list_transform(p, lambda x: list_position(list_transform(cs, lambda c: {_GAP}),
               list_min(list_transform(cs, lambda c: {_GAP})))) as a from lloyd, pts where it < {_ROUNDS})),
km as materialized (select k, list_sort(cs) as cs from lloyd where it = {_ROUNDS}),
st as materialized (
  select *, ['Trough', 'Recovery', 'Peak', 'Recession'][cluster + 1] as "Stage"
  from (select z.*, [{", ".join(f'"{c}"' for c in Z)}] as x, cast(list_position(list_transform(cs, lambda c: list_distance([{", ".join(f'"{c}"' for c in Z)}], c)),
               list_min(list_transform(cs, lambda c: list_distance([{", ".join(f'"{c}"' for c in Z)}], c)))) - 1 as integer) as cluster
        from z, km where k = 4)){more}
{select}""")


_YEAR_CLOSE = market_q.ORACLE["yearly_last_close"].replace("\n", " ")
_BOXES = ", ".join(f"quantile_cont(v, {q}) as {n}" for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))

ORACLE: dict[str, str] = {
    "lag_forecast": with_views(["v_tick"], _LAG_FORECAST),
    "macro_stages": _clusters_sql('select "Year", ' + ", ".join(f'round("{c}", 9) as "{c}"' for c in Z) + ', cluster, "Stage" from st'),
    "macro_elbow": _clusters_sql(f"""
select cast(k as integer) as k, round(list_sum(list_transform(p, lambda x: list_min(list_transform(cs, lambda c: {_GAP})))), 9) as inertia
from km, pts"""),
    "macro_cluster_quality": _clusters_sql("""
select round((select sum(own * own) from near), 9) as inertia,
       round((select avg(case when n = 1 then 0 else (b - a * n / (n - 1)) / greatest(b, a * n / (n - 1)) end) from sil), 9) as silhouette_sq_euclidean,
       round((select avg(worst) from db), 9) as davies_bouldin""", f""",
cen as (select cluster, [{", ".join(f'avg("{c}")' for c in Z)}] as c, count(*) as n from st group by cluster),
near as (select st."Year", cluster, list_distance(x, c) as own from st join cen using (cluster)),
pair as (select a."Year", a.cluster as own, b.cluster as other, avg(pow(list_distance(a.x, b.x), 2)) as d, count(*) as n
         from st a, st b group by all),
sil as (select "Year", any_value(n) filter (own = other) as n, any_value(d) filter (own = other) as a, min(d) filter (own <> other) as b
        from pair group by "Year"),
sc as (select cluster, avg(own) as s from near group by cluster),
db as (select max((sa.s + sb.s) / list_distance(a.c, b.c)) as worst from cen a join cen b on a.cluster <> b.cluster
       join sc sa on sa.cluster = a.cluster join sc sb on sb.cluster = b.cluster group by a.cluster)"""),
    "stage_close": _clusters_sql("""
select "Stage", round(avg("Close"), 6) as "Close_mean", round(stddev_samp("Close"), 6) as "Close_std", round(avg(pct), 6) as "Close_pct_mean",
       round(stddev_samp(pct), 6) as "Close_pct_std", any_value(f) as f_stat, round(any_value(p), 9) as p_value, any_value(p) < 0.05 as reject_h0
from j, t where df1 = 3 and df2 = 3 group by "Stage\"""", f""",
yc as ({_YEAR_CLOSE}),
j as (select *, ("Close" - lag("Close") over (order by "Year")) / nullif(lag("Close") over (order by "Year"), 0) * 100 as pct
      from st left join yc using ("Year")),
a as (select count("Close") as n, avg("Close") as m, var_pop("Close") * count("Close") as ss from j where "Close" is not null group by "Stage"),
f as (select round(sum(n * pow(m - g, 2)) / (count(*) - 1) / (sum(ss) / (sum(n) - count(*))), 6) as f, count(*) - 1 as df1, sum(n) - count(*) as df2
      from a, (select sum(n * m) / sum(n) as g from a)),
t as (select *, 8 / pi() * ((2 * x - 1) * sqrt(x * (1 - x)) / 4 + asin(2 * x - 1) / 8 + pi() / 16) as p
      from (select *, 1 / (1 + f) as x from f))"""),
    "stage_macro_stats": _clusters_sql(f"""
select "Stage", variable, count(*) as n, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as std, round(any_value(q1), 4) as q1,
       round(any_value(median), 4) as median, round(any_value(q3), 4) as q3, round(any_value(q3 - q1), 4) as iqr,
       round(min(v) filter (v >= q1 - 1.5 * (q3 - q1)), 4) as whisker_low, round(max(v) filter (v <= q3 + 1.5 * (q3 - q1)), 4) as whisker_high,
       count(*) filter (v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as n_outliers
from long join bx using ("Stage", variable) group by "Stage", variable""", f""",
long as ({" union all ".join(f"select 'S' as tag, st.\"Stage\", '{c[:-2]}' as variable, cast(mw.\"{c[:-2]}\" as double) as v from st join mw on mw.\"Year\" = st.\"Year\"" for c in Z)}),
bx as (select "Stage", variable, {_BOXES} from long group by all)"""),
}
