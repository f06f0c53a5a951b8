"""Queries that go through files (A1, A2, A5-A7), the whole monthly report (J16, M2), and model steps that SQL can
follow on given labels (K6-K8, K10, K15, K22, K24, B10)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bankspark.functions.scalars import default_month
from bankspark.operators import forest_grid as FG
from bankspark.operators import models as MD
from bankspark.operators import series as S
from bankspark.operators import stats as ST
from bankspark.plans import cycle as CY
from bankspark.plans import market as M
from bankspark.plans import price_model as PM
from bankspark.plans import report as rp
from bankspark.queries import market_q, report_q, stats_q
from bankspark.queries.common import portable
from bankspark.queries.oracle_views import with_views
from bankspark.session import ensure_checkpoint_dir
from bankspark.sources import sinks
from bankspark.sources.roles import Roles
from bankspark.sources.text import PRICE_HEADER_MAP, read_price_csv, read_sheet

ORDER = ["ts", "event_id"]
REMOVED_YEAR, BEFORE_YEAR = 1995, 1998


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/bankspark-{name}-{uuid.uuid4().hex}"


def q_price_csv_scan(spark, sf_dir):
    """A1: the price table as a CSV export with the original's headers, read as text and cleaned."""
    local = {v: k for k, v in PRICE_HEADER_MAP.items()}
    text = Roles(spark, sf_dir).price_text()
    export = text.select(*[F.col(c).alias(local[n]) for n, c in (
        ("Date", "date_text"), ("Close", "close_text"))], F.col("row_id").cast("string").alias(local["Open"]),
        F.lit("").alias(local["High"]), F.lit("").alias(local["Low"]), F.col("volume_text").alias(local["Volume"]),
        F.col("change_text").alias(local["Change %"]))
    path = _scratch(spark, "csv")
    export.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    clean = M.clean_prices(read_price_csv(spark, path))
    return portable(clean.select(F.col("Open").cast("bigint").alias("row_id"), "Date", "Close",
                                 F.col("Change %").alias("change_pct"), "Volume"))


def q_macro_sheet_scan(spark, sf_dir):
    """A2: the macro table as a workbook sheet exported to CSV, with one series that is not wanted."""
    long = Roles(spark, sf_dir).macro_long()
    years = sorted(r[0] for r in long.select("year").distinct().collect())
    other = long.filter("series_name = 'GDP'").withColumn("series_name", F.lit("Not wanted"))
    path = _scratch(spark, "sheet")
    M.years_to_columns(long.unionByName(other), years).write.option("header", True).csv(path)
    return M.sheet_to_long(read_sheet(spark, path), list(M.MACRO_NAMES)).select(
        F.col("Series Name").alias("series_name"), F.col("Year").alias("year"), F.col("Value").alias("value"))


def q_sink_days(spark, sf_dir):
    """Load two days anew, append a third, replace the second by half of its rows and the third by none."""
    rows = Roles(spark, sf_dir).t("orders").select(
        (F.lit(2023000) + F.col("o_orderkey") % 3).cast("int").alias("day_key"), "o_orderkey",
        F.floor("o_totalprice").cast("bigint").alias("amount"))
    path = _scratch(spark, "days")
    sinks.overwrite(rows, path, ["day_key"])
    sinks.overwrite(rows.filter("day_key < 2023002"), path, ["day_key"])
    sinks.append(rows.filter("day_key = 2023002"), path, ["day_key"])
    sinks.replace_day(rows.filter("o_orderkey % 2 = 0"), path, 2023001)
    sinks.replace_day(rows.filter("false"), path, 2023002)
    back = spark.read.parquet(path)
    return back.groupBy("day_key").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def _monthly(table, *columns):
    """A query of one table of the whole report job, with area columns taken from the area dimension; the
    month is the default of a run in it (I4)."""
    def query(spark, sf_dir):
        r = Roles(spark, sf_dir)
        month = default_month(dt.date(report_q.YEAR, report_q.MONTH, 28))
        out = rp.monthly_report(spark, r.gl(), r.loan_kpi(), r.city(), r.area(), r.sales_kpi(), month, report_q.YEAR)[table]
        return portable(out.select(*columns) if columns else out)

    return query


#: query: (table of the job, query of the same rows step by step, columns if not all)
MONTHLY = {
    "monthly_report": ("detail", "report_detail"),
    "monthly_npl": ("npl", "npl_by_area", "area_code", "rate", "du_no"),
    "monthly_debt_groups": ("debt_groups", "debt_groups"),
    "monthly_head": ("head", "head_values"),
    "monthly_measures": ("measure", "area_measures"),
    "monthly_wide": ("report", "report_wide"),
    "monthly_scorecard": ("scorecard", "scorecard"),
}


def q_npl_with_gaps(spark, sf_dir):
    """J6 where a written-off loan has no outstanding amount."""
    r = Roles(spark, sf_dir)
    kpi = r.loan_kpi().withColumn("outstanding_principal", F.when(F.col("write_off_month").isNull(),
                                                                  F.col("outstanding_principal")))
    return portable(rp.npl_by_area(kpi, r.city(), r.area(), report_q.MONTH, report_q.YEAR)
                    .select("area_code", "rate", "du_no"))


def q_priority_anova_test(spark, sf_dir):
    t = ST.anova_test(Roles(spark, sf_dir).t("orders"), "o_totalprice", "o_orderpriority")
    f = round(t["f_stat"], 6)
    p = round(ST.f_sf(f, t["df_between"], t["df_within"]), 9)  # of the reported F
    return spark.createDataFrame([(f, t["df_between"], t["df_within"], p, t["reject_h0"])],
                                 "f_stat double, df_between int, df_within int, p_value double, reject_h0 boolean")


def q_orders_hash_split(spark, sf_dir):
    return MD.hash_split(Roles(spark, sf_dir).t("orders").select("o_orderkey"), "o_orderkey")


def q_label_cluster_quality(spark, sf_dir):
    """K6-K8 on the given labels of the embeddings: inertia, squared-Euclidean silhouette, Davies-Bouldin index."""
    emb = Roles(spark, sf_dir).t("embeddings").select(
        "label", F.col("embedding").cast("array<double>").alias("e")).filter("label is not null")
    points = emb.select("label", F.posexplode("e").alias("dim", "x"))
    spread = (points.groupBy("label", "dim").agg((F.var_pop("x") * F.count("x")).alias("s"))
              .agg(F.sum("s").alias("inertia")).first()["inertia"])
    silhouette = MD.silhouette_sq_euclidean(emb.select("label", array_to_vector("e").alias("features")), "label")
    row = (round(spread, 4), round(silhouette, 6), round(MD.davies_bouldin_arrays(emb, "e", "label"), 6))
    return spark.createDataFrame([row], "inertia double, silhouette_sq_euclidean double, davies_bouldin double")


def q_lag1_forecast(spark, sf_dir):
    """K22 with one lag: min-max scaling fitted on the training part, a linear model, ten recursive steps."""
    idx = S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)
    return PM.lag_forecast(idx, "series_id", "close", steps_back=1).select(
        "series_id", F.col("step").cast("int").alias("step"), F.round("forecast", 5).alias("forecast"))


def q_stage_close_fixed(spark, sf_dir):
    """K24, B10 on fixed stage labels (year modulo 3), with one outlier year removed."""
    yearly = market_q.q_yearly_last_close(spark, sf_dir)
    stages = yearly.select("Year", F.concat(F.lit("S"), (F.col("Year") % 3).cast("string")).alias("Stage"))
    _, per_stage, _ = CY.stage_close(stages, yearly.select("Year", "Close"), exclude_years=[REMOVED_YEAR])
    return per_stage.select("Stage", *[F.round(c, 6).alias(c) for c in per_stage.columns if c != "Stage"])


def q_macro_before(spark, sf_dir):
    """Z-scores over all years, only the years before a given one kept."""
    z = CY.macro_zscores(M.macro_wide(Roles(spark, sf_dir).macro_long()), before_year=BEFORE_YEAR)
    return z.select("Year", *[F.round(f"{c}_z", 9).alias(f"{c}_z") for c in CY.MACRO_COLS])


def q_rf_grid(spark, sf_dir):
    """The reference's whole grid, 108 combinations over 5 folds, on the features of the daily index."""
    macro, rates = M.macro_wide(Roles(spark, sf_dir).macro_long()), M.monthly_rate_table(market_q._rates(spark, sf_dir))
    table, features = PM.index_features(market_q._prices(spark, sf_dir).select("row_id", "Date", "Close"), macro, rates)
    train = MD.hash_split(table, "Date").filter("is_train")
    return FG.grid_scores(PM.forest_vectors(train, features, "Close", "Date"), "features", "Close", "Date")


_YEARLY = market_q.ORACLE["yearly_last_close"]
_ANOVA = stats_q.ORACLE["priority_anova"]

QUERIES = {
    "price_csv_scan": q_price_csv_scan,
    "macro_sheet_scan": q_macro_sheet_scan,
    "sink_days": q_sink_days,
    **{name: _monthly(table, *columns) for name, (table, _, *columns) in MONTHLY.items()},
    "npl_with_gaps": q_npl_with_gaps,
    "priority_anova_test": q_priority_anova_test,
    "orders_hash_split": q_orders_hash_split,
    "label_cluster_quality": q_label_cluster_quality,
    "lag1_forecast": q_lag1_forecast,
    "stage_close_fixed": q_stage_close_fixed,
    "macro_before": q_macro_before,
    "rf_grid": q_rf_grid,
}

ORACLE = {
    "price_csv_scan": market_q.ORACLE["price_clean"],
    "macro_sheet_scan": market_q.ORACLE["macro_reshape"],
    "sink_days": """
with o as (select cast(2023000 + o_orderkey % 3 as integer) as day_key, o_orderkey,
                  cast(floor(o_totalprice) as bigint) as amount from orders)
select day_key, count(*) as n, cast(sum(amount) as bigint) as amount from o
where day_key = 2023000 or (day_key = 2023001 and o_orderkey % 2 = 0) group by day_key""",
    **{name: report_q.ORACLE[same] for name, (_, same, *_) in MONTHLY.items()},
    "npl_with_gaps": with_views(["v_loan_kpi", "v_city", "v_area"], f"""
with k as (select c.area_code, kpi_month, write_off_month, max_bucket, write_off_balance_principal as wo,
                  case when write_off_month is null then outstanding_principal end as op
           from v_loan_kpi l join v_city c on l.pos_city = c.tinh),
m as (select unnest(range(1, {report_q.MONTH} + 1)) + {report_q.YEAR * 100} as month_key),
s as (select a.area_code,
        sum(coalesce((select sum(op) from k where k.area_code = a.area_code and kpi_month = month_key), 0)
          + coalesce((select sum(wo) from k where k.area_code = a.area_code
                      and write_off_month between {report_q.YEAR * 100 + 1} and month_key), 0)) as t,
        sum(coalesce((select sum(op) from k where k.area_code = a.area_code and kpi_month = month_key and max_bucket > 2), 0)
          + coalesce((select sum(wo) from k where k.area_code = a.area_code and max_bucket > 2
                      and write_off_month between {report_q.YEAR * 100 + 1} and month_key), 0)) as x
      from v_area a, m group by a.area_code)
select area_code, cast(x as double) / nullif(cast(t as double), 0) as rate, cast(t as double) / {float(report_q.MONTH)} as du_no
from s"""),
    # the upper tail of F with 4 and d degrees of freedom is I_z(d / 2, 2) = z^(d/2) (1 + d/2 (1 - z)), z = d / (d + 4 f)
    "priority_anova_test": f"""
with t as ({_ANOVA}),
p as (select *, df_within / (df_within + df_between * f_stat) as z, df_within / 2.0 as a from t)
select f_stat, df_between, df_within, round(pow(z, a) * (1 + a * (1 - z)), 9) as p_value,
       pow(z, a) * (1 + a * (1 - z)) < 0.05 as reject_h0 from p where df_between = 4""",
    "orders_hash_split": """
select o_orderkey, cast('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8) as bigint) % 100 < 80 as is_train
from orders""",
    "label_cluster_quality": """
with e as (select vec_id, label, generate_subscripts(embedding, 1) as dim, cast(unnest(embedding) as double) as x
           from embeddings where label is not null),
c as (select label, dim, avg(x) as m, count(*) as n from e group by label, dim),
d as (select e.vec_id, e.label, any_value(c.n) as n, sum((e.x - c.m) * (e.x - c.m)) as own from e join c using (label, dim)
      group by e.vec_id, e.label),
w as (select label, sum(own) / count(*) as within_ss, avg(sqrt(own)) as scatter from d group by label),
a as (select e.vec_id, c.label as other, sum((e.x - c.m) * (e.x - c.m)) as gap from e join c using (dim)
      group by e.vec_id, c.label),
far as (select a.vec_id, min(a.gap + w.within_ss) as b from a join w on w.label = a.other
        join (select distinct vec_id, label from e) o on o.vec_id = a.vec_id and o.label <> a.other group by a.vec_id),
near as (select d.vec_id, d.n, (d.own + w.within_ss) * d.n / nullif(d.n - 1, 0) as a from d join w using (label)),
s as (select avg(case when near.n = 1 then 0 else (far.b - near.a) / greatest(far.b, near.a) end) as silhouette
      from near join far using (vec_id)),
p as (select x.label, max((wx.scatter + wy.scatter) / sqrt(x.dist)) as worst
      from (select l.label, r.label as other, sum((l.m - r.m) * (l.m - r.m)) as dist
            from c l join c r on l.dim = r.dim and l.label <> r.label group by l.label, r.label) x
      join w wx on wx.label = x.label join w wy on wy.label = x.other group by x.label)
select round((select sum(own) from d), 4) as inertia, round((select silhouette from s), 6) as silhouette_sq_euclidean,
       round((select avg(worst) from p), 6) as davies_bouldin""",
    "lag1_forecast": with_views(["v_tick"], """
with recursive p as (select series_id, close, row_number() over w - 1 as pos, count(*) over (partition by series_id) as len
                     from v_tick window w as (partition by series_id order by ts, event_id)),
f as (select series_id, min(close) as lo, max(close) as hi from p where pos < floor(len * 4 / 5) group by series_id),
y as (select series_id, pos, len, (close - lo) / (hi - lo) as y from p join f using (series_id)),
l as (select *, lag(y) over (partition by series_id order by pos) as x from y),
m as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from l where x is not null and pos < floor(len * 4 / 5)),
r as (select series_id, 1 as step, a + b * x as y from l, m where pos = len - 1
      union all select series_id, step + 1, a + b * y from r, m where step < 10)
select series_id, cast(step as integer) as step, round(y * (hi - lo) + lo, 5) as forecast from r join f using (series_id)"""),
    "stage_close_fixed": f"""
with y as ({_YEARLY}),
p as (select "Year", "Close", ("Close" - lag("Close") over w) / lag("Close") over w * 100 as pct from y window w as (order by "Year")),
s as (select 'S' || cast("Year" % 3 as varchar) as "Stage", "Close", pct from p where "Year" <> {REMOVED_YEAR})
select "Stage", round(avg("Close"), 6) as "Close_mean", round(stddev_samp("Close"), 6) as "Close_std",
       round(avg(pct), 6) as "Close_pct_mean", round(stddev_samp(pct), 6) as "Close_pct_std" from s group by "Stage\"""",
    "macro_before": f"""
with w as ({market_q.ORACLE["macro_wide"]}),
s as (select {", ".join(f'avg("{c}") as m_{c}, stddev_pop("{c}") as d_{c}' for c in CY.MACRO_COLS)} from w)
select "Year", {", ".join(f'round(("{c}" - m_{c}) / d_{c}, 9) as "{c}_z"' for c in CY.MACRO_COLS)}
from w, s where "Year" < {BEFORE_YEAR}""",
}
