"""Queries for market-series and macro operators (A1, A9, B9-B11, B13, C7, C8, C11, D10, D13,
E4, E5, E7-E10, F1-F4, H3, H4, I7-I10, I13, I14, K11, K12, K16, K21, K23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankspark.operators import lagged as LG
from bankspark.operators import series as S
from bankspark.plans import market as M
from bankspark.queries.common import portable
from bankspark.queries.oracle_views import with_views
from bankspark.sources.roles import Roles

# fixed values: parameters of the reference notebook
LAGS = [1, 90, 180, 360]
CORR_LAGS = 600
SMA_WINDOWS = [20, 50, 100, 200]
EMA_SPANS = [50, 10]
RSI_WINDOW = 14
TIME_STEP = 60
LATEST_N = 60
ORDER = ["ts", "event_id"]


def _indexed(spark, sf_dir):
    return S.with_index(Roles(spark, sf_dir).tick(), "series_id", ORDER)


def q_tick_lags(spark, sf_dir):
    df = S.lags(_indexed(spark, sf_dir), "series_id", ["close"], LAGS)
    df = df.withColumn("pct_change", F.try_divide(F.col("close") - F.col("close_lag_1"),
                                                  F.col("close_lag_1")) * 100)
    return df.select("series_id", "event_id", "close", *[f"close_lag_{k}" for k in LAGS], "pct_change")


def q_tick_sma(spark, sf_dir):
    df = S.rolling_mean(_indexed(spark, sf_dir), "series_id", "close", SMA_WINDOWS)
    return df.select("series_id", "event_id", *[F.round(f"SMA_{n}", 6).alias(f"SMA_{n}") for n in SMA_WINDOWS])


def q_tick_ema(spark, sf_dir):
    idx = _indexed(spark, sf_dir)
    df = S.ewm_adjust_false(idx, "series_id", ["close"] * len(EMA_SPANS),
                            [2.0 / (s + 1) for s in EMA_SPANS], [f"EMA_{s}" for s in EMA_SPANS])
    return df.select("series_id", "event_id", *[F.round(f"EMA_{s}", 6).alias(f"EMA_{s}") for s in EMA_SPANS])


def q_tick_rsi(spark, sf_dir):
    df = S.rsi(_indexed(spark, sf_dir), "series_id", "close", RSI_WINDOW)
    return df.select("series_id", "event_id", F.round(f"RSI_{RSI_WINDOW}", 6).alias(f"RSI_{RSI_WINDOW}"))


def _gappy(tick):
    return tick.withColumn("close", F.when(F.col("event_id") % 7 != 0, F.col("close")))


def q_tick_ffill(spark, sf_dir):
    idx = S.with_index(_gappy(Roles(spark, sf_dir).tick()), "series_id", ORDER)
    return S.forward_fill(idx, "series_id", ["close"]).select(
        "series_id", "event_id", F.col("close").alias("close_filled"))


def q_tick_windows(spark, sf_dir):
    df = S.collect_lags(_indexed(spark, sf_dir), "series_id", "close", TIME_STEP)
    return df.select("series_id", "event_id", F.col("close").alias("y"),
                     *[F.col("x")[i].alias(f"x_{i + 1}") for i in range(TIME_STEP)])


def q_tick_latest(spark, sf_dir):
    return S.latest(Roles(spark, sf_dir).tick(), "series_id", ORDER, LATEST_N, "back").select(
        "series_id", "event_id", "close", "back")


def q_tick_split(spark, sf_dir):
    # int(len * 0.8) of the original, in exact integer arithmetic
    df = S.chrono_split(S.with_position(_indexed(spark, sf_dir), "series_id"))
    return df.select("series_id", "event_id", F.col("is_train").cast("int").alias("is_train"))


def q_tick_nested_split(spark, sf_dir):
    df = S.nested_chrono_split(S.with_position(_indexed(spark, sf_dir), "series_id"))
    return df.select("series_id", "event_id", F.col("subseq").cast("int").alias("subseq"),
                     F.col("is_train").cast("int").alias("is_train"))


def q_tick_dataset(spark, sf_dir):
    """create_dataset variant: 60 lags -> next value, the series' final target left out."""
    pos = S.with_position(_indexed(spark, sf_dir), "series_id")
    df = S.supervised_dataset(pos, "series_id", "close", TIME_STEP, keep_last=False)
    return df.select("series_id", "event_id", F.col("close").alias("y"),
                     F.col("x")[0].alias("x_first"), F.col("x")[TIME_STEP - 1].alias("x_last"))


def q_tick_smooth(spark, sf_dir):
    """K20 on a deterministic prediction (the 20-row SMA of the close): EMA(10) and SMA(20) of it
    in time order, shown 20 days earlier."""
    from bankspark.plans.price_model import smooth_predictions
    df = S.rolling_mean(_indexed(spark, sf_dir), "series_id", "close", [20], name="prediction").drop(S.G)
    out = smooth_predictions(df.select("series_id", "ts", "event_id", "prediction"), "series_id", ORDER, "ts")
    return portable(out.select("series_id", "event_id", "shown_at", F.round("pred_ema_10", 6).alias("pred_ema_10"),
                               F.round("pred_sma_20", 6).alias("pred_sma_20")))


def q_bar_tail(spark, sf_dir):
    return portable(Roles(spark, sf_dir).bar()
                    .orderBy(F.col("date").desc(), F.col("series_id").desc()).limit(10))


def q_lag_corr_scan(spark, sf_dir):
    """Correlation of the close with the close and the user number 1..600 rows before, per series."""
    ev = Roles(spark, sf_dir).t("events").select(
        F.col("event_type").alias("series_id"), "ts", "event_id", F.col("value").alias("close"),
        F.col("user_id").cast("double").alias("user_id"))
    idx = S.with_index(ev, "series_id", ORDER)
    return LG.lag_correlations(idx, "series_id", "close", ["close", "user_id"], CORR_LAGS).withColumn("r", F.round("r", 7))


def _prices(spark, sf_dir):
    raw = Roles(spark, sf_dir).price_text().withColumnsRenamed(
        {"date_text": "Date", "close_text": "Close", "change_text": "Change %", "volume_text": "Volume"})
    return M.clean_prices(raw).withColumnRenamed("Change %", "change_pct")


def q_price_clean(spark, sf_dir):
    return portable(_prices(spark, sf_dir))


def q_price_null_counts(spark, sf_dir):
    return M.null_counts(_prices(spark, sf_dir), ["Date", "Close", "change_pct", "Volume"])


def q_yearly_last_close(spark, sf_dir):
    return M.yearly_last(_prices(spark, sf_dir), "Close", "Date", "row_id")


def q_yearly_close_pct(spark, sf_dir):
    from bankspark.plans.cycle import yearly_pct_change
    y = M.yearly_last(_prices(spark, sf_dir), "Close", "Date", "row_id")
    return yearly_pct_change(y).select("Year", "Close", F.round("Close_pct", 9).alias("Close_pct"))


def q_index_compare(spark, sf_dir):
    bar = Roles(spark, sf_dir).bar()
    a = bar.filter(F.col("series_id") == "click")
    b = bar.filter(F.col("series_id") == "view")
    return portable(M.align_series(a, b, "date", "click_close", "view_close"))


def q_macro_wide(spark, sf_dir):
    return M.macro_wide(Roles(spark, sf_dir).macro_long())


def q_macro_reshape(spark, sf_dir):
    long = Roles(spark, sf_dir).macro_long()
    # the distinct years (a calendar-bounded handful) become the sheet's columns
    years = sorted(r[0] for r in long.select("year").distinct().collect())
    sheet = M.years_to_columns(long, years)
    return M.sheet_to_long(sheet, list(M.MACRO_NAMES)).select(
        F.col("Series Name").alias("series_name"), F.col("Year").alias("year"), F.col("Value").alias("value"))


def _rates(spark, sf_dir):
    li = Roles(spark, sf_dir).t("lineitem")
    return li.groupBy(F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Month")) \
        .agg((F.count(F.lit(1)).cast("double") / 1000).alias("Rate"))


def q_features_joined(spark, sf_dir):
    prices = _prices(spark, sf_dir).select("row_id", "Date", "Close")
    macro = M.macro_wide(Roles(spark, sf_dir).macro_long())
    rates = M.monthly_rate_table(_rates(spark, sf_dir))
    return portable(M.attach_macro_and_rate(prices, macro, rates))


MACRO_VARS = ["Rate", "Inflation", "GDP", "Unemployment_rate"]
FEATURE_LAG = 360


def _daily_indexed(spark, sf_dir):
    """Daily prices with macro and rate attached, as one date-ordered series."""
    prices = _prices(spark, sf_dir).select("row_id", "Date", "Close", F.lit("index").alias("series"))
    macro = M.macro_wide(Roles(spark, sf_dir).macro_long())
    rates = M.monthly_rate_table(_rates(spark, sf_dir))
    # indexed first: the sort then carries three columns and reads one table
    return M.attach_macro_and_rate(S.with_index(prices, "series", ["Date", "row_id"]), macro, rates)


def q_macro_lag_corr(spark, sf_dir):
    """Correlation of the close with each macro variable 1..600 rows before."""
    return (LG.lag_correlations(_daily_indexed(spark, sf_dir), "series", "Close", MACRO_VARS, CORR_LAGS)
            .select("variable", "lag", F.round("r", 7).alias("r")))


def q_macro_lag_features(spark, sf_dir):
    """Lag-360 copies of every variable but the close, gaps filled by a regression on the close."""
    from bankspark.operators.stats import regression_impute
    df = S.lags(_daily_indexed(spark, sf_dir), "series", MACRO_VARS, [FEATURE_LAG])
    cols = [f"{v}_lag_{FEATURE_LAG}" for v in MACRO_VARS]
    df = regression_impute(df, cols, "Close")
    return df.select("row_id", "Close", *[F.format_string("%.8e", c).cast("double").alias(c) for c in cols])  # 9 digits


# ---------------------------------------------------------------- oracle text

_W = "window w as (partition by series_id order by ts, event_id)"


def _ema_sql() -> str:
    a = [repr(2.0 / (s + 1)) for s in EMA_SPANS]
    b = [repr(1.0 - 2.0 / (s + 1)) for s in EMA_SPANS]
    cols0 = ", ".join(f"close as e{i}" for i in range(len(EMA_SPANS)))
    cols1 = ", ".join(f"cast('{a[i]}' as double) * t.close + cast('{b[i]}' as double) * r.e{i}"
                      for i in range(len(EMA_SPANS)))
    outs = ", ".join(f"round(e{i}, 6) as EMA_{s}" for i, s in enumerate(EMA_SPANS))
    return with_views(["v_tick"], f"""
with recursive t as (select series_id, event_id, close,
                            row_number() over (partition by series_id order by ts, event_id) as rn from v_tick),
r as (select series_id, rn, event_id, {cols0} from t where rn = 1
      union all
      select t.series_id, t.rn, t.event_id, {cols1}
      from r join t on t.series_id = r.series_id and t.rn = r.rn + 1)
select series_id, event_id, {outs} from r""")


def _smooth_sql() -> str:
    a, b = repr(2.0 / 11), repr(1.0 - 2.0 / 11)
    return with_views(["v_tick"], f"""
with recursive t as (
  select series_id, event_id, ts, rn,
         case when count(close) over (partition by series_id order by rn rows between 19 preceding and current row) = 20
              then avg(close) over (partition by series_id order by rn rows between 19 preceding and current row) end as p
  from (select *, row_number() over (partition by series_id order by ts, event_id) as rn from v_tick)),
r as (select series_id, rn, event_id, ts, p, p as e from t where rn = 1
      union all
      select t.series_id, t.rn, t.event_id, t.ts, t.p,
             case when t.p is null then r.e when r.e is null then t.p
                  else cast('{a}' as double) * t.p + cast('{b}' as double) * r.e end
      from r join t on t.series_id = r.series_id and t.rn = r.rn + 1)
select series_id, event_id, strftime(ts - interval 20 day, '%Y-%m-%d %H:%M:%S.%f') as shown_at,
       round(e, 6) as pred_ema_10,
       round(case when count(p) over (partition by series_id order by rn rows between 19 preceding and current row) = 20
                  then avg(p) over (partition by series_id order by rn rows between 19 preceding and current row) end, 6)
         as pred_sma_20
from r""")


def _rsi_sql() -> str:
    a, b = repr(1.0 / RSI_WINDOW), repr(1.0 - 1.0 / RSI_WINDOW)
    return with_views(["v_tick"], f"""
with recursive t as (select series_id, event_id, rn,
                            case when diff > 0 then diff else 0.0 end as up,
                            case when diff < 0 then -diff else 0.0 end as dn
                     from (select series_id, event_id,
                                  row_number() over (partition by series_id order by ts, event_id) as rn,
                                  close - lag(close) over (partition by series_id order by ts, event_id) as diff
                           from v_tick)),
r as (select series_id, rn, event_id, up as eu, dn as ed from t where rn = 1
      union all
      select t.series_id, t.rn, t.event_id,
             cast('{a}' as double) * t.up + cast('{b}' as double) * r.eu,
             cast('{a}' as double) * t.dn + cast('{b}' as double) * r.ed
      from r join t on t.series_id = r.series_id and t.rn = r.rn + 1)
select series_id, event_id,
       round(case when rn < {RSI_WINDOW} then null when ed = 0 then 100.0
                  else 100.0 - 100.0 / (1.0 + eu / ed) end, 6) as RSI_{RSI_WINDOW}
from r""")


def _lag_pairs_sql(variables, value: str, rows: str, by: str) -> str:
    """Correlations over all pairs of rows of ``rows`` (by, rn, columns) that lie 1..CORR_LAGS apart."""
    cells = ", ".join(f"corr(a.{value}, b.{v}) as r{i}" for i, v in enumerate(variables))
    parts = " union all ".join(f"select {by}, '{v}' as variable, lag, r{i} as r from c" for i, v in enumerate(variables))
    return f"""
c as (select a.{by}, k.lag, {cells}
      from {rows} a join (select cast(unnest(range(1, {CORR_LAGS + 1})) as integer) as lag) k on true
      left join {rows} b on b.{by} = a.{by} and b.rn = a.rn - k.lag group by a.{by}, k.lag),
u as ({parts})"""


def _corr_sql() -> str:
    return f"""
with l as materialized (select event_type as series_id, value as close, cast(user_id as double) as user_id,
           row_number() over (partition by event_type order by ts, event_id) as rn from events),
{_lag_pairs_sql(("close", "user_id"), "close", "l", "series_id")}
select series_id, variable, lag, round(r, 7) as r from u"""


_PRICE_CLEAN = """
select row_id, cast(strptime(date_text, '%d/%m/%Y') as date) as Date,
       try_cast(replace(close_text, ',', '') as double) as Close,
       try_cast(replace(replace(change_text, '%', ''), ',', '') as double) as change_pct,
       case when contains(v, 'M') then try_cast(replace(v, 'M', '') as double) * 1000000.0
            when contains(v, 'K') then try_cast(replace(v, 'K', '') as double) * 1000.0
            when contains(v, 'B') then try_cast(replace(v, 'B', '') as double) * 1000000000.0
            else try_cast(v as double) end as Volume
from (select *, replace(volume_text, ',', '') as v from v_price_text)"""

_MACRO_WIDE = """
select cast(year as integer) as Year,
       avg(case when series_name = 'GDP' then value end) as GDP,
       avg(case when series_name = 'Inflation' then value end) as Inflation,
       avg(case when series_name = 'Unemployment_rate' then value end) as Unemployment_rate
from v_macro_long group by year"""

QUERIES = {
    "tick_lags": q_tick_lags,
    "tick_sma": q_tick_sma,
    "tick_ema": q_tick_ema,
    "tick_rsi": q_tick_rsi,
    "tick_ffill": q_tick_ffill,
    "tick_windows": q_tick_windows,
    "tick_latest": q_tick_latest,
    "tick_split": q_tick_split,
    "tick_nested_split": q_tick_nested_split,
    "tick_dataset": q_tick_dataset,
    "tick_smooth": q_tick_smooth,
    "bar_tail": q_bar_tail,
    "lag_corr_scan": q_lag_corr_scan,
    "price_clean": q_price_clean,
    "price_null_counts": q_price_null_counts,
    "yearly_last_close": q_yearly_last_close,
    "yearly_close_pct": q_yearly_close_pct,
    "index_compare": q_index_compare,
    "macro_wide": q_macro_wide,
    "macro_reshape": q_macro_reshape,
    "features_joined": q_features_joined,
    "macro_lag_corr": q_macro_lag_corr,
    "macro_lag_features": q_macro_lag_features,
}

_DAILY = f"""
select p.row_id, p.Date, p.Close, m.GDP, m.Inflation, m.Unemployment_rate, r.Rate
from ({_PRICE_CLEAN}) p
left join ({_MACRO_WIDE}) m on m.Year = year(p.Date)
left join (select year(l_shipdate) as y, month(l_shipdate) as mo, cast(count(*) as double) / 1000 as Rate
           from lineitem group by 1, 2) r on r.y = year(p.Date) and r.mo = month(p.Date)"""


def _macro_lag_corr_sql() -> str:
    return with_views(["v_price_text", "v_macro_long"], f"""
with d as ({_DAILY}),
l as materialized (select *, 0 as one, row_number() over (order by Date, row_id) as rn from d),
{_lag_pairs_sql(MACRO_VARS, "Close", "l", "one")}
select variable, lag, round(r, 7) as r from u""")


def _macro_lag_features_sql() -> str:
    lags = ", ".join(f"lag({v}, {FEATURE_LAG}) over w as {v}_lag_{FEATURE_LAG}" for v in MACRO_VARS)
    fits = ", ".join(f"regr_slope({v}_lag_{FEATURE_LAG}, Close) as b_{v}, regr_intercept({v}_lag_{FEATURE_LAG}, Close) as a_{v}"
                     for v in MACRO_VARS)
    outs = ", ".join(f"cast(printf('%.8e', coalesce({v}_lag_{FEATURE_LAG}, a_{v} + b_{v} * Close)) as double) as {v}_lag_{FEATURE_LAG}"
                     for v in MACRO_VARS)
    return with_views(["v_price_text", "v_macro_long"], f"""
with d as ({_DAILY}),
l as (select row_id, Close, {lags} from d window w as (order by Date, row_id)),
f as (select {fits} from l)
select row_id, Close, {outs} from l, f""")


ORACLE = {
    "tick_lags": with_views(["v_tick"], f"""
select series_id, event_id, close, {", ".join(f"lag(close, {k}) over w as close_lag_{k}" for k in LAGS)},
       (close - lag(close, 1) over w) / nullif(lag(close, 1) over w, 0) * 100 as pct_change
from v_tick {_W}"""),
    "tick_sma": with_views(["v_tick"], "select series_id, event_id, " + ", ".join(
        f"case when count(close) over (partition by series_id order by ts, event_id rows between {n - 1} preceding "
        f"and current row) = {n} then round(avg(close) over (partition by series_id order by ts, event_id rows "
        f"between {n - 1} preceding and current row), 6) end as SMA_{n}" for n in SMA_WINDOWS) + " from v_tick"),
    "tick_ema": _ema_sql(),
    "tick_rsi": _rsi_sql(),
    "tick_smooth": _smooth_sql(),
    "tick_ffill": with_views(["v_tick"], """
select series_id, event_id,
       last_value(c ignore nulls) over (partition by series_id order by ts, event_id
                                        rows between unbounded preceding and current row) as close_filled
from (select *, case when event_id % 7 <> 0 then close end as c from v_tick)"""),
    "tick_windows": with_views(["v_tick"], "select * from (select series_id, event_id, close as y, "
                               + ", ".join(f"lag(close, {TIME_STEP - i}) over w as x_{i + 1}" for i in range(TIME_STEP))
                               + f" from v_tick {_W}) where x_1 is not null"),
    "tick_latest": with_views(["v_tick"], f"""
select series_id, event_id, close, cast(back as integer) as back from (
  select series_id, event_id, close,
         row_number() over (partition by series_id order by ts desc, event_id desc) as back from v_tick)
where back <= {LATEST_N}"""),
    "tick_split": with_views(["v_tick"], """
select series_id, event_id,
       cast(case when row_number() over w - 1 < (count(*) over (partition by series_id) * 4) // 5
            then 1 else 0 end as integer) as is_train
from v_tick window w as (partition by series_id order by ts, event_id)"""),
    "tick_nested_split": with_views(["v_tick"], """
with p as (select series_id, event_id, row_number() over (partition by series_id order by ts, event_id) - 1 as pos,
                  count(*) over (partition by series_id) as len from v_tick),
q as (select *, (len * 4) // 5 as cut from p)
select series_id, event_id, cast(case when pos < cut then 1 else 2 end as integer) as subseq,
       cast(case when pos < cut then (case when pos < (cut * 4) // 5 then 1 else 0 end)
                 else (case when pos - cut < ((len - cut) * 4) // 5 then 1 else 0 end) end as integer) as is_train
from q"""),
    "tick_dataset": with_views(["v_tick"], f"""
select series_id, event_id, y, x_first, x_last from (
  select series_id, event_id, close as y, lag(close, {TIME_STEP}) over w as x_first, lag(close, 1) over w as x_last,
         row_number() over w as rn, count(*) over (partition by series_id) as len
  from v_tick window w as (partition by series_id order by ts, event_id))
where rn > {TIME_STEP} and rn < len"""),
    "bar_tail": with_views(["v_bar"], """
select series_id, cast(date as varchar) as date, open, high, low, close, volume from v_bar
order by date desc, series_id desc limit 10"""),
    "lag_corr_scan": _corr_sql(),
    "price_clean": with_views(["v_price_text"], f"select row_id, cast(Date as varchar) as Date, Close, change_pct, Volume from ({_PRICE_CLEAN})"),
    "price_null_counts": with_views(["v_price_text"], f"""
select cast(count_if(Date is null) as bigint) as Date, cast(count_if(Close is null) as bigint) as Close,
       cast(count_if(change_pct is null) as bigint) as change_pct,
       cast(count_if(Volume is null) as bigint) as Volume from ({_PRICE_CLEAN})"""),
    "yearly_last_close": with_views(["v_price_text"], f"""
select cast(Year as integer) as Year, Close from (
  select year(Date) as Year, Close,
         row_number() over (partition by year(Date) order by Date desc, row_id desc) as k
  from ({_PRICE_CLEAN}) where Close is not null) where k = 1"""),
    "yearly_close_pct": with_views(["v_price_text"], f"""
select Year, Close, round((Close - lag(Close) over (order by Year)) / nullif(lag(Close) over (order by Year), 0) * 100, 9)
       as Close_pct
from (select cast(Year as integer) as Year, Close from (
        select year(Date) as Year, Close,
               row_number() over (partition by year(Date) order by Date desc, row_id desc) as k
        from ({_PRICE_CLEAN}) where Close is not null) where k = 1)"""),
    "index_compare": with_views(["v_bar"], """
select cast(coalesce(a.date, b.date) as varchar) as date, a.close as click_close, b.close as view_close
from (select * from v_bar where series_id = 'click') a
full join (select * from v_bar where series_id = 'view') b on a.date = b.date"""),
    "macro_wide": with_views(["v_macro_long"], _MACRO_WIDE),
    "macro_lag_corr": _macro_lag_corr_sql(),
    "macro_lag_features": _macro_lag_features_sql(),
    "macro_reshape": with_views(["v_macro_long"], "select series_name, cast(year as integer) as year, value from v_macro_long"),
    "features_joined": with_views(["v_price_text", "v_macro_long"], f"""
select p.row_id, cast(p.Date as varchar) as Date, p.Close, m.GDP, m.Inflation, m.Unemployment_rate, r.Rate,
       cast(year(p.Date) as integer) as Year
from ({_PRICE_CLEAN}) p
left join ({_MACRO_WIDE}) m on m.Year = year(p.Date)
left join (select year(l_shipdate) as y, month(l_shipdate) as mo, cast(count(*) as double) / 1000 as Rate
           from lineitem group by 1, 2) r on r.y = year(p.Date) and r.mo = month(p.Date)"""),
}
