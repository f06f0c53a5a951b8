"""Price model features, forest fits, smoothing and a lag-model forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.operators import forest as FO
from bankspark.operators import lagged as LG
from bankspark.operators import models as MD
from bankspark.operators import series as S
from bankspark.operators import stats as ST
from bankspark.session import checkpoint, written

LAG = 360
SMA = [200, 100, 50]


def feature_table(indexed: DataFrame, series: str, close: str = "close",
                  lag_vars: list[str] | None = None, block_rows: int = S.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Lag-360 features imputed by regression on close (K12, K13), SMAs and RSI imputed by their
    mean (K14), EMA 50.  ``indexed`` comes from ``series.with_index``.  Returns the table and the
    feature columns; scaling happens after the split (``forest_scores``)."""
    lag_vars = lag_vars or [close]
    df = S.lags(indexed, series, lag_vars, [LAG], block_rows, name="{col}_lag_{k}")
    lag_cols = [f"{v}_lag_{LAG}" for v in lag_vars]
    df = ST.regression_impute(df, lag_cols, close, series)
    df = S.rolling_mean(df, series, close, SMA, block_rows)
    df = S.ema_span(df, series, close, 50, "EMA_50", block_rows)
    df = S.rsi(df, series, close, 14, "RSI_14", block_rows)
    df = ST.mean_impute(df, [f"SMA_{n}" for n in SMA] + ["RSI_14"], series)
    feats = lag_cols + [f"SMA_{n}" for n in SMA] + ["EMA_50", "RSI_14"]
    return checkpoint(df), feats


def daily_close(prices: DataFrame, date: str = "Date", close: str = "Close", row: str = "row_id") -> DataFrame:
    """One row per date: the last known close of the day."""
    return (prices.filter(F.col(close).isNotNull() & F.col(date).isNotNull()).groupBy(date)
            .agg(F.max_by(close, row).alias(close)))


def index_features(prices: DataFrame, macro: DataFrame, rates: DataFrame,
                   block_rows: int = S.DEFAULT_BLOCK_ROWS) -> tuple[DataFrame, list[str]]:
    """The original's nine model features of a daily index (K12-K14, K23): macro series and the rate lagged by ``LAG`` rows
    with gaps filled by a regression on the close, three SMAs and the RSI with gaps filled by their mean, and EMA 50.

    Returns (Date, Close, features) and the feature names; one row a calendar day, whatever the number of prices.
    """
    from bankspark.plans.market import attach_macro_and_rate

    variables = ["Rate", "GDP", "Inflation", "Unemployment_rate"]
    daily = daily_close(prices).withColumn("series", F.lit("index"))
    df = attach_macro_and_rate(S.with_index(daily, "series", ["Date"]), macro, rates)
    df = S.lags(df, "series", variables, [LAG], block_rows)
    lagged = [f"{v}_lag_{LAG}" for v in variables]
    df = ST.regression_impute(df, lagged, "Close")
    df = S.rolling_mean(df, "series", "Close", SMA, block_rows)
    df = S.ema_span(df, "series", "Close", 50, "EMA_50", block_rows)
    df = S.rsi(df, "series", "Close", 14, "RSI_14", block_rows)
    df = ST.mean_impute(df, [f"SMA_{n}" for n in SMA] + ["RSI_14"])
    features = lagged + [f"SMA_{n}" for n in SMA] + ["EMA_50", "RSI_14"]
    return written(df.select("Date", "Close", *features), "index-features"), features


def forest_vectors(train: DataFrame, features: list[str], label: str, key: str, degree: int = 2) -> DataFrame:
    """(key, label, features): z-scores of the rows given and their polynomial terms (K1, K3) as one vector."""
    return _polynomial(ST.zscore(train, features), features, degree).select(key, label, "features")


def _polynomial(scaled: DataFrame, features: list[str], degree: int = 2) -> DataFrame:
    from pyspark.ml.feature import PolynomialExpansion

    x = MD.assemble(scaled, [f"{c}_z" for c in features], "__x")
    return PolynomialExpansion(degree=degree, inputCol="__x", outputCol="features").transform(x).drop("__x")


def forest_scores(features: DataFrame, feature_cols: list[str], label: str, key: str,
                  num_trees: int, max_depth: int, min_leaf: int, seed: int = 42, keep: list[str] | None = None):
    """Fit on the hash-split train rows, predict and score train and test.

    Returns the test rows (``keep``, key, label, prediction) and one row of scores a part."""
    split = MD.hash_split(features, key)
    # z-scores (K1) with mean and std of the training rows only, so the test rows do not leak in
    split = ST.zscore(split, feature_cols, fit=split.filter("is_train"))
    rows = _polynomial(split, feature_cols).withColumn("__all", F.col("is_train").isNotNull())
    rows = rows.select(*dict.fromkeys([*(keep or []), key, label]), "is_train", "__all", "features")
    pred = FO.predictions(rows, "features", label, key, "is_train", "__all", [min_leaf], [num_trees], [max_depth], [2], seed)
    pred = written(pred.withColumn("prediction", F.col("predictions")[0]).drop("predictions", "min_leaf", "__all"), "forest-predictions")
    train, test = pred.filter("is_train"), pred.filter(~F.col("is_train"))
    scores = []
    for name, part in (("train", train), ("test", test)):
        s = MD.regression_scores(part, label)
        scores.append((name, s["n"], s["mse"], s["rmse"], s["mae"], s["r2"]))
    return test.drop("is_train"), scores


def smooth_predictions(pred: DataFrame, series: str, order: list[str], ts: str,
                       block_rows: int = S.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """EMA(10) and SMA(20) of predictions in time order, shown 20 days earlier."""
    idx = S.with_index(pred, series, order)
    out = S.ema_span(idx, series, "prediction", 10, "pred_ema_10", block_rows)
    out = S.rolling_mean(out, series, "prediction", [20], block_rows, name="pred_sma_{n}")
    return out.withColumn("shown_at", F.col(ts) - F.expr("INTERVAL 20 DAYS")).drop(S.G)


def lag_forecast(indexed: DataFrame, series: str, close: str = "close", steps_back: int = 60,
                 horizon: int = 10, train_share_num: int = 4, train_share_den: int = 5,
                 scale_on_all: bool = False) -> DataFrame:
    """Chronological split, min-max scaling fitted on the train part of each series (the whole series with
    ``scale_on_all``, as the original does), 60-lag windows, a linear model, and a recursive
    ``horizon``-step forecast per series (K2, K16, K21, K22).

    The model's normal equations are sums of lagged products, so no windows are built for training; the last window of a
    series comes from its last rows alone."""
    pos = S.with_position(indexed, series)
    pos = pos.withColumn(
        "__train", F.col("__pos") < F.floor(F.col("__len") * train_share_num / train_share_den))
    # one row per series, used to scale and to invert: materialised once
    fitted = written(ST.minmax_fit(pos if scale_on_all else pos.filter("__train"), close, series), "minmax")
    scaled = ST.minmax_scale(pos, close, series, "__y", fitted=fitted)
    coefficients, intercept = LG.lag_least_squares(scaled.filter("__train"), series, "__y", steps_back)
    ends = scaled.filter((F.col("__pos") >= F.col("__len") - 1 - steps_back) & (F.col("__pos") < F.col("__len") - 1))
    last = ends.groupBy(series).agg(F.sort_array(F.collect_list(F.struct("__pos", "__y"))).alias("__w")).select(
        series, F.col("__w")["__y"].alias("__x")).filter(F.size("__x") == steps_back)
    fc = MD.recursive_forecast(last, "__x", coefficients, intercept, horizon, "__p")
    fc = fc.select(series, F.posexplode("__p").alias("step", "__yhat"))
    inv = ST.minmax_inverse(fc, "__yhat", fitted, series, "forecast")
    return inv.select(series, (F.col("step") + 1).alias("step"), "forecast")
