import duckdb

import __spark_entry__ as entry
from bankspark.sources.tables import TABLES
from tests.conftest import SF001

NAMES = {
    "area_measures", "bar_corr", "bar_poly", "bar_tail", "cumulative_write_offs", "debt_groups",
    "deposit_tenor_mix", "embedding_clusters", "features_joined", "funding_daily", "funding_default_day",
    "funding_incremental",
    "gl_cube", "head_values", "headcount", "index_compare", "label_cluster_quality", "lag1_forecast",
    "lag_corr_scan", "lag_forecast", "loan_tenor_mix", "macro_before", "macro_cluster_quality",
    "macro_elbow", "macro_lag_corr", "macro_lag_features", "macro_reshape", "macro_sheet_scan",
    "macro_stages", "macro_wide", "monthly_debt_groups", "monthly_head", "monthly_measures", "monthly_npl",
    "monthly_report", "monthly_scorecard", "monthly_wide", "npl_by_area", "npl_with_gaps", "orders_describe",
    "orders_hash_split", "price_clean", "price_csv_scan", "price_null_counts", "priority_anova",
    "priority_anova_test", "priority_mean_std", "report_by_line", "report_detail", "report_wide", "rf_grid",
    "rf_metrics", "rf_refit_metrics", "rf_smoothed", "scorecard", "sink_days", "sma_metrics", "stage_close",
    "stage_close_fixed", "stage_macro_stats", "tick_box", "tick_dataset", "tick_describe", "tick_ema",
    "tick_ffill", "tick_histogram", "tick_lags", "tick_latest", "tick_mean_impute", "tick_minmax",
    "tick_nested_split", "tick_normal_curve", "tick_normal_fit", "tick_regr_impute", "tick_rsi", "tick_sma",
    "tick_smooth", "tick_split", "tick_windows", "tick_zscore", "yearly_close_pct", "yearly_last_close"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 25 and len({r.funding_id for r in rows}) == 25
    assert df.columns == ["day_key", "process_dt", "funding_id", "interest_rate", "vof_rate", "cof_rate",
                          "balance", "avg_balance_month"]


def test_registry_has_oracle_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    banking = {n for n in q if n != "pipeline" and not (n.startswith("op") and n[2].isdigit())}
    assert banking == NAMES
    assert banking - set(o) == {"embedding_clusters", "rf_grid", "rf_metrics", "rf_refit_metrics", "rf_smoothed"}


def test_oracle_agrees_on_flagship_and_report(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    for name in ("funding_daily", "area_measures", "scorecard", "tick_rsi"):
        s = entry.queries()[name](spark, SF001).toPandas()
        d = con.sql(entry.oracle_sql()[name]).df()
        cols = sorted(s.columns)
        assert cols == sorted(d.columns)
        key = lambda r: tuple("" if v is None or v != v else str(v) for v in r)
        sr = sorted((tuple(r) for r in s[cols].itertuples(index=False)), key=key)
        dr = sorted((tuple(r) for r in d[cols].itertuples(index=False)), key=key)
        assert len(sr) == len(dr)
        for a, b in zip(sr, dr):
            for x, y in zip(a, b):
                if x is None or (isinstance(x, float) and x != x):
                    assert y is None or (isinstance(y, float) and y != y)
                elif isinstance(x, float):
                    assert abs(x - y) <= 1e-9 * max(1.0, abs(x))
                else:
                    assert x == y


def test_portable_types(spark):
    import datetime as dt
    from decimal import Decimal
    from bankspark.queries.common import portable
    df = spark.createDataFrame([(Decimal("12"), Decimal("1.25"), dt.date(2023, 12, 15), 3, 1.5)],
                               "a decimal(38,0), b decimal(18,2), d date, i int, x float")
    out = portable(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "string", "int", "double"]
    assert tuple(out.first()) == (12, 1.25, "2023-12-15", 3, 1.5)
