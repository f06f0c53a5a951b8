"""Economic stages from macro series and the index close by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.operators import models as MD
from bankspark.operators import stats as ST
from bankspark.plans.market import label_stages
from bankspark.session import checkpoint

MACRO_COLS = ["GDP", "Inflation", "Unemployment_rate"]


def macro_zscores(macro: DataFrame, cols: list[str] | None = None, before_year: int | None = None) -> DataFrame:
    """z-scores of the macro columns over all years (K1), of which the years before ``before_year`` are kept.

    Materialised: one row per year, read by every k-means round, so the scans behind it run once."""
    z = checkpoint(ST.zscore(macro, cols or MACRO_COLS))
    return z if before_year is None else z.filter(F.col("Year") < before_year)


def economic_stages(macro: DataFrame, k: int = 4, before_year: int | None = None, cols: list[str] | None = None):
    """z-score the macro columns over all years, keep years before ``before_year``, cluster, label.

    Returns (Year, cols, z cols, cluster, Stage), inertia, centres.  The table
    has one row per calendar year.
    """
    cols = cols or MACRO_COLS
    z = macro_zscores(macro, cols, before_year)
    zcols = [f"{c}_z" for c in cols]
    found = MD.kmeans_all(z, zcols, [k], "Year")[k]
    return label_stages(MD.assign_clusters(z, zcols, found.centres), "cluster"), found.inertia, found.centres


def yearly_pct_change(yearly: DataFrame, value: str = "Close", year: str = "Year") -> DataFrame:
    """Year-over-year percent change of a yearly series (E5); one row per year."""
    w = Window.orderBy(year)   # a calendar's worth of rows
    prev = F.lag(value).over(w)
    return yearly.withColumn(f"{value}_pct", F.try_divide(F.col(value) - prev, prev) * 100)


def stage_close(stages: DataFrame, yearly_close: DataFrame, exclude_years: list[int] | None = None):
    """Join the index close of each year (C7), then per-stage mean/std and an ANOVA."""
    j = stages.join(yearly_close, "Year", "left")
    j = yearly_pct_change(j)
    if exclude_years:
        j = j.filter(~F.col("Year").isin(exclude_years))
    per_stage = ST.mean_std_by(j, "Stage", ["Close", "Close_pct"])
    test = ST.anova_test(j, "Close", "Stage")
    return j, per_stage, test


def stage_macro_stats(stages: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per stage mean and sample std of each macro column (D11), plus box figures (D16),
    as one row per (Stage, variable)."""
    cols = cols or MACRO_COLS
    long = stages.select("Stage", F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x")) for c in cols])).alias("m")
    ).select("Stage", "m.variable", "m.x").withColumn("__grp", F.concat_ws("|", "Stage", "variable"))
    ms = long.groupBy("Stage", "variable").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                               F.count("x").alias("n"))
    box = ST.box_summary(long, "x", "__grp")
    box = box.withColumn("Stage", F.split("__grp", r"\|")[0]).withColumn("variable", F.split("__grp", r"\|")[1]) \
        .drop("__grp")
    return ms.join(box, ["Stage", "variable"], "left")

