"""Sales scorecard.

Per person (sale_name, email, area) year-to-date means of three KPIs, each
ranked over all persons (DESC, NULLS FIRST as PostgreSQL orders them); the
area's NPL ratio ranked over the joined person rows; the area ratio lines
10-13 ranked over the areas.  Person-level ranks use ``global_rank`` (no
single-partition window); area-level ranks run over at most one row per
area of the area dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.functions.exact import ratio
from bankspark.operators.rank import global_rank
from bankspark.session import checkpoint

# fixed values: the scorecard table's columns
SCORECARD_COLUMNS = (
    "month_key", "area_code", "area_name", "email", "tong_diem", "rank_final",
    "ltn_avg", "rank_ltn_avg", "psdn_avg", "rank_psdn_avg", "approval_rate_avg",
    "rank_approval_rate_avg", "npl_truoc_wo_luy_ke", "rank_npl_truoc_wo_luy_ke",
    "diem_quy_mo", "rank_ptkd", "cir", "rank_cir", "margin", "rank_margin", "hs_von",
    "rank_hs_von", "hsbq_nhan_su", "rank_hsbq_nhan_su", "diem_fin", "rank_fin")

# fixed values: ratio line -> (value column, rank column, descending)
AREA_RATIOS = ((10, "cir", "rank_cir", False), (11, "margin", "rank_margin", True),
               (12, "hs_von", "rank_hs_von", True), (13, "hsbq_nhan_su", "rank_hsbq_nhan_su", True))


# fixed values: the person KPIs, their averaged column and rank column
KPIS = (("loan_to_new", "ltn_avg", "rank_ltn_avg"), ("psdn", "psdn_avg", "rank_psdn_avg"),
        ("app_rate", "approval_rate_avg", "rank_approval_rate_avg"))


def _kpi_ranks(per_person: DataFrame, area: DataFrame) -> DataFrame:
    """The three KPI averages ranked DESC NULLS FIRST over all persons, in one ranking pass, and brought back to
    (email, area) in one aggregate; persons that share email and area give every combination of their values,
    as the original's joins do.

    Only persons that those joins can match, with an email and an area of the dimension, are gathered: without an
    email or area name nothing matches, and all such persons would meet in one group."""
    stacked = per_person.select(
        "email", "area_name",
        F.explode(F.array(*[F.struct(F.lit(avg).alias("metric"), F.col(avg).alias("v"))
                            for _, avg, _ in KPIS])).alias("m")
    ).select("email", "area_name", "m.metric", "m.v")
    ranked = global_rank(stacked, "v", "r", ascending=False, nulls_first=True, by=["metric"])
    ranked = (ranked.filter(F.col("email").isNotNull() & F.col("area_name").isNotNull())
              .join(F.broadcast(area.select("area_name").distinct()), "area_name", "left_semi"))
    out = ranked.groupBy("email", "area_name").agg(*[
        F.collect_list(F.when(F.col("metric") == avg, F.struct("v", "r"))).alias(avg) for _, avg, _ in KPIS])
    for _, avg, rk in KPIS:
        out = out.withColumn(avg, F.explode(avg)).withColumn(rk, F.col(avg)["r"]).withColumn(avg, F.col(avg)["v"])
    return out


def _rank_by_area(joined: DataFrame, value: str, out: str, ascending: bool,
                  nulls_first: bool) -> DataFrame:
    """Rank rows by a value that is constant within each area.

    Equal to rank() over all person rows: one row per area carries the
    area's row count as weight, rank = 1 + weight of the areas ordered
    strictly before.  That table is bounded by the area dimension, so its
    windows run on one partition and the result is broadcast back.
    """
    per_area = joined.groupBy("area_name", value).agg(F.count(F.lit(1)).alias("__w")).coalesce(1)
    v = F.col(value)
    order = (v.asc_nulls_first() if nulls_first else v.asc_nulls_last()) if ascending else \
        (v.desc_nulls_first() if nulls_first else v.desc_nulls_last())
    upto = F.sum("__w").over(Window.orderBy(order))            # RANGE frame: ties included
    ties = F.sum("__w").over(Window.partitionBy(value))
    ranked = per_area.select("area_name", (upto - ties + 1).cast("int").alias(out))
    return joined.join(F.broadcast(ranked), "area_name")


def _area_ratio_ranks(measure: DataFrame) -> DataFrame:
    """Ranks of the ratio lines 10-13 over the areas, one row per area (bounded by the area list).

    One window partitioned by line: the order key is the value (ascending line) or its negation
    (descending lines), with NULLs placed last resp. first as PostgreSQL does.
    """
    desc = [sid for sid, _, _, d in AREA_RATIOS if d]
    sid, v = F.col("sort_id"), F.col("value")
    is_desc = sid.isin(desc)
    key = F.when(is_desc, -v).otherwise(v)
    null_pos = F.when(v.isNull(), F.when(is_desc, 0).otherwise(1)).otherwise(F.when(is_desc, 1).otherwise(0))
    w = Window.partitionBy("sort_id").orderBy(null_pos, key)
    ranked = (measure.filter(sid.isin([s for s, _, _, _ in AREA_RATIOS]))
              .select("sort_id", "area_name", v.cast("double").alias("v"), F.rank().over(w).alias("r")))
    wide = ranked.groupBy("area_name").pivot("sort_id", [s for s, _, _, _ in AREA_RATIOS]) \
        .agg(F.first("v").alias("v"), F.first("r").alias("r"))
    return wide.select("area_name", *[c for s, val, rk, _ in AREA_RATIOS
                                      for c in (F.col(f"{s}_v").alias(val), F.col(f"{s}_r").alias(rk))])


def person_kpis(sales_kpi: DataFrame, month: int) -> DataFrame:
    """One scan of the sales KPI table: per (sale_name, email, area_name) the year-to-date sums and
    counts of each KPI and the number of year-to-date rows.  Persons, their averages and the
    headcount per area all derive from this table (one row per person), which is materialised."""
    ytd = F.col("month") <= month
    aggs = [F.count(F.when(ytd, F.lit(1))).alias("ytd_rows")]
    for src, avg, _ in KPIS:
        aggs += [F.sum(F.when(ytd, F.col(src))).alias(f"{avg}__s"), F.count(F.when(ytd, F.col(src))).alias(f"{avg}__n")]
    return checkpoint(sales_kpi.groupBy("sale_name", "email", "area_name").agg(*aggs))


def scorecard(people: DataFrame, area: DataFrame, npl: DataFrame, measure: DataFrame,
              month: int, month_key: int) -> DataFrame:
    """``people`` is ``person_kpis(sales_kpi, month)``."""
    persons = people.select("email", "area_name").distinct().join(area, "area_name")
    # the original groups the year-to-date rows only: persons without any have no KPI row
    per_person = people.filter(F.col("ytd_rows") > 0).select(
        "sale_name", "email", "area_name",
        *[ratio(F.col(f"{avg}__s"), F.col(f"{avg}__n")).alias(avg) for _, avg, _ in KPIS])
    keys = ["email", "area_name"]
    # npl and the ratio lines hold one row per area: broadcast sides of a proven bound
    joined = (persons.join(_kpi_ranks(per_person, area), keys)
              .join(F.broadcast(npl.select("area_code", F.col("rate").alias("npl_truoc_wo_luy_ke"))),
                    "area_code"))
    joined = joined.join(F.broadcast(_area_ratio_ranks(measure)), "area_name", "left")
    joined = checkpoint(joined)
    # the NPL rank runs over the person rows before the ratio lines are joined
    joined = _rank_by_area(joined, "npl_truoc_wo_luy_ke", "rank_npl_truoc_wo_luy_ke",
                           ascending=True, nulls_first=False)
    joined = joined.withColumn(
        "diem_quy_mo", F.col("rank_ltn_avg") + F.col("rank_psdn_avg")
        + F.col("rank_approval_rate_avg") + F.col("rank_npl_truoc_wo_luy_ke"))
    # inner joins of the original: persons of an area without all four ratio lines drop out
    joined = joined.filter(F.col("rank_cir").isNotNull() & F.col("rank_margin").isNotNull()
                           & F.col("rank_hs_von").isNotNull() & F.col("rank_hsbq_nhan_su").isNotNull())
    joined = joined.withColumn("diem_fin", F.col("rank_cir") + F.col("rank_margin")
                               + F.col("rank_hs_von") + F.col("rank_hsbq_nhan_su"))
    joined = _rank_by_area(joined, "diem_fin", "rank_fin", ascending=True, nulls_first=False)
    joined = joined.withColumn("tong_diem", F.col("diem_quy_mo") + F.col("diem_fin"))
    # both person-level scores ranked in one pass, then attached by value
    scores = joined.select(F.explode(F.array(
        F.struct(F.lit("rank_ptkd").alias("metric"), F.col("diem_quy_mo").alias("v")),
        F.struct(F.lit("rank_final").alias("metric"), F.col("tong_diem").alias("v")))).alias("m")
    ).select("m.metric", "m.v").groupBy("metric", "v").agg(F.count(F.lit(1)).alias("__w"))
    ranked = checkpoint(global_rank(scores, "v", "r", ascending=True, nulls_first=False,
                                    weight="__w", by=["metric"]))
    for metric, col in (("rank_ptkd", "diem_quy_mo"), ("rank_final", "tong_diem")):
        rk = ranked.filter(F.col("metric") == metric).select(F.col("v").alias(col), F.col("r").alias(metric))
        joined = joined.join(rk, col, "left")
    return joined.withColumn("month_key", F.lit(month_key).cast("int")).select(*SCORECARD_COLUMNS)
