"""Monthly report of the card business.

The original runs 28 x n aggregate queries for the NPL staging, scans the GL
40 times, and pivots with 224 dynamic updates.  Here:

* NPL (J6): one conditional aggregation per area over the KPI snapshot.  The
  running write-off sum over months 1..n is folded into a weight: a write-off
  booked in month w is counted (n - w + 1) times.
* GL measures (J8): one scan of the wanted accounts, summed by (account, area);
  those sums are matched to report lines through a broadcast join with the
  fixed measure catalogue (exact codes and code prefixes as keys).  Everything after
  that works on a cube of (#lines x #areas) rows, materialised once.
* Allocation (J9-J11), rollups (J12), ratios (J13): joins and a pivot over
  frames bounded by (#lines x #areas), pinned to one partition so they need
  no exchanges; the base lines are materialised once because the ratios and
  the final union read them again.
* The sales table is scanned once into one row per person (headcount and
  scorecard); the loan KPI snapshot once for the NPL staging.
* Quotients are rounded exactly (``div_round``), ratios use exact decimals.
"""

from __future__ import annotations

import datetime as _dt
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankspark.functions.exact import div_round
from bankspark.functions.scalars import area_code_of, default_month
from bankspark.operators.joins import attach_small
from bankspark.plans import catalogue as cat
from bankspark.session import checkpoint, checkpoint_all

MONEY = "decimal(38,2)"
DEFAULT_YEAR = 2023


def _leaf_lines() -> list[int]:
    return sorted(set(cat.LINE_CODES) | set(cat.LINE_PREFIXES))


def _in_area(loan_kpi: DataFrame, city: DataFrame, column: str) -> DataFrame:
    """Loans of known provinces with a column of the province dimension (broadcast while it is small)."""
    return attach_small(loan_kpi, city.select(F.col("tinh").alias("pos_city"), column), "pos_city")


# ---- J6 NPL ratio by area --------------------------------------------------

def npl_by_area(loan_kpi: DataFrame, city: DataFrame, area: DataFrame, month: int,
                year: int = DEFAULT_YEAR) -> DataFrame:
    """fact_temp: per area code, du_no = mean over months 1..n of (outstanding +
    cumulative write-offs), rate = bad share (bucket > 2) of it.

    Columns: area_code, rate (double), du_no (double), du_no_sum (exact sum over
    the n months, decimal), n_months.
    """
    first, last = year * 100 + 1, year * 100 + month
    in_kpi = F.col("kpi_month").between(first, last)
    in_wo = F.col("write_off_month").between(first, last)
    # rows outside both windows add nothing: drop them before the join (pushed to the scan)
    relevant = loan_kpi.filter(in_kpi | in_wo)
    kpi = _in_area(relevant, city, "area_code").select(
        F.col("area_code"), "kpi_month", "outstanding_principal", "write_off_month",
        "write_off_balance_principal", "max_bucket")
    weight = (F.lit(last + 1) - F.col("write_off_month")).cast("decimal(10,0)")
    bad = F.col("max_bucket") > 2
    held = F.when(in_kpi, F.col("outstanding_principal"))
    written_off = F.when(in_wo, F.col("write_off_balance_principal") * weight)

    def total(which):
        # each term is summed apart: a NULL amount of one does not take the other with it
        parts = [F.coalesce(F.sum(which(v)), F.lit(0)).cast(MONEY) for v in (held, written_off)]
        return (parts[0] + parts[1]).cast(MONEY)

    agg = kpi.groupBy("area_code").agg(total(lambda v: v).alias("t"),
                                       total(lambda v: F.when(bad, v)).alias("x"))
    # every report area gets a row, as the original loops over the area list
    out = area.select("area_code").join(agg, "area_code", "left").select(
        "area_code",
        F.coalesce("t", F.lit(0).cast(MONEY)).alias("t"),
        F.coalesce("x", F.lit(0).cast(MONEY)).alias("x"))
    return out.select(
        "area_code",
        F.try_divide(F.col("x").cast("double"), F.col("t").cast("double")).alias("rate"),
        (F.col("t").cast("double") / F.lit(float(month))).alias("du_no"),
        F.col("t").alias("du_no_sum"),
        F.lit(month).alias("n_months"))


def monthly_running_total(df: DataFrame, keys: list[str], month_key: str, values: list[str],
                          first_key: int, last_key: int, keys_from: DataFrame | None = None) -> DataFrame:
    """Cumulative sums over a dense yyyyMM grid (E6, C9): every key gets every month, months
    without rows count 0 (the original's COALESCE), running sum from the first month.

    Rows are aggregated to (keys, month) before the window, so a key holding a third of the
    data still has one row per month in its window partition.
    """
    y0, m0 = divmod(first_key, 100)
    y1, m1 = divmod(last_key, 100)
    n = (y1 - y0) * 12 + (m1 - m0) + 1
    key_rows = (keys_from if keys_from is not None else df).select(*keys).distinct()
    grid = key_rows.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__i")).select(
        *keys, ((F.lit(y0) + F.floor((F.lit(m0 - 1) + F.col("__i")) / 12)) * 100
                + (F.lit(m0 - 1) + F.col("__i")) % 12 + 1).cast("int").alias(month_key))
    monthly = (df.filter(F.col(month_key).between(first_key, last_key))
               .groupBy(*keys, month_key).agg(*[F.sum(v).alias(v) for v in values]))
    w = Window.partitionBy(*keys).orderBy(month_key).rowsBetween(Window.unboundedPreceding, 0)
    dense = grid.join(monthly, [*keys, month_key], "left")
    return dense.select(*keys, month_key, *[F.sum(F.coalesce(F.col(v), F.lit(0))).over(w).alias(f"{v}_cum")
                                            for v in values])


def cumulative_write_offs(loan_kpi: DataFrame, city: DataFrame, area: DataFrame, month: int,
                          year: int = DEFAULT_YEAR) -> DataFrame:
    """Per area and month m = 1..n: write-offs booked in months 1..m, all loans and bucket > 2
    (the ``vwo_balance`` / ``vwo_balance_xau`` of each loop step of J6)."""
    wo = _in_area(loan_kpi, city, "area_code").select(
        "area_code", F.col("write_off_month").alias("month_key"),
        F.col("write_off_balance_principal").alias("wo"),
        F.when(F.col("max_bucket") > 2, F.col("write_off_balance_principal")).alias("wo_bad"))
    return monthly_running_total(wo, ["area_code"], "month_key", ["wo", "wo_bad"],
                                 year * 100 + 1, year * 100 + month, keys_from=area)


# ---- J7 debt groups --------------------------------------------------------

def debt_groups(loan_kpi: DataFrame, city: DataFrame, first_month_key: int,
                last_month_key: int, region_col: str = "area_code") -> DataFrame:
    """du_no_sau_wo: outstanding by area and month, split by bucket group 1, 2, 3-5.

    ``region_col``: the column of the province dimension to group by, where it has a region beside the area."""
    b = F.coalesce(F.col("max_bucket"), F.lit(1))
    op = F.col("outstanding_principal")
    kpi = loan_kpi.filter(F.col("kpi_month").between(first_month_key, last_month_key))
    return (_in_area(kpi, city, region_col)
            .groupBy(F.col(region_col).alias("area"), "kpi_month")
            .agg(F.sum(op).alias("du_no_ck"),
                 F.sum(F.when(b == 1, op).otherwise(0)).alias("du_no_nhom_1"),
                 F.sum(F.when(b == 2, op).otherwise(0)).alias("du_no_nhom_2"),
                 F.sum(F.when(b.isin(3, 4, 5), op).otherwise(0)).alias("du_no_nhom_345")))


# ---- J8 GL cube ------------------------------------------------------------

def gl_cube(gl: DataFrame, month: int, year: int | None = None) -> DataFrame:
    """(sort_id, area_code, amount): year-to-date GL amounts per report line and area code.

    ``year=None`` reproduces the original filter, which compares the calendar
    month only.  Area code '0' is head office.
    """
    spark = gl.sparkSession
    if year is None:
        cond = F.month("transaction_date") <= month
    else:
        # a date range rather than year()/month(): it reaches the parquet scan as pushed filters
        end = _dt.date(year + 1, 1, 1) if month == 12 else _dt.date(year, month + 1, 1)
        cond = (F.col("transaction_date") >= F.lit(_dt.date(year, 1, 1))) & \
               (F.col("transaction_date") < F.lit(end))
    code = F.col("account_code").cast("string")
    codes = sorted({c for cs in cat.LINE_CODES.values() for c in cs})
    wanted = code.isin(codes)
    for prefix in sorted({p for ps in cat.LINE_PREFIXES.values() for p in ps}):
        wanted = wanted | code.startswith(prefix)
    # sums per (account, area) first: only they are matched to report lines
    sums = (gl.filter(cond & wanted)
            .groupBy(code.alias("code"), area_code_of(F.col("analysis_code")).alias("area_code"))
            .agg(F.sum("amount").cast(MONEY).alias("amount")).filter(F.col("area_code").isNotNull()))
    keys = [F.concat(F.lit("C:"), F.col("code"))]
    keys += [F.concat(F.lit(f"P{n}:"), F.substring("code", 1, n)) for n in cat.prefix_lengths()]
    # the catalogue is a fixed list of ~70 codes: a proven-small broadcast side
    return (sums.select(F.explode(F.array(*keys)).alias("match_key"), "area_code", "amount")
            .join(F.broadcast(cat.measure_map(spark)), "match_key")
            .groupBy("sort_id", "area_code").agg(F.sum("amount").cast(MONEY).alias("amount")))


def _closure() -> list[tuple[int, int]]:
    """(parent, leaf line) pairs: rollups of rollups flattened to leaves."""
    direct = {p: [c for c in chain(_leaf_lines(), [r[0] for r in cat.ROLLUPS]) if lo <= c <= hi]
              for p, lo, hi, _ in cat.ROLLUPS}

    def leaves(p):
        out = []
        for c in direct[p]:
            out += leaves(c) if c in direct else [c]
        return out

    return [(p, leaf) for p in direct for leaf in leaves(p)]


def _rollup(values: DataFrame, keys: list[str]) -> DataFrame:
    """Parent lines as sums of their leaf lines (J12); rounding kept where the original rounds."""
    spark = values.sparkSession
    rmap = spark.createDataFrame(_closure(), "parent int, sort_id int")
    rounded = [p for p, _, _, r in cat.ROLLUPS if r]
    summed = (values.join(F.broadcast(rmap.coalesce(1)), "sort_id")
              .groupBy(F.col("parent").alias("sort_id"), *keys)
              .agg(F.sum("value").alias("value")))
    return summed.withColumn(
        "value", F.when(F.col("sort_id").isin(rounded), F.round("value", 2))
        .otherwise(F.col("value")).cast(MONEY))


def head_values(cube: DataFrame) -> DataFrame:
    """fact_head_value: every catalogue line (NULL when no head rows) plus rollups."""
    spark = cube.sparkSession
    lines = spark.createDataFrame([(s,) for s in _leaf_lines()], "sort_id int")
    head = cube.filter(F.col("area_code") == "0").select("sort_id", F.col("amount").alias("value"))
    leaf = lines.join(head, "sort_id", "left").select(
        "sort_id", F.round("value", 2).cast(MONEY).alias("value"))
    return leaf.unionByName(_rollup(leaf, []))


# ---- J9-J14 area measures --------------------------------------------------

def headcount(sales_kpi: DataFrame) -> DataFrame:
    """Distinct sales staff per area name, all months (count_sale).

    Accepts the sales KPI rows or the per-person table of ``scorecard.person_kpis``."""
    return sales_kpi.groupBy("area_name").agg(F.countDistinct("sale_name").alias("cnt_sale"))


def _total_over(df: DataFrame, col: str, by: list[str] | None = None) -> F.Column:
    # windows over a handful of rows (one per area, or per line and area)
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return F.sum(col).over(w)


def _bounded(df: DataFrame) -> DataFrame:
    """Pin a frame whose size is bounded by (#report lines x #areas) to one partition.

    Joins, windows and aggregates between single-partition children need no
    exchange, so the allocation logic runs as one stage instead of dozens of
    tiny ones; the scans that feed it stay distributed.
    """
    return df.coalesce(1)


def _join(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    # both sides are single-partition and tiny: a hash join in place, no broadcast job
    return a.join(b.hint("shuffle_hash"), on, how)


def area_measures(cube: DataFrame, npl: DataFrame, sales_kpi: DataFrame, area: DataFrame,
                  month_key: int, keep_without_head: bool = False, share_digits: int = 2) -> DataFrame:
    """fact_report_tong_hop_raw: (month, sort_id, area_name, value).

    ``keep_without_head=False`` is the original: a share-of-amount line with no
    head-office rows yields no area rows at all (its inner join on 1=1 meets an
    empty side).  ``True`` keeps each area's own amount for such lines.
    ``share_digits``: the original rounds each area's share to 2 places before use.
    """
    cube, npl, area = _bounded(cube), _bounded(npl), _bounded(area)
    own = cube.filter(F.col("area_code") != "0")
    head = cube.filter(F.col("area_code") == "0").select("sort_id", F.col("amount").alias("head"))
    tot = own.groupBy("sort_id").agg(F.sum("amount").alias("total"))

    # Own amount + (own / all areas' amount, rounded to 2) x head
    how = "left" if keep_without_head else "inner"
    j9 = (own.filter(F.col("sort_id").isin(*cat.SHARE_OF_AMOUNT))
          .transform(lambda d: _join(d, tot, "sort_id")).transform(lambda d: _join(d, head, "sort_id", how))
          .transform(lambda d: _join(d, area, "area_code"))
          .select("sort_id", "area_name",
                  F.round(F.col("amount") + div_round(F.col("amount"), F.col("total"), share_digits, 2, 2)
                          * F.coalesce(F.col("head"), F.lit(0)), 2).alias("value")))

    # Head x area NPL balance share (unrounded share)
    # one row per (balance-share line, area): an equi-join to the head, no cross join
    shares = npl.select("area_code", F.col("du_no_sum").alias("t"),
                        _total_over(npl, "du_no_sum").alias("t_all"))
    shares = shares.withColumn(
        "sort_id", F.explode(F.array(*[F.lit(s) for s in cat.SHARE_OF_BALANCE])))
    j10 = (_join(_join(shares, head, "sort_id"), area, "area_code")
           .select("sort_id", "area_name",
                   div_round(F.col("head") * F.col("t"), F.col("t_all"), 2, 4, 2).alias("value")))

    # Own amount + head x headcount share
    # one row per area name; feeds J11 and J14, so the sales scan runs once
    cnt = checkpoint(_bounded(headcount(sales_kpi)))
    cnt = _join(cnt.select("area_name", "cnt_sale", _total_over(cnt, "cnt_sale").alias("cnt_all")),
                area, "area_name")
    j11 = (own.filter(F.col("sort_id").isin(*cat.SHARE_OF_HEADCOUNT))
           .transform(lambda d: _join(_join(d, head, "sort_id"), cnt, "area_code"))
           .select("sort_id", "area_name",
                   div_round(F.col("amount") * F.col("cnt_all") + F.col("head") * F.col("cnt_sale"),
                             F.col("cnt_all"), 2, 2, 0).alias("value")))

    # Headcount line
    j14 = cnt.select(F.lit(cat.HEADCOUNT_LINE).alias("sort_id"), "area_name",
                     F.col("cnt_sale").cast(MONEY).alias("value"))

    # leaf lines feed the rollups; leaves + headcount + rollups feed the ratios.  The leaves
    # derive from materialised, bounded inputs, so the base lines are materialised once
    # (a few hundred rows) and the leaves are simply evaluated twice inside that job.
    leaves = _bounded(j9.unionByName(j10).unionByName(j11).select(
        F.col("sort_id").cast("int"), "area_name", F.col("value").cast(MONEY)))
    rolled = _rollup(leaves, ["area_name"])
    base = checkpoint(_bounded(
        leaves.unionByName(j14.select(F.col("sort_id").cast("int"), "area_name", "value"))
        .unionByName(rolled)))
    out = base.unionByName(_ratios(base))
    return out.select(F.lit(month_key).cast("int").alias("month"), "sort_id", "area_name", "value")


def _ratios(values: DataFrame) -> DataFrame:
    """CIR, margin, return on funding, profit per head; a row only where the inputs exist."""
    need = [1, 2, 4, 5, 7, 8, 25]
    wide = (values.filter(F.col("sort_id").isin(need))
            .groupBy("area_name").pivot("sort_id", need)
            .agg(F.first("value").alias("v"), F.count(F.lit(1)).alias("n")))

    def v(s):
        return F.col(f"{s}_v")

    def has(*ss):
        cond = None
        for s in ss:
            c = F.coalesce(F.col(f"{s}_n"), F.lit(0)) > 0
            cond = c if cond is None else cond & c
        return cond

    specs = [
        (10, has(7, 8), div_round(v(8) * -100, v(7), 2, 2, 2)),
        (11, has(1, 4, 25), div_round(v(1) * 100, v(4) + v(25), 2, 2, 2)),
        (12, has(1, 5), div_round(v(1) * -100, v(5), 2, 2, 2)),
        (13, has(1, 2), div_round(v(1), v(2), 2, 2, 2)),
    ]
    arr = F.array(*[F.when(cond, F.struct(F.lit(sid).alias("sort_id"), val.cast(MONEY).alias("value")))
                    for sid, cond, val in specs])
    return (wide.select("area_name", F.explode(arr).alias("r"))
            .filter(F.col("r").isNotNull())
            .select(F.col("r.sort_id").cast("int").alias("sort_id"), "area_name",
                    F.col("r.value").alias("value")))


# ---- H1, J17 report layout ---------------------------------------------------

def present_lines(measure: DataFrame) -> list[int]:
    """Sorted distinct line ids of a measure table (D18); at most the catalogue's lines."""
    row = measure.agg(F.sort_array(F.collect_set("sort_id")).alias("ids")).first()
    return list(row["ids"] or [])


def report_by_line(measure: DataFrame, lines: list[int] | None = None) -> DataFrame:
    """One column per report line present, one row per (month, area) (H2)."""
    lines = lines or present_lines(measure)
    wide = measure.groupBy("month", "area_name").pivot("sort_id", lines).agg(F.first("value"))
    return wide.select("month", "area_name", *[F.col(str(s)).alias(f"sort_id_{s}") for s in lines])


def report_wide(measure: DataFrame, area: DataFrame, area_names: list[str]) -> DataFrame:
    """One column per area (fact_report_tong_hop), for the line ids present."""
    # the original fills each cell with a scalar subquery, which fails on two rows
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate (sort_id, area_name) in measure"))
                 .cast(MONEY)).otherwise(F.first("value"))
    return measure.groupBy("sort_id").pivot("area_name", area_names).agg(one)


def report_detail(wide: DataFrame, head: DataFrame, lines: DataFrame) -> DataFrame:
    """fact_report_tong_hop_detail: title, head value and the area columns."""
    return (wide.join(lines, "sort_id")
            .join(head.select("sort_id", F.col("value").alias("head")), "sort_id", "left"))


# ---- J16 driver -------------------------------------------------------------

def area_names_of(area: DataFrame) -> list[str]:
    """The area dimension's names in code order: the report has one column per name."""
    return [r["area_name"] for r in area.select("area_code", "area_name").distinct().orderBy("area_code").collect()]


def monthly_report(spark: SparkSession, gl: DataFrame, loan_kpi: DataFrame, city: DataFrame,
                   area: DataFrame, sales_kpi: DataFrame, month: int | None = None,
                   year: int | None = None, gl_year: int | None = None,
                   area_names: list[str] | None = None, region_col: str = "area_code") -> dict[str, DataFrame]:
    """All tables of ``report_monthly`` as lazy DataFrames; month and year default to today's."""
    from bankspark.plans.scorecard import person_kpis, scorecard

    month, year = month or default_month(), year or _dt.date.today().year
    month_key = year * 100 + month
    # each input table is scanned once; the small results are materialised side by side
    npl, cube = checkpoint_all(npl_by_area(loan_kpi, city, area, month, year), gl_cube(gl, month, gl_year))
    head = head_values(cube)
    people = person_kpis(sales_kpi, month)     # the sales table is scanned once
    measure = checkpoint(area_measures(cube, npl, people, area, month_key))
    wide = report_wide(measure, area, area_names or area_names_of(area))
    return {
        "npl": npl.drop("du_no_sum", "n_months"),
        "debt_groups": debt_groups(loan_kpi, city, year * 100 + 1, month_key, region_col),
        "head": head,
        "measure": measure,
        "report": wide,
        "detail": report_detail(wide, head, cat.report_lines(spark)),
        "scorecard": scorecard(people, area, npl, measure, month, month_key),
    }
