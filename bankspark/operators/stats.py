"""Descriptive statistics, scaling, imputation and tests.

Everything is a grouped aggregate (partial aggregation before the shuffle) or
a join of the rows to a per-group statistics table, which is broadcast when it
is small (``attach_small`` counts it first).  Exact quantiles avoid ``percentile``, which holds
a group's values in one task: an approximate pass brackets each order
statistic, a second pass counts the rows below the bracket, and only the
values inside it are put in order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.operators.joins import attach_one, attach_small
from bankspark.session import written

_ONE = "__one"


def _group(df: DataFrame, group: str | None) -> tuple[DataFrame, str]:
    if group:
        return df, group
    return df.withColumn(_ONE, F.lit("all")), _ONE


ACCURACY = 10_000  # of the approximate pass: its rank error is at most 1 / ACCURACY of the rows
MAX_INSIDE = 1_000_000  # rows of a bracket that are put in order by one task; a larger bracket is split first
CUTS = 1_000  # parts of a bracket that is split


def exact_quantiles(df: DataFrame, value: str, qs: list[float], group: str | None = None) -> DataFrame:
    """(group, q, quantile): linear interpolation between order statistics (numpy / pandas default).

    The bracket of a quantile holds about 4 / ACCURACY of the group's rows, or the whole of a group below
    2 * ACCURACY rows, summed by value first; equal values are one row, so a hot value adds nothing.
    A bracket of over MAX_INSIDE rows is split at the quantiles of its own values, again until it holds no more.
    """
    d, g = _group(df, group)
    x = d.select(g, F.col(value).alias("__v")).filter(F.col(value).isNotNull())
    slack = 2.0 / ACCURACY
    low = [max(0.0, q - slack) for q in qs]
    high = [min(1.0, q + slack) for q in qs]
    arr = lambda vs: F.array(*[F.lit(float(v)) for v in vs])
    brackets = x.groupBy(g).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.percentile_approx("__v", low, ACCURACY).alias("__low"), F.percentile_approx("__v", high, ACCURACY).alias("__high"))
    # the ends of the range, and small groups, are bracketed by the extremes themselves
    small = F.col("__n") < 2 * ACCURACY
    ends = [F.struct(F.lit(float(q)).alias("q"),
                     F.when(small | F.lit(q <= slack), F.col("__min")).otherwise(F.col("__low")[i]).alias("lo"),
                     F.when(small | F.lit(q >= 1 - slack), F.col("__max")).otherwise(F.col("__high")[i]).alias("hi"))
            for i, q in enumerate(qs)]
    brackets = written(brackets.select(g, "__n", F.array(*ends).alias("__b")), "brackets")
    largest = brackets.agg(F.max("__n")).first()[0] or 0
    if largest * 5 > MAX_INSIDE * ACCURACY:
        brackets = _split_brackets(x, brackets, g)
    rows = attach_small(x, brackets, g)
    # one row per (group, quantile, value inside the bracket), and one for all rows below it
    inside = rows.select(g, "__n", "__v", F.explode("__b").alias("b")).filter(F.col("__v") <= F.col("b.hi"))
    counts = inside.groupBy(g, "__n", F.col("b.q").alias("q"),
                            F.when(F.col("__v") >= F.col("b.lo"), F.col("__v")).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(g, "q").orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("__upto", F.sum("__c").over(w)).filter(F.col("__v").isNotNull())
    place = F.col("q") * (F.col("__n") - 1)
    picked = placed.groupBy(g, "q", "__n").agg(
        F.min(F.when(F.col("__upto") > F.floor(place), F.col("__v"))).alias("__vlo"),
        F.min(F.when(F.col("__upto") > F.ceil(place), F.col("__v"))).alias("__vhi"))
    return picked.select(g, "q", (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * (place - F.floor(place))).alias("quantile"))


def _split_brackets(x: DataFrame, brackets: DataFrame, g: str) -> DataFrame:
    """Brackets of at most MAX_INSIDE rows: a pass counts the rows below and inside each and cuts it into CUTS parts of
    about equal rows; the parts around the wanted place, with one more on either side, are the next bracket.

    A bracket that this does not narrow holds a value of more rows than a part, which is one row once summed by value.
    """
    grid = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])
    while True:
        rows = attach_small(x, brackets, g)
        b = rows.select(g, "__n", "__v", F.explode("__b").alias("b")).filter(F.col("__v") <= F.col("b.hi"))
        inside = F.col("__v") >= F.col("b.lo")
        cut = b.groupBy(g, "__n", "b").agg(
            F.count_if(~inside).alias("below"), F.count_if(inside).alias("inside"),
            F.percentile_approx(F.when(inside, F.col("__v")), grid, ACCURACY).alias("cuts"))
        # of the two order statistics around the place, as a share of the rows inside; the cuts' own rank error is below a part
        share = lambda place: (place - F.col("below")) / F.col("inside") * CUTS
        place = F.col("b.q") * (F.col("__n") - 1)
        lo = F.greatest(F.floor(share(F.floor(place))) - 1, F.lit(0)).cast("int")
        hi = F.least(F.ceil(share(F.ceil(place) + 1)) + 1, F.lit(CUTS)).cast("int")
        # the ends of the old bracket stay as they are
        new_lo = F.when(lo <= 0, F.col("b.lo")).otherwise(F.get("cuts", lo))
        new_hi = F.when(hi >= CUTS, F.col("b.hi")).otherwise(F.get("cuts", hi))
        narrows = (F.col("inside") > MAX_INSIDE) & ((new_lo > F.col("b.lo")) | (new_hi < F.col("b.hi")))
        cut = written(cut.select(g, "__n", narrows.alias("narrows"), F.when(narrows, F.struct(
            F.col("b.q").alias("q"), new_lo.alias("lo"), new_hi.alias("hi"))).otherwise(F.col("b")).alias("b")), "cuts")
        if cut.filter("narrows").limit(1).isEmpty():
            return brackets
        brackets = written(cut.groupBy(g, "__n").agg(F.collect_list("b").alias("__b")), "brackets")


def describe(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """``describe()``: count, mean, sample std, min, 25/50/75 % (exact), max."""
    d, g = _group(df, group)
    base = d.groupBy(g).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                            F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                            F.max(value).alias("max"))
    qs = exact_quantiles(d, value, [0.25, 0.5, 0.75], g)
    wide = qs.groupBy(g).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    wide = wide.select(g, *[F.col(f"`{q}`").alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = base.join(wide, g, "left")
    return out.drop(_ONE) if not group else out


def box_summary(df: DataFrame, value: str, group: str | None = None, whisker: float = 1.5) -> DataFrame:
    """Box plot figures: quartiles, IQR, whiskers at the extreme points within 1.5 IQR, outliers."""
    d, g = _group(df, group)
    qs = exact_quantiles(d, value, [0.25, 0.5, 0.75], g)
    q = qs.groupBy(g).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    q = q.select(g, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = attach_small(d.select(g, value).filter(F.col(value).isNotNull()), q, g)
    lo_b = F.col("q1") - F.lit(whisker) * F.col("iqr")
    hi_b = F.col("q3") + F.lit(whisker) * F.col("iqr")
    agg = x.groupBy(g, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col(value) >= lo_b, F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= hi_b, F.col(value))).alias("whisker_high"),
        F.count_if((F.col(value) < lo_b) | (F.col(value) > hi_b)).alias("n_outliers"))
    return agg.drop(_ONE) if not group else agg


def histogram(df: DataFrame, value: str, bins: int = 30, group: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] with density = n / (N * width); empty bins included."""
    d, g = _group(df, group)
    x = d.select(g, value).filter(F.col(value).isNotNull())
    rng = x.groupBy(g).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"),
                           F.count(F.lit(1)).alias("__N"))
    xb = attach_small(x, rng, g)
    span = F.col("__hi") - F.col("__lo")
    edge = lambda i: F.col("__lo") + i * (span / bins)
    guess = F.least(F.floor((F.col(value) - F.col("__lo")) / span * bins) + 1, F.lit(bins)).cast("int")
    # the quotient may round across an edge: the edges themselves decide, as in numpy
    b = F.when(span == 0, F.lit(1)).when(F.col(value) < edge(guess - 1), guess - 1).when(
        (F.col(value) >= edge(guess)) & (guess < bins), guess + 1).otherwise(guess)
    counts = xb.groupBy(g, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(g, "__lo", "__hi", "__N", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    out = grid.join(counts, [g, "bin"], "left").select(
        g, "bin",
        (F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_low"),
        (F.col("__lo") + F.col("bin") * width).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.try_divide(F.coalesce("count", F.lit(0)).cast("double"), F.col("__N") * width).alias("density"))
    return out.drop(_ONE) if not group else out


def normal_fit(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Maximum-likelihood normal fit (mean, population std) and the density at the mean."""
    d, g = _group(df, group)
    out = d.groupBy(g).agg(F.avg(value).alias("mu"), F.stddev_pop(value).alias("sigma"))
    out = out.withColumn("pdf_at_mu", F.lit(1.0) / (F.col("sigma") * F.lit(math.sqrt(2 * math.pi))))
    return out.drop(_ONE) if not group else out


def normal_curve(df: DataFrame, value: str, points: int = 100, group: str | None = None) -> DataFrame:
    """The fitted normal density at ``points`` evenly spaced values from min to max (D17):
    one row per (group, point), built from one aggregate per group."""
    d, g = _group(df, group)
    st = d.groupBy(g).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"),
                          F.avg(value).alias("__mu"), F.stddev_pop(value).alias("__sd"))
    x = F.col("__lo") + F.col("i") * ((F.col("__hi") - F.col("__lo")) / (points - 1))
    out = (st.select(g, "__lo", "__hi", "__mu", "__sd", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
           .select(g, "i", x.alias("x"), normal_pdf(x, F.col("__mu"), F.col("__sd")).alias("pdf")))
    return out.drop(_ONE) if not group else out


def normal_pdf(x, mu, sigma):
    """Column expression of the normal density."""
    z = (x - mu) / sigma
    return F.exp(F.lit(-0.5) * z * z) / (sigma * F.lit(math.sqrt(2 * math.pi)))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise-complete, as (var_a, var_b, r)."""
    cells = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                      F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
             for a in cols for b in cols]
    return df.agg(F.array(*cells).alias("m")).select(F.explode("m").alias("c")).select("c.*")


def mean_std_by(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """``groupby(g).agg(['mean', 'std'])``."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return df.groupBy(group).agg(*aggs)


def zscore(df: DataFrame, cols: list[str], group: str | None = None, suffix: str = "_z",
           fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, like ``StandardScaler`` (K1).

    ``fit``: rows to take mean and std from (e.g. the training split); default ``df``.
    """
    d, g = _group(df, group)
    f = _group(fit, group)[0] if fit is not None else d
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__mu_{c}"), F.stddev_pop(c).alias(f"__sd_{c}")]
    stats = f.groupBy(g).agg(*aggs)
    out = attach_small(d, stats, g)
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.try_divide(F.col(c) - F.col(f"__mu_{c}"), F.col(f"__sd_{c}")))
    out = out.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])
    return out.drop(_ONE) if not group else out


def minmax_fit(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    d, g = _group(df, group)
    return d.groupBy(g).agg(F.min(col).alias("__min"), F.max(col).alias("__max"))


def minmax_scale(df: DataFrame, col: str, group: str | None = None, out: str | None = None,
                 fitted: DataFrame | None = None) -> DataFrame:
    """``MinMaxScaler((0, 1))``; pass ``fitted`` to scale with statistics fitted elsewhere (K2)."""
    d, g = _group(df, group)
    stats = fitted if fitted is not None else minmax_fit(d, col, g)
    res = attach_small(d, stats, g)
    res = res.withColumn(out or f"{col}_scaled",
                         F.try_divide(F.col(col) - F.col("__min"), F.col("__max") - F.col("__min")))
    res = res.drop("__min", "__max")
    return res.drop(_ONE) if not group else res


def minmax_inverse(df: DataFrame, col: str, fitted: DataFrame, group: str | None = None,
                   out: str | None = None) -> DataFrame:
    d, g = _group(df, group)
    res = attach_small(d, fitted, g)
    res = res.withColumn(out or f"{col}_inv", F.col(col) * (F.col("__max") - F.col("__min")) + F.col("__min"))
    res = res.drop("__min", "__max")
    return res.drop(_ONE) if not group else res


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA: F, df_between, df_within from one aggregate per group."""
    x = df.select(group, value).filter(F.col(value).isNotNull())
    per = x.groupBy(group).agg(F.count(F.lit(1)).alias("__n"), F.avg(value).alias("__m"),
                               (F.var_pop(value) * F.count(F.lit(1))).alias("__ssw"))
    grand = per.agg((F.sum(F.col("__n") * F.col("__m")) / F.sum("__n")).alias("__grand"))
    per = attach_one(per, grand)
    dev = F.col("__m") - F.col("__grand")
    tot = per.agg(F.sum("__n").alias("N"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("__n") * dev * dev).alias("ssb"), F.sum("__ssw").alias("ssw"))
    return tot.select(
        (F.col("ssb") / (F.col("k") - 1) / (F.col("ssw") / (F.col("N") - F.col("k")))).alias("f_stat"),
        (F.col("k") - 1).cast("int").alias("df_between"),
        (F.col("N") - F.col("k")).cast("int").alias("df_within"))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        for aa in (m * (b - m) * x / ((qam + m2) * (a + m2)),
                   -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))):
            d = 1.0 + aa * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + aa / c
            c = c if abs(c) > tiny else tiny
            delta = d * c
            h *= delta
        if abs(delta - 1.0) < 3e-16:
            break
    return h


def betainc_regularized(a: float, b: float, x: float) -> float:
    """I_x(a, b) by the continued fraction (driver-side scalar helper)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F distribution."""
    if f is None or f != f:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc_regularized(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def anova_test(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> dict:
    """F, degrees of freedom, p-value and the 5 % decision; the p-value is a driver-side scalar."""
    row = anova_oneway(df, value, group).first()
    p = f_sf(row["f_stat"], row["df_between"], row["df_within"])
    return {"f_stat": row["f_stat"], "df_between": row["df_between"], "df_within": row["df_within"],
            "p_value": p, "reject_h0": bool(p < alpha)}


def regression_impute(df: DataFrame, targets: list[str], feature: str, group: str | None = None) -> DataFrame:
    """Fill NULL targets with intercept + slope * feature, fitted on complete pairs."""
    d, g = _group(df, group)
    aggs = []
    for t in targets:
        aggs += [F.regr_slope(F.col(t), F.col(feature)).alias(f"__b_{t}"),
                 F.regr_intercept(F.col(t), F.col(feature)).alias(f"__a_{t}")]
    fit = d.groupBy(g).agg(*aggs)
    out = attach_small(d, fit, g)
    for t in targets:
        out = out.withColumn(t, F.coalesce(F.col(t), F.col(f"__a_{t}") + F.col(f"__b_{t}") * F.col(feature)))
    out = out.drop(*[f"__a_{t}" for t in targets], *[f"__b_{t}" for t in targets])
    return out.drop(_ONE) if not group else out


def mean_impute(df: DataFrame, cols: list[str], group: str | None = None) -> DataFrame:
    """``fillna(mean())`` per column."""
    d, g = _group(df, group)
    means = d.groupBy(g).agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    out = attach_small(d, means, g)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__mean_{c}")))
    out = out.drop(*[f"__mean_{c}" for c in cols])
    return out.drop(_ONE) if not group else out


def regression_metrics(df: DataFrame, y: str, yhat: str, group: str | None = None) -> DataFrame:
    """MSE, RMSE, MAE and R^2 = 1 - SSE/SST over rows with both values."""
    d, g = _group(df, group)
    x = d.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    err = F.col(y) - F.col(yhat)
    m = x.groupBy(g).agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                         F.sum(err * err).alias("__sse"), (F.var_pop(y) * F.count(y)).alias("__sst"),
                         F.count(F.lit(1)).alias("n"))
    m = m.select(g, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                 (F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("__sst"))).alias("r2"))
    return m.drop(_ONE) if not group else m
