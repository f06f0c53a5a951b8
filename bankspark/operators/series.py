"""Row-ordered series operators that scale to one very long series.

pandas-style ``shift``/``rolling``/``ewm`` are positional.  The obvious Spark
form, ``Window.partitionBy(series).orderBy(t)``, sends a whole series to one
task -- fatal when one series holds a third of the data.  Instead:

* ``with_index`` gives every row its global position ``g`` in (series, order)
  with a range-partitioned sort and per-partition offsets (one row per
  partition, broadcast), like RDD ``zipWithIndex``; the sorted rows are
  written as Parquet, so positions are stable if an executor is lost and
  later reads take only the columns they need.
* ``blocked`` cuts positions into blocks of ``block_rows`` and copies the
  last ``overlap`` rows of every block into the next one, so any window that
  looks back at most ``overlap`` rows is exact inside ``(series, block)``
  partitions of bounded size.
* recursive smoothers (EMA, RSI) compose each stretch of rows where it is
  stored, carry the states to the block starts with one fold over those
  summaries, and move the rows once, to blocks whose states are a vectorised
  prefix composition.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bankspark.operators.joins import attach_small
from bankspark.session import written

DEFAULT_BLOCK_ROWS = 1_000_000
G = "__bankspark_pos"   # global position in (series, order)
BLK = "__blk"      # block number
COPY = "__copy"    # True on overlap copies


def with_index(df: DataFrame, series: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Append ``G``: 0-based global position of the row in (series, *order).

    ``order`` must make the order total (add a unique tiebreak column).
    """
    spark = df.sparkSession
    keys = [series, *order]
    # without a number, adaptive execution merges the session's partitions by their size
    s = (df.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = s.withColumn("__pid", F.shiftright("__mid", 33)) \
         .withColumn("__loc", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    # the ids depend on the physical partitioning: materialise once so that the
    # counts below and the rows see the same ids (and recomputation cannot move them)
    s = written(s, "series")
    # rows before each partition, as zipWithIndex counts them: one row per partition
    counts = sorted(s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).collect())
    before = accumulate([r["__n"] for r in counts], initial=0)
    offsets = spark.createDataFrame([(r["__pid"], o) for r, o in zip(counts, before)], "__of long, __off long")
    s = s.join(F.broadcast(offsets), F.col("__pid") == F.col("__of"))
    return s.withColumn(G, F.col("__off") + F.col("__loc")).drop("__mid", "__pid", "__loc", "__of", "__off")


def series_stats(indexed: DataFrame, series: str, value: str | None = None) -> DataFrame:
    """One row per series: first global position and row count (and first non-null value)."""
    aggs = [F.min(G).alias("__g0"), F.count(F.lit(1)).alias("__len")]
    if value is not None:
        aggs += [F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(G))).alias("__first"),
                 F.min(F.when(F.col(value).isNotNull(), F.col(G))).alias("__g_first")]
    return indexed.groupBy(series).agg(*aggs)


def with_position(indexed: DataFrame, series: str, value: str | None = None) -> DataFrame:
    """Append ``__pos`` (0-based position within the series) and ``__len`` (series length)."""
    stats = series_stats(indexed, series, value)
    out = attach_small(indexed, stats, series)
    return out.withColumn("__pos", F.col(G) - F.col("__g0"))


def blocked(indexed: DataFrame, overlap: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rows tagged with their block, plus copies of each block's last ``overlap`` rows in the next."""
    if overlap >= block_rows:
        raise ValueError("block_rows must exceed the look-back")
    block = F.floor(F.col(G) / block_rows)
    if overlap == 0:
        return indexed.withColumn(BLK, block).withColumn(COPY, F.lit(False))
    in_tail = F.col(G) % block_rows >= block_rows - overlap
    blocks = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    return indexed.select("*", F.explode(blocks).alias(BLK)).withColumn(COPY, F.col(BLK) != block)


def block_window(series: str) -> Window:
    return Window.partitionBy(series, BLK).orderBy(G)


def lags(indexed: DataFrame, series: str, cols: list[str], ks: list[int],
         block_rows: int = DEFAULT_BLOCK_ROWS, name: str = "{col}_lag_{k}") -> DataFrame:
    """pandas ``shift(k)`` within each series for every (column, k)."""
    b = blocked(indexed, max(ks), block_rows)
    w = block_window(series)
    b = b.select("*", *[F.lag(c, k).over(w).alias(name.format(col=c, k=k)) for c in cols for k in ks])
    return b.filter(~F.col(COPY)).drop(BLK, COPY)


def rolling_mean(indexed: DataFrame, series: str, col: str, windows: list[int],
                 block_rows: int = DEFAULT_BLOCK_ROWS, name: str = "SMA_{n}") -> DataFrame:
    """pandas ``rolling(n).mean()``: NULL unless the last n rows are all present and non-null."""
    b = blocked(indexed, max(windows) - 1, block_rows)
    outs = []
    for n in windows:
        w = block_window(series).rowsBetween(-(n - 1), 0)
        outs.append(F.when(F.count(col).over(w) == n, F.avg(col).over(w)).alias(name.format(n=n)))
    return b.select("*", *outs).filter(~F.col(COPY)).drop(BLK, COPY)


def collect_lags(indexed: DataFrame, series: str, col: str, steps: int,
                 block_rows: int = DEFAULT_BLOCK_ROWS, out: str = "x",
                 include_incomplete: bool = False) -> DataFrame:
    """Supervised windows (K21): ``out`` = the previous ``steps`` values, oldest first."""
    b = blocked(indexed, steps, block_rows)
    w = block_window(series).rowsBetween(-steps, -1)
    b = b.select("*", F.collect_list(col).over(w).alias(out))
    b = b.filter(~F.col(COPY)).drop(BLK, COPY)
    return b if include_incomplete else b.filter(F.size(out) == steps)


def supervised_dataset(positioned: DataFrame, series: str, col: str, steps: int,
                       keep_last: bool = True, block_rows: int = DEFAULT_BLOCK_ROWS,
                       out: str = "x") -> DataFrame:
    """K21's two variants: every full window (``keep_last``), or without the series' final
    target as ``create_dataset(data, steps)`` builds it.  Needs ``with_position``."""
    w = collect_lags(positioned, series, col, steps, block_rows, out)
    return w if keep_last else w.filter(F.col("__pos") < F.col("__len") - 1)


def chrono_split(positioned: DataFrame, share_num: int = 4, share_den: int = 5,
                 out: str = "is_train") -> DataFrame:
    """``int(len * 0.8)`` first rows of each series are train (K16); needs ``with_position``."""
    cut = F.floor(F.col("__len") * share_num / share_den)
    return positioned.withColumn(out, F.col("__pos") < cut)


def nested_chrono_split(positioned: DataFrame, share_num: int = 4, share_den: int = 5) -> DataFrame:
    """Two sub-sequences (first 80 % / rest) of each series, each split 80/20 again.

    Adds ``subseq`` (1 or 2) and ``is_train`` from positions and lengths only: no window.
    """
    cut = F.floor(F.col("__len") * share_num / share_den)
    first = F.col("__pos") < cut
    sub_pos = F.when(first, F.col("__pos")).otherwise(F.col("__pos") - cut)
    sub_len = F.when(first, cut).otherwise(F.col("__len") - cut)
    return (positioned.withColumn("subseq", F.when(first, 1).otherwise(2))
            .withColumn("is_train", sub_pos < F.floor(sub_len * share_num / share_den)))


def latest(df: DataFrame, series: str, order: list[str], n: int, out: str = "back") -> DataFrame:
    """The last ``n`` rows of each series (F4), numbered from 1 for the last.  Spark keeps only the first n
    rows per series and task below the shuffle."""
    w = Window.partitionBy(series).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def forward_fill(indexed: DataFrame, series: str, cols: list[str],
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """pandas ``ffill`` in series order: last non-null value so far.

    Inside a block: ``last(ignorenulls)``; a block that starts with NULLs takes
    the last non-null value of earlier blocks from a per-block summary (one
    row per block) carried forward by a window over blocks.
    """
    own = indexed.withColumn(BLK, F.floor(F.col(G) / block_rows))
    w_in = Window.partitionBy(series, BLK).orderBy(G).rowsBetween(Window.unboundedPreceding, 0)
    filled = own.select("*", *[F.last(c, ignorenulls=True).over(w_in).alias(f"__in_{c}") for c in cols])
    summ = own.groupBy(series, BLK).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(G))).alias(f"__end_{c}") for c in cols])
    # one row per block of a series: rows / block_rows of them
    w_b = Window.partitionBy(series).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(series, BLK, *[F.last(f"__end_{c}", ignorenulls=True).over(w_b).alias(f"__carry_{c}")
                                       for c in cols])
    out = filled.join(carry, [series, BLK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"__in_{c}"), F.col(f"__carry_{c}")))
    return out.drop(BLK, *[f"__in_{c}" for c in cols], *[f"__carry_{c}" for c in cols])


# ---- recursive smoothers -----------------------------------------------------
#
# A smoother's step is affine in its state, y' = d * y + l, and so is every run of steps.  One scan of the index
# reads the rows where they lie and gives each stretch (consecutive rows of one series and block) its composed step; one
# pass over the stretches of a series carries the state to the start of each block; then the rows move once,
# to their block, whose states are a prefix composition from the carried one.


def affine_states(d, l):
    """(D, L) with the state after step i of y' = d[i] * y + l[i] equal to D[i] * y + L[i], by doubling steps."""
    import numpy as np

    d, l, step = np.array(d, dtype="float64"), np.array(l, dtype="float64"), 1
    while step < len(d) and d[step:].any():  # stops early once the start is forgotten
        l[step:] = d[step:] * l[:-step] + l[step:]
        d[step:] = d[step:] * d[:-step]
        step *= 2
    return d, l


def _value_steps(xs, alpha, ignore_na, gap):
    """pandas' ewm steps of the non-null values: (their places, d, l, NULLs after the last); ``gap`` NULLs come before."""
    import numpy as np

    at = np.flatnonzero(xs == xs)
    if not len(at):
        return at, at * 0.0, at * 0.0, gap + len(xs)
    beta, gaps = 1.0 - alpha, np.diff(at, prepend=-1 - gap) - 1
    if ignore_na:
        d, share = np.full(len(at), beta), np.full(len(at), alpha)
    else:  # the weight of the old state decays through the NULLs
        weight = beta ** (gaps + 1.0)
        d, share = np.where(gaps == 0, beta, weight / (weight + alpha)), np.where(gaps == 0, alpha, alpha / (weight + alpha))
    return at, d, share * xs[at], len(xs) - 1 - int(at[-1])


def _composed(d, l):
    """One step that equals the given ones in turn."""
    import numpy as np

    if not len(d):
        return 1.0, 0.0
    rest = np.cumprod(d[::-1])[::-1]
    return float(rest[0]), float((l * np.append(rest[1:], 1.0)).sum())


def _column(table, name):
    import numpy as np

    return table.column(name).to_numpy().astype("float64") if table.column(name).null_count == 0 else \
        np.array(table.column(name).to_pandas(), dtype="float64")


class _Ewm:
    """State of one ewm column: its value (NaN before the first) and the NULLs since."""

    def __init__(self, col, alpha, ignore_na):
        self.col, self.alpha, self.ignore_na, self.start = col, alpha, ignore_na, (float("nan"), 0.0)
        self.reads, self.width = [col], 6

    def summary(self, xs):
        """Of a stretch: rows, leading NULLs, first value, then the composed step of the others and the NULLs after."""
        (x,) = xs
        at, d, l, trail = _value_steps(x, self.alpha, self.ignore_na, 0)
        if not len(at):
            return [float(len(x)), float(len(x)), float("nan"), 1.0, 0.0, 0.0]
        return [float(len(x)), float(at[0]), float(x[at[0]]), *_composed(d[1:], l[1:]), float(trail)]

    def joined(self, one, two):
        """The summary of two stretches in turn."""
        n, lead, v, d, l, trail = one
        n2, lead2, v2, d2, l2, trail2 = two
        if v != v:
            return [n + n2, n + lead2, v2, d2, l2, trail2]
        if v2 != v2:
            return [n + n2, lead, v, d, l, trail + n2]
        _, (d0,), (l0,), _ = _value_steps(_array([v2]), self.alpha, self.ignore_na, int(trail + lead2))
        return [n + n2, lead, v, d2 * d0 * d, d2 * (d0 * l + l0) + l2, trail2]

    def after(self, state, summary, first):
        y, gap = state
        n, lead, v, d, l, trail = summary
        if v != v:
            return y, gap + n
        if y == y:
            _, (d0,), (l0,), _ = _value_steps(_array([v]), self.alpha, self.ignore_na, int(gap + lead))
            v = d0 * y + l0
        return d * v + l, trail

    def states(self, xs, state, first):
        import numpy as np

        (x,), (y, gap) = xs, state
        at, d, l, _ = _value_steps(x, self.alpha, self.ignore_na, int(gap))
        out = np.full(len(x), y)
        if len(at):
            if y != y:  # the first value starts the state
                d[0], l[0], y = 0.0, x[at[0]], 0.0
            big, small = affine_states(d, l)
            y = big * y + small
            out[at[0]:] = np.repeat(y, np.diff(at, append=len(x)))
        return [out]


class _Wilder:
    """State of Wilder's averages of rises and falls: both averages and the last value."""

    def __init__(self, col, alpha):
        self.col, self.alpha, self.start = col, alpha, (0.0, 0.0, float("nan"))
        self.reads, self.width = [col], 6

    def _moves(self, x, last):
        import numpy as np

        diff = np.diff(x, prepend=last)  # NaN next to a NULL: neither a rise nor a fall
        return np.where(diff > 0, diff, 0.0), np.where(diff < 0, -diff, 0.0)

    def summary(self, xs):
        (x,) = xs
        up, down = self._moves(x, float("nan"))
        beta = _array([1.0 - self.alpha]).repeat(len(x) - 1)
        d, rise = _composed(beta, self.alpha * up[1:])
        return [float(len(x)), float(x[0]), float(x[-1]), d, rise, _composed(beta, self.alpha * down[1:])[1]]

    def joined(self, one, two):
        n, head, tail, d, rise, fall = one
        n2, head2, tail2, d2, rise2, fall2 = two
        (u,), (f,) = self._moves(_array([head2]), tail)
        beta = 1.0 - self.alpha
        return [n + n2, head, tail2, d2 * beta * d, d2 * (beta * rise + self.alpha * u) + rise2,
                d2 * (beta * fall + self.alpha * f) + fall2]

    def after(self, state, summary, first):
        up, down, last = state
        _, head, tail, d, rise, fall = summary
        (u,), (f,) = self._moves(_array([head]), last)
        beta = 1.0 - self.alpha
        up, down = (u, f) if first else (self.alpha * u + beta * up, self.alpha * f + beta * down)
        return d * up + rise, d * down + fall, tail

    def states(self, xs, state, first):
        (x,), (y_up, y_down, last) = xs, state
        out = []
        for y, move in zip((y_up, y_down), self._moves(x, last)):
            d, l = _array([1.0 - self.alpha]).repeat(len(x)), self.alpha * move
            if first:
                d[0], l[0] = 0.0, move[0]
            big, small = affine_states(d, l)
            out.append(big * y + small)
        return out


def _array(values):
    import numpy as np

    return np.array(values, dtype="float64")


def _smoothed(indexed: DataFrame, series: str, smoothers: list, outs: list[str], block_rows: int, finish=None) -> DataFrame:
    """Append the smoothers' states (one column each, or what ``finish`` makes of them and the row's place in its series)."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    block = F.floor(F.col(G) / block_rows)
    reads = sorted({c for s in smoothers for c in s.reads})
    kind = indexed.schema[series].dataType.simpleString()
    keyed = indexed.select(F.col(series).alias("__s"), G, *[F.col(c).cast("double").alias(f"__x_{c}") for c in reads])

    def summaries(batches):
        """Each stretch of consecutive rows of a series and block in a batch."""
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(G).to_numpy()
            if (np.diff(g) < 0).any():
                b = b.sort_by(G)
                g = b.column(G).to_numpy()
            xs = {c: _column(b, f"__x_{c}") for c in reads}
            code = b.column("__s").dictionary_encode().indices.fill_null(-1).to_numpy()
            cut = np.flatnonzero((np.diff(g) != 1) | (np.diff(code) != 0) | (np.diff(g // block_rows) != 0)) + 1
            starts, stops = np.append(0, cut), np.append(cut, len(g))
            values = [[v for s in smoothers for v in s.summary([xs[c][i:j] for c in s.reads])] for i, j in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([b.column("__s").take(pa.array(starts)), pa.array(g[starts]), pa.array(values, pa.list_(pa.float64()))],
                                             ["__s", "__from", "__sum"])

    stretches = keyed.mapInArrow(summaries, f"__s {kind}, __from long, __sum array<double>")

    parts = np.cumsum([0, *[s.width for s in smoothers]])
    known = lambda values: [float("nan") if v is None else v for v in values]  # noqa: E731  NaN may come back as NULL

    def of_block(key, pdf):
        """The stretches of a block as one."""
        pdf = pdf.sort_values("__from")
        total = None
        for sums in map(known, pdf["__sum"]):
            total = sums if total is None else [v for s, a in zip(smoothers, parts) for v in
                                                s.joined(total[a:a + s.width], sums[a:a + s.width])]
        return pd.DataFrame({"__s": [pdf["__s"].iloc[0]], "__from": [int(pdf["__from"].iloc[0])], "__sum": [total]})

    def carry(pdf):
        """State at the start of each block of one series, in one pass over its blocks."""
        pdf = pdf.sort_values("__from")
        states, rows, begin = [s.start for s in smoothers], [], int(pdf["__from"].iloc[0])
        for name, start, sums in zip(pdf["__s"], pdf["__from"].tolist(), map(known, pdf["__sum"])):
            rows.append((name, start // block_rows, [float(v) for state in states for v in state], begin))
            states = [s.after(state, sums[a:a + s.width], start == begin) for s, state, a in zip(smoothers, states, parts)]
        return pd.DataFrame(rows, columns=["__s", BLK, "__state", "__g0"])

    # a stretch ends with its block or Arrow batch; a series has rows / block_rows blocks
    blocks = stretches.groupBy("__s", F.floor(F.col("__from") / block_rows)).applyInPandas(of_block, stretches.schema)
    starts = written(blocks.groupBy("__s").applyInPandas(carry, f"__s {kind}, {BLK} long, __state array<double>, __g0 long"), "carry")
    on = (F.col(series).eqNullSafe(F.col("__s"))) & (block == F.col(BLK))
    rows = attach_small(indexed, starts, on)
    fields = indexed.columns

    def replay(table):
        table = table.sort_by(G)
        state, g0 = known(table.column("__state")[0].as_py()), table.column("__g0")[0].as_py()
        g, made, at = table.column(G).to_numpy(), [], 0
        for s in smoothers:
            own = len(s.start)
            made += s.states([_column(table, f"__x_{c}") for c in s.reads], state[at:at + own], int(g[0]) == g0)
            at += own
        if finish:
            made = finish(made, g - g0)
        return pa.Table.from_arrays([*[table.column(c) for c in fields], *[pa.array(v, mask=v != v) for v in made]], [*fields, *outs])

    schema = StructType([*indexed.schema.fields, *[StructField(o, DoubleType()) for o in outs]])
    casts = [F.col(c).cast("double").alias(f"__x_{c}") for c in reads]
    return rows.select(*rows.columns, *casts).groupBy("__s", BLK).applyInArrow(replay, schema)


def ewm_adjust_false(indexed: DataFrame, series: str, cols: list[str], alphas: list[float],
                     outs: list[str], block_rows: int = DEFAULT_BLOCK_ROWS, ignore_na: bool = False) -> DataFrame:
    """pandas ``ewm(alpha=a, adjust=False, ignore_na=...).mean()`` per series for each column.

    y_0 = first non-null x, then y = a*x + (1-a)*y_prev; a NULL x keeps y, and with ``ignore_na=False``
    (the pandas default) the weight of y decays through the gap; rows before the first non-null value are
    NULL.  The rows are shuffled once, to blocks of ``block_rows`` rows.
    """
    return _smoothed(indexed, series, [_Ewm(c, a, ignore_na) for c, a in zip(cols, alphas)], outs, block_rows)


def ema_span(indexed: DataFrame, series: str, col: str, span: int, out: str | None = None,
             block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``ewm(span=s, adjust=False).mean()``: alpha = 2 / (s + 1)."""
    return ewm_adjust_false(indexed, series, [col], [2.0 / (span + 1)], [out or f"EMA_{span}"],
                            block_rows)


def rsi(indexed: DataFrame, series: str, col: str, window: int = 14, out: str | None = None,
        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Wilder RSI as the ``ta`` package computes it.

    diff = x - x_prev; up = diff where > 0 else 0; down = -diff where < 0 else
    0 (the first row counts as 0); both smoothed by ewm(alpha=1/window,
    adjust=False); NULL for the first window-1 rows; 100 where down is 0.
    The rows are shuffled once, to blocks of ``block_rows`` rows.
    """
    def index(states, place):
        import numpy as np

        up, down = states
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(down == 0, 100.0, 100.0 - 100.0 / (1.0 + up / down))
        return [np.where(place < window - 1, np.nan, value)]

    return _smoothed(indexed, series, [_Wilder(col, 1.0 / window)], [out or f"RSI_{window}"], block_rows, index)
