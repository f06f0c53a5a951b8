"""Sums of lagged products of long series.

For channels a and b of a series, S[k] = sum over t of a[t] * b[t - k], for every lag k up to a greatest one.  Correlations
at all lags and the normal equations of a model on lags need nothing else, so neither builds a window of lags per row.

The rows are read where the index has them and are never shuffled: a task sums the products of each stretch of
consecutive rows (by FFT, or by dot products for few lags) and keeps the stretch's first and last ``max_lag`` rows;
one pass over the stretches of a series adds the products across their borders.  A stretch is what a task reads of a series, so
a series has about as many as it has input splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.operators.series import G

DIRECT_LAGS = 64   # up to here dot products are used
Channels = Callable[[np.ndarray], np.ndarray]


def lagged_products(channels: np.ndarray, products: list[tuple[int, int]], max_lag: int) -> np.ndarray:
    """S of each product of channels (channels by rows): products by lags 0 .. max_lag."""
    n = channels.shape[1]
    out = np.zeros((len(products), max_lag + 1))
    if max_lag <= DIRECT_LAGS:
        for i, (a, b) in enumerate(products):
            for k in range(min(max_lag, n - 1) + 1):
                out[i, k] = channels[a, k:] @ channels[b, :n - k]
    elif n:
        size = 1 << (n + max_lag - 1).bit_length()
        spectrum = np.fft.rfft(channels, size)
        for i, (a, b) in enumerate(products):
            out[i] = np.fft.irfft(spectrum[a] * spectrum[b].conj(), size)[:max_lag + 1]
        out[:, n:] = 0.0
    return out


class Stretch:
    """Sums of consecutive rows, and the values of the first and last max_lag of them (columns by rows, NaN for NULL)."""

    def __init__(self, values: np.ndarray, channels: Channels, products: list, max_lag: int):
        self.channels, self.products, self.max_lag = channels, products, max_lag
        self.n = values.shape[1]
        self.head = values[:, :max_lag]
        self.tail = values[:, max(0, self.n - max_lag):]
        self.sums = self._of(values)

    def _of(self, values: np.ndarray) -> np.ndarray:
        return lagged_products(self.channels(values), self.products, self.max_lag)

    def extend(self, other: "Stretch") -> None:
        """Append the stretch that follows."""
        border = np.concatenate([self.tail, other.head], axis=1)
        self.sums = self.sums + other.sums + self._of(border) - self._of(self.tail) - self._of(other.head)
        if self.head.shape[1] < self.max_lag:
            self.head = np.concatenate([self.head, other.head], axis=1)[:, :self.max_lag]
        both = np.concatenate([self.tail, other.tail], axis=1)
        self.tail = both[:, max(0, both.shape[1] - self.max_lag):]
        self.n += other.n


def lagged_sums(indexed: DataFrame, series: str, cols: list[str], channels: Channels, products: list[tuple[int, int]],
                max_lag: int, finish: Callable[[Stretch], list[float]] | None = None) -> DataFrame:
    """(series, n, sums): ``sums`` has the products' S one after the other, or what ``finish`` makes of the whole series.

    ``channels`` turns column values (NaN for NULL) into the channels that ``products`` number; it must be zero where a
    value does not count.  ``indexed`` comes from ``with_index`` and should still have its order; otherwise stretches
    are short, which costs memory but is as exact.
    """
    kind = indexed.schema[series].dataType.simpleString()
    wide, lists = len(cols), pa.list_(pa.float64())
    keyed = indexed.select(F.col(series).alias("__s"), G, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    fields = ["__s", "__from", "__n", "__sums", "__head", "__tail"]

    def row(name: pa.Array, start: int, s: Stretch) -> pa.RecordBatch:
        short = s.n <= max_lag  # its head is the whole stretch
        arrays = [np.zeros(0) if short else s.sums, s.head, np.zeros(0) if short else s.tail]
        return pa.RecordBatch.from_arrays(
            [name, pa.array([start], pa.int64()), pa.array([s.n], pa.int64()),
             *[pa.ListArray.from_arrays(pa.array([0, a.size], pa.int32()), pa.array(np.ascontiguousarray(a).ravel())) for a in arrays]],
            fields)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, start = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if (np.diff(b.column(G).to_numpy()) < 0).any():
                b = b.sort_by(G)
            g = b.column(G).to_numpy()
            values = np.array([b.column(f"__x{i}").to_pandas().to_numpy(dtype="float64", na_value=np.nan) for i in range(wide)])
            code = b.column("__s").dictionary_encode().indices.fill_null(-1).to_numpy()
            cut = np.flatnonzero((np.diff(g) != 1) | (np.diff(code) != 0)) + 1
            for i, j in zip(np.append(0, cut), np.append(cut, len(g))):
                part, own = Stretch(values[:, i:j], channels, products, max_lag), b.column("__s").slice(i, 1)
                if held is not None and start + held.n == g[i] and own.equals(name):
                    held.extend(part)
                    continue
                if held is not None:
                    yield row(name, start, held)
                held, name, start = part, own, int(g[i])
        if held is not None:
            yield row(name, start, held)

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("__from")
        total = None
        for r in range(len(table)):
            n = table["__n"][r].as_py()
            sums, head, tail = (table[c][r].values.to_numpy() for c in ("__sums", "__head", "__tail"))
            part = Stretch(head.reshape(wide, -1), channels, products, max_lag)
            if n > max_lag:
                part.n, part.sums, part.tail = n, sums.reshape(len(products), -1), tail.reshape(wide, -1)
            if total is None:
                total = part
            else:
                total.extend(part)
        values = finish(total) if finish else total.sums.ravel().tolist()
        return pa.table({series: table["__s"].slice(0, 1), "n": pa.array([total.n], pa.int64()), "sums": pa.array([values], lists)})

    parts = keyed.mapInArrow(stretches, f"__s {kind}, __from long, __n long, __sums array<double>, __head array<double>, __tail array<double>")
    return parts.groupBy("__s").applyInArrow(join, f"`{series}` {kind}, n long, sums array<double>")


# ---- correlation at every lag (K11) -----------------------------------------------------------------------------------


def lag_correlations(indexed: DataFrame, series: str, value: str, variables: list[str], max_lag: int) -> DataFrame:
    """(series, variable, lag, r): Pearson correlation of ``value`` with each variable ``lag`` rows before, lags 1 .. max_lag.

    Pairs with a NULL do not count; r is NULL without two pairs or without variance.  Values are centred and scaled by the
    whole table's mean and deviation first (one aggregate), which leaves r as it is and keeps the sums exact.
    """
    cols = [value, *[v for v in variables if v != value]]
    stats = indexed.agg(*[f(F.col(c).cast("double")) for c in cols for f in (F.avg, F.stddev_pop)]).first()
    centre = np.array([m or 0.0 for m in stats[::2]])
    spread = np.array([s or 1.0 for s in stats[1::2]])

    def channels(values: np.ndarray) -> np.ndarray:
        known = ~np.isnan(values)
        x = np.where(known, (values - centre[:, None]) / spread[:, None], 0.0)
        return np.concatenate([known.astype(float), x, x * x])

    w = len(cols)
    products = [p for v in variables for j in [cols.index(v)] for p in
                ((0, j), (w, j), (2 * w, j), (0, w + j), (0, 2 * w + j), (w, w + j))]

    def finish(s: Stretch) -> list[float]:
        out = []
        for n, sx, sxx, sy, syy, sxy in s.sums.reshape(len(variables), 6, -1)[:, :, 1:]:
            n = np.rint(n)
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy, c = sxx / n - (sx / n) ** 2, syy / n - (sy / n) ** 2, sxy / n - sx / n * (sy / n)
                r = c / np.sqrt(vx * vy)
                flat = (n < 2) | (vx <= 1e-13 * (sxx / n)) | (vy <= 1e-13 * (syy / n))
            out.append(np.where(flat, np.nan, np.clip(r, -1.0, 1.0)))
        return np.concatenate(out).tolist()

    found = lagged_sums(indexed, series, cols, channels, products, max_lag, finish)
    names = F.array(*[F.lit(v) for v in variables])
    out = found.select(series, F.posexplode("sums").alias("at", "r"))
    return out.select(series, names[(F.col("at") / max_lag).cast("int")].alias("variable"),
                      (F.col("at") % max_lag + 1).cast("int").alias("lag"), F.when(~F.isnan("r"), F.col("r")).alias("r"))


# ---- least squares on lags (K22) --------------------------------------------------------------------------------------


def lag_gram(head: np.ndarray, tail: np.ndarray, sums: np.ndarray, total: float, n: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the full windows of one series: of y[t - i] * y[t - j], and of y[t - i], for i, j = 0 .. steps.

    The lagged products run over all pairs; those that no window holds are among the first and last ``steps`` values.
    """
    gram, means = np.zeros((steps + 1, steps + 1)), np.zeros(steps + 1)
    before, after = np.append(0.0, np.cumsum(head)), np.append(0.0, np.cumsum(tail[::-1]))
    for i in range(steps + 1):
        means[i] = total - before[steps - i] - after[i]
    for d in range(steps + 1):
        low = np.append(0.0, np.cumsum(head[:steps - d] * head[d:]))        # pairs that begin before s
        high = np.append(0.0, np.cumsum((tail[:steps - d] * tail[d:])[::-1]))  # the last pairs
        for j in range(d, steps + 1):
            gram[j - d, j] = gram[j, j - d] = sums[d] - low[steps - j] - high[j - d]
    return gram, means


def lag_least_squares(indexed: DataFrame, series: str, col: str, steps: int) -> tuple[list[float], float]:
    """(coefficients, oldest lag first, intercept) of the linear model of a value on the ``steps`` before it in its series.

    All full windows of all series count alike.  The normal equations come from lagged products; only their
    (steps + 2) squared sums reach the driver.  A NULL raises: gaps must be filled first.
    """
    width = (steps + 1) * (steps + 2) + 1

    def channels(values: np.ndarray) -> np.ndarray:
        if np.isnan(values).any():
            raise ValueError("NULL in a series: fill its gaps first")
        return np.concatenate([values, np.ones_like(values)])

    def finish(s: Stretch) -> list[float]:
        if s.n <= steps:
            return [0.0] * width
        gram, means = lag_gram(s.head[0], s.tail[0], s.sums[0], float(s.sums[1, 0]), s.n, steps)
        return [*gram.ravel().tolist(), *means.tolist(), float(s.n - steps)]

    per_series = lagged_sums(indexed, series, [col], channels, [(0, 0), (0, 1)], steps, finish).select("sums")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            total += b.column("sums").flatten().to_numpy().reshape(-1, width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["at", "s"])

    rows = per_series.mapInArrow(added, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros(width)
    for r in rows:
        sums[r["at"]] = r["s"]
    n = sums[-1]
    if not n:
        raise ValueError(f"no series has more than {steps} rows")
    gram, means = sums[:(steps + 1) ** 2].reshape(steps + 1, -1) / n, sums[(steps + 1) ** 2:-1] / n
    spread = gram - np.outer(means, means)
    by_lag = np.linalg.lstsq(spread[1:, 1:], spread[1:, 0], rcond=None)[0]
    return by_lag[::-1].tolist(), float(means[0] - by_lag @ means[1:])


def forecast_weights(coefficients: list[float], intercept: float, steps: int) -> np.ndarray:
    """Row h: weights of a window (oldest first) and the constant in the forecast h + 1 steps on.

    The forecast's recursion is the companion matrix of the window and a constant; step h reads off its power.
    """
    n = len(coefficients)
    companion = np.zeros((n + 1, n + 1))
    companion[np.arange(n - 1), np.arange(1, n)] = 1.0
    companion[n - 1] = [*coefficients, intercept]
    companion[n, n] = 1.0
    out, row = [], companion[n - 1]
    for _ in range(steps):
        out.append(row)
        row = row @ companion
    return np.array(out)
