"""Random forests of regression trees grown over Spark.

Spark's own forest collects every node on the driver and holds histograms of up to ``maxMemoryInMB`` in a task, so deep trees
over many rows fit neither.  Here trees are grown in two steps and never collected:

* a node of more than ``GROUP_ROWS`` rows is split by one aggregate: tasks count the drawn rows in histograms, the sums of a node meet
  in one group, and the driver gets the split found there; all rows of its children are counted by the next aggregate;
* the rows of each smaller node are dealt to a group, which grows the rest of that branch level by level from the drawn rows, lets
  the others walk down and predicts, so no tree is stored: what leaves the group are the predictions, summed over the trees by row.

The rules are those of Spark's forest: Poisson(1) bootstrap, thresholds from 32 quantile bins, a new draw of ceil(sqrt(features))
features a node, the largest reduction of the variance, at least ``min_leaf`` bootstrap rows a side.  Every draw is a hash of the seed, the tree and the
row's values or the node's path, so a forest does not depend on how rows are partitioned or branches are dealt.

A row's path passes the leaf of every lesser depth and every larger ``min_samples_split``, and a shorter forest is the first trees
of a longer one: one growth gives the predictions of all these cuts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark.session import written

BINS = 32
GROUP_ROWS = 400_000    # rows of a branch that one group grows: about 100 MB
DEAL_ROWS = 60_000_000  # row copies dealt at a time: about 2.5 GB of shuffle
OPEN_NODES = 2_000      # histograms in a task at a time: about 10 MB
BATCH = 1 << 16         # rows at a time in a task, but for an Arrow batch: about 3 MB
LINES = 512             # nodes at a time in a group: their histograms of a feature stay in the cache
ROWS = 8192             # rows at a time in a group, likewise
FEW = (4, 8, 16)        # nodes of up to so many rows are split without histograms
BLOCK = 16              # bits of a row's place in its block
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
# the draw by the first 16 bits of a hash, 255 where the others decide
_DRAWN = np.searchsorted(_POISSON, np.arange(1 << 16) * 2.0 ** -16, side="right").astype(np.uint8)
_DRAWN[(_POISSON[_POISSON < 1] * 2 ** 16).astype(np.int64)] = 255


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number (splitmix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _root(seed: int, tree: int) -> np.ndarray:
    return _mix(np.array([(seed << 32) + tree + 1], dtype=np.uint64))


def draws(row: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row occurs in the tree's bootstrap sample."""
    bits = _mix(row.view(np.uint64) ^ _root(seed, tree))
    out = _DRAWN[bits >> np.uint64(48)]
    odd = np.flatnonzero(out == 255)
    out[odd] = np.searchsorted(_POISSON, (bits[odd] >> np.uint64(11)) * 2.0 ** -53, side="right")
    return out


def _features(path: np.ndarray, width: int) -> np.ndarray:
    """The features that each node may split by, ascending."""
    take, keys, low = math.ceil(math.sqrt(width)), _mix(np.arange(1, width + 1)), np.uint64((1 << width.bit_length()) - 1)
    out, own = np.empty((len(path), take), np.int64), np.arange(width, dtype=np.uint64)
    for a in range(0, len(path), LINES):
        bits = _mix(path[a:a + LINES, None] ^ keys) & ~low | own
        bits.partition(take - 1, axis=1)
        out[a:a + LINES] = bits[:, :take] & low
    out.sort(axis=1)
    return out


def _children(path: np.ndarray) -> np.ndarray:
    """Paths of the left and the right child, two columns."""
    return np.stack([_mix(path ^ np.uint64(1)), _mix(path ^ np.uint64(2))], axis=1)


def _network(n: int) -> list[tuple[int, int]]:
    """Batcher's sorting network for n = 2, 4, 8, ... values: pairs to put in order."""
    pairs, p = [], 1
    while p < n:
        k = p
        while k:
            pairs += [(i + j, i + j + k) for j in range(k % p, n - k, 2 * k) for i in range(min(k, n - j - k))
                      if (i + j) // (2 * p) == (i + j + k) // (2 * p)]
            k //= 2
        p *= 2
    return pairs


_NETWORKS = {n: _network(n) for n in FEW}


def _codes(flat: np.ndarray, at: np.ndarray, node: np.ndarray, size: np.ndarray, choice: np.ndarray) -> np.ndarray:
    """bin * nodes + node of each row under each of its node's features: features by rows.

    The rows are in the order of the nodes; ``size``: rows of each node; ``at``: where a row's bins begin in ``flat``.
    """
    codes = np.stack([np.repeat(c, size) for c in choice.T])
    for a in range(0, len(at), ROWS):  # a block's bins stay in the cache for all features
        of, first = node[a:a + ROWS], at[a:a + ROWS]
        for code in codes[:, a:a + ROWS]:
            code += first
            code[:] = flat[code]
            code *= len(choice)
            code += of
    return codes


def _gains(left: np.ndarray, s: np.ndarray, n, t, min_leaf: int) -> np.ndarray:
    """What splits leave of the sum of squares, by rows and sum of the left sides; -1 where a side is too small."""
    right, gain, rest = n - left, s * s, t - s
    gain /= np.maximum(left, 1)
    rest *= rest
    rest /= np.maximum(right, 1)
    gain += rest
    gain[(left < min_leaf) | (right < min_leaf)] = -1.0
    return gain


def _lowers(gain: np.ndarray, n: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Whether a split lowers the variance."""
    return gain > t * t / np.maximum(n, 1) * (1 + 1e-12)


def _many(flat: np.ndarray, at: np.ndarray, size: np.ndarray, choice: np.ndarray, w: np.ndarray, wy: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """(place among the node's features, bin, whether it lowers the variance) of each node's best split, by histograms."""
    m = len(size)
    best, place, cut = np.full(m, -2.0), np.zeros(m, np.int64), np.zeros(m, np.int64)
    for k, code in enumerate(_codes(flat, at, np.repeat(np.arange(m), size), size, choice)):
        left, s = (np.bincount(code, x, BINS * m).reshape(BINS, m) for x in (w, wy))
        if not k:
            n, t = left.sum(axis=0), np.ascontiguousarray(s.T).sum(axis=1)
        for b in range(1, BINS - 1):
            left[b] += left[b - 1]
            s[b] += s[b - 1]
        gain = np.ascontiguousarray(_gains(left[:-1], s[:-1], n, t, min_leaf).T)
        b = gain.argmax(axis=1)
        gain = gain[np.arange(m), b]
        better = gain > best
        best, place, cut = np.where(better, gain, best), np.where(better, k, place), np.where(better, b, cut)
    return place, cut, _lowers(best, n, t)


def _few(flat: np.ndarray, at: np.ndarray, start: np.ndarray, size: np.ndarray, choice: np.ndarray, w: np.ndarray, wy: np.ndarray,
         min_leaf: int, most: int) -> tuple[np.ndarray, ...]:
    """As ``_many``, for nodes of at most ``most`` rows that begin at ``start``: their rows are put in the order of their bins.

    Sums are added in the order of the histograms (rows in a bin, then bins), so both find the same among splits that are equally good.
    """
    m, take = choice.shape
    bits = most.bit_length() - 1
    of = np.arange(most)[:, None]
    real = of < size
    of = np.minimum(start + of, len(at) - 1)
    # places without a row weigh nothing and come last
    w, wy = np.where(real, w[of], 0.0), np.where(real, wy[of], 0.0)
    bins = np.where(real[:, None], flat[at[of][:, None] + choice.T], np.uint8(BINS - 1))
    n = w.sum(axis=0)
    t = np.bincount((bins[:, 0] + np.arange(m) * BINS).ravel(), wy.ravel(), m * BINS).reshape(m, BINS).sum(axis=1)
    kind = np.uint8 if bits < 4 else np.uint16
    key = (bins.astype(kind) << kind(bits)) | np.arange(most, dtype=kind)[:, None, None]
    for a, b in _NETWORKS[most]:
        low = np.minimum(key[a], key[b])
        np.maximum(key[a], key[b], out=key[b])
        key[a] = low
    of = (key & kind(most - 1)) * np.int64(m) + np.arange(m)
    bins = key >> kind(bits)
    w, wy = w.ravel()[of], wy.ravel()[of]
    best, cut = np.full((take, m), -1.0), np.zeros((take, m), bins.dtype)
    left, own, before = np.zeros((take, m)), np.zeros((take, m)), np.zeros((take, m))
    for i in range(most - 1):
        left += w[i]
        own += wy[i]
        s = before + own
        ends = bins[i] != bins[i + 1]
        gain = _gains(left, s, n, t, min_leaf)
        better = ends & (gain > best)
        np.copyto(best, gain, where=better)
        np.copyto(cut, bins[i], where=better)
        np.copyto(before, s, where=ends)
        own[ends] = 0.0
    place = best.argmax(axis=0)
    each = np.arange(m)
    return place, cut[place, each], _lowers(best[place, each], n, t)


def _splits(flat: np.ndarray, at: np.ndarray, size: np.ndarray, choice: np.ndarray, w: np.ndarray, wy: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """(feature, bin, whether it lowers the variance) of each node's best split; the rows are in the order of the nodes."""
    m = len(size)
    start = np.cumsum(size) - size
    place, cut, found = np.empty(m, np.int64), np.empty(m, np.int64), np.empty(m, bool)
    least = 0
    for most in FEW:
        of = np.flatnonzero((size > least) & (size <= most))
        step = 16 * LINES // most
        for a in range(0, len(of), step):
            i = of[a:a + step]
            place[i], cut[i], found[i] = _few(flat, at, start[i], size[i], choice[i], w, wy, min_leaf, most)
        least = most
    of = np.flatnonzero(size > least)
    upto, a = np.cumsum(size[of]), 0
    while a < len(of):
        b = min(a + LINES, max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + 4 * ROWS, side="right"))))
        i, a = of[a:b], b
        if i[-1] - i[0] == len(i) - 1:
            rows = slice(start[i[0]], start[i[-1]] + size[i[-1]])
        else:
            rows = np.repeat(start[i] - (np.cumsum(size[i]) - size[i]), size[i])
            rows += np.arange(len(rows))
        place[i], cut[i], found[i] = _many(flat, at[rows], size[i], choice[i], w[rows], wy[rows], min_leaf)
    return choice[np.arange(m), place], cut, found


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, wanted: np.ndarray, above: list[tuple[float, float]], path: np.ndarray,
         closed: bool, min_leaf: int, depths: list[int], splits: list[int]) -> np.ndarray:
    """Predictions of the wanted rows of one branch under every (depth, split size): rows by depths by splits.

    ``above``: (bootstrap rows, mean) of the nodes that lead to the branch, from the root on; a ``closed`` one is the last of these.
    """
    width, last = bins.shape[1], depths[-1]
    flat, least, alive = np.ascontiguousarray(bins).ravel(), np.array(splits), np.ones((1, len(splits)), bool)
    value = np.zeros((1, len(depths), len(splits)))
    for depth, (count, mean) in enumerate(above):
        value[0, np.searchsorted(depths, depth):, alive[0]] = mean
        alive = alive & (count >= least)
    if closed:
        return np.repeat(value, len(y), axis=0)
    leaf, every = np.zeros(len(y), np.int64), flat
    # the rows drawn, in the order of their nodes; at: where a row's bins begin in flat
    rows = np.flatnonzero(w > 0)
    at, weight, sums, label = rows * width, w[rows], w[rows] * y[rows], y[rows]
    size, depth, first, levels, values = np.array([len(rows)]), len(above), 0, [], []
    while True:
        m, of = len(path), np.repeat(np.arange(len(path)), size)
        count, total = np.bincount(of, weight, m), np.bincount(of, sums, m)
        mean = total / np.maximum(count, 1)
        for j in range(len(splits)):
            value[alive[:, j], np.searchsorted(depths, depth):, j] = mean[alive[:, j], None]
        values.append(value)
        found = np.zeros(m, bool)
        if depth < last and len(rows):
            start = np.cumsum(size) - size
            alive = alive & (count[:, None] >= least)
            found = (count >= 2 * min_leaf) & (np.minimum.reduceat(label, start) < np.maximum.reduceat(label, start)) & alive.any(axis=1)
        feature, cut, child = np.zeros(m, np.uint16), np.zeros(m, np.uint8), np.full(m, -1, np.int32)
        for settled in (False, True):
            if settled and len(split):
                feature[split], cut[split], found[split] = _splits(flat, at, size, _features(path[split], width), weight, sums, min_leaf)
            # rows of nodes that stay whole are done
            inner = np.repeat(found if not settled else found[split], size)
            if not inner.all():
                out = np.flatnonzero(~inner)
                leaf[rows[out]] = first + of[out]
                keep = np.flatnonzero(inner)
                rows, at, weight, sums, label, of = (x[keep] for x in (rows, at, weight, sums, label, of))
            size = size[found] if not settled else size[found[split]]
            split = np.flatnonzero(found)
        child[split] = np.arange(len(split), dtype=np.int32)
        levels.append((first, child, len(split), feature, cut))
        if not len(split):
            break
        # left children first, then the right ones: rows of a node stay together and in order
        right = flat[at + np.repeat(feature[split], size)] > np.repeat(cut[split], size)
        order = np.concatenate([np.flatnonzero(~right), np.flatnonzero(right)])
        rights = np.add.reduceat(right, np.cumsum(size) - size, dtype=np.int64)
        size = np.concatenate([size - rights, rights])
        rows, at, weight, sums, label = (x[order] for x in (rows, at, weight, sums, label))
        path = _children(path[split]).T.ravel()
        value, alive = np.concatenate([value[split]] * 2), np.concatenate([alive[split]] * 2)
        first, depth = first + m, depth + 1
        if len(levels) % 4 == 0:  # bins in the order of the rows again
            flat, at = flat.reshape(-1, width)[at // width].ravel(), np.arange(len(at)) * width
    # the others only walk
    rows = np.flatnonzero(wanted & (w == 0))
    node, at = np.zeros(len(rows), np.int32), rows * width
    for first, child, lefts, feature, cut in levels:
        to = child[node]
        if (to < 0).any():
            out, keep = np.flatnonzero(to < 0), np.flatnonzero(to >= 0)
            leaf[rows[out]] = first + node[out]
            rows, at, node, to = (x[keep] for x in (rows, at, node, to))
        if not len(rows):
            break
        node = to + lefts * (every[at + feature[node]] > cut[node]).astype(np.int32)
    values = np.concatenate(values)
    out = np.zeros((len(y), len(depths), len(splits)))
    chosen = np.flatnonzero(wanted)
    out[chosen] = values[leaf[chosen]]
    return out


class Top:
    """The nodes of one tree that are split by aggregates, and the branches below them; node 0 is the root."""

    def __init__(self, path: np.ndarray, rows: int):
        self.path, self.rows, self.depth, self.parent = [path[0]], [rows], [0], [-1]
        self.left, self.feature, self.bin, self.count, self.mean = [-1], [0], [0], [0.0], [0.0]
        self.closed, self.counted = [False], [True]  # the rows of a node not yet counted are a guess

    def open(self, limit: int, max_depth: int) -> tuple[list[int], list[int]]:
        """(nodes to split, nodes whose rows are to be counted); the first are counted as well."""
        new = [i for i in range(len(self.rows)) if self.left[i] < 0 and not self.closed[i]]
        split = [i for i in new if self.depth[i] < max_depth and self.rows[i] > limit * (1 if self.counted[i] else 0.9)]
        return split, [i for i in new if not self.counted[i] and i not in set(split)]

    def settle(self, i: int, r, limit: int) -> None:
        """Takes over the rows of a node and, if they are too many, its split, or closes it where there is none."""
        self.rows[i], self.counted[i] = r["rows"], True
        if r["feature"] is None or r["rows"] <= limit:
            return
        self.count[i], self.mean[i] = r["count"], r["total"] / max(r["count"], 1)
        if r["feature"] < 0:
            self.closed[i] = True
            return
        self.feature[i], self.bin[i], self.left[i] = r["feature"], r["bin"], len(self.path)
        share = r["count_left"] / r["count"]
        for path, part in zip(_children(np.array([self.path[i]], dtype=np.uint64))[0], (share, 1 - share)):
            for column, v in ((self.path, path), (self.rows, r["rows"] * part), (self.depth, self.depth[i] + 1), (self.parent, i), (self.left, -1),
                              (self.feature, 0), (self.bin, 0), (self.count, 0.0), (self.mean, 0.0), (self.closed, False), (self.counted, False)):
                column.append(v)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """For ``_walk``: left child, feature and bin of each node, and the steps; rows stay in a node that is not split."""
        left = np.array(self.left)
        inner = left >= 0
        return np.where(inner, left, np.arange(len(left))), np.array(self.feature), np.where(inner, self.bin, 255).astype(np.uint8), max(self.depth)

    def leads(self, nodes: list[int]) -> np.ndarray:
        """Whether each node is one of these or above one."""
        out = np.zeros(len(self.left), bool)
        for i in nodes:
            while i >= 0 and not out[i]:
                out[i], i = True, self.parent[i]
        return out

    def above(self, i: int) -> list[tuple[float, float]]:
        chain = [] if not self.closed[i] else [(self.count[i], self.mean[i])]
        while (i := self.parent[i]) >= 0:
            chain.append((self.count[i], self.mean[i]))
        return chain[::-1]


def _walk(tables: tuple, flat: np.ndarray, at: np.ndarray, leads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, the node of each); ``at``: where a row's bins begin in ``flat``.  With ``leads``, rows of other nodes may be left out."""
    left, feature, cut, steps = tables
    rows, node = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    for _ in range(steps):
        # the right child follows the left one
        node = left[node] + (flat[at + feature[node]] > cut[node])
        if leads is not None:
            on = leads[node]
            if 4 * np.count_nonzero(on) < 3 * len(on):
                on = np.flatnonzero(on)
                rows, at, node = rows[on], at[on], node[on]
    return rows, node


def _sorted(code: np.ndarray) -> np.ndarray:
    """The order of the codes, equal ones as they come; small codes take a sixth of the time."""
    return np.argsort(code.astype(np.uint16) if len(code) and code.max() < 1 << 16 else code, kind="stable")


def _arrays(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """id, draw, y, whether the row trains, whether it is wanted, bins by rows; some batches at a time."""
    part, rows = [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            part, rows = [*part, batch], rows + batch.num_rows
        if rows >= BATCH or rows and batch is None:
            table = pa.Table.from_batches(part)
            bins = np.frombuffer(b"".join(table["bins"].to_pylist()), dtype=np.uint8).reshape(-1, width)
            yield (*(table[c].to_numpy() for c in ("id", "draw", "y", "trains", "wanted")), bins)
            part, rows = [], 0


FOUND = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("rows", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()),
                   ("count", pa.float64()), ("total", pa.float64()), ("count_left", pa.float64())])


def _tops(table: DataFrame, width: int, trees: list[tuple[int, int]], rows: int, max_depth: int, seed: int, limit: int) -> list[Top]:
    """The top of every tree, given as (min_leaf, number): one aggregate a level, for up to ``OPEN_NODES`` nodes."""
    spark = table.sparkSession
    tops = [Top(_root(seed, number), rows) for _, number in trees]
    while todo := [(t, split, only) for t, top in enumerate(tops) for split, only in [top.open(limit, max_depth)] if split or only]:
        while todo:
            part = [todo.pop()]
            while todo and sum(len(split) for _, split, _ in part) + len(todo[-1][1]) <= OPEN_NODES:
                part.append(todo.pop())
            held = spark.sparkContext.broadcast({t: (tops[t], split, only) for t, split, only in part})

            def count(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                sums, counts, first, plans = {}, {}, None, {}
                for t, (top, split, only) in held.value.items():
                    place = np.full(len(top.path), -1)
                    place[split + only] = np.arange(len(split) + len(only))
                    choice = _features(np.array([top.path[i] for i in split], dtype=np.uint64), width)
                    plans[t] = top.tables(), top.leads(split + only), place, choice
                    sums[t], counts[t] = np.zeros((choice.shape[1], 2, BINS * len(split))), np.zeros(len(split) + len(only), np.int64)
                for ids, draw, y, trains, wanted, bins in _arrays(batches, width):
                    first, flat, at = ids[0] if first is None else first, bins.ravel(), np.arange(len(ids)) * width
                    for t, (tables, leads, place, choice) in plans.items():
                        rows, node = _walk(tables, flat, at, leads)
                        node, w = place[node], draws(draw[rows], seed, trees[t][1]) * trains[rows]
                        use = (node >= 0) & ((w > 0) | wanted[rows])
                        counts[t] += np.bincount(node[use], minlength=len(counts[t]))
                        of = np.flatnonzero((node >= 0) & (node < len(choice)) & (w > 0))
                        if not len(of):
                            continue
                        of = of[_sorted(node[of])]
                        row, own = rows[of], w[of].astype(np.float64)
                        own_y = own * y[row]
                        for total, code in zip(sums[t], _codes(flat, row * width, node[of], np.bincount(node[of], minlength=len(choice)), choice)):
                            total[0] += np.bincount(code, own, sums[t].shape[2])
                            total[1] += np.bincount(code, own_y, sums[t].shape[2])
                for t, found in sums.items() if first is not None else ():
                    nodes, m = [*held.value[t][1], *held.value[t][2]], len(held.value[t][1])
                    found = [x.tobytes() for x in found.reshape(len(found), 2, BINS, m).transpose(3, 1, 0, 2)]
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()),
                                                      "first": pa.array([first] * len(nodes), pa.int64()), "rows": pa.array(counts[t]),
                                                      "sums": pa.array(found + [None] * (len(nodes) - m), pa.binary())})

            def split(records: pa.Table) -> pa.Table:
                t, node = records["tree"][0].as_py(), records["node"][0].as_py()
                top, records = held.value[t][0], records.sort_by("first")
                values = dict.fromkeys(FOUND.names) | {"tree": t, "node": node, "rows": pc.sum(records["rows"]).as_py()}
                if not records["sums"].null_count:
                    count, total = sum(np.frombuffer(x).reshape(2, -1, BINS) for x in records["sums"].to_pylist())
                    n, whole = count[0].sum(), total[0].sum()
                    gain = _gains(count.cumsum(axis=1)[:, :-1], total.cumsum(axis=1)[:, :-1], n, whole, trees[t][0])
                    place, b = np.unravel_index(gain.argmax(), gain.shape)
                    feature = _features(np.array([top.path[node]], dtype=np.uint64), width)[0, place]
                    values |= {"feature": int(feature) if _lowers(gain[place, b], n, whole) else -1, "bin": int(b), "count": float(n),
                               "total": float(whole), "count_left": float(count[place, :b + 1].sum())}
                return pa.table({k: [v] for k, v in values.items()}).cast(FOUND)

            counted = table.mapInArrow(count, "tree int, node int, first long, rows long, sums binary")
            for r in counted.groupBy("tree", "node").applyInArrow(
                    split, "tree int, node int, rows long, feature int, bin int, count double, total double, count_left double").collect():
                tops[r["tree"]].settle(r["node"], r, limit)  # one row a node
    return tops


_SUMS = "forest int, part int, tree int, block long, place binary, value binary"


def _packed(forest: int, part: int, tree: int, ids: np.ndarray, value: np.ndarray) -> Iterator[tuple]:
    """Values of rows with ascending ids, one record a block."""
    block = ids >> BLOCK
    cuts = np.flatnonzero(np.diff(block)) + 1
    for i, v in zip(np.split(ids, cuts), np.split(value, cuts)):
        yield forest, part, tree, int(i[0] >> BLOCK), (i & ((1 << BLOCK) - 1)).astype(np.uint16).tobytes(), np.ascontiguousarray(v).tobytes()


def _binary(cuts: np.ndarray, values: np.ndarray) -> pa.Array:
    """The values between one cut and the next as bytes."""
    one = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * one).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _table(records: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = ["forest", "part", "tree", "block", "place", "value"]
    return pa.table([pa.array([r[i] for r in records], k) for i, k in enumerate(kinds)], names=names)


def _grown(table: DataFrame, width: int, tops: dict[int, Top], trees: list[tuple[int, int]], forest_of: list[int], part_of: list[int],
           depths: list[int], splits: list[int], seed: int, limit: int) -> DataFrame:
    """Sums of the predictions by row over the trees of ``tops``, packed by block of rows."""
    spark = table.sparkSession
    held = spark.sparkContext.broadcast(tops)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = {t: (top.tables(), np.array(top.closed)) for t, top in held.value.items()}
        for ids, draw, y, trains, wanted, bins in _arrays(batches, width):
            flat, block = bins.ravel(), ids >> BLOCK
            of = np.cumsum(np.diff(block, prepend=block[0]) != 0)  # stretches of rows of one block
            for t, (tables, closed) in plans.items():
                w = draws(draw, seed, trees[t][1]) * trains
                use = np.flatnonzero((w > 0) | wanted)
                if not len(use):
                    continue
                _, node = _walk(tables, flat, use * width)
                code = node * (of[-1] + 1) + of[use]
                order = _sorted(code)
                use, code = use[order], code[order]
                cuts = np.append(np.append(0, np.flatnonzero(np.diff(code)) + 1), len(code))
                start, drawn = cuts[:-1], w[use] > 0
                node = node[order[start]]
                # rows of a closed node only get its mean: they stay in as many groups as records
                apart = np.where(closed[node], 1 + ids[use[start]], 0)
                packed = [_binary(cuts, (ids[use] & ((1 << BLOCK) - 1)).astype(np.uint16)), _binary(np.append(0, np.cumsum(drawn))[cuts], y[use[drawn]]),
                          _binary(cuts, w[use] + 128 * wanted[use].astype(np.uint8)), _binary(cuts, bins[use])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), t), pa.int32()), pa.array(node, pa.int32()), pa.array(apart), pa.array(block[use[start]]),
                                                  *packed], ["tree", "node", "apart", "block", "place", "y", "w", "bins"])

    def branch(records: pa.Table) -> pa.Table:
        t, node = records["tree"][0].as_py(), records["node"][0].as_py()
        top, places = held.value[t], records["place"].to_pylist()
        by = np.argsort(records["block"].to_numpy() << BLOCK | np.array([int.from_bytes(p[:2], "little") for p in places]))
        block, length = records["block"].to_numpy()[by], np.array([len(p) // 2 for p in places])[by]
        place, y, w, bins = (np.frombuffer(b"".join([column[i] for i in by]), dtype=kind) for column, kind in (
            (places, np.uint16), *((records[c].to_pylist(), kind) for c, kind in (("y", np.float64), ("w", np.uint8), ("bins", np.uint8)))))
        ids, wanted, w, bins = np.repeat(block << BLOCK, length) | place, w >= 128, w & 127, bins.reshape(-1, width)
        label = np.zeros(len(ids))
        label[w > 0] = y
        if (np.diff(ids) < 0).any():
            by = np.argsort(ids)
            ids, wanted, w, bins, label = ids[by], wanted[by], w[by], bins[by], label[by]
        value = grow(bins, label, w.astype(np.float64), wanted, top.above(node), np.array([top.path[node]], dtype=np.uint64),
                     top.closed[node], trees[t][0], depths, splits)
        return _table(list(_packed(forest_of[t], part_of[t], t, ids[wanted], value[wanted])) if wanted.any() else [])

    groups = sum(sum(1 for i in top.left if i < 0) for top in tops.values())
    dealt = table.mapInArrow(deal, "tree int, node int, apart long, block long, place binary, y binary, w binary, bins binary")
    grown = (dealt.repartition(min(groups, 4 * spark.sparkContext.defaultParallelism + groups // 16), "tree", "node", "apart")
             .groupBy("tree", "node", "apart").applyInArrow(branch, _SUMS))
    cuts = len(depths) * len(splits)

    def add(records: pa.Table) -> pa.Table:
        first = records.slice(0, 1).to_pylist()[0]
        sums, seen = np.zeros((1 << BLOCK, cuts)), np.zeros(1 << BLOCK, bool)
        for place, value in _in_order(records):
            place = np.frombuffer(place, np.uint16)
            sums[place] += np.frombuffer(value).reshape(len(place), cuts)
            seen[place] = True
        return _table(list(_packed(first["forest"], first["part"], first["tree"], (first["block"] << BLOCK) + np.flatnonzero(seen), sums[seen])))

    return grown.groupBy("forest", "part", "block").applyInArrow(add, _SUMS)


def _in_order(records: pa.Table) -> Iterator[tuple[bytes, bytes]]:
    """Always added in one order: by tree, then by rows, as a tree's branches share none."""
    records = records.select(["tree", "place", "value"]).sort_by("tree")
    return zip(records["place"].to_pylist(), records["value"].to_pylist())


def predictions(rows: DataFrame, features: str, label: str, key: str, trains: str, wanted: str, leaf_sizes: list[int], sizes: list[int],
                depths: list[int], splits: list[int], seed: int = 42, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The other columns of every wanted row, min_leaf, and the predictions under every (trees, depth, split size), in order, by the
    forests of each least leaf size, grown from the rows that train.

    ``features`` is a vector column.  Rows of the same key, label and features are drawn together.
    """
    spark = rows.sparkSession
    sizes, depths, splits = sorted(sizes), sorted(depths), sorted(splits)
    keep = [c for c in rows.columns if c != features]
    head = rows.select(features).first()
    if head is None:
        raise ValueError("no rows")
    width = len(head[0])
    x = rows.select(*keep, vector_to_array(features).alias("__x"))
    cuts = [i / BINS for i in range(1, BINS)]
    found = x.filter(trains).agg(F.avg(label), *[F.percentile_approx(F.col("__x")[i], cuts) for i in range(width)]).first()
    if found[0] is None:
        raise ValueError("no rows to train on")
    mean, edges = found[0], [np.unique(np.array(e)) for e in found[1:]]

    own = T.StructType([f for f in x.schema if f.name in keep])
    for name, kind in (("id", T.LongType()), ("draw", T.LongType()), ("y", T.DoubleType()), ("trains", T.BooleanType()),
                       ("wanted", T.BooleanType()), ("bins", T.BinaryType())):
        own = own.add("__bins" if name == "bins" else f"__{name}", kind)

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["__x"].flatten().to_numpy().reshape(-1, width)
            bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)
            others = [c for c in b.schema.names if c != "__x"]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in others), pa.array([r.tobytes() for r in bins], pa.binary())], [*others, "__bins"])

    y, in_train = F.col(label).cast("double"), F.coalesce(F.col(trains), F.lit(False))
    known = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit(f"{label} is NULL or NaN in a row that trains")).cast("double")).otherwise(y - F.lit(mean))
    numbered = x.select(*keep, F.monotonically_increasing_id().alias("__id"), F.xxhash64(key, label, "__x").alias("__draw"),
                        F.when(in_train, known).otherwise(0.0).alias("__y"), in_train.alias("__trains"),
                        F.coalesce(F.col(wanted), F.lit(False)).alias("__wanted"), "__x").filter("__trains or __wanted")
    table = written(numbered.mapInArrow(bin_rows, own), "forest-rows")
    plain = table.select(*[F.col(f"__{c}").alias(c) for c in ("id", "draw", "y", "trains", "wanted", "bins")])
    count = plain.count()
    trees = [(leaf, number) for leaf in leaf_sizes for number in range(sizes[-1])]
    forest_of = [leaf_sizes.index(leaf) for leaf, _ in trees]
    part_of = [sum(number >= s for s in sizes) for _, number in trees]
    tops = _tops(plain, width, trees, count, depths[-1], seed, group_rows)
    step = max(1, DEAL_ROWS // (count * max(1, len(depths) * len(splits) // 4)))
    sums = []
    for a in range(0, len(trees), step):
        if sums:  # else the shuffle files of all rounds stay until the driver happens to collect its garbage
            spark.sparkContext._jvm.System.gc()
        dealt = {t: tops[t] for t in range(a, min(a + step, len(trees)))}
        sums.append(written(_grown(plain, width, dealt, trees, forest_of, part_of, depths, splits, seed, group_rows), "forest-sums"))
    whole = sums[0]
    for more in sums[1:]:
        whole = whole.unionAll(more)
    cells = len(depths) * len(splits)

    def rows_of(records: pa.Table) -> pa.Table:
        forest, block = records["forest"][0].as_py(), records["block"][0].as_py()
        out, seen = np.zeros((len(sizes), 1 << BLOCK, cells)), np.zeros(1 << BLOCK, bool)
        for part in range(len(sizes)):
            for place, value in _in_order(records.filter(pc.equal(records["part"], part))):
                place = np.frombuffer(place, np.uint16)
                out[part, place] += np.frombuffer(value).reshape(len(place), cells)
                seen[place] = True
        at = np.flatnonzero(seen)
        out = np.cumsum(out[:, at], axis=0) / np.array(sizes)[:, None, None] + mean
        flat = np.ascontiguousarray(out.transpose(1, 0, 2)).reshape(len(at), -1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))
        return pa.table({"min_leaf": pa.array([leaf_sizes[forest]] * len(at), pa.int32()), "__id": (block << BLOCK) + at, "predictions": lists})

    summed = whole.groupBy("forest", "block").applyInArrow(rows_of, "min_leaf int, __id long, predictions array<double>")
    return table.select(*keep, "__id").join(summed, "__id").drop("__id")


def cut_keys(sizes: list[int], depths: list[int], splits: list[int]) -> list[tuple[int, int, int]]:
    """(trees, depth, split size) of each place of ``predictions``."""
    return list(product(sorted(sizes), sorted(depths), sorted(splits)))
