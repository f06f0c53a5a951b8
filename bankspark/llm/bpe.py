"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Each word is a row of a batch.  The leaves of its tree hold ``rank * positions + position`` for every
adjacent pair, infinity for a pair without a merge, and each inner node the least of its children; so the
root is the leftmost pair of lowest rank.  A merge joins the two symbols, clears the right one and changes
the leaves of the pairs left and right of it, each with a logarithmic climb to the root.  All words of a
batch with a tree of the same size take their next merge in the same numpy operations, until no root
holds a mergeable pair.  Fewer than ``TOGETHER`` words of a size (so any very long word) take their merges one
by one on a plain tree whose climbs end where a node keeps its value.  Only words that are new to a Python
worker are encoded (``words.Words``).

Defined cases: null text counts as empty and has no ids and an empty decoding; special tokens written in
a text become their ids, as the vocabulary file asks; a word of any length is one row with a tree of its
own size; repeated rows get equal results; an empty table gives an empty result; further columns ride
along only where asked for.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark.llm.arrow_text import column, slices, text_bytes
from bankspark.llm.words import MAX_WORDS, Words

_NONE = np.iinfo(np.int64).max
_BATCH = 1 << 19  # tree leaves at once
TOGETHER = 16     # words from which merges in common pay


def byte_symbols() -> dict[int, str]:
    """Printable stand-in of each byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Vocabulary:
    """Merges, ids and tokens of a BPE file of the tokenizers library with byte symbols and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.specials = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        self.tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.specials}
        symbols = byte_symbols()
        self.inner = np.array([ids[symbols[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[symbols[b] + end] for b in range(256)], np.int64)
        pairs = np.array([(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]], np.int64).reshape(-1, 3)
        keys = pairs[:, 0] << 20 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        self._merged = pairs[:, 2]
        self.by_pair = dict(zip(self._keys.tolist(), self._ranks.tolist()))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where there is no merge."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each (already pre-tokenised) word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        out: list[list[int]] = [[]] * len(words)
        levels = np.ceil(np.log2(np.maximum(sizes - 1, 1))).astype(np.int64)
        for level in np.unique(levels).tolist():
            members = np.flatnonzero(levels == level)
            step = max(1, _BATCH >> level)
            for i in range(0, len(members), step):
                part = members[i:i + step]
                some = [raw[m] for m in part.tolist()]
                done = self._merge(some, sizes[part], 1 << level) if len(part) >= TOGETHER else map(self._merge_one, some)
                for m, ids in zip(part.tolist(), done):
                    out[m] = ids
        return out

    def _merge_one(self, raw: bytes) -> list[int]:
        """Ids of one word, from arrays of its own size."""
        size = len(raw)
        start = self.inner[np.frombuffer(raw, np.uint8)]
        start[-1] = self.last[raw[-1]]
        leaves = 1 << max(0, size - 2).bit_length()
        level = np.full(leaves, _NONE, np.int64)
        rank = self.ranks(start[:-1], start[1:])
        level[:size - 1] = np.where(rank >= 0, rank * size + np.arange(size - 1), _NONE)
        levels = [level]
        while len(level) > 1:
            level = np.minimum(level[::2], level[1::2])
            levels.append(level)
        tree = array("q", [_NONE])
        for level in reversed(levels):
            tree.frombytes(level.tobytes())
        symbol, follow = array("q", start.tobytes()), array("q", range(1, size + 1))
        before = array("q", range(-1, size - 1))
        ranks, merged = self.by_pair, self._merged

        def put(leaf: int, value: int) -> None:
            node = leaf + leaves
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                if other < value:
                    value = other
                if tree[node] == value:
                    return
                tree[node] = value

        while tree[1] != _NONE:
            rank, i = divmod(tree[1], size)
            j = follow[i]
            k = follow[i] = follow[j]
            symbol[i] = now = int(merged[rank])
            symbol[j] = -1
            if j < leaves:
                put(j, _NONE)
            value = _NONE
            if k < size:
                before[k] = i
                rank = ranks.get(now << 20 | symbol[k], -1)
                if rank >= 0:
                    value = rank * size + i
            put(i, value)
            p = before[i]
            if p >= 0:
                rank = ranks.get(symbol[p] << 20 | now, -1)
                put(p, rank * size + p if rank >= 0 else _NONE)
        return [x for x in symbol if x >= 0]

    def _merge(self, raw: list[bytes], sizes: np.ndarray, leaves: int) -> list[list[int]]:
        n, width = len(raw), leaves + 1
        data = np.frombuffer(b"".join(raw), np.uint8)
        inside = np.arange(width) < sizes[:, None]
        symbol = np.zeros((n, width), np.int64)
        symbol[inside] = self.inner[data]
        symbol[np.arange(n), sizes - 1] = self.last[data[np.cumsum(sizes) - 1]]
        follow = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        rank = self.ranks(symbol[:, :-1], symbol[:, 1:])
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        tree[:, leaves:] = np.where(inside[:, 1:] & (rank >= 0), rank * width + np.arange(leaves), _NONE)
        at = leaves
        while at > 1:
            tree[:, at // 2:at] = np.minimum(tree[:, at:2 * at:2], tree[:, at + 1:2 * at:2])
            at //= 2
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            rank, i = np.divmod(tree[rows, 1], width)
            j = follow[rows, i]
            k = follow[rows, j]
            symbol[rows, i] = self._merged[rank]
            symbol[rows, j] = -1
            follow[rows, i] = k
            more = k < sizes[rows]
            before[rows[more], k[more]] = i[more]
            self._set(tree, leaves, rows[j < leaves], j[j < leaves], None, width)
            value = self._pair(symbol, rows, i, np.minimum(k, width - 1), more, width)
            self._set(tree, leaves, rows, np.minimum(i, leaves - 1), value, width)
            p = before[rows, i]
            some = p >= 0
            value = self._pair(symbol, rows[some], p[some], i[some], None, width)
            self._set(tree, leaves, rows[some], p[some], value, width)
            rows = rows[tree[rows, 1] != _NONE]
        keep = inside & (symbol >= 0)
        flat, ends = symbol[keep], np.cumsum(keep.sum(axis=1))
        flat = flat.tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _pair(self, symbol: np.ndarray, rows: np.ndarray, left: np.ndarray, right: np.ndarray,
              valid: np.ndarray | None, width: int) -> np.ndarray:
        rank = self.ranks(symbol[rows, left], symbol[rows, right])
        good = rank >= 0 if valid is None else valid & (rank >= 0)
        return np.where(good, rank * width + left, _NONE)

    @staticmethod
    def _set(tree: np.ndarray, leaves: int, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray | None,
             width: int) -> None:
        """Set one leaf of each row and climb to the root."""
        node = leaf + leaves
        tree[rows, node] = _NONE if value is None else value
        while leaves > 1:
            leaves //= 2
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks; special tokens stay."""
        return " ".join([self.tokens[i] for i in ids])


class Codec:
    """What a Python worker keeps between batches: vocabulary, word table, and the texts made of each word's ids."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.words = Words(self.vocabulary.specials, self.vocabulary.encode_words)
        self._texts: list[tuple[bytes, bytes, int]] = []

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[list[int]], bytes, bytes]]:
        """(ids of each word, decimal ids joined by blanks, decoded UTF-8) of each text."""
        if len(self.words.ids) > MAX_WORDS:
            self.words.clear()
            self._texts.clear()
        numbers = [n.tolist() for n in self.words.numbers(texts)]
        ids, made = self.words.ids, self._texts
        for w in ids[len(made):]:
            made.append((" ".join(map(str, w)).encode(), self.vocabulary.decode(w).encode(), len(w)))
        for n in numbers:
            parts = [made[w] for w in n]
            yield [ids[w] for w in n], b" ".join([p[0] for p in parts]), b" ".join([p[1] for p in parts])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, path: str, keep: dict[str, Column], text_col: str = "text",
                  with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256; and on request ids (array<int>) and decoded (string).

    ``path`` is the vocabulary file, readable at the same place on every executor.
    """
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("__text"))
    names = list(keep)
    schema = rows.drop("__text").schema.add("n_tokens", "long").add("ids_sha256", "string")
    schema = schema.add("decoded_sha256", "string")
    more = []
    if with_ids:
        more.append("ids")
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if with_text:
        more.append("decoded")
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            texts = column(b, "__text")
            for i, j in slices(text_bytes(texts)[1]):
                out: dict[str, list] = {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", *more)}
                for words, numbers, decoded in own.encode(texts.slice(i, j - i).to_pylist()):
                    out["n_tokens"].append(numbers.count(b" ") + 1 if numbers else 0)
                    out["ids_sha256"].append(hashlib.sha256(numbers).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        out["ids"].append([x for w in words for x in w])
                    if with_text:
                        out["decoded"].append(decoded.decode())
                kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [column(b, n).slice(i, j - i) for n in names]
                    + [pa.array(v, kinds.get(n, pa.string())) for n, v in out.items()], [*names, *out])

    return rows.mapInArrow(run, schema)
