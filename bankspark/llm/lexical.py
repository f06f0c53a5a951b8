"""Ranked lexical search by blocked dense matrix products: every document against every item, the best ``k`` of each item.

Scores are sums of integer term impacts, so they are the same however documents are grouped.  Terms are runs of ASCII
letters, digits and non-ASCII characters, with A-Z lower-cased.  With N documents that hold a term, L terms in
them, n in a document, and df documents that hold a term, a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a
document's length factor is m = 100 - B + (B n N) div L, and tf occurrences give the impact
w * ((10^9 tf) div (1000 tf + 20 m)), with B = 50.

1. One pass over the texts writes each document as the numbers and counts of the items' terms in it.
2. Sums over that table give N, L and the df of the items' terms (one row a term).
3. One pass over that table scores: the items are cut into tiles of ``ITEM_TILE`` with a compact vocabulary of their own (the
   terms of the tile's items), cut again where it has over ``TERM_TILE`` terms or a sum could reach 2^53; ``DOC_TILE``
   documents at a time become a dense float64 matrix of impacts over those terms, and a BLAS product with the items' 0/1 matrix
   gives exact partial sums, which add up in 64-bit integers.
4. A task keeps the ``k`` best documents of each item; a document that ties with the last of them is judged by its
   doc_id.  Two window steps, by item and slice and then by item, leave the best k of all.

The items are held in shards of about ``SHARD_BYTES`` of text, one after the other, so neither the driver nor a task holds more
of the benchmark; documents are never shuffled, at most ``k`` rows a task and item are.

Defined cases: null and empty texts, and texts without terms, count for nothing and are never found; rows with one item_id
are one item, whose terms are those of all its rows, and rows without item_id are one as well; repeated documents are
ranked each; a null doc_id comes before others of its score; items without terms have no rows; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column, list_array, slices, text_bytes
from bankspark.session import written

K = 50
B = 50
ITEM_TILE, TERM_TILE, DOC_TILE = 64, 4096, 512
SHARD_BYTES = 8 << 20
TOP_SLICES = 16
_EXACT = 1 << 53
_IMPACT = 10 ** 6  # (10^9 tf) div (1000 tf + 20 m) is below it

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


# ---- 1. documents as numbers of the items' terms ---------------------------------------------------------------------


def _vectors(source: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for b in batches:
            texts, ids = column(b, "text"), column(b, "doc_id")
            for i, j in slices(text_bytes(texts)[1]):
                data, offsets = text_bytes(texts.slice(i, j - i))
                kept, sizes, stops, terms, counts = [], [], [0], [], []
                for k in range(j - i):
                    words = _terms(data[offsets[k]:offsets[k + 1]].tobytes())
                    if words:
                        held = Counter(map(number, words))
                        held.pop(None, None)
                        kept.append(i + k)
                        sizes.append(len(words))
                        terms.extend(held.keys())
                        counts.extend(held.values())
                        stops.append(len(terms))
                stops = np.array(stops)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                     list_array(pa.array(terms, pa.int32()), stops), list_array(pa.array(counts, pa.int64()), stops)],
                    ["doc_id", "n", "terms", "counts"])

    return source.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def _document_counts(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; one row a term and task is shuffled, one a term comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            total += np.bincount(column(b, "terms").flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["term", "df"])

    found = vectors.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def weights_of(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


# ---- 3. tiles and products -------------------------------------------------------------------------------------------


class Tile:
    """Items first .. first + number - 1 of a shard and their compact vocabulary in parts that are summed exactly."""

    def __init__(self, first: int, items: list[list[int]], weights: np.ndarray, term_tile: int = TERM_TILE):
        self.first, self.number = first, len(items)
        vocabulary = np.array(sorted({t for terms in items for t in terms}), np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []  # (terms, items by terms as 0/1)
        begin = bound = 0
        for at, t in enumerate(vocabulary.tolist()):
            most = int(weights[t]) * _IMPACT
            if at - begin == term_tile or bound + most >= _EXACT:
                self._part(vocabulary[begin:at], items)
                begin, bound = at, 0
            bound += most
        self._part(vocabulary[begin:], items)

    def _part(self, terms: np.ndarray, items: list[list[int]]) -> None:
        matrix = np.zeros((len(items), len(terms)))
        for n, held in enumerate(items):
            at = np.searchsorted(terms, held)
            at[at == len(terms)] = 0
            matrix[n, at[terms[at] == held]] = 1
        self.parts.append((terms, matrix))

    def scores(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (items by documents) from the documents' (term, document, impact)."""
        total = np.zeros((self.number, n_docs), np.int64)
        for own, matrix in self.parts:
            at = np.searchsorted(own, terms)
            at[at == len(own)] = 0
            here = own[at] == terms
            tile = np.zeros((len(own), n_docs))
            tile[at[here], docs[here]] = impacts[here]
            total += (matrix @ tile).astype(np.int64)
        return total


class Best:
    """The k best (score, doc) of each of some items, smaller docs first among equal scores; a null doc is smallest."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # item, score, doc, doc is not null

    def add(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        rows = [np.concatenate(x) for x in zip(self.rows, (item, scores[item, at], docs[at], known[at]))]
        order = np.lexsort((rows[2], rows[3], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        begin = np.searchsorted(rows[0], np.arange(len(self.floor)))
        place = np.arange(len(order)) - begin[rows[0]]
        full = place == self.k - 1
        self.floor[rows[0][full]] = rows[1][full]
        self.rows = [x[place < self.k] for x in rows]


def _scored(vectors: DataFrame, items: list[tuple[int | None, list[int]]], n_docs: int, n_terms: int, weights: np.ndarray,
            k: int) -> DataFrame:
    """(item_id, doc_id, score) of each task's k best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [Tile(i, [t for _, t in items[i:i + ITEM_TILE]], weights) for i in range(0, len(items), ITEM_TILE)]
        best = [Best(t.number, k) for t in tiles]
        for b in batches:
            for i in range(0, b.num_rows, DOC_TILE):
                part = b.slice(i, DOC_TILE)
                ids, lists = column(part, "doc_id"), column(part, "terms")
                sizes = np.array(lists.value_lengths())
                doc = np.repeat(np.arange(part.num_rows), sizes)
                terms = lists.flatten().to_numpy().astype(np.int64)
                tf = column(part, "counts").flatten().to_numpy()
                m = np.array([100 - B + B * n * n_docs // n_terms for n in column(part, "n").to_pylist()], np.int64)
                impacts = (weights[terms] * ((10 ** 9 * tf) // (1000 * tf + 20 * m[doc]))).astype(np.float64)
                docs, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
                for tile, top in zip(tiles, best):
                    top.add(tile.scores(terms, doc, impacts, part.num_rows), docs, known)
        for tile, top in zip(tiles, best):
            item, score, doc, known = top.rows
            names = [items[tile.first + n][0] for n in item.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(doc, pa.int64(), mask=~known), pa.array(score, pa.int64())],
                ["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


# ---- the operator ----------------------------------------------------------------------------------------------------


def ranked(docs: DataFrame, benchmark: DataFrame, k: int = K, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The ``k`` best documents with a score above 0 of each item: item_id, rank, doc_id, score."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    out = None
    for shard in range(shards):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard).collect()
        part = _search(source, [(r["item_id"], r["text"]) for r in rows], k)
        if shards > 1:
            part = written(part, "ranked")
        out = part if out is None else out.unionByName(part)
    best = lambda *by: F.row_number().over(
        Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first()))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(TOP_SLICES))
    out = out.withColumn("slice", part).withColumn("rank", best("item_id", "slice")).filter(F.col("rank") <= k)
    return (out.withColumn("rank", best("item_id")).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _search(source: DataFrame, rows: list[tuple[int | None, str]], k: int) -> DataFrame:
    """Each task's best documents for a shard of the items."""
    held: dict[int | None, set[bytes]] = {}
    for name, text in rows:
        held.setdefault(name, set()).update(_terms(text.encode()))
    vocabulary = {t: n for n, t in enumerate(sorted({t for terms in held.values() for t in terms}))}
    items = [(name, sorted(vocabulary[t] for t in terms)) for name, terms in
             sorted(held.items(), key=lambda x: (x[0] is not None, x[0] or 0)) if terms]
    vectors = written(_vectors(source, vocabulary), "term-counts")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = weights_of(n_docs, _document_counts(vectors, len(vocabulary)))
    return _scored(vectors, items, n_docs, n_terms, weights, k)
