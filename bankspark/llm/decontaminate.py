"""Benchmark decontamination: BM25 over an inverted index of the test items, searched by block-max WAND.

The index holds the items' words with BM25 impacts, each divided by the item's score against itself, so a
passage that contains the whole item scores 1 whatever its length, and one threshold serves all items.
Posting lists are cut into blocks of ``BLOCK`` items with the greatest impact of each.

Every document is cut into passages of 2 * s words, one every s words, where s is the longest item's number
of words; so any stretch as long as an item lies whole in one passage.  An item's low impacts, up to a total of
``MINOR``, cannot reach the threshold alone, so a passage without enough of its major words (the rest) is
no match; this bound is computed for all passages of a slice at once.  Any other passage is a query of
block-max WAND, which returns every item from the threshold on.  Each hit is
verified on the words: the last quarter of an item is its answer, the rest its question, and the passage
must hold at least ``QUESTION_OVERLAP`` and ``ANSWER_OVERLAP`` of their five-word shingles.

The items are indexed in shards of about ``SHARD_BYTES`` of text.  Number of items, word counts, mean length and longest
item are those of the whole benchmark, so results do not depend on how it is cut.  If there are several shards,
Spark counts the words, and each shard is one pass over the documents, whose result is written before the next shard
is read; so the driver and a task hold one shard at a time.  Documents are never shuffled.

Words are runs of letters, digits and non-ASCII characters after lower-casing.

Defined cases: null and empty texts match nothing, nor do items without words or without item_id; items
with equal texts are all reported; a question or answer shorter than five words is one shingle; repeated rows give
repeated results; a row without doc_id is reported with a null doc_id; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column, list_array, slices, text_bytes
from bankspark.llm.shingles import sequence_hash, word_hashes_of
from bankspark.session import written

K1, B = 1.2, 0.75
THRESHOLD = 0.6    # of an item's score against itself
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.8, 0.5  # of their shingles
MINOR = 0.3        # total of the impacts of an item's minor words
SHINGLE = 5
BLOCK = 16
SHARD_BYTES = 8 << 20
ANSWER_SHARE = 0.25
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[48:58] = _SEPARATOR[65:91] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each text and in all)."""
    return word_hashes_of(pc.utf8_lower(texts), _SEPARATOR)


class Corpus(NamedTuple):
    """What a shard needs to know of the whole benchmark; items without words do not count."""
    items: int
    words: int             # of all items
    longest: int           # words of an item
    terms: np.ndarray      # words of the shard
    counts: np.ndarray     # items of the benchmark that hold each


class Index:
    """Inverted index of one shard of items [(item_id, word hashes)], which are the whole benchmark if there is no corpus."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float = THRESHOLD, corpus: Corpus | None = None):
        items = [(i, w) for i, w in items if len(w)]
        self.ids = [i for i, _ in items]
        self.floor = threshold - 1e-9
        cuts = [len(w) - max(1, int(len(w) * ANSWER_SHARE)) for _, w in items]
        self.parts = [(_shingles(w[:c] if c else w), _shingles(w[c:])) for c, (_, w) in zip(cuts, items)]
        counts = [Counter(w.tolist()) for _, w in items]
        if corpus is None:
            df = Counter(t for c in counts for t in c)
            total, mean = len(items), sum(len(w) for _, w in items) / max(1, len(items))
            self.stride = max((len(w) for _, w in items), default=1)
        else:
            df = dict(zip(corpus.terms.tolist(), corpus.counts.tolist()))
            total, mean, self.stride = corpus.items, corpus.words / max(1, corpus.items), max(1, corpus.longest)
        postings: dict[int, list[tuple[int, float]]] = {}
        major: dict[int, list[tuple[int, float]]] = {}
        self.needed: list[float] = []  # of an item's major impacts
        for n, (c, (_, w)) in enumerate(zip(counts, items)):
            norm = K1 * (1 - B + B * len(w) / mean)
            scores = {t: math.log1p((total - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                      for t, tf in c.items()}
            own = sum(scores.values())
            low = 0.0
            for t, s in sorted(scores.items(), key=lambda x: (x[1], x[0])):
                postings.setdefault(t, []).append((n, s / own))
                if low + s / own <= MINOR:
                    low += s / own
                else:
                    major.setdefault(t, []).append((n, s / own))
            self.needed.append(self.floor - low)
        self.terms = np.array(sorted(postings), np.uint64)
        self.items = [[n for n, _ in postings[t]] for t in self.terms.tolist()]
        self.impacts = [[s for _, s in postings[t]] for t in self.terms.tolist()]
        self.blocks = [[max(s[i:i + BLOCK]) for i in range(0, len(s), BLOCK)] for s in self.impacts]
        self.best = [max(b) for b in self.blocks]
        lists = [major.get(t, []) for t in self.terms.tolist()]
        self.major_size = np.array([len(x) for x in lists] + [0])
        self.major_first = np.cumsum(self.major_size) - self.major_size
        self.major_items = np.array([n for x in lists for n, _ in x], np.int64)
        self.major_impacts = np.array([s for x in lists for _, s in x])

    def term_numbers(self, words: np.ndarray) -> np.ndarray:
        """Index of each word's term; the number of terms for words of no item."""
        at = np.searchsorted(self.terms, words)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == words, at, len(self.terms))

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: every (item, score) from the threshold on, for a query of distinct terms."""
        lists, impacts, blocks, best, floor = self.items, self.impacts, self.blocks, self.best, self.floor
        cursors = [(lists[t][0], t, 0) for t in terms]  # (item, term, place in the term's list)
        found = []
        while True:
            cursors.sort()
            bound, pivot = 0.0, -1
            for n, (_, t, _) in enumerate(cursors):
                bound += best[t]
                if bound >= floor:
                    pivot = n
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            tight, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.ids)
            for _, t, place in cursors[:pivot + 1]:  # block maxima at the pivot item
                at = bisect_left(lists[t], item, place)
                if at < len(lists[t]):
                    tight += blocks[t][at // BLOCK]
                    until = min(until, lists[t][min(at | (BLOCK - 1), len(lists[t]) - 1)] + 1)
            if tight < floor:
                target = max(until, item + 1)  # up to there no item can reach the threshold
            elif cursors[0][0] == item:
                score = sum(impacts[t][place] for _, t, place in cursors[:pivot + 1])
                if score >= floor:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            moved = []
            for _, t, place in cursors[:pivot + 1]:
                at = bisect_left(lists[t], target, place)
                if at < len(lists[t]):
                    moved.append((lists[t][at], t, at))
            cursors = moved + cursors[pivot + 1:]

    def overlaps(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the item's question and answer shingles in a passage."""
        out = []
        for n, part in self.parts[item]:
            held = set(sequence_hash(passage, np.arange(len(passage) - n + 1), n).tolist()) if len(passage) >= n else set()
            out.append(len(part & held) / len(part))
        return out[0], out[1]


def _shingles(words: np.ndarray) -> tuple[int, set[int]]:
    n = min(SHINGLE, len(words))
    return n, set(sequence_hash(words, np.arange(len(words) - n + 1), n).tolist())


def passages(first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of each passage, and passages per text, from the words before each text and in all."""
    counts = np.diff(first)
    number = np.where(counts > 0, np.maximum(1, -(-counts // stride) - 1), 0)
    text = np.repeat(np.arange(len(counts)), number)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)) * stride + first[text]
    return text, start, np.minimum(start + 2 * stride, first[text + 1]), number


def possible(terms: np.ndarray, first: np.ndarray, number: np.ndarray, index: Index) -> np.ndarray:
    """Passages that hold enough major words of some item (a repeated word counts again, so none is missed)."""
    size = index.major_size[terms]
    at = np.flatnonzero(size)
    size = size[at]
    where = np.repeat(at, size)
    posting = np.repeat(index.major_first[terms[at]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text = np.searchsorted(first, where, "right") - 1
    chunk = (where - first[text]) // index.stride
    before = np.cumsum(number) - number
    keys, weights = [], []
    for back in (0, 1):  # a chunk of words lies in the passage that it begins and in the one before
        inside = (chunk - back >= 0) & (chunk - back < number[text])
        keys.append((before[text] + chunk - back)[inside] * len(index.ids) + index.major_items[posting[inside]])
        weights.append(index.major_impacts[posting[inside]])
    keys, slot = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(slot, np.concatenate(weights), len(keys))
    return np.unique(keys[sums >= np.array(index.needed)[keys % len(index.ids)] - 1e-6] // len(index.ids))


def leaks_of(texts: pa.Array, index: Index) -> list[dict[int, tuple]]:
    """For each text {item: (score, question overlap, answer overlap, first word of the passage)}, the best passage."""
    words, first = words_of(texts)
    terms = index.term_numbers(words)
    text, start, end, number = passages(first, index.stride)
    out: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
    for k in possible(terms, first, number, index).tolist():
        query = np.unique(terms[start[k]:end[k]])
        for item, score in index.search(query[query < len(index.terms)].tolist()):
            question, answer = index.overlaps(item, words[start[k]:end[k]])
            best = out[text[k]].get(item)
            if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP and (best is None or score > best[0] + 1e-9):
                out[text[k]][item] = (score, question, answer, int(start[k] - first[text[k]]))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item in it: doc_id, item_id, score, question_overlap, answer_overlap, at_word."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"),
                                                           F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    if shards == 1:
        return _search_shard(source, sorted((r["item_id"], r["text"]) for r in items.distinct().collect()), threshold)
    shard = F.pmod(F.xxhash64("item_id"), F.lit(shards)).cast("int")
    items = written(items.distinct().withColumn("shard", shard), "benchmark-items")
    words = written(_item_words(items), "benchmark-words")
    total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    held = words.select("shard", F.explode("words").alias("word")).groupBy("word", "shard").agg(F.count(F.lit(1)).alias("n"))
    held = written(held, "benchmark-shard-words")
    counts = held.groupBy("word").agg(F.sum("n").alias("df"))
    held = written(held.select("word", "shard").join(counts, "word").sortWithinPartitions("shard"), "benchmark-counts")
    out = None
    for k in range(shards):
        rows = items.filter(F.col("shard") == k).select("item_id", "text").collect()
        df = held.filter(F.col("shard") == k).select("word", "df").toArrow()
        terms, n = (df[c].to_numpy() for c in ("word", "df"))
        corpus = Corpus(*total, terms.view(np.uint64), n)
        part = _search_shard(source, sorted((r["item_id"], r["text"]) for r in rows), threshold, corpus)
        part = written(part, "leaks")
        out = part if out is None else out.unionByName(part)
    return out


def _item_words(items: DataFrame) -> DataFrame:
    """(shard, n, words) of each item with words: number of words, and the distinct ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, shard = column(b, "text"), column(b, "shard").to_numpy()
            for i, j in slices(text_bytes(texts)[1]):
                words, first = words_of(texts.slice(i, j - i))
                n = np.diff(first)
                parts = [np.unique(words[x:y]) for x, y in zip(first[:-1], first[1:]) if y > x]
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
                values = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard[i:j][n > 0]), pa.array(n[n > 0].astype(np.int64)),
                                                  list_array(pa.array(values), offsets)], ["shard", "n", "words"])

    return items.mapInArrow(run, "shard int, n long, words array<long>")


def _search_shard(source: DataFrame, items: list[tuple[int, str]], threshold: float,
                  corpus: Corpus | None = None) -> DataFrame:
    fields = {"doc_id": pa.int64(), "item_id": pa.int64(), "score": pa.float64(), "question_overlap": pa.float64(),
              "answer_overlap": pa.float64(), "at_word": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = words_of(pa.array([t for _, t in items], pa.string()))
        index = Index([(i, words[a:b]) for (i, _), a, b in zip(items, first[:-1], first[1:])], threshold, corpus)
        for b in batches:
            texts, ids = column(b, "text"), column(b, "doc_id").to_pylist()
            if not len(index.ids):
                continue
            for i, j in slices(text_bytes(texts)[1]):
                rows = [(ids[i + k], index.ids[item], *values) for k, found in enumerate(leaks_of(texts.slice(i, j - i), index))
                        for item, values in sorted(found.items())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(list(zip(*rows)) or [[]] * len(fields), fields.values())], list(fields))

    return source.mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, "
                                  "answer_overlap double, at_word long")
