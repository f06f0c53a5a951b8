"""MinHash near-duplicate documents, with exact links and connected components.

1. Each document becomes its set of word shingles (``shingles``), ``BANDS * ROWS`` minima of universal
   hashes (multiply, add, compare by high bits; modulo 2^32) and one key per band of ``ROWS`` minima.
2. Documents with equal sets (128-bit sum of the set) are one class; only the class's least doc_id goes on.
3. In each band bucket every member is paired with one centre, the member of least random rank, so a
   bucket of m documents gives m - 1 candidates.  Pairs whose set sizes rule out the link are dropped.
4. Candidates are verified on the full sets, recomputed from the texts: 100 * intersection >= percent * union.
5. Components of the verified links come from alternating large-star and small-star (``components``).
6. A member that is not linked to its centre may still be linked to another member.  Buckets whose members
   lie in different components are compared exactly: the members in blocks of about ``BLOCK`` shingles
   or ``BLOCK_ROWS`` members, each pair of blocks one group of bounded size, which counts all intersections by matrix products.
   Only links that join two components leave a group.  Then the components are computed again with them.
   So two documents that share a bucket are either in one component or compared on their full sets.

With 32 bands of 4 rows a link of similarity 0.85 shares no bucket with probability 6e-11, one of 0.8 with 5e-8.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; repeated rows get
equal results; a row without doc_id is linked with nothing and kept; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column, list_array, slices, text_bytes
from bankspark.llm.components import connected_components
from bankspark.llm.narrow import of_documents
from bankspark.llm.shingles import shingle_sets
from bankspark.llm.words import mix
from bankspark.session import bounded_batches, written

BANDS, ROWS = 32, 4
BLOCK, BLOCK_ROWS = 1 << 17, 1024  # shingles and members of a block
SLICE = 1 << 18  # bytes of texts whose words are hashed at once
_CHUNK = 4096


def hash_family(count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    values = mix(np.arange(2 * count) + (1 + seed) * 1_000_003)
    return ((values[:count] >> np.uint64(32)) | np.uint64(1)).astype(np.uint32), \
        (values[count:] >> np.uint64(32)).astype(np.uint32)


def minima(items: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Least value of each universal hash over a non-empty set."""
    a, b = family
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    short = (items >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), _CHUNK):
        np.minimum(low, (a[:, None] * short[None, i:i + _CHUNK] + b[:, None]).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    rows = low.reshape(bands, -1).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for r in range(rows.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key


def sets_of(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, a slice of the texts at a time."""
    for i, j in slices(text_bytes(texts)[1], SLICE):
        yield from shingle_sets(texts.slice(i, j - i), words)


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands) from docs (doc_id, text); empty sets have no bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(bands * rows)
        for b in batches:
            size, set_a, set_b, keys = [], [], [], [np.zeros(0, np.uint64)]
            for s in sets_of(column(b, "text"), words):
                size.append(len(s))
                set_a.append(s.sum())
                set_b.append(mix(s ^ np.uint64(0x5555)).sum())
                keys.append(band_keys(minima(s, family), bands) if len(s) else keys[0])
            offsets = np.cumsum([len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array(size, pa.int64()), pa.array(np.array(set_a, np.uint64).view(np.int64)),
                 pa.array(np.array(set_b, np.uint64).view(np.int64)),
                 list_array(pa.array(np.concatenate(keys).view(np.int64)), offsets)],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, centre = None, None
        for batch in batches:
            texts_b, texts_a = column(batch, "text_b"), column(batch, "text_a")
            ids = column(batch, "a").to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            for k, one in enumerate(sets_of(texts_b, words)):
                if ids[k] != last:
                    last, centre = ids[k], shingle_sets(texts_a.slice(k, 1), words)[0]
                keep[k] = similar(centre, one, percent)
            yield pa.RecordBatch.from_arrays([column(batch, n).filter(pa.array(keep)) for n in ("a", "b")], ["a", "b"])

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = written(signatures(source, words, bands, rows), "signatures")
    usable = marked.filter("n_shingles > 0 and doc_id is not null")
    classes = written(usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("first")), "classes")
    # a class's documents have equal bands
    members = written(usable.join(classes, (usable["doc_id"] == classes["first"]) & (usable["set_a"] == classes["set_a"]))
                      .select("doc_id", usable["n_shingles"].alias("n"), F.explode("bands").alias("key")).distinct(),
                      "members")
    rank = F.struct(F.xxhash64("doc_id").alias("r"), "doc_id", "n")
    buckets = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(rank).alias("c"))
                      .filter("m > 1").select(F.col("key").alias("bucket"), "m", F.col("c.doc_id").alias("centre"),
                                              F.col("c.n").alias("centre_n")), "buckets")
    hits = written(members.join(buckets, members["key"] == buckets["bucket"]).filter(F.col("doc_id") != F.col("centre"))
                   .select("bucket", "m", "doc_id", "n", "centre", "centre_n"), "hits")
    fits = F.lit(100) * F.least("n", "centre_n") >= F.lit(percent) * F.greatest("n", "centre_n")
    pairs = written(hits.filter(fits).select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    involved = written(hits.select("doc_id").unionByName(hits.select(F.col("centre").alias("doc_id"))).distinct(), "involved")
    texts = written(of_documents(source, involved).dropDuplicates(["doc_id"]), "texts")
    links = written(verified(pairs, texts, words, percent), "links")
    found = written(connected_components(links), "components")
    more = written(_rest(hits.filter("m > 2"), found, texts, words, percent), "links")
    if not more.isEmpty():
        found = written(connected_components(links.unionByName(more)), "components")

    of_class = classes.join(found, classes["first"] == found["node"], "left").select(
        F.col("set_a").alias("a"), F.col("set_b").alias("b"), F.col("n_shingles").alias("n"),
        F.coalesce("component", "first").alias("component"))
    of_class = written(of_class, "classes")
    out = (marked.drop("bands").join(of_class, (marked["set_a"] == of_class["a"]) & (marked["set_b"] == of_class["b"])
                                     & (marked["n_shingles"] == of_class["n"]) & marked["doc_id"].isNotNull(), "left"))
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _rest(hits: DataFrame, found: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one bucket, its centre apart (it has met them all), that lie in different
    components so far."""
    parts = written(hits.join(found, hits["doc_id"] == found["node"], "left")
                    .select("bucket", "doc_id", "n", F.coalesce("component", "doc_id").alias("part")), "parts")
    mixed = written(parts.groupBy("bucket").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("size"),
        F.expr("bit_xor(xxhash64(doc_id))").alias("x"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("y"))
        .filter("p <> q").groupBy("x", "y", "m", "size").agg(F.min("bucket").alias("of"))  # equal buckets once
        .select("of", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("m") / BLOCK_ROWS)).cast("int").alias("k")), "mixed")
    rows = written(parts.join(mixed, parts["bucket"] == mixed["of"])
                   .select("of", "k", "doc_id", "part", F.pmod(F.xxhash64("doc_id", F.lit(1)), "k").cast("int").alias("blk")),
                   "mixed")
    rows = rows.join(texts.select("doc_id", "text"), "doc_id")
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    dealt = rows.select("of", "doc_id", "part", "blk", "text", other).select(
        "of", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "doc_id", "part", "text")

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        part, blk = (column(rows, n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("part", "blk"))
        ids = column(rows, "doc_id").to_pylist()
        links: list[tuple[int, int]] = []
        if len(np.unique(part)) > 1:
            i, j = key[1].as_py(), key[2].as_py()
            left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
            sets = list(sets_of(column(rows, "text").combine_chunks(), words))
            both = intersections([sets[x] for x in left], [sets[y] for y in right])
            size = np.array([len(x) for x in sets])
            union = size[left][:, None] + size[right][None, :] - both
            hit = (100 * both >= percent * union) & (part[left][:, None] != part[right][None, :])
            root = {p: p for p in part.tolist()}

            def top(p: int) -> int:
                while root[p] != p:
                    root[p] = p = root[root[p]]
                return p

            for x, y in zip(*(v.tolist() for v in np.nonzero(hit))):
                p, q = top(int(part[left[x]])), top(int(part[right[y]]))
                if p != q:
                    root[q] = p
                    links.append((ids[left[x]], ids[right[y]]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return dealt.groupBy("of", "i", "j").applyInArrow(compare, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by matrix products over the shared items."""
    out = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return out
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)

    def cells(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(column, row) of each shared item of each set, by column."""
        items = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, items), max(0, len(shared) - 1))
        inside = np.flatnonzero(shared[at] == items) if len(shared) else np.zeros(0, np.int64)
        order = inside[np.argsort(at[inside], kind="stable")]
        return at[order], np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]

    sides = [(len(sets), *cells(sets)) for sets in (left, right)]
    for start in range(0, len(shared), _CHUNK):
        width = min(_CHUNK, len(shared) - start)
        dense = []
        for rows, at, owner in sides:
            i, j = np.searchsorted(at, (start, start + width))
            matrix = np.zeros((rows, width), np.float32)
            matrix[owner[i:j], at[i:j] - start] = 1
            dense.append(matrix)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out
