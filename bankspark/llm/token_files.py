"""Token ids of documents as entropy-coded files, and back.

``write_tokens`` orders the documents by doc_id over range partitions, encodes each whole text (a given end
id after each document) and writes the ids of a partition as segments of at most ``SEGMENT_IDS`` ids.  A
segment is one row of a Parquet table in the shared folder and decodes on its own: a frequency table
over all its ids, shared by its blocks (see ``rans``), the coded blocks, and for each document that it
touches the ordinal in the partition, the id, the number of ids here, and whether the document begins or
ends here.  One pass suffices, a task holds one segment, and nothing passes through the driver but one id
count a partition.

``read_tokens`` decodes the segments independently and returns one row per document; a document that
crosses segments is put together from its pieces' checksums.

Defined cases: null text counts as empty (only the end id); rows without doc_id come first; repeated rows
are separate documents in the order of their texts; an empty table gives an empty result; further columns
are ignored; a damaged block raises.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.llm import rans
from bankspark.llm.arrow_text import column, slices, text_bytes
from bankspark.llm.bpe import byte_symbols
from bankspark.llm.words import MAX_WORDS, Words
from bankspark.session import written

SEGMENT_IDS = 64 * rans.BLOCK_IDS
_FIELDS = {"part": pa.int32(), "segment": pa.int32(), "offset": pa.int64(), "n_ids": pa.int64(),
           "frequencies": pa.binary(), "blocks": pa.list_(pa.binary()), "doc_no": pa.list_(pa.int64()),
           "doc_id": pa.list_(pa.int64()), "doc_ids_here": pa.list_(pa.int64()),
           "begins": pa.list_(pa.bool_()), "ends": pa.list_(pa.bool_())}
_SCHEMA = ("part int, segment int, offset long, n_ids long, frequencies binary, blocks array<binary>, "
           "doc_no array<long>, doc_id array<long>, doc_ids_here array<long>, begins array<boolean>, "
           "ends array<boolean>")


class LibraryEncoder:
    """Ids of texts with the tokenizers library's model: the library encodes each word that is new to the worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._model = tokenizer.model
        specials = [(t.content, i) for i, t in sorted(tokenizer.get_added_tokens_decoder().items())]
        self._bytes = {b: c for b, c in byte_symbols().items()}
        self.words = Words(specials, self._encode)
        self._clear()

    def _clear(self) -> None:
        self.words.clear()
        self._flat, self._sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encode(self, words: list[str]) -> list[list[int]]:
        tokenize, symbols = self._model.tokenize, self._bytes
        return [[t.id for t in tokenize(w.encode("utf-8", "surrogatepass").decode("latin-1").translate(symbols))]
                for w in words]

    def __call__(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with the end id after each, ids per text)."""
        if len(self.words.ids) > MAX_WORDS:
            self._clear()
        numbers = self.words.numbers(texts)
        new = self.words.ids[len(self._sizes):]
        if new:
            sizes = np.array([len(x) for x in new], np.int64)
            self._sizes = np.concatenate([self._sizes, sizes])
            self._flat = np.concatenate([self._flat, np.fromiter(chain.from_iterable(new), np.uint32, sizes.sum())])
        first = np.cumsum(self._sizes) - self._sizes
        words = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        size = self._sizes[words]
        stops = np.cumsum(size)
        ids = self._flat[np.repeat(first[words] - (stops - size), size) + np.arange(size.sum())]
        ends = np.concatenate([[0], stops])[np.cumsum([len(n) for n in numbers])]
        return np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 segment_ids: int = SEGMENT_IDS, block_ids: int = rans.BLOCK_IDS) -> DataFrame:
    """Write the token files; returns the written table of segments."""
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(path)
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []          # ids not yet written
        pieces: list[tuple] = []             # (doc_no, doc_id, ids, begins, ends) of the held ids
        segment = offset = waiting = doc_no = 0

        def flush(n: int) -> pa.RecordBatch:
            nonlocal held, pieces, segment, offset, waiting
            ids = np.concatenate(held)
            here, rest, left = [], [], n
            for no, doc, size, begins, ends in pieces:
                if size <= left:
                    here.append((no, doc, size, begins, ends))
                elif left:
                    here.append((no, doc, left, begins, False))
                    rest.append((no, doc, size - left, False, ends))
                else:
                    rest.append((no, doc, size, begins, ends))
                left -= min(left, size)
            table = rans.Table.of_ids(ids[:n])
            row = [part, segment, offset, n, table.to_bytes(), rans.encode(ids[:n], table, block_ids),
                   *[list(x) for x in zip(*here)]]
            held, pieces, waiting = [ids[n:]], rest, waiting - n
            segment, offset = segment + 1, offset + n
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _FIELDS.values())],
                                              list(_FIELDS))

        for b in batches:
            texts, names = column(b, "text"), column(b, "doc_id").to_pylist()
            for i, j in slices(text_bytes(texts)[1]):
                ids, sizes = encode(texts.slice(i, j - i).to_pylist(), end_id)
                held.append(ids)
                waiting += len(ids)
                for name, size in zip(names[i:j], sizes.tolist()):
                    pieces.append((doc_no, name, size, True, True))
                    doc_no += 1
                while waiting >= segment_ids:
                    yield flush(segment_ids)
        if waiting:
            yield flush(waiting)

    return written(ordered.mapInArrow(run, _SCHEMA), "tokens", codec="uncompressed")


def decoded_segments(segments: DataFrame) -> DataFrame:
    """(part, doc_no, doc_id, at, n, crc, begins, ends) of each piece; ``at`` counts the partition's ids before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = {n: column(b, n)[k] for n in _FIELDS}
                ids = np.concatenate(rans.decode(row["blocks"].as_py(), rans.Table.from_bytes(
                    row["frequencies"].as_py()))).astype("<u4")
                sizes = np.array(row["doc_ids_here"].as_py(), np.int64)
                stops = np.cumsum(sizes)
                data = memoryview(ids).cast("B")
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(stops.tolist(), sizes.tolist())]
                count = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"].as_py()] * count, pa.int32()), row["doc_no"].values, row["doc_id"].values,
                     pa.array(stops - sizes + row["offset"].as_py()), pa.array(sizes), pa.array(crc, pa.int64()),
                     row["begins"].values, row["ends"].values],
                    ["part", "doc_no", "doc_id", "at", "n", "crc", "begins", "ends"])

    return segments.mapInArrow(run, "part int, doc_no long, doc_id long, at long, n long, crc long, begins boolean, "
                                    "ends boolean")


def read_tokens(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    totals = sorted(segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # a row a partition
    bases = dict(zip([r["part"] for r in totals], accumulate([r["n"] for r in totals], initial=0)))
    base = spark.createDataFrame(list(bases.items()), "of_part int, base long")
    pieces = written(decoded_segments(segments), "pieces")

    def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                crc, n = 0, 0
                for p in sorted(r["pieces"], key=lambda p: p["at"]):
                    crc, n = rans.crc32_combine(crc, p["crc"], 4 * p["n"]), n + p["n"]
                rows.append({"part": r["part"], "doc_id": r["doc_id"], "at": min(p["at"] for p in r["pieces"]),
                             "n": n, "crc": crc})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("doc_id", pa.int64()),
                                                              ("at", pa.int64()), ("n", pa.int64()),
                                                              ("crc", pa.int64())]))

    whole = pieces.filter("begins and ends").select("part", "doc_id", "at", "n", "crc")
    # a document's pieces are as many as the segments it fills
    crossing = (pieces.filter("not (begins and ends)").groupBy("part", "doc_no", "doc_id")
                .agg(F.collect_list(F.struct("at", "n", "crc")).alias("pieces"))
                .mapInArrow(join_pieces, "part int, doc_id long, at long, n long, crc long"))
    return (whole.unionByName(crossing).join(F.broadcast(base), F.col("part") == F.col("of_part"))
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"),
                    F.col("crc").alias("ids_crc32")))
