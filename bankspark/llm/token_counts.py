"""Token counts of documents from a digest cache: only contents that the cache does not know are encoded, once each.

The cache is a Parquet table (tokenizer, content, n_tokens), partitioned by the tokenizer's digest: of the vocabulary
file, the library and its version.  The content digest is that of the normalised text; since any other change of a
text may change its count, normalising only makes null the empty text.

1. Every row becomes (doc_id, n_bytes, content digest); one row a distinct content is joined to the stored counts.
2. Distinct misses are encoded and appended.  Two bitmaps of digest slots (``SLOTS`` bits each, whatever the size of the
   input) keep texts from the shuffle: a text whose slot holds no miss is not read further; one whose slot holds neither
   a stored content nor one that occurs twice is surely a miss of its own and is encoded where it is
   read.  The others are joined exactly to the row that stands for its content.
3. The rows' digests are joined to the counts, both plain exchanges, so that a content that a third of all rows share is split.

An append that fails leaves no rows; a content that two runs append at once has equal rows, of which one counts.

Counts are the library's: ``tokenizers`` for a .json file, ``sentencepiece`` for a .model file, without begin, end or added
special tokens, truncation or padding, and with special strings inside texts handled as by default.

Defined cases: null text counts as empty and has no tokens; repeated rows, rows without doc_id and equal texts each get a row
of their own; an empty table gives an empty result and appends nothing; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column, slices, text_bytes
from bankspark.session import written

LIMIT = 4096
SLOTS = 1 << 24
_CACHE = "content binary, n_tokens long, tokenizer string"
_WORDS_HELD, _WORD_LENGTH = 1 << 20, 64


# ---- counting ------------------------------------------------------------------------------------------------------


class PieceCounter(dict):
    """Token counts with a sentencepiece model; counts of words are held.

    A model that changes no character but blanks, sets one blank before the text, and has no piece with a blank after another
    character, never merges across the beginning of a run of blanks.  Then a text's count is the sum over such stretches
    (blanks and what follows up to the next blank).  With any other model, texts are counted whole.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        blank = "▁"
        self.by_words = (trained.model_type == trained.BPE and not trained.treat_whitespace_as_suffix
                         and not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces
                         and not spec.remove_extra_whitespaces and any(p.piece == blank for p in proto.pieces)
                         and not any(p.type == p.USER_DEFINED or blank in p.piece.lstrip(blank) for p in proto.pieces))
        self.blank = blank

    def whole(self, text: str) -> int:
        return len(self.model.encode(text, add_bos=False, add_eos=False))

    def __missing__(self, stretch: str) -> int:
        # the library sets the first blank itself; it sets none before nothing
        n = self.whole(stretch[1:]) if len(stretch) > 1 else 1
        if len(stretch) <= _WORD_LENGTH:
            if len(self) >= _WORDS_HELD:
                self.clear()
            self[stretch] = n
        return n

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_words or self.blank in text:
            return self.whole(text)
        return sum(self[m.group()] for m in _STRETCH.finditer(" " + text)) if len(text) > 1 << 20 else \
            sum(map(self.__getitem__, _STRETCH.findall(" " + text)))


_STRETCH = re.compile(" +[^ ]*")


def _library_counter(path: str) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


_COUNTERS: dict[str, Callable[[str], int]] = {}


def counter(path: str) -> Callable[[str], int]:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path) if path.endswith(".model") else _library_counter(path)
    return _COUNTERS[path]


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file, the library and its version."""
    import sentencepiece
    import tokenizers

    name = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    with open(path, "rb") as file:
        return sha256(name.encode() + b"\n" + file.read()).hexdigest()


# ---- the cache -----------------------------------------------------------------------------------------------------


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer's contents."""
    rows = spark.read.schema(_CACHE).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _slot_bits(contents: DataFrame) -> DataFrame:
    """Bitmap of the contents' slots: one row of 4 kB a run of 32,768 slots."""
    slot = F.pmod(F.xxhash64("content"), F.lit(SLOTS))
    return contents.groupBy(F.bitmap_bucket_number(slot).alias("run")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def _with_slot(rows: DataFrame, bits: DataFrame, out: str) -> DataFrame:
    """Whether a row's slot is set; at most SLOTS / 32,768 rows are broadcast."""
    slot = F.pmod(F.xxhash64("content"), F.lit(SLOTS))
    at = F.bitmap_bit_position(slot)
    joined = rows.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("run"), "left")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(place div 8 as int) + 1, 1)")), 16, 10).cast("long")
    one = F.expr("cast(place % 8 as int)")
    return joined.withColumn("place", at).withColumn(
        out, F.coalesce(F.getbit(byte, one) == 1, F.lit(False))).drop("run", "bits", "place")


def _encoded(texts: DataFrame, path: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            text, content = column(b, "text"), column(b, "content")
            for i, j in slices(text_bytes(text)[1]):
                numbers = [count(t) for t in text.slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays([content.slice(i, j - i), pa.array(numbers, pa.int64())], ["content", "n_tokens"])

    return texts.select("content", "text").mapInArrow(run, "content binary, n_tokens long")


def token_counts(docs: DataFrame, cache: str, path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit; what the cache at ``cache`` lacks is appended."""
    spark = docs.sparkSession
    tokenizer = tokenizer_digest(path)
    spark.createDataFrame([], _CACHE).write.mode("ignore").partitionBy("tokenizer").parquet(cache)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("content", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = written(source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "contents")

    distinct = rows.groupBy("content").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    known = stored_counts(spark, cache, tokenizer).select(F.col("content").alias("stored"), "n_tokens")
    known = written(distinct.join(known, F.col("content") == F.col("stored"), "left").drop("stored"), "known")
    misses = known.filter("n_tokens is null")
    counts = known.filter("n_tokens is not null").select("content", "n_tokens")
    if not misses.isEmpty():
        found = _with_slot(source, written(_slot_bits(misses), "slots"), "missing").filter("missing")
        found = _with_slot(found, written(_slot_bits(known.filter("n_tokens is not null or n > 1")), "slots"), "shared")
        alone = found.filter("not shared")
        first = misses.select(F.col("content").alias("of"), "first")
        shared = found.filter("shared").join(first, (F.col("content") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first")),
                                             "left_semi")
        shared = shared.groupBy("content").agg(F.first("text").alias("text"))  # repeated rows have the id in common too
        new = written(_encoded(alone, path).unionByName(_encoded(shared, path)), "new-counts")
        new.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache)
        counts = written(counts.unionByName(new), "counts")
    return (rows.join(counts.select(F.col("content").alias("of"), "n_tokens"), F.col("content") == F.col("of"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
