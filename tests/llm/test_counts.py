import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bankspark.llm import queries, token_counts
from tests.llm import brute
from tests.llm.conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def plain(library, docs):
    return sorted(((i is not None, i or 0, len((t or "").encode()), n, n > 4096)
                   for (i, t), n in zip(docs, [len(x) for x in library.encode([t or "" for _, t in docs])])))


def rows_of(frame):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in frame.collect())


def test_query_matches_library(spark, library):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows("documents")]
    assert rows_of(queries.op12_token_counts(spark, brute.SF)) == plain(library, docs)


def test_odd_rows_and_none(spark, odd, none, library, tmp_path):
    cache = str(tmp_path / "cache")
    assert token_counts.token_counts(none, cache, MODEL).count() == 0
    assert rows_of(token_counts.token_counts(odd, cache, MODEL)) == plain(library, ODD)


def test_words_add_up_to_texts(library):
    """Runs of blanks, other white space, control characters, the blank's own sign, unknown characters."""
    rng = random.Random(9)
    signs = [" ", " ", "  ", "   ", "a", "b", "the", "ing", "\n", "\t", "▁", " ", "　", "é", "é", "日本",
             "\U0001f600", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", "ﬁ", "①", "İ", "\r", "1", "99", "-", "'s"]
    count = token_counts.PieceCounter(MODEL)
    assert count.by_words
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        assert count(text) == len(library.encode(text)), text
    for text in ["x" * 50_000, "word  " * 300_000, " " * 1000, "日" * 3000]:
        assert count(text) == len(library.encode(text))


def test_word_sums_only_with_such_models(tmp_path):
    """A model that rewrites its input, or has a piece across a blank, is asked for whole texts."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    piece = proto.pieces.add()
    piece.piece, piece.score = "e▁t", 0.0
    path = str(tmp_path / "across.model")
    with open(path, "wb") as file:
        file.write(proto.SerializeToString())
    count = token_counts.PieceCounter(path)
    assert not count.by_words
    plain_model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert count("the time e t") == len(plain_model.encode("the time e t"))


def test_cache_encodes_distinct_misses_once(spark, tmp_path):
    cache = str(tmp_path / "cache")
    schema = "doc_id long, text string"
    docs = [(i, f"text number {i % 7}") for i in range(50)] + [(3, "text number 3"), (None, "text number 6"), (99, None)]
    inner = token_counts._encoded

    def counting(texts, path):
        out = inner(texts, path)
        nonlocal total
        total += out.count()
        return out

    total = 0
    token_counts._encoded = counting
    try:
        token_counts.token_counts(spark.createDataFrame(docs, schema).repartition(6), cache, MODEL).collect()
        assert total == 8  # seven texts and the empty one
        token_counts.token_counts(spark.createDataFrame(docs[::-1], schema), cache, MODEL).collect()
        assert total == 8
        more = token_counts.token_counts(spark.createDataFrame(docs + [(100, "new"), (101, "new")], schema), cache, MODEL)
        assert more.count() == len(docs) + 2 and total == 9
    finally:
        token_counts._encoded = inner
    stored = spark.read.parquet(cache)
    assert stored.count() == 9 and stored.select("tokenizer").distinct().count() == 1
    # another tokenizer has counts of its own
    other = public_tokenizers.path("byte_bpe_50k.json")
    got = token_counts.token_counts(spark.createDataFrame(docs, schema), cache, other).filter("doc_id = 1").first()
    assert got.n_tokens == len(Tokenizer.from_file(other).encode("text number 1", add_special_tokens=False).ids)
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_stored_counts_are_used(spark, tmp_path):
    """A stored count is taken as it is, and equal rows of two writers count once."""
    cache, one = str(tmp_path / "cache"), spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "d")], "doc_id long, text string")
    digest = token_counts.tokenizer_digest(MODEL)
    row = spark.range(1).select(F.unhex(F.sha2(F.lit("abc").cast("binary"), 256)).alias("content"), F.lit(77).cast("long").alias("n_tokens"),
                                F.lit(digest).alias("tokenizer"))
    for _ in range(2):
        row.write.mode("append").partitionBy("tokenizer").parquet(cache)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(one, cache, MODEL, limit=76).collect()}
    assert got[1] == got[2] == 77 and got[3] < 3 and len(got) == 3


def test_slots_find_every_content(spark, monkeypatch):
    """Few slots: all texts take the exact way."""
    monkeypatch.setattr(token_counts, "SLOTS", 1 << 15)
    rng = np.random.default_rng(1)
    contents = spark.createDataFrame([(bytes(x),) for x in rng.integers(0, 256, (300, 32), np.uint8)], "content binary")
    held = contents.limit(100)
    marked = token_counts._with_slot(contents, token_counts._slot_bits(held), "here")
    assert marked.join(held, "content").filter("not here").count() == 0 and marked.filter("here").count() < 110
    monkeypatch.setattr(token_counts, "SLOTS", 1)
    docs = spark.createDataFrame([(i, f"t{i % 9}") for i in range(40)], "doc_id long, text string")
    import tempfile
    got = token_counts.token_counts(docs, tempfile.mkdtemp() + "/c", MODEL)
    assert got.count() == 40 and got.filter("n_tokens is null").count() == 0
