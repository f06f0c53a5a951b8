import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bankspark.llm import bpe, queries, rans, token_files
from tests.llm import brute
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_codec_equals_the_library(library):
    rng = random.Random(3)
    letters = "ab'sStTdDmMlLvVeErR 12.,!\n\u00e9\u00c9\u0130\u0301\u03a3<|>endoftext\u1e9e"
    texts = [t for _, t in ODD if t is None or len(t) < 10_000] + [
        "", "''s 's's we'd'm", "a\x1cb\x1fc\x85d\u00a0e\u2003f\u200bg", "\u0301abc \uac01 \u1100\u1161\u11a8", "\x00\x01\x7f",
        "\u2167 \u2177 \u00aa \u02b0", "ab" * 2000, "12\u0969\u096a \u00bd \u00b2", "<|endoftext", "<|startoftext|><|endoftext|>"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    own = bpe.Codec(queries.vocabulary_path())
    for text, (words, numbers, decoded) in zip(texts, own.encode(texts)):
        want = ids_of(library, text)
        assert [i for w in words for i in w] == want, repr(text)
        assert numbers.decode() == " ".join(map(str, want))
        assert decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_one_word_of_a_megabyte(library):
    """Lone words take their merges on a plain tree; the library's time is a matter of a second."""
    rng = random.Random(8)
    own = bpe.Codec(queries.vocabulary_path())
    for text in ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "a" * 70_001, "ab" * 40_000):
        began = time.monotonic()
        (words, _, _), = own.encode([text])
        assert time.monotonic() - began < 60
        assert [i for w in words for i in w] == ids_of(library, text)


def test_words_together_and_alone_agree(monkeypatch):
    rng = random.Random(9)
    vocabulary = bpe.Vocabulary(queries.vocabulary_path())
    words = ["".join(rng.choices("aehinorstl", k=rng.randint(1, 70))) for _ in range(400)]
    alone = [vocabulary._merge_one(w.encode()) for w in words]
    monkeypatch.setattr(bpe, "TOGETHER", 1)
    assert vocabulary.encode_words(words) == alone


def test_word_table_may_be_cleared(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    own = bpe.Codec(queries.vocabulary_path())
    for text in ("one two three four", "five six one", "four three one"):
        (words, _, _), = own.encode([text])
        assert [i for w in words for i in w] == ids_of(library, text)


def test_bpe_query_matches_the_library(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, brute.SF).collect()}
    for r in brute.rows("documents"):
        ids = ids_of(library, r["text"])
        assert got.pop(r["doc_id"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert not got


def test_bpe_odd_rows(odd, none, library):
    path, keep = queries.vocabulary_path(), {"doc_id": odd["doc_id"], "member": odd["member"]}
    rows = bpe.encode_decode(odd, path, keep, with_ids=True, with_text=True).collect()
    texts = dict(ODD[:13])
    assert len(rows) == len(ODD)
    for r in rows:
        if r.doc_id is not None:
            assert r.ids == ids_of(library, texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.member == "y"
            assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode_decode(none, path, {"doc_id": none["doc_id"]}).count() == 0


@pytest.mark.parametrize("n", [1, 7, 100, 4095, 4096, 5000, 70_000])
def test_rans_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) * 37, 49_000).astype(np.uint32)
    table = rans.Table.of_ids(ids)
    table = rans.Table.from_bytes(table.to_bytes())
    blocks = rans.encode(ids, table, 60_000)
    assert np.array_equal(np.concatenate(rans.decode(blocks, table)), ids)
    if n >= 60_000:
        lanes = rans.LANES
        later = rans.decode(blocks[:1], table, checkpoint=1)[0]
        assert np.array_equal(later, ids[rans.CHECKPOINT * lanes:60_000])
        bound = -(np.bincount(ids)[ids] / n).astype(float)
        assert sum(map(len, blocks)) < 1.15 * -np.log2(-bound).sum() / 8
    with pytest.raises(ValueError):
        rans.decode([blocks[0][:-9] + bytes([blocks[0][-9] ^ 1]) + blocks[0][-8:]], table)


def test_crc_of_joined_pieces():
    a, b = b"some bytes", b"more" * 100
    assert rans.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rans.crc32_combine(0, zlib.crc32(a), len(a)) == zlib.crc32(a)


def expected(library, docs):
    out, start = {}, 0
    for i, t in sorted(docs):
        ids = np.array([*ids_of(library, t), queries.END_ID], "<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_files_query_matches_the_library(spark, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op7_token_files(spark, brute.SF).collect()}
    assert got == expected(library, [(r["doc_id"], r["text"]) for r in brute.rows("documents")])


def test_token_files_with_documents_across_segments(spark, library):
    docs = [(i, t) for i, t in ODD[:12]] + [(i, "some more words here " * (i % 40)) for i in range(100, 160)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    segments = token_files.write_tokens(frame, queries.vocabulary_path(), queries.END_ID, segment_ids=500, block_ids=128)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_tokens(spark, segments).collect()}
    assert got == expected(library, docs)


def test_token_files_odd_rows(spark, odd, none):
    path = queries.vocabulary_path()
    rows = token_files.read_tokens(spark, token_files.write_tokens(odd, path, 1)).collect()
    assert len(rows) == len(ODD)
    spans = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert token_files.read_tokens(spark, token_files.write_tokens(none, path, 1)).count() == 0
