"""Texts coded with zstandard raw-content dictionaries: the shared part of the compression classifiers.

A class is described by a dictionary of sample text.  A text is coded in blocks, each
against the fresh dictionary, so a long text is judged by the dictionary all the way and
not by its own history.  Everything that is learnt is a bounded sample (parameters below);
it is taken by hash, so it does not depend on the order or partitioning of the rows.
"""

from __future__ import annotations

from collections import Counter

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICT_BYTES = 128 << 10  # of a class's dictionary
DICT_ROWS = 1024        # at most, sampled for a dictionary
PIECE_CHARS = 300       # of a sampled row, at least
LEAST_BYTES = 8 << 10   # of a dictionary, if the samples have them
BLOCK_BYTES = 1024      # coded at once


class Coder:
    """Coded size of a text under one dictionary."""

    def __init__(self, dictionary: bytes, block: int = BLOCK_BYTES):
        # greedy matching from 4 bytes on: words and endings count, not only phrases
        params = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=4, hash_log=16, chain_log=16, search_log=3, window_log=18,
            target_length=8, write_content_size=False, write_checksum=False, write_dict_id=False)
        data = zstandard.ZstdCompressionDict(dictionary or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        self._compress = zstandard.ZstdCompressor(dict_data=data, compression_params=params).compress
        self._block = block

    def size(self, text: bytes) -> int:
        code, block = self._compress, self._block
        if len(text) <= block:
            return len(code(text))
        return sum(len(code(text[i:i + block])) for i in range(0, len(text), block))


def sampled_ids(rows: DataFrame, per_class: int, seed: int) -> DataFrame:
    """Up to ``per_class`` ids of each class from rows (id, label): the row of least hash in each of
    ``per_class`` hash slots.  One partial aggregate; classes of any size shuffle per_class rows a task."""
    h = F.xxhash64("id", F.lit(seed))
    return (rows.groupBy("label", F.pmod(h, F.lit(per_class)).alias("slot"))
            .agg(F.min(F.struct(h.alias("h"), "id")).alias("first")).select("label", "first.*"))


def sampled_texts(ids: DataFrame, texts: DataFrame, piece: int) -> list[tuple]:
    """[(label, text)] in hash order of collected ids; ``piece`` characters from a place given by the hash (more where
    a class has few ids, so that its pieces still fill a dictionary).  The ids are a bounded sample, so they are broadcast."""
    known = ids.collect()
    spark = texts.sparkSession
    kind = texts.schema["id"].dataType.simpleString()
    label = ids.schema["label"].dataType.simpleString()
    few = Counter(r["label"] for r in known)
    small = spark.createDataFrame([(r["id"], r["label"], r["h"], max(piece, DICT_BYTES // few[r["label"]])) for r in known],
                                  f"id {kind}, label {label}, h long, piece int")
    text = F.coalesce(F.col("text"), F.lit(""))
    room = F.greatest(F.length(text) - F.col("piece"), F.lit(0)) + 1
    text = F.substr(text, (F.pmod(F.col("h"), room) + 1).cast("int"), F.col("piece"))
    found = texts.join(F.broadcast(small), "id").select("label", "h", "id", text.alias("text"))
    return [(r["label"], r["text"]) for r in sorted(found.collect(), key=lambda r: (r["h"], r["id"]))]


def dictionaries(samples: list[tuple], limit: int = DICT_BYTES) -> dict:
    """Dictionary bytes per label from [(label, text)]."""
    out: dict = {}
    for label, text in samples:
        data = out.setdefault(label, bytearray())
        if len(data) < limit:
            data += text.encode() + b"\n"
    least = max(LEAST_BYTES, min(map(len, out.values()), default=0))  # no class gains by a larger dictionary
    return {k: bytes(v[:min(limit, least)]) for k, v in out.items()}


