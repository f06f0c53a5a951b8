import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from bankspark.llm import lexical, queries
from tests.llm import brute
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def plain(docs, items, k=50):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    of = {}
    for i, t in items:
        of.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in of.items():
        scores = []
        for i, c, n in held:
            m = 50 + 50 * n * len(held) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is not None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query_matches_plain_scores(spark):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows("documents")]
    items = [(r["item_id"], r["text"]) for r in brute.rows("benchmark")]
    got = queries.op13_lexical(spark, brute.SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert rows_of(got) == plain(docs, items)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_ties_tiles_and_shards(spark, monkeypatch, shard_bytes):
    """Many equal documents, tiles smaller than the data, and several shards of items."""
    monkeypatch.setattr(lexical, "DOC_TILE", 7)
    monkeypatch.setattr(lexical, "ITEM_TILE", 3)
    monkeypatch.setattr(lexical, "TERM_TILE", 4)
    rng = random.Random(3)
    vocabulary = [f"W{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6)))) for i in range(400)]
    docs += [(i, "w1 W2 w3") for i in range(400, 520)] + [(450, "w1 w2 w3"), (None, "w1 w2 w3"), (None, None), (-5, "w1 w2 w3")]
    items = [(i, ", ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12)))) for i in range(17)]
    items += [(3, "w1 w29"), (None, "w7 w8"), (40, "none of these"), (41, None), (42, "...")]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.ranked(frame, bench, k=20, shard_bytes=shard_bytes)
    assert rows_of(got) == plain(docs, items, 20)


def test_odd_rows_and_none(spark, odd, none):
    items = [(1, "one two THREE"), (2, "été 日本語"), (3, None), (4, "words same line")]
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, score int, doc_id string")
    assert rows_of(lexical.ranked(odd, bench)) == plain(ODD, items)
    assert lexical.ranked(none, bench).count() == 0
    assert lexical.ranked(odd, bench.limit(0)).count() == 0


def test_sums_stay_exact():
    """A vocabulary whose sums could pass 2^53 is cut, and the parts add up in integers."""
    weights = np.full(1000, 24_000, np.int64) * 10 ** 3
    tile = lexical.Tile(0, [list(range(1000)), [5, 999]], weights)
    assert len(tile.parts) > 1
    assert all(weights[t].sum() * lexical._IMPACT < 2 ** 53 for t, _ in tile.parts)
    rng = np.random.default_rng(0)
    impacts = weights * rng.integers(1, 10 ** 6, 1000)
    terms = np.arange(1000)
    got = tile.scores(terms, np.zeros(1000, np.int64), impacts.astype(float), 1)
    assert got[:, 0].tolist() == [int(impacts.sum()), int(impacts[5] + impacts[999])]


def test_best_keeps_the_smaller_ids_of_ties():
    best = lexical.Best(1, 3)
    for docs in ([9, 8], [7, 6, 5], [4]):
        best.add(np.full((1, len(docs)), 10), np.array(docs), np.ones(len(docs), bool))
    best.add(np.array([[11, 10]]), np.array([50, 0]), np.array([True, False]))
    assert best.rows[2].tolist() == [50, 0, 4] and best.rows[3].tolist() == [True, False, True]
