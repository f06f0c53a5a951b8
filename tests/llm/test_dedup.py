import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bankspark.llm import exact_dedup, line_dedup, minhash, quality, queries, suffix_dedup
from bankspark.llm.components import connected_components
from bankspark.llm.shingles import shingle_sets
from tests.llm import brute
from tests.llm.conftest import ODD

NAMED = sorted({(i, t) for i, t in ODD if i is not None}, key=lambda x: x[0])


def texts(sf_dir=brute.SF):
    return [(r["doc_id"], r["text"]) for r in brute.rows("documents", sf_dir)]


# exact dedup

def test_exact_query_matches_brute_force(spark):
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256, r.kept) for r in
           queries.op9_exact_dedup(spark, brute.SF).collect()}
    assert got == {i: (k, n, h, k == i) for i, (k, n, h) in brute.copies(texts()).items()}


def test_exact_long_texts_differ_in_one_byte(spark):
    long = "x" * 5000
    docs = [(1, long + "a"), (2, long + "b"), (3, long + "A"), (4, long), (5, long), (6, "x" * 64), (7, "X" * 64), (8, "x" * 65)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in
           exact_dedup.exact_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (5, 2), 5: (5, 2), 6: (7, 2), 7: (7, 2), 8: (8, 1)}


def test_exact_odd_rows(odd, none):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[1].keep_id, by[1].group_size, by[1].kept) == (2, 2, False)  # null and empty are equal
    assert by[4].keep_id == 5 and by[12].group_size == 2 and by[12].kept
    assert all(r.kept and r.group_size == 1 for r in rows if r.doc_id is None)
    kept = exact_dedup.keep_one_copy(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [2, 3, 5, 6, 7, 8, 9, 10, 11, 12] and ids.count(None) == 2
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.keep_one_copy(none).count() == 0


def test_exact_doc_id_of_several_texts(spark):
    docs = [(5, "a"), (5, "b"), (7, "A"), (8, "B"), (9, "c"), (9, "c"), (9, "C"), (9, "d"), (5, "L" * 700), (5, "l" * 700 + "x"),
            (8, "l" * 700), (5, None), (5, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame).collect())
    assert rows == sorted([(5, 7, 2, False), (5, 8, 2, False), (7, 7, 2, True), (8, 8, 2, True), (9, 9, 3, True), (9, 9, 3, True),
                           (9, 9, 3, True), (9, 9, 1, True), (5, 8, 2, False), (5, 5, 1, True), (8, 8, 2, True),
                           (5, 5, 2, True), (5, 5, 2, True)])
    kept = [(r.doc_id, (r.text or "").lower()[-1:], len(r.text or "")) for r in exact_dedup.keep_one_copy(frame).collect()]
    assert sorted(kept) == [(5, "", 0), (5, "x", 701), (7, "a", 1), (8, "b", 1), (8, "l", 700), (9, "c", 1), (9, "d", 1)]


# near duplicates

def test_minhash_query_matches_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op4_minhash(spark, brute.SF).collect()}
    assert got == brute.near(texts(), 3, 85)


def test_minhash_chains_and_blocks(spark, monkeypatch):
    """Chains of edits, where most members are not linked to a bucket's centre, with many small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 400)
    rng = random.Random(5)
    docs, i = [], 0
    for _ in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for step in range(14):
            docs.append((i, " ".join(words)))
            i += 1
            words = list(words)
            for _ in range(rng.choice([1, 2, 4])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame, 3, 85).collect()}
    assert got == brute.near(docs, 3, 85)


def test_minhash_in_arrow_batches_of_few_rows(spark):
    """A limit that the session has set holds, and batches may end anywhere."""
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2000")
    rng = random.Random(6)
    docs = []
    for i in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)] if i % 10 == 0 else list(words)
        words[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    frame = session.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame, 3, 85).collect()}
    assert got == brute.near(docs, 3, 85)
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2000"


def test_whole_texts_reach_the_workers_in_small_batches(spark):
    """Near duplicates and the quality score, whatever rows stand in a partition."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes]})

    for run in (minhash.near_duplicates, lambda d: quality.score(d, quality.Model({}, 0.0, 0.0), {"doc_id": F.col("doc_id")})):
        session = spark.newSession()
        docs = session.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text")).coalesce(1)
        assert run(docs.limit(3)).count() == 3
        found = [r["size"] for r in docs.mapInArrow(sizes, "size long").collect()]
        assert sum(found) > 24_000_000 and max(found) < 5_000_000


def test_texts_are_hashed_a_slice_at_a_time():
    texts = pa.array([None, ""] + [" ".join(f"w{i * k}" for k in range(400)) for i in range(3000)])
    assert texts.nbytes > 6_000_000
    whole = [int(s.sum()) for s in shingle_sets(texts, 5)]
    tracemalloc.start()
    got = [int(s.sum()) for s in minhash.sets_of(texts, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == whole and peak < 40_000_000


def test_minhash_odd_rows(odd, none):
    rows = minhash.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == len(ODD)
    want = brute.near(NAMED, 3, 85)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
               for r in rows if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(none).count() == 0


def test_intersections():
    a, b = np.array([1, 5, 9], np.uint64), np.array([5, 9, 11, 12], np.uint64)
    assert minhash.intersections([a, b], [b, np.zeros(0, np.uint64)]).tolist() == [[2, 0], [4, 0]]


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + \
        [(2000, k) for k in range(2001, 2100)] + [(7, 7)]
    links = [e for e in edges if e[0] != e[1]]
    want = brute.roots({x for e in links for x in e}, links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# lines

def test_lines_query_matches_brute_force(spark):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed_lines) for r in queries.op3_line_dedup(spark, brute.SF).collect()}
    assert got == {i: (n, len(gone), " ".join(map(str, gone))) for i, (n, gone) in brute.removed_lines(texts()).items()}


def test_lines_of_few_words_with_split_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SPLIT", 3)
    monkeypatch.setattr(line_dedup, "NEAREST", 1)
    rng = random.Random(4)
    docs = [(i, "\n".join(" ".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 14))) for _ in range(12)))
            for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.line_duplicates(frame).collect()}
    assert got == brute.removed_lines(docs)


def _template_group(size):
    """Rows of the group of a word that ``size`` lines of ten words share, which differ in one word: all pairs pass."""
    rng = np.random.default_rng(3)
    one = np.ones(size, np.int64)
    return [one, rng.permutation(size), np.zeros(size, np.int32), np.left_shift(1, rng.integers(0, 62, size)),
            10 * one, one]


def test_line_group_of_one_template_is_walked_in_slices(monkeypatch):
    monkeypatch.setattr(line_dedup, "PAIRS", 10_000, raising=False)
    word, doc, line, b, n, place = table = _template_group(2000)
    sizes = [len(i) for i, _ in line_dedup.candidate_pairs(word, b.view(np.uint64), n, place, 80)]
    assert sum(sizes) == 2000 * 1999 // 2 and max(sizes) < 12_000
    got = pa.Table.from_batches(line_dedup.group_candidates(table, 80)).to_pylist()
    assert {(r["doc_id"], r["doc_2"], r["first"], r["more"]) for r in got} == \
        {(d, k, k == 0, d > line_dedup.NEAREST) for d in range(2000) for k in range(min(d, line_dedup.NEAREST))}
    marked = np.zeros(line_dedup.FILTER, bool)
    marked[line_dedup.line_slots(np.array([1500]), np.array([0], np.int32))] = True
    open_lines = [b for b in line_dedup.group_candidates(table, 80, marked)]
    assert max(b.num_rows for b in open_lines) < 12_000
    assert {r["doc_2"] for b in open_lines for r in b.to_pylist() if r["doc_id"] == 1500} == set(range(1500))


def test_line_group_of_twenty_thousand(monkeypatch):
    table = _template_group(20_000)
    got = pa.Table.from_batches(line_dedup.group_candidates(table, 80))
    assert got.num_rows == 3 + 3 * (20_000 - 3) and set(got["doc_2"].to_pylist()) == {0, 1, 2}


def test_lines_in_every_partition(spark):
    docs = [(i, f"a line that every single document of this set has\nand one of its own v{i} w{i} x{i} y{i}\ntiny {i % 3}")
            for i in range(200)]
    got = {r.doc_id: (r.n_lines, r.removed) for r in
           line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(40)).collect()}
    assert got == brute.removed_lines(docs)


def test_lines_without_ids_are_apart(spark):
    docs = [(1, "one two three four five six"), (None, "one two three four five six\nseven eight nine ten"),
            (None, "eleven twelve\nthirteen\nseven eight nine ten"), (None, "eleven twelve\nthirteen\nseven eight nine ten")]
    rows = line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    gone = sorted((r.n_lines, tuple(r.removed)) for r in rows if r.doc_id is None)
    # the shared last line stays in the text whose hash comes first; repeated rows do not remove each other
    assert gone in ([(2, (0,)), (3, (2,)), (3, (2,))], [(2, (0, 1)), (3, ()), (3, ())])
    assert [tuple(r.removed) for r in rows if r.doc_id == 1] == [()]


def test_lines_of_one_template(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PAIRS", 100, raising=False)
    docs = [(i, f"one two three four v{i * 7919} five six seven eight nine\nx{i} y{i} z{i}") for i in range(300)]
    got = {r.doc_id: (r.n_lines, r.removed) for r in
           line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute.removed_lines(docs)


def test_parts_of_similar_sets_have_a_common_key():
    rng = np.random.default_rng(8)
    seen = 0
    for _ in range(400):
        n = int(rng.integers(4, 140))
        one = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        two = np.concatenate([one[rng.integers(0, n // 7 + 1):], rng.integers(0, 1 << 63, rng.integers(0, n // 7 + 1), dtype=np.uint64)])
        one, two = np.unique(one), np.unique(two)
        both = len(np.intersect1d(one, two))
        if 100 * both < 80 * (len(one) + len(two) - both):
            continue
        seen += 1
        words, first = np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)])
        length = (words % np.uint64(9)).astype(np.int64) + 1
        owner, key = line_dedup.part_keys(words, length, first, np.array([0, 1]), 80)
        assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist())
    assert seen > 50


def test_long_lines_with_few_changes(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ONE_IN", (3, 1), raising=False)
    rng = random.Random(9)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(8, 200))] for _ in range(6)]
    def changed(words):
        return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < rng.choice([0.03, 0.08, 0.11]) else w for w in words)
    docs = [(i, "\n".join(changed(rng.choice(bases)) for _ in range(3))) for i in range(150)]
    got = {r.doc_id: (r.n_lines, r.removed) for r in
           line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute.removed_lines(docs)


def test_equal_sets_are_one_in_a_group():
    """A line that every task sends is dealt out once: no pairs between its copies."""
    size = 50
    doc, line, one = np.arange(size), np.zeros(size, np.int64), np.ones(size, np.uint64)
    rows = [r for k in range(size) for r in line_dedup._packed(
        line_dedup._PART, one[:1], one[:1].astype(np.uint32), doc[k:k + 1], line[:1], one[:1], np.array([9]), one[:1],
        np.zeros((1, 2), np.uint64)).to_pylist()]
    assert sum(b.num_rows for b in line_dedup._candidates(rows, 80, 4, None)) == 0


def _near_misses(size):
    """Lines of one template that differ in so many words that few are similar, though the bitmaps let many pairs pass."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for i in range(size):
        words = list(base)
        for k in rng.sample(range(60), rng.choice([4, 5])):
            words[k] = f"x{i}y{k}"
        docs.append((i, " ".join(words)))
    return docs


def test_lines_of_near_copies_list_no_pairs(spark, monkeypatch):
    counts, write = [], line_dedup.written

    def counted(frame, *rest):
        out = write(frame, *rest)
        counts.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    docs = _near_misses(1200)
    got = {r.doc_id: (r.n_lines, r.removed) for r in
           line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute.removed_lines(docs)
    assert 100 < sum(1 for _, gone in got.values() if not gone)
    assert max(counts) < 80 * len(docs)  # three candidates in each of some 20 groups; with pairs listed it was 163 times


def test_large_groups_of_open_lines_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP", 600, raising=False)
    docs = _near_misses(150)
    got = {r.doc_id: (r.n_lines, r.removed) for r in
           line_dedup.line_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute.removed_lines(docs)
    rng = np.random.default_rng(5)
    rank, n, marked = rng.permutation(90), rng.integers(4, 60, 90), rng.random(90) < 0.3
    seen = set()
    for _, rows, late in line_dedup.in_blocks(rank, n, marked, 400):
        assert n[rows].sum() < 600
        seen |= {(rank[i], rank[j]) for i in rows[late] for j in rows if rank[j] < rank[i]}
    assert seen >= {(i, j) for i in rank[marked].tolist() for j in range(i)}


def test_packed_sets_are_small_and_come_back():
    rng = np.random.default_rng(7)
    size = 3000
    n = rng.integers(4, 160, size)
    first = np.append(0, np.cumsum(n))
    words = rng.integers(0, 1 << 63, first[-1], dtype=np.uint64)
    h, b, n = line_dedup.set_keys(words, first)
    wide = np.zeros((size, 2), np.uint64)
    large = np.flatnonzero(n >= line_dedup.WIDE)
    wide[large] = line_dedup.wide_bitmaps(words, first, large)
    doc, line = np.sort(rng.integers(0, 40_000, size)), rng.integers(0, 12, size)
    part, key = np.sort(rng.integers(0, 2, size)), rng.integers(0, 1 << 24, size, dtype=np.uint64)
    batch = line_dedup._packed(line_dedup._PART, part, key, doc, line, b, n, h, wide)
    again = line_dedup._unpacked(batch.to_pylist())
    for x, y in zip(again, (key, doc, line, None, n, h.astype(np.uint32), wide)):
        assert y is None or np.array_equal(x, y)
    mid = (n >= 32) & (n < 96)
    assert np.array_equal(again[3][n >= 32], b[n >= 32]) and mid.any()
    assert np.array_equal(again[3][n < 32], (b ^ b >> np.uint64(32))[n < 32] & np.uint64(0xFFFFFFFF))
    held = sum(len(v) for r in batch.to_pylist() for v in r.values() if isinstance(v, bytes))
    assert held < 22 * size  # before: 27


def test_sets_of_any_size_pass_their_bitmaps():
    """No similar pair is dropped where bitmaps of 32, 64 and 128 bits meet."""
    rng = np.random.default_rng(11)
    for size in (28, 31, 32, 36, 80, 95, 96, 110):
        sets = [rng.integers(0, 1 << 63, size, dtype=np.uint64)]
        for _ in range(40):
            gone, more = rng.integers(0, size // 10 + 1, 2)
            sets.append(np.concatenate([sets[0][gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
        sets = sorted(sets, key=len)
        words, first = np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets]))
        h, b, n = line_dedup.set_keys(words, first)
        wide = np.zeros((len(n), 2), np.uint64)
        large = np.flatnonzero(n >= line_dedup.WIDE)
        wide[large] = line_dedup.wide_bitmaps(words, first, large)
        one = np.zeros(len(n), np.int64)
        rows = line_dedup._packed(line_dedup._PART, one, one, np.arange(len(n)), one, b, n, h, wide).to_pylist()
        _, _, _, b, n, _, wide = line_dedup._unpacked(rows)
        got = {(i, j) for x, y in line_dedup.candidate_pairs(one, b, n.astype(np.int64), one, 80, wide) for i, j in zip(x, y)}
        want = set()
        for i in range(len(n)):
            for j in range(i + 1, len(n)):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (n[i] + n[j] - both):
                    want.add((i, j))
        assert want and want <= got


def test_lines_odd_rows(odd, none):
    rows = line_dedup.line_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    want = brute.removed_lines(NAMED)
    assert all((r.n_lines, r.removed) == want[r.doc_id] for r in rows if r.doc_id is not None)
    kept = line_dedup.drop_lines(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    by = {r.doc_id: r.text for r in kept.collect()}
    assert by[10] == "\n\n\nline one two three four five\n\n\n\n\n\n\n" and by[1] is None and by[12] == ""
    assert line_dedup.line_duplicates(none).count() == 0 and line_dedup.drop_lines(none).count() == 0


# repeated passages

def test_passages_query_matches_brute_force(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in
           queries.op5_suffix_dedup(spark, brute.SF).collect()}
    assert got == brute.cut(texts())


def test_passages_small_chunks_and_hot_grams(spark, monkeypatch):
    """Stretches of long texts, periodic text, and 32-grams that count as hot at once."""
    for name, value in (("CHUNK", 700), ("HOT", 3), ("SHARD_ENTRIES", 40), ("REMEMBERED", 5),
                        ("BATCH_ENTRIES", 7), ("PASS_WINDOWS", 300)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcd e\u00e9") for _ in range(260))
    docs = [(i, "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 900))) + passage[rng.randint(0, 60):]
             + "xy" * rng.randint(0, 120)) for i in range(25)] + [(50, passage * 4), (51, "z" * 99), (52, "z" * 100), (53, "z" * 101)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    cut = suffix_dedup.cut_text(frame)
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), r.sha) for r in
           cut.withColumn("sha", F.sha2("kept", 256)).collect()}
    assert got == brute.cut(docs)


def test_passages_odd_rows(odd, none):
    rows = suffix_dedup.cut_text(odd).collect()
    assert len(rows) == len(ODD)
    want = brute.cut(NAMED)
    assert all((r.n_bytes, r.n_bytes - len(r.kept), len(r.spans)) == want[r.doc_id][:3] for r in rows if r.doc_id is not None)
    assert all(not r.spans for r in rows if r.doc_id is None)
    assert suffix_dedup.cut_text(none).count() == 0


def test_family_levels_grow_geometrically():
    family, rng, seen = suffix_dedup.Family(), np.random.default_rng(1), set()
    for _ in range(40):
        keys = rng.integers(0, 3000, 200).astype(np.uint64)
        want = []
        for k in keys.tolist():
            want.append(k in seen)
            seen.add(k)
        assert family.add(keys, keys * np.uint64(3)).tolist() == want
    sizes = [len(k) for k, _ in family.levels]
    assert len(sizes) <= 8 and all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    assert not family.add(keys[:5], keys[:5]).any()  # equal keys whose second fingerprints differ
