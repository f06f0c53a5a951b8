import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from bankspark.llm import compression, decontaminate, language_id, quality, queries, url_filter
from tests.llm import brute
from tests.llm.conftest import ODD

SF01 = "/root/testdata/sf0.01"


# languages

def test_language_query_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in brute.rows("documents", SF01)}
    rows = queries.op6_language_id(spark, SF01).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def plain_dictionaries(samples):
    joined = {k: b"".join(t.encode() + b"\n" for x, t in samples if x == k) for k in {k for k, _ in samples}}
    size = min(compression.DICT_BYTES, max(compression.LEAST_BYTES, min(map(len, joined.values()))))
    return {k: v[:size] for k, v in joined.items()}


def test_language_query_equals_plain_version(spark):
    docs = brute.rows("documents")
    known = [(r["doc_id"], r["lang"], r["text"]) for r in docs
             if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None and r["text"] is not None]
    samples = brute.class_samples(known, compression.DICT_ROWS, 6, compression.PIECE_CHARS, compression.DICT_BYTES)
    books = plain_dictionaries([(k, t.lower()) for k, t in samples])
    count = Counter(k for _, k, _ in known)
    got = {r.doc_id: r for r in queries.op6_language_id(spark, brute.SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        data = (r["text"] or "").lower().encode()
        sizes = {k: brute.coded_size(data, books[k], compression.BLOCK_BYTES) for k in books}
        best = min(books, key=lambda k: (sizes[k], -count[k], k))
        if any(c.isalpha() for c in r["text"] or ""):
            score = 1 / sum(np.exp((sizes[best] - n) / language_id.SCALE) for n in sizes.values())
            assert got[r["doc_id"]].lang_pred == best and abs(got[r["doc_id"]].score - score) < 1e-9
        else:
            assert (got[r["doc_id"]].lang_pred, got[r["doc_id"]].score) == ("und", 0.0)


def test_letters_are_letters_by_category(spark):
    model = [("en", b"the same words in one line of text here " * 20), ("fr", "le la les d\u00e9j\u00e0 ".encode() * 20)]
    texts = [(1, "\u00bd"), (2, "\u00b2 \u2460"), (3, "12"), (4, "\u65e5"), (5, "12 a"), (6, "_ \u2167")]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(texts, "doc_id long, text string"), model,
                                                               {"doc_id": F.col("doc_id")}).collect()}
    assert [got[i] == "und" for i in range(1, 7)] == [True, True, True, False, False, True]


def test_language_odd_rows(odd, none):
    model = [("en", b"the same words in one line of text here " * 20), ("fr", "le la les d\u00e9j\u00e0 \u00e9t\u00e9 ".encode() * 20)]
    rows = language_id.identify(odd, model, {"doc_id": odd["doc_id"], "n": odd["n"]}).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3)) and by[12].lang_pred == "en"
    assert all(r.lang in (r.lang_pred, "und") for r in rows)
    assert language_id.identify(none, model, {"doc_id": none["doc_id"]}).count() == 0
    untrained = language_id.train(none.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text"))
    assert untrained == [] and language_id.identify(odd, [], {"doc_id": odd["doc_id"]}).first().lang_pred == "und"


def test_language_ties_go_to_the_first():
    same = [("b", b"abc"), ("a", b"abc")]
    coders = [(n, language_id.Coder(d)) for n, d in same]
    assert language_id._judge("hello", coders, 0.01)[0] == "b"
    assert language_id._judge("hello", coders, 0.01)[3] == "und"  # no margin


# quality

def test_quality_query_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["quality"] for r in brute.rows("labels", SF01)}
    rows = queries.op8_quality(spark, SF01).collect()
    assert len(rows) == len(brute.rows("documents", SF01))
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9


def test_quality_query_equals_plain_version(spark):
    """Dictionaries, differences and scores anew; the curve's two numbers must be where the weighted log loss has no slope."""
    docs = {r["doc_id"]: r["text"] for r in brute.rows("documents")}
    known = [(r["doc_id"], r["quality"], docs.get(r["doc_id"])) for r in brute.rows("labels")
             if r["doc_id"] in docs and r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0]
    half = [[r for r in known if brute.id_hash(r[0], 80) % 2 == side] for side in (0, 1)]
    pieces = brute.class_samples(half[0], compression.DICT_ROWS, 8, compression.PIECE_CHARS, compression.DICT_BYTES)
    books = plain_dictionaries([(k, quality.marked(t)) for k, t in pieces])

    def value(text):
        b, g = (brute.coded_size(quality.marked(text or "").encode(), books[k], quality.BLOCK_BYTES) for k in (0, 1))
        return (b - g) / (b + g)

    model = queries.quality_model(spark.read.parquet(f"{brute.SF}/documents.parquet"),
                                  spark.read.parquet(f"{brute.SF}/labels.parquet"))
    assert model.dictionaries == books
    fit = brute.class_samples(half[1], quality.FIT_ROWS, 81, compression.PIECE_CHARS * 20, compression.DICT_BYTES)
    y, x = np.array([k for k, _ in fit]), np.array([value(t) for _, t in fit])
    total = Counter(k for _, k, _ in known)
    weight = np.where(y == 1, total[1] / (y == 1).sum(), total[0] / (y == 0).sum())
    weight /= weight.mean()
    miss = weight * (y - 1 / (1 + np.exp(-(model.slope * x + model.intercept))))
    scale = x.std()
    assert abs((miss * x / scale).sum() - 1e-3 * model.slope * scale) < 1e-4 and abs(miss.sum() - 1e-3 * model.intercept) < 1e-4
    for r in queries.op8_quality(spark, brute.SF).collect():
        want = 1 / (1 + np.exp(-(model.slope * value(docs[r.doc_id]) + model.intercept)))
        assert abs(r.score - want) < 1e-9 and r.predicted == int(want >= 0.3)


def test_quality_marks():
    assert quality.marked("It It It is OK ok OK") == "It \x011 \x012 is \x02ok ok \x02ok"
    assert quality.marked("") == ""


def test_quality_odd_rows_and_labels(spark, odd, none):
    texts = odd.select(F.col("doc_id").alias("id"), "text")
    none_labels = spark.createDataFrame([], "id long, label int")
    for labels, score in ((none_labels, 0.5), (spark.createDataFrame([(4, 1), (None, 0), (5, None)], "id long, label int"), 1.0),
                          (spark.createDataFrame([(4, 0)], "id long, label int"), 0.0)):
        rows = quality.score(odd, quality.train(labels, texts), {"doc_id": F.col("doc_id")}).collect()
        assert len(rows) == len(ODD) and {r.score for r in rows} == {score}
    both = spark.createDataFrame([(4, 1), (5, 1), (8, 0), (9, 0), (4, 0), (11, 1), (10, 0)], "id long, label int")
    model = quality.train(both, texts)
    rows = quality.score(odd, model, {"doc_id": F.col("doc_id")}).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(ODD) and by[1] == by[2] and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(none, model, {"doc_id": F.col("doc_id")}).count() == 0


def test_logistic_fit_separates():
    x = np.array([-2, -1.5, -1, -0.2, 0.1, 1, 1.5, 2.0])
    slope, intercept = quality.fit_logistic(x, (x > 0).astype(float), np.ones(8))
    assert slope > 0 and abs(intercept) < 2


# decontamination

ITEMS = [(1, "What is the tall tower by the old river gate called? The answer is the Lantern of Saint Orsola."),
         (2, "Name the capital city of the northern province. Answer: Ullmarstad on the lake."),
         (3, None), (None, "What is the tall tower"), (4, "tiny item"), (5, "Name the capital city of the northern province. "
                                                                         "Answer: Ullmarstad on the lake.")]


def test_wand_equals_exhaustive_search():
    rows = [(r["item_id"], r["text"]) for r in brute.rows("benchmark", SF01)]
    words, first = decontaminate.words_of(pa.array([t for _, t in rows]))
    index = decontaminate.Index([(i, words[a:b]) for (i, _), a, b in zip(rows, first[:-1], first[1:])])
    impacts: dict = {}
    for t, (items, scores) in enumerate(zip(index.items, index.impacts)):
        for n, s in zip(items, scores):
            impacts.setdefault(n, {})[t] = s
    rng = np.random.default_rng(7)
    for floor in (0.02, 0.1, 0.3, 0.6):
        index.floor = floor
        for k in range(60):
            query = sorted(set(rng.choice(len(index.terms), 40).tolist()) | set(list(impacts[k % len(impacts)])[:15]))
            want = {n: sum(m.get(t, 0) for t in query) for n, m in impacts.items()}
            want = {n: s for n, s in want.items() if s >= floor}
            got = dict(index.search(query))
            assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-9 for n in got)


def test_leaks_query_finds_every_verbatim_item(spark):
    items = {r["item_id"]: r["text"] for r in brute.rows("benchmark", SF01)}
    want = {(r["doc_id"], i) for r in brute.rows("documents", SF01) for i, t in items.items() if t in (r["text"] or "")}
    assert want and {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, SF01).collect()} == want


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_leaks_need_question_and_answer(spark, shard_bytes):
    filler = "nothing to see in these plain words of filler text " * 30
    question = ITEMS[0][1].split("?")[0]
    docs = [(1, filler + ITEMS[0][1].upper() + filler), (2, filler + question + filler), (3, ITEMS[1][1].replace(" ", "\n")),
            (4, filler), (5, "so a Tiny, item!"), (6, None), (7, ""), (7, ""), (None, ITEMS[0][1])]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(ITEMS, "item_id long, text string"), shard_bytes=shard_bytes)
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert pairs == {(1, 1), (3, 2), (3, 5), (5, 4), (None, 1)}


def test_leaks_do_not_depend_on_shards(spark):
    rng = random.Random(11)
    common = [f"word{k}" for k in range(60)]
    items, docs = [(100, None), (101, " .. ")], []
    for i in range(40):
        words = [rng.choice(common[:10 + 50 * (k % 2)]) for k in range(rng.randint(12, 60))]
        for _ in range(len(words) // 5):
            words[rng.randrange(len(words))] = f"name{rng.randrange(50)}"
        items.append((i, " ".join(words)))
        for changed in range(1, 7):  # an altered copy keeps whole runs of words
            at = rng.randrange(len(words) - changed)
            copy = words[:at] + [f"other{k}" for k in range(changed)] + words[at + changed:]
            docs.append((len(docs), " ".join(rng.choices(common, k=90) + copy + rng.choices(common, k=90))))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, cut = (sorted(map(tuple, decontaminate.leaks(docs, items, shard_bytes=n).collect())) for n in (1 << 20, 1000))
    assert len(whole) > 40 and cut == whole


def test_leaks_odd_rows(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.leaks(odd, items).count() == 0
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(odd, items.limit(0)).count() == 0


# urls

def rule_of(host, path):
    best = None
    for verdict, text in queries.URL_RULES:
        domain, _, rest = text.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (
                best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    return brute.lower(host), re.match(r"[^?#]*", rest[len(host):]).group()


def test_url_query_matches_plain_rules(spark):
    urls = {r["page_id"]: r["url"] for r in brute.rows("pages", SF01)}
    rows = queries.op10_url_filter(spark, SF01).collect()
    assert {r.page_id for r in rows} == set(urls) and len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id])
        best = rule_of(r.host, r.path)
        assert r.rule == (best[0] if best else None) and r.verdict == (best[1] if best else r.verdict)
        if not best:
            assert r.verdict == ("block" if r.block_score > 0 else "allow"), r
    # the scores written out, and the accuracy on the rule-decided pages that were not learnt from
    want = plain_scores([(r.page_id, r.host_words, r.path, (rule_of(r.host, r.path) or [None, None])[1]) for r in rows])
    assert all(abs(r.block_score - want[r.page_id]) < 1e-6 for r in rows)
    held = [r for r in rows if r.rule and zlib.crc32(str(r.page_id).encode()) % 5 == 0]
    assert len(held) > 15 and np.mean([(r.block_score > 0) == (r.verdict == "block") for r in held]) > 0.8


def tokens_of(words, path):
    path = re.sub(r"\d+", "#", path.lower())
    return [f"h {w}" for w in words] + [f"p {t}" for t in regex.split(r"[^\p{L}#]+", path) if t]


def plain_scores(rows):
    """Naive Bayes by Counter: rows (id, host words, path, rule's verdict or None)."""
    slot = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) % url_filter.BUCKETS  # noqa: E731  two's complement: the size divides 2^64
    counts, classes = {True: Counter(), False: Counter()}, Counter()
    for w in url_filter.SEED_WORDS:
        counts[True][slot(f"h {w}")] += url_filter.SEED_WEIGHT
    for i, words, path, rule in rows:
        if rule and zlib.crc32(str(i).encode()) % 5:
            classes[rule == "block"] += 1
            counts[rule == "block"].update({slot(t) for t in tokens_of(words, path)})
    vocabulary = len(set(counts[True]) | set(counts[False]))
    total = {c: sum(counts[c].values()) + vocabulary for c in counts}
    out = {}
    for i, words, path, _ in rows:
        odds = np.log((classes[True] + 1) / (classes[False] + 1))
        for s in {slot(t) for t in tokens_of(words, path)}:
            if counts[True][s] or counts[False][s]:
                odds += np.log((counts[True][s] + 1) / total[True]) - np.log((counts[False][s] + 1) / total[False])
        out[i] = odds
    return out


def test_url_verdicts_follow_the_rules_examples(spark):
    """Words that go along with blocked or allowed pages decide, also against and without seed words."""
    urls = [f"http://{w}.shop.net/es/{i}" for i, w in enumerate(["zork", "blip"] * 20)] + \
           [f"http://{w}.shop.com/de/{i}" for i, w in enumerate(["garden", "casino"] * 20)] + \
           ["http://zork.example.org/x", "http://garden.example.org/x", "http://casino.example.org/x", "http://poker.example.org/x"]
    pages = spark.createDataFrame([(i, u, "<p>zork blip garden casino poker shop example</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in url_filter.url_filter(pages, queries.URL_RULES).collect()}
    assert all(rows[i].verdict == ("block" if i < 40 else "allow") for i in range(80))
    # casino: a seed word, but the rules' pages speak for it; zork is none, and they speak against it
    assert [rows[i].verdict for i in range(80, 84)] == ["block", "allow", "allow", "block"]


def test_url_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com?q=/en/", "http://a.net/es/1#/fr/",
            "http://freebets.example.org/a", "http://\u00e9t\u00e9.org/x", "x://y://z/w", "http://" + "ab" * 3000 + ".org/" + "c" * 5000,
            "http://casino.example.org/", "http://plain.example.org/", "http://plain.example.org/"] + [
        f"http://{x}.example.org/" for x in ("garden", "river", "stone", "cloud", "meadow", "harbour")]
    pages = spark.createDataFrame([(i, u, "<p>free bets ab</p>" if i % 2 else None, "h", "r") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string, rule string")
    rows = {r.page_id: r for r in url_filter.url_filter(pages, queries.URL_RULES).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        assert (rows[i].host, rows[i].path) == split(u)
    assert rows[4].rule == "www.example.com/en/" and rows[6].rule == "net/es/" and rows[5].rule is None
    assert rows[7].host_words[:2] == ["free", "bets"] and rows[7].block_score > rows[12].block_score and rows[12].verdict == "allow"
    assert url_filter.url_filter(pages.limit(0), queries.URL_RULES).count() == 0


def test_long_words_split_labels(spark):
    long, longer = "versicherungsgesellschaften", "versicherungsgesellschaftenrecht"
    texts = spark.createDataFrame([(f"meine {long} {long} {longer} online online",)], "text string")
    labels = spark.createDataFrame([("meine" + long + "online",), (long,), (longer,), ("online" + "q" * 45,)], "label string")
    got = {r.label: r.words for r in url_filter.segmented_labels(labels, url_filter.word_counts(texts, "text")).collect()}
    assert got == {"meine" + long + "online": ["meine", long, "online"], long: [long], longer: [longer],
                   "online" + "q" * 45: ["online", "q" * 45]}


def test_segmentation_is_the_most_likely_split():
    counts = Counter({"free": 50, "bets": 40, "be": 60, "ts": 1, "freebe": 1})
    assert url_filter.segment("freebets", counts, 200) == ["free", "bets"]
    assert url_filter.segment("", counts, 200) == [] and "".join(url_filter.segment("qqzz", counts, 200)) == "qqzz"
