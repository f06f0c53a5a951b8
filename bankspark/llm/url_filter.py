"""URL filter: host and path rules first, then naive Bayes on segmented host and path tokens.

1. ``split_urls`` takes host and path from each url.
2. ``apply_rules`` finds the longest rule that fits the host or a parent domain and the start of the path.
3. Host labels such as ``freebets`` are split into words by unigram Viterbi.  The word counts come from a
   whole text column; only words that occur inside some label are kept, found by joining all substrings
   (up to ``HEAD`` letters) of the distinct labels with the counts, longer words by their first ``HEAD`` letters.
4. Multinomial naive Bayes scores every row's segmented host words and path tokens.  It is trained on the rows that a
   rule decides, which are labelled examples of both classes, but for a held-out share by which its accuracy can
   be told; each seed word counts as ``SEED_WEIGHT`` further occurrences in blocked hosts.  A row without a rule is blocked if its
   log odds are above 0.  Tokens are hashed into ``BUCKETS`` slots: the model that every task holds has a fixed size
   (one double per slot, 512 kB) whatever the vocabulary.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is judged by
the class prior; ties between equally long rules go to allow; if no rule decides a row, the seed words alone judge; repeated rows get equal results; an empty table gives an empty result; a null word
text adds no words; further columns of the input are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column
from bankspark.session import written

HEAD = 20  # letters by which words meet the labels
BUCKETS = 1 << 16
SMOOTHING = 1.0
SEED_WEIGHT = 5    # occurrences in blocked hosts that a seed word stands for
HELD_OUT = 5       # a row is not learnt from if this divides the crc32 of its id
#: Host words that are known to speak for block.
SEED_WORDS = ("adult", "ads", "bet", "bets", "casino", "gambling", "malware", "phishing", "pills", "poker", "porn",
              "scam", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "xxx")


def split_urls(url: Column) -> tuple[Column, Column]:
    """(host, path): host in ASCII lower case after the first ``://``; path up to ``?`` or ``#``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; rules are (verdict, ``host/path``)."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in reversed(ordered):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_labels(host: Column) -> Column:
    """Letter runs of a host, in order."""
    return F.filter(F.split(host, r"[^\p{L}]+"), lambda x: x != "")


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n): lower-case letter runs of the whole column, markup removed."""
    plain = F.lower(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"<[^>]*>", " "))
    return (texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
            .filter(F.col("word") != "")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """Most likely split of ``label`` under word probabilities n / total; unknown words pay by length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    sizes = sorted({len(w) for w in counts})
    new = 0  # where the best unknown word begins
    for end in range(1, len(label) + 1):
        if best[end - 1][0] + 2.5 * (end - 1) >= best[new][0] + 2.5 * new:
            new = end - 1
        options = [(best[new][0] + math.log(1 / total) - 2.5 * (end - new), new - end, new)]
        for size in sizes:
            if size > end:
                break
            n = counts.get(label[end - size:end])
            if n:
                options.append((best[end - size][0] + math.log(n / total), -size, end - size))
        score, _, start = max(options)
        best.append((score, start))
    words, end = [], len(label)
    while end:
        words.append(label[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def segmented_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) for a column of distinct labels."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    starts = F.sequence(F.lit(1), F.length("label"))
    parts = labels.select("label", F.explode(F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(HEAD), F.length("label") - i + 1)),
        lambda n: F.substring(F.col("label"), i, n))))).alias("word"))
    parts = parts.distinct()
    heads = parts.filter(F.length("word") == HEAD).withColumnRenamed("word", "head")
    longer = counts.filter(F.length("word") > HEAD).withColumn("head", F.substring("word", 1, HEAD))
    longer = heads.join(longer, "head").filter(F.col("label").contains(F.col("word"))).select("label", "word", "n")
    known = (parts.join(counts, "word").select("label", "word", "n").unionByName(longer).groupBy("label")
             .agg(F.collect_list(F.struct("word", "n")).alias("known")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, found = column(b, "label").to_pylist(), column(b, "known").to_pylist()
            words = [segment(x, {w["word"]: w["n"] for w in k or []}, total) for x, k in zip(names, found)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))],
                                             ["label", "words"])

    return labels.join(known, "label", "left").mapInArrow(run, "label string, words array<string>")


def _slots(words: Column, path: Column) -> Column:
    """Distinct hash slots of the host words and of the path tokens (digit runs count as one token), so that one
    very long url does not outweigh the rest."""
    path_tokens = F.filter(F.split(F.regexp_replace(F.lower(path), r"\d+", "#"), r"[^\p{L}#]+"), lambda x: x != "")
    tokens = F.concat(F.transform(words, lambda w: F.concat(F.lit("h "), w)),
                      F.transform(path_tokens, lambda w: F.concat(F.lit("p "), w)))
    return F.array_distinct(F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int")))


def bayes_weights(rows: DataFrame, seeds: list[int]) -> tuple[float, np.ndarray]:
    """(prior, weight per slot): log odds of block, from rows (slots, block) and seed slots; at most 2 x BUCKETS counts."""
    n = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}
    table = np.zeros((2, BUCKETS))
    np.add.at(table[1], seeds, SEED_WEIGHT)
    for r in rows.select("block", F.explode("slots").alias("slot")).groupBy("block", "slot").count().collect():
        table[int(r["block"]), r["slot"]] += r["count"]
    seen = table.sum(axis=0) > 0
    logs = np.log((table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * seen.sum()))
    return math.log((n.get(True, 0) + SMOOTHING) / (n.get(False, 0) + SMOOTHING)), np.where(seen, logs[1] - logs[0], 0.0)


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               word_col: str = "html", seeds: tuple[str, ...] = SEED_WORDS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, host_words, block_score (log odds of the method)."""
    host, path = split_urls(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    rows = written(rows.select("*", rule.alias("rule"), verdict.alias("ruled")), "urls")

    hosts = written(rows.select("host").distinct(), "hosts")
    labels = written(hosts.select(F.explode(host_labels(F.col("host"))).alias("label")).distinct(), "labels")
    spark = pages.sparkSession
    counts = written(word_counts(pages, word_col), "words")
    words = written(segmented_labels(labels, counts), "segments")
    by_host = written(
        hosts.select("host", F.posexplode_outer(host_labels(F.col("host"))).alias("at", "label"))
        .join(words, "label", "left").groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
        .select(F.col("host").alias("of_host"), F.flatten(F.transform("parts", lambda p: F.coalesce(
            p["words"], F.array().cast("array<string>")))).alias("host_words")), "host-words")
    rows = written(rows.join(by_host, rows["host"] == by_host["of_host"])
                   .select("page_id", "host", "path", "rule", "ruled", "host_words",
                           _slots(F.col("host_words"), F.col("path")).alias("slots")), "scored")
    seed_slots = spark.createDataFrame([([w], "") for w in seeds], "words array<string>, path string")
    seed_slots = [r[0][0] for r in seed_slots.select(_slots(F.col("words"), F.col("path"))).collect()]
    learnt = rows.filter("ruled is not null").filter(F.coalesce(F.crc32(F.col("page_id").cast("string").cast("binary")) % HELD_OUT != 0, F.lit(True)))
    prior, weights = bayes_weights(learnt.select((F.col("ruled") == "block").alias("block"), "slots"), seed_slots)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = column(b, "slots")
            ends = np.asarray(slots.offsets) - slots.offsets[0].as_py()
            sums = np.concatenate([[0.0], np.cumsum(weights[np.asarray(slots.flatten())])])
            odds = prior + np.round(sums[ends[1:]] - sums[ends[:-1]], 9)
            keep = [n for n in b.schema.names if n != "slots"]
            yield pa.RecordBatch.from_arrays([column(b, n) for n in keep] + [pa.array(odds)], [*keep, "block_score"])

    scored = rows.mapInArrow(score, "page_id long, host string, path string, rule string, ruled string, "
                                    "host_words array<string>, block_score double")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("block_score") > 0, "block").otherwise("allow"))
                         .alias("verdict"), "host_words", "block_score")
