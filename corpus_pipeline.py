"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is written as
Parquet in the shared folder and read again as the next stage's documents.  All stages but the last return
the columns of their input, whatever further columns it has.

A row without doc_id passes the stages that compare documents.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark.llm import bpe, decontaminate, exact_dedup, minhash, quality
from bankspark.llm.queries import quality_model, vocabulary_path
from bankspark.session import written


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in ``ids`` (one column)."""
    gone = written(ids.toDF("gone").filter("gone is not null").distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score from the threshold on)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    places = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(docs.columns)}
    scored = quality.score(docs, quality_model(docs, labels), places, text_name=f"c{docs.columns.index('text')}")
    return scored.filter("predicted = 1").select(*places).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return exact_dedup.keep_one_copy(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (five-word shingles, similarity 0.8)."""
    found = minhash.near_duplicates(docs, words=5, percent=80)
    return _without(docs, found.filter("not kept").select("doc_id"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoding, and the ids of each document."""
    return bpe.encode_decode(docs, vocabulary_path(), {"doc_id": F.col("doc_id")}, with_ids=True)


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_copies), ("near-duplicates", near_copies),
          ("benchmark decontamination", benchmark_leaks), ("bpe", tokens)]

#: SQL cannot express the classifier, the component search or the tokenizer; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
